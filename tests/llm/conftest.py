import pytest

#: a missing text, a missing id, empty and blank texts, copies, repeated rows, a near copy, a long text
LONG = " ".join(f"word{i % 977} item{i % 613}" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
ROWS = [
    (1, None), (2, ""), (3, "   \n\n"), (4, BASE), (5, BASE), (6, BASE + " tail"), (7, LONG), (7, LONG), (8, "one"), (9, "É ß 漢字 İ"),
    (None, BASE + " other words here"), (None, None), (10, "Mixed CASE words, and MIT License text\nMIT License again"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge rows with extra columns whose names operators use inside."""
    rows = [(i, t, "x", 1, 2.5, [1]) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n int, value double, words array<int>").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
