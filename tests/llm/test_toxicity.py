"""Toxicity: the Spark scores equal the softmax read directly; edge rows; held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

from tallywick.llm import toxicity
from tests.llm.conftest import ROWS

BAD = ["idiot", "moron", "clown", "worthless"]


def corpus(n=1500):
    rng = np.random.default_rng(1)
    filler = [f"w{i}x" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(filler, 40))
        toxic = i % 4 == 0
        if toxic:
            words[5] = BAD[i % 4 // 1 % len(BAD)] if i % 8 else "idiots"
            words[20] = BAD[(i // 4) % len(BAD)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 0))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    return docs, toxicity.trained(docs, marks)


def test_spark_scores_equal_the_softmax_and_misspellings_share_pieces(spark, fitted):
    docs, model = fitted
    texts = ["w1x w2x idiot w3x", "w1x w2x w3x w4x", "w1x w2x idiiot w3x", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.scored(frame, model).collect()}
    for i, text in enumerate(texts):
        assert got[i]["score"] == pytest.approx(model.score(text), abs=1e-5)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[0]["score"] > got[1]["score"]
    assert got[2]["score"] > got[1]["score"]  # unseen misspelling
    assert got[3]["score"] == got[4]["score"] == pytest.approx(1 / (1 + math.exp(-model.offset)))


def test_held_out_rows_are_scored_right(spark, fitted):
    docs, model = fitted
    out = toxicity.scored(docs, model).collect()
    held = [r for r in out if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert held and right / len(held) >= 0.9


def test_edge_rows_and_labels(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 1), (5, 0, 1), (None, 1, 1), (10, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.trained(edge_docs, labels)
    out = toxicity.scored(edge_docs, model).collect()
    assert len(out) == len(ROWS)
    assert all(0.0 <= r["score"] <= 1.0 for r in out)
    assert [r for r in out if r["doc_id"] is None and r["held_out"]] == []
    assert toxicity.scored(no_docs, toxicity.trained(no_docs, labels.limit(0))).count() == 0
    constant = toxicity.trained(edge_docs, labels.where("toxic = 0"))
    assert all(r["score"] < 1e-5 for r in toxicity.scored(edge_docs, constant).collect())
