"""Phrase collocations against their SQL twin, run by DuckDB on the same rows."""

import random

import duckdb
import pandas as pd

from tallywick.llm import collocations


def twin(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang"]))
    return sorted(con.sql(collocations.ORACLE).fetchall())


def corpus():
    rng = random.Random(11)
    common = ["new york city", "New York", "of the", "big data engine", "on the other hand", "zürich straße"]
    filler = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(900):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(common) if rng.random() < 0.3 else " ".join(rng.choices(filler, k=rng.randint(1, 4))))
        text = rng.choice([". ", " ", ", ", "\n", "\t", "; "]).join(parts)
        rows.append((i, text if i % 50 else None, rng.choice(["en", "de", None])))
    rows += [(5, "new york city new york city", "en")] * 3 + [(None, "", "en")]
    return rows


def test_equal_to_the_sql_twin(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    assert got == twin(rows)
    assert len({r[0] for r in got}) == 3 and len(got) > 10


def test_top_and_edges(spark, edge_docs, no_docs):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = collocations.collocations(docs, top=2).collect()
    assert sorted(r["rank"] for r in got) == [1, 1, 1, 2, 2, 2]
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(edge_docs.withColumn("lang", edge_docs["id"])).count() >= 0


def test_occurrences_of_rare_phrases_are_never_written(spark, monkeypatch):
    """2,000 texts of frequent words in any order: no phrase is frequent, so no place is written."""
    rng, written, parked = random.Random(4), [], collocations.parked
    words = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join(rng.choices(words, k=20)) + ".A\tlast phrase", "en") for i in range(2000)]

    def recorded(df, name):
        out = parked(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(collocations, "parked", recorded)
    got = sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == twin(rows) and got
    assert sum(written) < 10_000  # the 2,000 places of one phrase, words and phrases; 46,000 places are read


def test_words_never_share_a_number(spark, monkeypatch):
    numbered, seeds = collocations.word_number, []

    def clashing(lang, word, seed):
        seeds.append(seed)
        return numbered(lang, word, seed) % 10 if seed < 2 else numbered(lang, word, seed)

    monkeypatch.setattr(collocations, "word_number", clashing)
    rows = corpus()
    got = sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == twin(rows) and 2 in seeds and 3 not in seeds
