"""Spelling variants: exact one-edit neighbours through a dictionary of trie-node pairs.

Every distinct prefix of the words is a node of the forward trie and every
distinct suffix a node of the reversed trie; both are numbered once (a written
table, so numbers do not change when a task is run again).  A word ``w`` of
length L then stands for L + 1 *splits* ``(node(w[:i]), node(w[i:]))`` and L
*gaps* ``(node(w[:i]), node(w[i+1:]))``, pairs of integers.  Two words are one
edit apart exactly when

* a gap of the longer equals a split of the shorter (one inserted or deleted
  code point), or
* a gap of one equals a gap of the other (one replaced code point),

so one grouping by integer pairs finds every neighbour and nothing else: two
nodes fix the prefix and suffix strings.  All words that share a pair differ in
one code point only, so a pair holds at most as many words as the alphabet has
letters (90 here): no group grows with the data.

All of it is DataFrame code; word counting is a partial aggregation, so a very
common word costs one row per task.  Chains of forms are followed by pointer
doubling, each round written to the shared folder.

Defined cases: a missing text has no runs; a missing ``doc_id`` is written as
the empty string in ``<doc_id>:<run>``; repeated rows count again; ties of
``n`` go to the smallest word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import parked, table

#: fixed values of the contract
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST_COUNT, FACTOR, MODULUS = 7, 2, 10, 31


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: runs after lower-casing A-Z and the planted deletion, kept with 7+ code points and 2+ occurrences."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(RUN), 0)).alias("run"),
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    cut = runs.select(
        "run", F.char_length("run").alias("size"), F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h")
    ).select(
        F.when(
            F.col("h") % MODULUS == 0,
            F.expr("concat(substring(run, 1, cast(h % size as int)), substring(run, cast(h % size as int) + 2))"),
        )
        .otherwise(F.col("run"))
        .alias("word")
    )
    return cut.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def numbered(strings: DataFrame, name: str) -> DataFrame:
    """Distinct strings of column ``s`` with a number each, written once."""
    return parked(strings.distinct().select("s", F.monotonically_increasing_id().alias("node")), name)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: both orders of every pair of words one insertion, deletion or replacement apart.

    ``words`` holds distinct words with a number ``wid``.  Places carry numbers
    only: per word, the node pairs of its splits and gaps, from one grouping by
    word.  One grouping by node pair then meets all words sharing a pair; a
    group holds at most one split (the pair spells that word) and at most 90
    gaps (words differing in that place only).
    """
    places = words.select("wid", "word", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("i")).select(
        "wid", "i", F.expr("substring(word, 1, i)").alias("prefix"), F.expr("substring(word, i + 1)").alias("suffix")
    )
    forward = numbered(places.select(F.col("prefix").alias("s")), "trie-forward")
    backward = numbered(places.select(F.col("suffix").alias("s")), "trie-backward")
    nodes = (
        places.join(forward.withColumnRenamed("s", "prefix").withColumnRenamed("node", "p"), "prefix")
        .join(backward.withColumnRenamed("s", "suffix").withColumnRenamed("node", "q"), "suffix")
        .groupBy("wid")
        .agg(F.array_sort(F.collect_list(F.struct("i", "p", "q"))).alias("at"))
    )
    # splits (p[i], q[i]) for i in 0..L; gaps (p[i], q[i + 1]) for i in 0..L-1
    pairs = nodes.select(
        "wid",
        F.explode(
            F.concat(
                F.transform("at", lambda x: F.struct(F.lit(True).alias("split"), x["p"].alias("p"), x["q"].alias("q"))),
                F.transform(
                    F.slice("at", 1, F.size("at") - 1),
                    lambda x, j: F.struct(F.lit(False).alias("split"), x["p"].alias("p"), F.element_at("at", j + 2)["q"].alias("q")),
                ),
            )
        ).alias("k"),
    ).select("wid", "k.split", "k.p", "k.q")
    met = parked(
        pairs.groupBy("p", "q").agg(F.collect_list(F.struct("split", "wid")).alias("m")).where(F.size("m") >= 2).select("m"),
        "trie-met",
    )
    gaps = F.filter("m", lambda x: ~x["split"])
    split = F.filter("m", lambda x: x["split"])
    # a gap word against the split word (one code point more), and gap words against each other (one replaced)
    inserted = met.select(F.explode(gaps).alias("a"), F.try_element_at(split, F.lit(1)).alias("b")).where(F.col("b").isNotNull())
    replaced = met.select(gaps.alias("g")).select(F.explode("g").alias("a"), "g").select("a", F.explode("g").alias("b")).where(
        F.col("a.wid") < F.col("b.wid")
    )
    one_way = inserted.select(F.col("a.wid").alias("x"), F.col("b.wid").alias("y")).unionByName(
        replaced.select(F.col("a.wid").alias("x"), F.col("b.wid").alias("y"))
    )
    ids = one_way.unionByName(one_way.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    named = words.select("wid", "word")
    return ids.join(named.withColumnRenamed("wid", "x"), "x").join(
        named.withColumnRenamed("wid", "y").withColumnRenamed("word", "near"), "y"
    ).select("word", "near")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by pointer doubling over ``word, form`` (form null at a root); forms only rise in n, so chains end."""
    pointers = parked(forms.select("word", F.col("form").alias("to")), "forms-0")
    step = 0
    while True:
        step += 1
        ahead = pointers.select(F.col("word").alias("to"), F.col("to").alias("further"))
        moved = pointers.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved"))
        moved = parked(moved, f"forms-{step}")
        pointers = moved.select("word", "to")
        if not moved.where("moved").limit(1).count():
            return pointers.select("word", F.coalesce("to", "word").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every counted word of the texts."""
    words = parked(word_counts(docs).withColumn("wid", F.monotonically_increasing_id()), "spelling-words")
    near = neighbours(words.select("wid", "word"))
    rated = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = rated.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    )
    forms = words.drop("wid").join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.m") >= FACTOR * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.m") >= FACTOR * F.col("n"), -F.col("best.m")).alias("form_n"),
    )
    forms = parked(forms, "spelling-forms")
    return forms.join(roots(forms.select("word", "form")), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", F.col("form_n").cast("long").alias("form_n")
    )


def op12_spelling_variants(spark, folder: str) -> DataFrame:
    """Spelling variants of the words of every whole text of ``documents``."""
    return variants(table(spark, folder, "documents"))
