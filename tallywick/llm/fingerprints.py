"""SimHash fingerprints of documents and the search for near ones, in SQL functions only.

The terms of a text are its pairs of neighbouring words; each occurrence of a
term votes with the 64 bits of its hash, so a term weighs as often as it occurs.
Votes are counted three bits to a number, 21 bits apart, in one aggregation that
is combined where the text is read.  Near fingerprints meet in block tables: the
64 bits are cut in ``radius + 3`` blocks, and two fingerprints within the radius
agree on at least three of them, so they share a row in one of the tables.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywick.llm.common import parked, table

RADIUS = 3
LANES = (0, 21, 42)
#: terms counted together: a lane of 21 bits cannot run over
CHUNK_BITS = 20
#: rows of a range while documents are put in order
RANGE_ROWS = 100_000


def fingerprints(bodies: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., fingerprint`` (long) of ``bodies(keys..., body)``."""
    words = bodies.select(*keys, F.split(F.translate("body", "\n\t\r", "   "), " ").alias("w"))
    exploded = words.select(*keys, F.posexplode(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, size(w))").alias("b"))).alias("at", "t"))
    hashed = exploded.select(*keys, F.shiftright("at", CHUNK_BITS).alias("chunk"), F.xxhash64("t.a", "t.b").alias("term"))
    mask = sum(1 << lane for lane in LANES)
    sums = [F.sum(F.shiftrightunsigned("term", j).bitwiseAND(F.lit(mask))).alias(f"s{j}") for j in range(21)]
    top = F.sum(F.shiftrightunsigned("term", 63)).alias("s63")
    counted = hashed.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"), top, *sums)
    lane = F.lit((1 << 21) - 1)
    bits = [F.shiftrightunsigned(f"s{b % 21}", 21 * (b // 21)).bitwiseAND(lane) if b < 63 else F.col("s63") for b in range(64)]
    votes = counted.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(x).alias(f"b{b}") for b, x in enumerate(bits)])
    value = " | ".join(f"shiftleft(cast(2 * b{b} > n as bigint), {b})" for b in range(64))
    return votes.select(*keys, F.expr(value).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def near_pairs(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a < b`` of all different values of ``fps(fingerprint)`` within the radius.

    Equal fingerprints are one value first, so the size of a table's row is bounded
    by how many values agree in its bits, whatever the number of copies.
    """
    blocks = radius + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), 3):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    values = fps.select("fingerprint").where("fingerprint is not null").distinct()
    rows = values.select("fingerprint", F.posexplode(F.array(*map(F.lit, masks))).alias("number", "mask"))
    rows = rows.select("fingerprint", "number", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("part"))
    other = rows.select(F.col("fingerprint").alias("b"), "number", "part")
    return (
        rows.join(other, ["number", "part"])
        .where((F.col("fingerprint") < F.col("b")) & (F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("b"))) <= radius))
        .select(F.col("fingerprint").alias("a"), "b")
        .distinct()
    )


def near_counts(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint, n_near``: how many other fingerprints lie within the radius, where there are any."""
    pairs = near_pairs(fps, radius)
    ends = pairs.select(F.col("a").alias("fingerprint")).unionByName(pairs.select(F.col("b").alias("fingerprint")))
    return ends.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_near"))


def successors(keys: DataFrame) -> DataFrame:
    """Every row of ``keys(k, h, n)``, each different, with ``next_k, next_h``; the first follows the last.

    Rows are dealt to ranges of the order; only the first row of every range meets
    in one task.
    """
    keys = parked(keys, "keys")
    ranges = max(1, -(-keys.count() // RANGE_ROWS))
    ranged = parked(keys.repartitionByRange(ranges, "k", "h").withColumn("r", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("r").orderBy("k", "h")
    led = ranged.select("k", "h", "n", "r", F.lead(F.struct("k", "h")).over(inside).alias("next"))
    heads = ranged.groupBy("r").agg(F.min(F.struct("k", "h")).alias("head"))
    ordered = Window.orderBy("r")
    first = F.first("head").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("r", F.coalesce(F.lead("head").over(ordered), first).alias("after"))
    return led.join(after, "r").withColumn("next", F.coalesce("next", "after")).select(
        "k", "h", "n", F.col("next.k").alias("next_k"), F.col("next.h").alias("next_h")
    )


def fingerprinted(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness.

    Missing texts are empty; an empty text has the fingerprint of one empty word.
    Rows equal in id and text count once in the order and get the same result each;
    missing ids come first, equal ids are ordered by a hash of the text.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = named.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"), "text")
    narrow = keyed.groupBy("k", "h").agg(F.max(F.char_length("text")).cast("long").alias("n"))
    order = parked(successors(narrow), "order")
    bodies = keyed.select("k", "h", "text")
    wanted = order.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.floor(F.col("n") / 2).cast("int").alias("half"))
    pieces = (
        bodies.join(wanted, ["k", "h"])
        .groupBy(F.col("to_k").alias("k"), F.col("to_h").alias("h"))
        .agg(F.max("half").alias("half"), F.max(F.expr("left(text, half)")).alias("piece"))
    )
    both = bodies.join(pieces, ["k", "h"]).select("k", "h", "text", F.expr("concat(left(text, char_length(text) - half), piece)").alias("edited"))
    sides = both.select("k", "h", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.coalesce("edited", F.lit("")).alias("body")))).alias("x"))
    prints = fingerprints(sides.select("k", "h", "x.side", "x.body"), ["k", "h", "side"])
    digests = both.groupBy("k", "h").agg(F.max(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"))
    found = prints.groupBy("k", "h").agg(
        F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("own"), F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("changed")
    )
    found = parked(found.join(digests, ["k", "h"]), "prints")
    following = found.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("own").alias("after"))
    near = near_counts(found.select(F.col("own").alias("fingerprint")), radius)
    result = order.join(found, ["k", "h"]).join(following, ["next_k", "next_h"]).join(near.withColumnRenamed("fingerprint", "own"), "own", "left")
    text_of = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return keyed.select("doc_id", "k", "h").join(result, ["k", "h"]).select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256", text_of("own").alias("fingerprint"), text_of("changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def op4_document_fingerprints(spark, folder: str) -> DataFrame:
    return fingerprinted(table(spark, folder, "documents"))
