"""Benchmark decontamination: a prefix-filtered set join of documents with item windows.

Items are cut into windows of ten words, windows into shingles of five.  A
bitmap of fixed size over the items' shingles picks the stretches of documents
that can matter; only those leave the scan.  Shingles are then ordered by how
often the stretches hold them.  A window counts only if all of it occurs, so its
necessary prefix is its one rarest shingle.  Joining on that shingle gives the
place where the window would have to stand (positional bound) and whether the
stretch is long enough (length bound); the window's words are compared there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import WordHashes, ascii_words, parked, shingle_hashes, table, texts

WINDOW = 10
SHINGLE = 5
BITMAP_BITS = 1 << 26

_WINDOWS = pa.schema([("item_id", pa.string()), ("window", pa.string()), ("size", pa.int32()), ("grams", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64()))])
_STRETCHES = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("text_key", pa.binary()), ("stretches", pa.list_(pa.struct([("first", pa.int32()), ("words", pa.string())])))]
)
STRETCHES = "doc_id long, n_words long, text_key binary, stretches array<struct<first:int,words:string>>"


def _grams(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def item_windows(items: DataFrame) -> DataFrame:
    """Windows of every item with their shingles; a missing id counts as an empty one."""

    def cut(batches):
        hashes = WordHashes()
        for batch in batches:
            data, out = batch.to_pydict(), []
            for item, text in zip(data["item_id"], data["text"], strict=True):
                words = ascii_words(text)
                for i in range(max(len(words) - WINDOW, 0) + 1 if words else 0):
                    window = words[i : i + WINDOW]
                    size = min(SHINGLE, len(window))
                    out.append((item, b" ".join(window), len(window), _grams(window, size), shingle_hashes(hashes.of(window), size).view(np.int64)))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array([w.decode("utf-8", "replace") for w in columns[1]]), pa.array(columns[2], pa.int32()),
                     pa.array([[g.decode("utf-8", "replace") for g in gs] for gs in columns[3]], pa.list_(pa.string())), pa.array(columns[4], pa.list_(pa.int64()))],
                    schema=_WINDOWS,
                )

    chosen = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, "item_id string, window string, size int, grams array<string>, hashes array<long>")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """One bit per hashed shingle: at most ``BITMAP_BITS / 64`` rows return, however many items there are."""
    rows = (
        windows.select(F.explode("hashes").alias("h"))
        .select(F.pmod("h", F.lit(BITMAP_BITS)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("held"))
        .toPandas()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    bits[rows["at"].to_numpy(np.int64)] = rows["held"].to_numpy(np.int64)
    return bits.view(np.uint64)


def stretches(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Word count of every row and the runs of words that item shingles may cover."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def found(batches):
        import xxhash

        hashes, held = WordHashes(), shared.value
        for batch in batches:
            data, out = batch.to_pydict(), []
            for doc, text in zip(data["doc_id"], data["text"], strict=True):
                words = ascii_words(text)
                h = hashes.of(words)
                cover = np.zeros(len(words) + 1, np.int32)
                for size in sizes:
                    g = shingle_hashes(h, size).view(np.int64) % BITMAP_BITS
                    g = g.astype(np.uint64)
                    hit = np.flatnonzero((held[g >> np.uint64(6)] >> (g & np.uint64(63))) & np.uint64(1))
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + size, -1)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).view(np.int8), [0]))))
                runs = [{"first": a, "words": b" ".join(words[a:b]).decode("utf-8", "replace")} for a, b in edges.reshape(-1, 2).tolist()]
                key = xxhash.xxh3_128_digest(h.tobytes())
                out.append((doc, len(words), key, runs))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _STRETCHES, strict=True)], schema=_STRETCHES)

    return texts(docs).mapInArrow(found, STRETCHES)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Missing and empty texts have no words; items without words have no windows.
    Repeated rows get the same result each.  Results are made once per different
    word sequence, so a third of all rows being copies costs one of them.
    """
    windows = parked(item_windows(items), "windows")
    sizes = [r[0] for r in windows.select(F.least("size", F.lit(SHINGLE))).distinct().collect()]  # at most five rows
    scan = parked(stretches(docs, _bitmap(windows), sizes), "stretches")
    runs = (
        scan.where(F.size("stretches") > 0)
        .select("text_key", F.explode("stretches").alias("r"))
        .select("text_key", F.col("r.first").alias("first"), F.split("r.words", " ").alias("words"))
        .distinct()
    )
    grams = None
    for size in sizes:
        part = runs.where(F.size("words") >= size).select(
            "text_key", "first", "words",
            F.posexplode(F.expr(f"transform(sequence(1, size(words) - {size - 1}), i -> concat_ws(' ', slice(words, i, {size})))")).alias("at", "gram"),
        )
        grams = part if grams is None else grams.unionByName(part)
    result = scan.select("doc_id", "n_words", "text_key")
    if grams is not None:
        places = windows.select("window", "size", F.posexplode("grams").alias("place", "gram")).distinct()
        counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        rarest = (
            places.join(counts, "gram", "left")
            .groupBy("window", "size")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram", "place")).alias("p"))
            .select("window", "size", F.col("p.gram").alias("gram"), F.col("p.place").alias("place"))
        )
        start = F.col("at") - F.col("place")
        exact = F.expr("concat_ws(' ', slice(words, cast(at - place as int) + 1, size)) = window")
        standing = (
            grams.join(rarest, "gram")
            .where((start >= 0) & (start + F.col("size") <= F.size("words")))
            .where(exact)
            .select("text_key", (F.col("first") + start).alias("start"), "size", "window")
            .distinct()
        )
        standing = parked(standing, "standing")
        item_ids = standing.select("text_key", "window").distinct().join(windows.select("item_id", "window").distinct(), "window")
        by_items = item_ids.select("text_key", "item_id").distinct().groupBy("text_key").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
        by_words = standing.groupBy("text_key").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("s"))
        covered = F.expr(
            "aggregate(s, struct(0L as n, 0L as upto), (a, x) -> struct("
            "a.n + greatest(0L, x.start + x.size - greatest(a.upto, cast(x.start as bigint))) as n,"
            "greatest(a.upto, cast(x.start + x.size as bigint)) as upto), a -> a.n)"
        )
        result = result.join(by_items.join(by_words, "text_key").select("text_key", "ids", covered.alias("n_hit")), "text_key", "left")
    else:
        result = result.withColumn("ids", F.lit(None).cast("array<string>")).withColumn("n_hit", F.lit(0).cast("long"))
    return result.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size(F.coalesce("ids", F.array().cast("array<string>"))), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("ids", F.array().cast("array<string>"))).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` in whose text no item window occurs; rows without an id stay."""
    bad = contamination(docs, items).where("contaminated and doc_id is not null").select(F.col("doc_id").alias("contaminated_id")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["contaminated_id"], "left_anti")


def op1_benchmark_decontamination(spark, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
