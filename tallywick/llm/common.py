"""Helpers shared by the text operators: tables, shared storage, words and hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters to lower case, the rest of a-z, 0-9 and non-ASCII bytes kept, other ASCII to a space
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


#: Spark's setting to delete a query's shuffle files when it ends, not when the driver collects its garbage
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shipped(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per context, wherever it was imported from."""
    context = spark.sparkContext
    if getattr(context, "_tallywick_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = f"{tempfile.mkdtemp(prefix='tallywick-')}/tallywick.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(target)
    context._tallywick_shipped = True


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of documents, whatever other columns they have."""
    shipped(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where a local session has none is a temporary folder set; elsewhere a
    missing setting is an error, as a machine-local folder would lose data.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallywick-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def parked(df: DataFrame, name: str) -> DataFrame:
    """Writes rows to the shared folder and reads them back.

    Cuts the lineage and is computed once, so later stages survive lost executors
    without repeating the scan before it.  The shuffle files of the write go with it;
    the rows stay until they are :func:`released`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.parked_at = path
    return out


def released(*written: DataFrame) -> None:
    """Deletes tables that :func:`parked` wrote and that nothing reads any more."""
    for df in written:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.parked_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def blank_words(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII blanks after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, kept while there are fewer than ``limit``."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, in order; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def each_batch(rows: Callable[[dict[str, list]], dict[str, object]], schema: pa.Schema):
    """A ``mapInArrow`` function out of one that maps column lists to column lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = rows(batch.to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type, from_pandas=False) for f in schema], schema=schema
                )

    return run
