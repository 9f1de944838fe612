"""Best-fit packing of tokenised documents into sequences of a fixed length.

Every document is tokenised where it is read; only piece lengths and checksums
leave the task.  Pieces are dealt by a hash of their key to groups of about
``group_pieces`` and each group is packed on its own by best-fit decreasing, so
no task holds more than a group whatever the corpus size.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import parked, table, texts

SEQUENCE_TOKENS = 2048
END_ID = 0
GROUP_PIECES = 16384
#: words remembered by a Python worker; all are forgotten when it is full
REMEMBERED_WORDS = 800_000
_SYMBOLS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: fixed values of byte-level vocabularies: the character that stands for each byte
_PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_MARKS = {b: b for b in _PLAIN_BYTES} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN_BYTES)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of texts, word by word.

    The vocabulary splits at white space and drops it, so a text's ids are those
    of its blank-separated words; a word met before costs one lookup.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}

    def _word(self, word: str) -> bytes:
        """Letters of Latin-1, with ASCII symbols after them, go to the model directly.

        The vocabulary's normaliser and splitter leave such a run of letters whole,
        so the model alone gives the same ids; all else takes the whole way.
        """
        if max(word) < "\u0100":
            lowered = word.lower()
            core = lowered.rstrip(_SYMBOLS)
            if core.isalpha():
                found = self.known.get(core)
                if found is None:
                    marks = core.encode().decode("latin-1").translate(_BYTE_MARKS)
                    ids = [t.id for t in self.model.tokenize(marks)]
                    found = struct.pack(f"<{len(ids)}I", *ids)
                    self.known[core] = found
                return found if len(core) == len(lowered) else found + self._whole(lowered[len(core) :])
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        found = self.known.get(text)
        if found is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
            self.known[text] = found
        return found

    def _learn(self, words: list[str]) -> None:
        if len(self.known) + 2 * len(words) > REMEMBERED_WORDS:
            self.known = {"": b""}
        for word in words:
            self.known[word] = self._word(word)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            words = (text or "").replace("\n", " ").split(" ")
            missing = [w for w in set(words) if w not in self.known]
            if missing:
                self._learn(missing)
            try:
                out.append(b"".join(map(self.known.__getitem__, words)))
            except KeyError:  # the memory was emptied while this text was learnt
                self._learn(list(set(words)))
                out.append(b"".join(map(self.known.__getitem__, words)))
        return out


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: its ids, then ``end_id``, cut every ``tokens``.

    A missing or empty text is the end id alone.  Repeated rows and missing ids
    are documents of their own.
    """
    end, step = np.array([end_id], "<u4").tobytes(), tokens * 4

    def cut(batches):
        for batch in batches:
            data = batch.to_pydict()
            rows = []
            for doc, ids in zip(data["doc_id"], _word_ids(tokenizer).ids(data["text"]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES, strict=True)], schema=_PIECES
                )

    return texts(docs).mapInArrow(cut, PIECES)


class OpenBins:
    """Open bins by remaining capacity, over a segment tree of their numbers.

    A leaf counts the bins with that capacity; an inner node sums its leaves.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        at = capacity + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the open bin with the least capacity that holds ``length``."""
        at = length + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at <<= 1
                if not self.count[at]:
                    at += 1
        capacity = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length; ``lengths`` must not increase."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins, made = OpenBins(capacity), 0
    for i, length in enumerate(lengths.tolist()):
        found = open_bins.tightest(length)
        if found is None:
            found, made = (capacity, made), made + 1
        free, number = found
        bins[i], offsets[i] = number, capacity - free
        if free > length:
            open_bins.add(free - length, number)
    return bins, offsets


def pack(parts: DataFrame, tokens: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``tokens``.

    Full pieces are sequences of their own inside their group.  Ties are ordered
    by document and piece, so equal input gives equal sequences.
    """
    counted = parked(parts, "pieces")
    groups = max(1, round(counted.count() / group_pieces))

    def packed(key, group):
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit_decreasing(group["length"].to_numpy(), tokens)
        first = key[0].as_py() << 32
        return group.drop_columns(["bundle"]).append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    dealt = counted.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("bundle").applyInArrow(packed, PACKED)


def packed_documents(docs: DataFrame, tokenizer: str | None = None, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Documents as pieces placed in sequences; see :func:`pieces` and :func:`pack`."""
    return pack(pieces(docs, tokenizer or default_tokenizer(), tokens), tokens)


def op6_best_fit_packing(spark, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))
