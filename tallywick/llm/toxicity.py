"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is a run of 0-9, a-z and non-ASCII characters after lower-casing A-Z.  It
is represented by the mean of the vectors of its bag: the word itself and the
3- to 5-byte pieces of ``<word>``, each hashed into one of ``BUCKETS`` rows of a
table ``E``.  A text's vector is the mean of its words' vectors (every
occurrence counts), and a linear softmax over two classes reads it.  ``E``, the
softmax weights and the biases are trained together by minibatch gradient
descent in numpy on a bounded sample of labelled texts, so a misspelt word that
was never seen still shares most pieces, and so most of its vector, with the
spelling that was.

Scoring needs no vectors: the difference of the two logits is linear in the
text's vector, so each word adds a fixed number ``s(w)`` and a text's score is
``sigmoid(bias + mean of s over its words)``, the same value the softmax gives.
Each task keeps a bounded cache of ``s`` per word.

Defined cases: a missing or empty text, or one without words, has the vector 0
and scores ``sigmoid(bias)``; a missing ``doc_id`` is kept as null and never
held out; repeated rows are scored alike; labels of one id given more than once
count as 1 if any of them is 1; with no labels, or one class only, the model
returns that class's share (0.5 for none) for every text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import ascii_words, each_batch, table, texts

#: at most about this many labelled texts are used for training (the documented sample bound)
TRAINING_ROWS = 3_000
BUCKETS, DIM = 1 << 18, 8
SMALLEST, LARGEST = 3, 5
#: passes over the sample, at least MIN_STEPS batches in all, so small samples are fitted too
EPOCHS, MIN_STEPS, BATCH, RATE, SEED = 8, 100, 256, 0.3, 7
THRESHOLD = 0.5


def pieces(word: bytes) -> list[int]:
    """Rows of the word's bag: the whole word and every 3- to 5-byte piece of ``<word>``."""
    import xxhash

    marked = b"<" + word + b">"
    found = [xxhash.xxh3_64_intdigest(b"w" + word) % BUCKETS]
    for size in range(SMALLEST, LARGEST + 1):
        found.extend(xxhash.xxh3_64_intdigest(marked[i : i + size]) % BUCKETS for i in range(len(marked) - size + 1))
    return found


@dataclass
class Model:
    """Row table ``table`` (BUCKETS x DIM), softmax weights (DIM x 2) and biases (2)."""

    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    @property
    def direction(self) -> np.ndarray:
        return (self.weights[:, 1] - self.weights[:, 0]).astype(np.float64)

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])

    def word_value(self, word: bytes) -> float:
        """What one occurrence of a word adds to the difference of logits."""
        return float(self.table[pieces(word)].mean(axis=0) @ self.direction)

    def score(self, text: str | None) -> float:
        """Probability of label 1 by the softmax: one text, directly."""
        words = ascii_words(text)
        if not words:
            return 1.0 / (1.0 + math.exp(-self.offset))
        hidden = np.mean([self.table[pieces(w)].mean(axis=0) for w in words], axis=0)
        logits = hidden @ self.weights + self.bias
        return float(1.0 / (1.0 + np.exp(logits[0] - logits[1])))


def constant_model(p: float) -> Model:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Model(np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM, 2), np.float32), np.array([0.0, math.log(p / (1 - p))], np.float32))


def _words_of(labelled: DataFrame) -> DataFrame:
    """``row, label, word, count`` per distinct word of each sampled text; rows without words give one null word."""
    schema = pa.schema([("row", pa.int64()), ("label", pa.int32()), ("word", pa.binary()), ("count", pa.int32())])

    def rows(data):
        out = {"row": [], "label": [], "word": [], "count": []}
        for row, label, text in zip(data["row"], data["label"], data["text"], strict=True):
            counts: dict[bytes, int] = {}
            for word in ascii_words(text):
                counts[word] = counts.get(word, 0) + 1
            for word, count in counts.items() or [(None, 0)]:
                out["row"].append(row), out["label"].append(label), out["word"].append(word), out["count"].append(count)
        return out

    ddl = "row long, label int, word binary, count int"
    return labelled.mapInArrow(each_batch(rows, schema), ddl)


def train(rows: np.ndarray, labels: np.ndarray, words: list, counts: np.ndarray) -> Model:
    """Joint gradient descent on (row, word, count) triples; ``words[i]`` None marks a row without words."""
    order = np.unique(rows, return_inverse=True)[1]
    n = int(order.max()) + 1 if len(order) else 0
    y = np.zeros(n, np.int64)
    y[order] = labels
    present = np.array([w is not None for w in words], bool)
    vocabulary: dict[bytes, int] = {}
    word_index = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in np.asarray(words, object)[present]], np.int64)
    doc, count = order[present], counts[present].astype(np.float64)
    totals = np.bincount(doc, weights=count, minlength=n)
    weight = count / totals[doc]
    bags = [pieces(w) for w in vocabulary]
    bag_start = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    bag_rows = np.fromiter((r for b in bags for r in b), np.int64, int(bag_start[-1]))
    bag_size = np.diff(bag_start).astype(np.float64)
    # pairs sorted by row, so a batch of rows is one slice of pairs
    by_doc = np.argsort(doc, kind="stable")
    doc, word_index, weight = doc[by_doc], word_index[by_doc], weight[by_doc]
    pair_start = np.searchsorted(doc, np.arange(n + 1))

    rng = np.random.default_rng(SEED)
    params = [
        ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32),
        ((rng.random((DIM, 2)) - 0.5) / DIM).astype(np.float32),
        np.zeros(2, np.float32),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    batches = max(1, math.ceil(n / BATCH))
    step = 0

    def adam(i: int, grad: np.ndarray, at=None) -> None:
        """One Adam step; for the row table only the rows ``at`` move (lazy Adam)."""
        first, second = moments[i]
        where = slice(None) if at is None else at
        first[where] = 0.9 * first[where] + 0.1 * grad
        second[where] = 0.999 * second[where] + 0.001 * grad * grad
        correction = math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        params[i][where] -= (RATE * correction * first[where] / (np.sqrt(second[where]) + 1e-8)).astype(np.float32)

    def per_dim(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        """Sums of ``values`` rows by ``index`` (0 <= index < size), all columns at once."""
        order = np.argsort(index, kind="stable")
        ordered = index[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
        out = np.zeros((size, values.shape[1]), np.float32)
        if len(starts):
            out[ordered[starts]] = np.add.reduceat(values[order].astype(np.float32, copy=False), starts, axis=0)
        return out

    for _ in range(max(EPOCHS, math.ceil(MIN_STEPS / batches))):
        for chosen in np.array_split(rng.permutation(n), batches):
            step += 1
            table_, weights, bias = params
            lengths_of_docs = pair_start[chosen + 1] - pair_start[chosen]
            pair = np.repeat(pair_start[chosen] - np.cumsum(np.concatenate([[0], lengths_of_docs[:-1]])), lengths_of_docs) + np.arange(lengths_of_docs.sum())
            local_doc = np.repeat(np.arange(len(chosen)), lengths_of_docs)
            used, local_word = np.unique(word_index[pair], return_inverse=True)
            lengths = bag_size[used].astype(np.int64)
            gather = np.repeat(bag_start[used] - np.cumsum(np.concatenate([[0], lengths[:-1]])), lengths) + np.arange(lengths.sum())
            row_ids = bag_rows[gather]
            owner = np.repeat(np.arange(len(used)), lengths)
            scale = (1.0 / bag_size[used][owner])[:, None]
            vectors = per_dim(owner, table_[row_ids] * scale, len(used))
            w = weight[pair][:, None]
            hidden = per_dim(local_doc, vectors[local_word] * w, len(chosen))
            logits = hidden @ weights + bias
            logits -= logits.max(axis=1, keepdims=True)
            prob = np.exp(logits)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(chosen)), y[chosen]] -= 1.0
            grad = prob / len(chosen)
            d_hidden = grad @ weights.T
            d_vectors = per_dim(local_word, d_hidden[local_doc] * w, len(used))
            touched, at = np.unique(row_ids, return_inverse=True)
            adam(0, per_dim(at, d_vectors[owner] * scale, len(touched)), touched)
            adam(1, hidden.T @ grad)
            adam(2, grad.sum(axis=0))
    return Model(*params)


def held_out() -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text is divisible by 5."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fits on at most about ``rows`` texts whose labels are not held out, taken by a hash of the id.

    Only the sample's distinct words and their counts reach the driver.
    """
    marks = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .where("label in (0, 1)")
    )
    count, ones = marks.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not count or ones in (0, count):
        return constant_model((ones or 0) / count if count else 0.5)
    if count > rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / count))
    # about `rows` id and label pairs, so the texts need no shuffle
    labelled = texts(docs).join(F.broadcast(marks), "doc_id").select(F.monotonically_increasing_id().alias("row"), "label", "text")
    bag = _words_of(labelled).toArrow()
    if not bag.num_rows:
        return constant_model((ones or 0) / count)
    return train(
        bag["row"].to_numpy(), bag["label"].to_numpy(zero_copy_only=False), bag["word"].to_pylist(), bag["count"].to_numpy(zero_copy_only=False)
    )


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, in one narrow pass."""
    # each row's share of the difference of logits: 2 MB, sent once with the function
    projected, offset = model.table.astype(np.float64) @ model.direction, model.offset

    def rows(data):
        cache: dict[bytes, float] = {}
        scores = []
        for text in data["text"]:
            words = ascii_words(text)
            total = 0.0
            for word in words:
                value = cache.get(word)
                if value is None:
                    if len(cache) > 200_000:
                        cache.clear()
                    value = cache[word] = float(projected[pieces(word)].mean())
                total += value
            z = offset + (total / len(words) if words else 0.0)
            scores.append(1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0)
        return {"doc_id": data["doc_id"], "score": scores}

    return (
        texts(docs)
        .mapInArrow(each_batch(rows, _SCHEMA), "doc_id long, score double")
        .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    )


def op11_toxicity(spark, folder: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learnt from ``labels.toxic`` outside the held-out fifth."""
    docs = table(spark, folder, "documents")
    return scored(docs, trained(docs, table(spark, folder, "labels")))
