"""License scans: a set-similarity join of text windows with license templates.

Template words are ordered by how many documents hold them, rare ones first.  A
window that contains a share ``threshold`` of a template must hold one of the
template's ``n - ceil(threshold * n) + 1`` rarest words (prefix filter), cannot
be longer than the template allows (length filter), and only windows with enough
template words between the prefix word and their end are counted (positional
filter).  Templates are an argument, so every task carries their small index and
no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import ascii_words, each_batch, table, texts

#: fixed values: phrases whose words must stand consecutively, and notices
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
NOTICES = {
    "apache": ["licensed under the apache license version 2 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "gpl": ["this work is licensed under the gnu general public license version 3"],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
THRESHOLD = 0.9
SLACK = 1.25


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    needed: int
    span: int
    exact: bool


def templates(phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]], threshold: float) -> list[Template]:
    """Phrases need all their words in a window of their own length, in order."""
    made = []
    for label, text in phrases.items():
        words = tuple(ascii_words(text))
        made.append(Template(label, words, len(set(words)), len(words), True))
    for label, texts in notices.items():
        for text in texts:
            words = tuple(ascii_words(text))
            needed = math.ceil(threshold * len(set(words)) - 1e-9)
            made.append(Template(label, words, needed, math.ceil(SLACK * len(words)), False))
    return made


def word_frequencies(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each of the given words stands; one row per word returns."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def counted(batches):
        for batch in batches:
            counts = dict.fromkeys(words, 0)
            for text in batch.column("text").to_pylist():
                for word in words.intersection(ascii_words(text)):
                    counts[word] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    rows = docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(words, 0) | {bytes(r["word"]): r["n"] for r in rows}


class Index:
    """Templates by the words of their prefix."""

    def __init__(self, made: Sequence[Template], frequency: Mapping[bytes, int]):
        self.made = list(made)
        self.by_word: dict[bytes, list[int]] = {}
        for i, t in enumerate(self.made):
            ordered = sorted(set(t.words), key=lambda w: (frequency[w], w))
            for word in ordered[: len(ordered) - t.needed + 1]:
                self.by_word.setdefault(word, []).append(i)

    def places(self, words: list[bytes]) -> tuple[list[tuple[int, str]], dict[str, float]]:
        """Starts of phrases with their label, and the best containment by label."""
        near: dict[int, list[int]] = {}
        for word in set(words) & self.by_word.keys():
            at = [p for p, w in enumerate(words) if w == word]
            for i in self.by_word[word]:
                near.setdefault(i, []).extend(at)
        base, best = [], {}
        for i, at in near.items():
            t = self.made[i]
            if t.exact:
                size = len(t.words)
                starts = {p - k for p in at for k in range(size) if p >= k}
                hits = [s for s in sorted(starts) if tuple(words[s : s + size]) == t.words]
                base += [(s, t.label) for s in hits]
                share = 1.0 if hits else 0.0
            else:
                share = self._share(t, words, sorted(set(at)))
            if share:
                best[t.label] = max(best.get(t.label, 0.0), share)
        return sorted(base), best

    @staticmethod
    def _share(t: Template, words: list[bytes], at: list[int]) -> float:
        own, most = set(t.words), 0
        for p in at:
            low, high = max(0, p - t.span + 1), min(len(words), p + t.span)
            held = [q for q in range(low, high) if words[q] in own]
            if len(held) < t.needed:
                continue
            count: dict[bytes, int] = {}
            first = 0
            for q in held:
                count[words[q]] = count.get(words[q], 0) + 1
                while held[first] <= q - t.span:
                    w = words[held[first]]
                    count[w] -= 1
                    if not count[w]:
                        del count[w]
                    first += 1
                most = max(most, len(count))
        return most / len(own) if most >= t.needed else 0.0


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scanned(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Licenses of every row.

    ``score`` is the largest share of a template held by a window, 0 where none
    reaches its threshold.  A missing or empty text has no words and no license;
    repeated rows and missing ids stay.
    """
    docs = texts(docs)
    made = templates(phrases, notices, threshold)
    index = Index(made, word_frequencies(docs, frozenset(w for t in made for w in t.words)))

    def rows(data):
        out = {f.name: [] for f in _SCHEMA}
        out["doc_id"] = data["doc_id"]
        for text in data["text"]:
            words = ascii_words(text)
            base, best = index.places(words)
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(base[0][0] if base else None)
            out["last_word"].append(base[-1][0] if base else None)
            out["base_labels"].append(",".join(sorted({label for _, label in base})))
            out["labels"].append(",".join(sorted(best)))
            out["score"].append(max(best.values(), default=0.0))
        return out

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.mapInArrow(each_batch(rows, _SCHEMA), schema)


def op2_license_scan(spark, folder: str) -> DataFrame:
    return scanned(table(spark, folder, "documents"))
