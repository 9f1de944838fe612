"""Secret scans: a keyword automaton first, anchored expressions only at its hits.

One Aho-Corasick pass over the lower-cased text finds the keywords; a regular
expression is tried only where one starts.  Hex runs have no keyword: they are
looked for in the text's projection on {hex digit, other}, again by one plain
search.  Tokens that embed a CRC-32 count only if it is right.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tallywick.llm.common import each_batch, table, texts

#: fixed values: order of kinds in the result, keywords and expressions
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
EXPRESSIONS = {
    "assign": re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASSIGNED, ACCESS, HEX = 12, 18, 16
_HEX_BYTES = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def checksum_holds(token: str) -> bool:
    """The last six characters are the base-62 CRC-32 of those after the prefix."""
    body, check = token[4:-6], token[-6:]
    value = zlib.crc32(body.encode())
    digits = ""
    while value:
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits.rjust(6, "0") == check


def _holds(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= ASSIGNED
    if kind == "access":
        return len(match[0]) >= ACCESS
    if kind == "hex":
        return len(match[0]) >= HEX
    return checksum_holds(match[0])


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, ordered by start, then kind."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    lowered = text.lower() if text.isascii() else raw.lower().decode("utf-8", "surrogatepass")
    hits: dict[str, list[int]] = {}
    for last, (kind, length) in _automaton().iter(lowered):
        hits.setdefault(kind, []).append(last - length + 1)
    found = []
    for kind, starts in hits.items():
        free = 0  # matches of a kind don't overlap, dropped ones included
        for start in sorted(starts):
            if start >= free and (match := EXPRESSIONS[kind].match(text, start)):
                free = match.end()
                if _holds(kind, match):
                    found.append((start, free, kind))
    if b"h" * HEX in raw.translate(_HEX_BYTES):
        found += [(m.start(), m.end(), "hex") for m in EXPRESSIONS["hex"].finditer(text) if _holds("hex", m)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
)


def scanned(docs: DataFrame) -> DataFrame:
    """Secrets of every row; a missing or empty text has none, repeated rows stay."""

    def rows(data):
        out = {f.name: [] for f in _SCHEMA}
        out["doc_id"] = data["doc_id"]
        for text in data["text"]:
            found = spans(text)
            base = [s for s in found if s[2] in KINDS[:3]]
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(sum(s[2] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(found))
        return out

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return texts(docs).mapInArrow(each_batch(rows, _SCHEMA), schema)


def op7_secret_scan(spark, folder: str) -> DataFrame:
    return scanned(table(spark, folder, "documents"))
