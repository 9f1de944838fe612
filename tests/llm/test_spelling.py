"""Spelling variants against a plain reading of the contract."""

import random
import re
import zlib
from collections import Counter

from tallywick.llm import spelling

TO_LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            if len(low) >= 7:
                counts[low] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def corpus():
    rng = random.Random(5)
    alphabet = "abcdefghijklmnopqrstuvwxyzéàü"
    bases = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 10))) for _ in range(25)]
    vocabulary = []
    for base in bases:
        vocabulary += [base] * rng.choice([3, 30, 300])
        for _ in range(rng.randint(1, 5)):
            i = rng.randrange(len(base))
            kind = rng.randrange(3)
            edited = base[:i] + rng.choice(alphabet) + base[i + (kind == 0) :] if kind < 2 else base[:i] + base[i + 1 :]
            vocabulary += [edited] * rng.choice([1, 2, 3, 25])
    # a chain: each one edit from the next, each 10 times rarer
    vocabulary += ["chainwordxx"] * 3 + ["chainwordx"] * 40 + ["chainword"] * 450 + ["Chainword"] * 3
    rng.shuffle(vocabulary)
    rows = [(i, " ".join(vocabulary[k : k + 37]).upper() if i % 7 == 0 else ", ".join(vocabulary[k : k + 37])) for i, k in enumerate(range(0, len(vocabulary), 37))]
    return rows + [(None, "chainword nullid"), (99999, None), (None, None)]


def test_variants_equal_the_plain_reading(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(docs).collect()}
    expected = brute(rows)
    assert got == expected
    assert any(root != form and form is not None for form, root, *_ in expected.values())
    assert sum(v[3] for v in expected.values()) > 20


def test_edge_rows(spark, edge_docs, no_docs):
    assert spelling.variants(no_docs).count() == 0
    got = {r["word"]: r for r in spelling.variants(edge_docs).collect()}
    from tests.llm.conftest import ROWS

    assert set(got) == set(brute(ROWS))
