"""Decontamination, near-duplicates, lines, fingerprints and quality against brute force."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from tallywick.llm import components, decontamination, fingerprints, linededup, nearwords, quality
from tallywick.llm.common import ascii_words
from tests.llm.conftest import BASE, ROWS


def least_of(links, nodes):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(500, 501), (501, 500), (7, 7)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == least_of(links, {n for x in links for n in x})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(spark, edge_docs, no_docs):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = draw.choices(words, k=draw.choice((3, 30, 120)))
        texts.append(" ".join(base))
        for _ in range(5):
            changed = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 25))):
                changed[draw.randrange(len(changed))] = draw.choice(words)
            texts.append(" ".join(changed))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for text in texts:
        w = text.split()
        k = min(4, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    expected = least_of(links, range(len(sets)))
    rows = nearwords.near_duplicates(frame, words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in enumerate(sets)}


def test_long_lists_make_no_row_per_pair(spark, monkeypatch):
    """120 texts of one template, alike below the similarity, some with a near copy: all share their lists."""
    draw = random.Random(11)
    base = [f"t{i}" for i in range(70)]
    texts = []
    for number in range(120):
        changed = list(base)
        for place in draw.sample(range(4, 60, 8), 3):
            changed[place + draw.randrange(3)] = f"own{number}"
        texts.append(" ".join(changed))
        if number % 10 == 0:
            texts.append(" ".join([*changed[:-1], "end"]))
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in map(str.split, texts)]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    made, parked = [], nearwords.parked

    def counted(df, name):
        out = parked(df, name)
        if name.startswith("pairs-"):
            made.append(out.count())
        return out

    monkeypatch.setattr(nearwords, "parked", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = nearwords.near_duplicates(frame, words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == least_of(links, range(len(sets)))
    # leaders and lists of at most SHORT members only, far from the 8,646 pairs of texts
    assert sum(made) < 2000


@pytest.mark.parametrize("block_values", [1 << 21, 2000])
def test_blocks_of_a_list_equal_brute_force(spark, monkeypatch, block_values):
    """A long list, as one block and as many, is joined as by all of its links, sets of any size."""
    import numpy as np

    draw = np.random.default_rng(3)
    sets = []
    for _ in range(30):
        core = draw.integers(0, 1 << 32, int(draw.integers(1, 400)), dtype=np.uint64)
        sets += [np.unique(core), *[np.unique(np.where(draw.random(len(core)) < share, draw.integers(0, 1 << 32, len(core), dtype=np.uint64), core)) for share in (0.05, 0.1, 0.15)]]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    before = [(i, i + 1) for i in range(0, len(sets), 10)]  # joined by earlier rounds
    comps = least_of(before, range(len(sets)))
    rows = [(1, i, comps[i], len(s), nearwords.low_halves(s).tobytes(), -(-sum(map(len, sets)) // block_values)) for i, s in enumerate(sets)]
    monkeypatch.setattr(nearwords, "TILE", 16)
    members = spark.createDataFrame(rows, "value long, id long, c long, n long, low binary, blocks long")
    found = [tuple(r) for r in nearwords.pairs_of_long_lists(members, 80).collect()]
    true = [x for x in found if x in set(links)]
    assert links and least_of(true + before, range(len(sets))) == least_of(links + before, range(len(sets)))


def test_many_links_of_a_list_come_back_as_a_forest(spark):
    """300 sets linked with each other: a link per member, not one per pair."""
    import numpy as np

    core = np.arange(500, dtype=np.uint32)
    rows = [(1, i, i, 501, np.append(core, np.uint32(1000 + i)).tobytes(), 1) for i in range(300)]
    members = spark.createDataFrame(rows, "value long, id long, c long, n long, low binary, blocks long")
    found = [tuple(r) for r in nearwords.pairs_of_long_lists(members, 80).collect()]
    assert len(found) == 299 and set(least_of(found, range(300)).values()) == {0}


def test_near_duplicate_edges(edge_docs, no_docs):
    kept = nearwords.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    assert ids == [-1, -1, 1, 2, 3, 4, 7, 7, 8, 9, 10]
    assert nearwords.near_duplicates(no_docs).count() == 0


def test_contamination_equals_brute_force(spark, edge_docs, no_docs):
    items = [("a", BASE[:200]), ("b", "short Item"), (None, None), ("c", ""), ("d", BASE[100:300]), ("e", "absent words that do not stand anywhere at all in any of these texts")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = {}
    for item, text in items:
        w = ascii_words(text)
        for i in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    docs = edge_docs.unionByName(spark.createDataFrame([(20, "a SHORT item; short item " + BASE)], "doc_id long, text string"), allowMissingColumns=True)
    expected = []
    for doc, text in [*ROWS, (20, "a SHORT item; short item " + BASE)]:
        w, hit, held = ascii_words(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    held |= owners
        expected.append((doc or -1, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    rows = [((r[0] or -1), *r[1:]) for r in decontamination.contamination(docs, bench).collect()]
    assert sorted(rows) == sorted(expected)
    assert decontamination.contamination(no_docs, bench).count() == 0
    assert not decontamination.contamination(edge_docs, bench.limit(0)).where("contaminated").count()


def test_lines(spark, edge_docs, no_docs):
    line = "the quick brown fox jumps over the lazy dog near the old river bank"
    texts = [f"{line}\nanother line that stands alone here", f"{line}!\n\nunlike in every way, this one", None, "", line]
    frame = spark.createDataFrame([(i, t, len(t or ""), "s") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, at string")
    rows = {r["doc_id"]: r for r in linededup.without_repeated_lines(frame).collect()}
    assert [rows[i]["text"] for i in range(5)] == [texts[0], "\nunlike in every way, this one", None, "", ""]
    assert rows[1]["n_chars"] == len(rows[1]["text"]) and rows[0].asDict().keys() == {"doc_id", "text", "n_chars", "at"}
    assert linededup.without_repeated_lines(no_docs).count() == 0
    assert linededup.without_repeated_lines(edge_docs).count() == len(ROWS)


def test_fingerprints(spark, edge_docs, no_docs):
    frame = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = sorted((i, t or "") for i, t in dict(ROWS).items() if i is not None)
    rows = {r["doc_id"]: r for r in fingerprints.fingerprinted(frame).collect()}
    for at, (i, text) in enumerate(texts):
        n, following = len(text), texts[(at + 1) % len(texts)][1]
        edited = text[: n - n // 2] + following[: n // 2]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["n_chars"] == n
    assert rows[4]["fingerprint"] == rows[5]["fingerprint"] and rows[1]["fingerprint"] == rows[2]["fingerprint"]
    assert rows[4]["near_next"] == 1.0
    assert fingerprints.fingerprinted(edge_docs).count() == len(ROWS)
    assert fingerprints.fingerprinted(no_docs).count() == 0


def test_block_tables_find_all_near_values(spark):
    draw = random.Random(2)
    values = [draw.getrandbits(64) - (1 << 63) for _ in range(60)]
    for v in list(values):
        for _ in range(3):
            x = v
            for b in draw.sample(range(64), draw.randint(1, 5)):
                x ^= (1 << b) if b < 63 else -(1 << 63)
            values.append(x)
    found = {(r["a"], r["b"]) for r in fingerprints.near_pairs(spark.createDataFrame([(v,) for v in values], "fingerprint long")).collect()}
    assert found == {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


@pytest.mark.parametrize("text", [None, "", " ", "!", "word"])
def test_statistics_of_small_texts(text):
    assert len(quality.text_statistics(text)) == len(quality.STATISTICS)


def test_quality(spark, folder, edge_docs, no_docs):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.trained(docs, labels)
    rows = quality.scored(docs, model).join(labels, "doc_id").where("held_out")
    right, all_rows = rows.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert right >= 0.9 * all_rows
    assert all(0 <= r["score"] <= 1 for r in quality.scored(edge_docs, model).collect())
    assert quality.without_rejected(edge_docs, model).columns == edge_docs.columns
    assert quality.scored(no_docs, model).count() == 0
    assert not quality.trained(docs, labels.limit(0)).rules


@pytest.mark.parametrize("line", ["", "ab", "abcde", "abcdef", "ab\r cdefé", "a😀b😀cd😀", "日本語日本語日本語日本"])
def test_runs_of_characters_are_counted_by_code_point(line):
    assert len(linededup.shingles_of(line)) == len({line[i : i + 5] for i in range(max(1, len(line) - 4))})


def test_signatures_of_long_lines_hold_every_part(monkeypatch):
    line = "".join(random.Random(4).choices("abcdef ", k=2000))
    whole = linededup._signed([line, "x", line])
    monkeypatch.setattr(linededup, "BLOCK", 64)
    assert (linededup._signed([line, "x", line]) == whole).all()
    assert (whole[0] == whole[2]).all() and (whole[0] != whole[1]).any()


def test_rows_without_ids_lose_their_own_lines_only(spark):
    line = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(None, f"a line that only this one has\n{line}"), (None, f"{line}\nsomething else that stands alone"), (1, line)]
    texts = [r["text"] for r in linededup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert "a line that only this one has" in "\n".join(texts) and "something else that stands alone" in "\n".join(texts)
    assert "\n".join(texts).count(line) == 1


def test_like_lines_equal_brute_force(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(3, 8))) for _ in range(300)]
    lines = []
    for _ in range(40):
        line = " ".join(draw.choices(words, k=20))
        lines += [line, line.replace(line[5:8], "zq"), line + " tail", line]
    kept = linededup.without_repeated_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    least = list(range(len(lines)))
    for _ in range(4):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = min(least[i], least[j])
    assert {r["doc_id"] for r in kept.where("text != ''").collect()} == {i for i, x in enumerate(least) if i == x}


def test_lists_of_the_same_members_are_compared_once(spark, monkeypatch):
    """60 sets, each linked with its neighbours, in 20 lists: a link per member, not one per list or pair."""
    import numpy as np

    members = 60
    sets = spark.createDataFrame([(i, 100, np.arange(8 * i, 8 * i + 100, dtype=np.uint64).tobytes()) for i in range(members)], "id long, n long, whole binary")
    lists = spark.createDataFrame([(i, 100, v) for i in range(members) for v in range(20)], "id long, n long, value long")
    made, compared = [], nearwords.pairs_of_long_lists

    def counted(*given):
        made.append(compared(*given).count())
        return compared(*given)

    monkeypatch.setattr(nearwords, "pairs_of_long_lists", counted)
    found = nearwords.linked_through_lists(lists, lambda pairs: pairs.where("b - a < 2"), lambda ids: sets.join(ids, "id"), 80)
    assert {r["id"]: r["c"] for r in found.collect()} == dict.fromkeys(range(members), 0)
    assert 0 < made[0] < members


def test_lines_that_stand_alone_are_written_as_places_only(spark, monkeypatch):
    draw, written, parked = random.Random(6), {}, linededup.parked

    def counted(df, name):
        out = parked(df, name)
        written[name] = out.count() * len(out.columns)
        return out

    monkeypatch.setattr(linededup, "parked", counted)
    texts = ["\n".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(20)) for _ in range(30)]
    kept = linededup.without_repeated_lines(spark.createDataFrame(list(enumerate([*texts, texts[0]])), "doc_id long, text string"))
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(["", *texts])
    # four numbers for each of 620 lines, no signature; the 20 lines of the copy are listed for removal
    assert sum(written.values()) <= 4 * 620 + 40 * 4 + 3


def test_written_rows_leave_no_shuffle_files(spark):
    from pathlib import Path

    from tallywick.llm.common import parked, released

    place = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = {p.name for p in place.rglob("shuffle_*")}
    rows = parked(spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count(), "rows")
    for _ in range(50):
        if {p.name for p in place.rglob("shuffle_*")} <= before:
            break
        time.sleep(0.1)
    assert {p.name for p in place.rglob("shuffle_*")} <= before
    assert rows.count() == 100
    assert Path(rows.parked_at.removeprefix("file:")).exists()
    released(rows)
    assert not Path(rows.parked_at.removeprefix("file:")).exists()


def test_line_dedup_runs_no_python(spark, monkeypatch):
    """Every table it writes and its result come from DataFrame operations alone."""
    plans, parked = [], linededup.parked

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return parked(df, name)

    monkeypatch.setattr(linededup, "parked", noted)
    line = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = spark.createDataFrame([(1, line), (2, line + "!"), (3, "unlike in every way, this one")], "doc_id long, text string")
    rows = spark.read.schema(rows.schema).parquet(parked(rows, "rows").parked_at)
    out = linededup.without_repeated_lines(rows)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: line, 2: "", 3: "unlike in every way, this one"}
    assert len(plans) > 5 and not [p for p in plans if "Arrow" in p or "Python" in p or "Pandas" in p]


def test_pairs_of_unlike_lines_in_a_list_make_no_rows(spark, monkeypatch):
    """40 lines that share a list and no more: the join of the list's members gives none of their 780 pairs."""
    written, parked = {}, linededup.parked

    def counted(df, name):
        out = parked(df, name)
        written[name] = out.count()
        return out

    draw = random.Random(9)
    signed = [(i, [77], draw.getrandbits(64) - (1 << 63)) for i in range(40)]
    frame = spark.createDataFrame(signed, "id long, bands array<long>, sketch long")
    monkeypatch.setattr(linededup, "parked", counted)
    monkeypatch.setattr(linededup, "signed_lines", lambda lines: frame)
    lines = spark.createDataFrame([(i, f"line {i}") for i in range(40)], "id long, line string")
    assert linededup.line_components(lines).count() == 0
    assert written["line-lists"] == 40 and written["line-pairs-0"] + written["line-pairs-1"] < 40


@pytest.mark.parametrize("line", ["ab", "abcde", "abcdef", "ab\r cdefé", "a😀b😀cd😀", "日本語日本語日本語日本", "aaaaaaaaaaaa"])
def test_shingles_in_sql_are_those_of_code_points(spark, line):
    lines = spark.createDataFrame([(1, line)], "id long, line string")
    hashes = {r["h"] for r in linededup.shingle_rows(lines).collect()}
    assert len(hashes) == len(linededup.shingles_of(line))
    pairs = spark.createDataFrame([(1, 2, line, line), (1, 3, line, line + "xyzxyzxyzw")], "a long, b long, a_line string, b_line string")
    assert [tuple(r) for r in linededup.similar(pairs, 80).collect()] == [(1, 2)]


def test_members_of_a_list_make_rows_of_links_only(spark, monkeypatch):
    """200 variants of a line, alike and mostly below the similarity: no row for a pair that is not a link."""
    draw = random.Random(12)
    base = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    lines = set()
    while len(lines) < 200:
        changed = list(base)
        for place in draw.sample(range(300), draw.randint(3, 6)):
            changed[place] = draw.choice("ABCDEFG")
        lines.add("".join(changed))
    lines, written, parked = sorted(lines), {}, linededup.parked
    draw.shuffle(lines)

    def counted(df, name):
        out = parked(df, name)
        written[name] = out.count()
        return out

    # one list for all, so that each pair is tried
    signed = linededup.signed_lines
    monkeypatch.setattr(linededup, "parked", counted)
    monkeypatch.setattr(linededup, "signed_lines", lambda given: signed(given).withColumn("bands", F.array(F.lit(7).cast("long"))).withColumn("sketch", F.lit(0).cast("long")))
    found = linededup.line_components(spark.createDataFrame(list(enumerate(lines)), "id long, line string"))
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    links = [(i, j) for i in range(200) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    expected = least_of(links, range(200))
    linked = {x for pair in links for x in pair}
    assert {r["id"]: r["c"] for r in found.collect()} == {i: expected[i] for i in linked}
    assert links and len(links) < 10_000 and sum(v for k, v in written.items() if k.startswith("line-pairs")) <= 199 + len(links)


def test_sets_of_lines_and_links_inside_equal_brute_force(spark):
    draw = random.Random(13)
    lines = ["ab", "日本語日本語日本語日本", "aaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaa"]
    for size in (30, 400):
        base = "".join(draw.choices("abcdefé😀 ", k=size))
        lines += [base, *[base[:i] + "X" + base[i + 1 :] for i in range(0, size, size // 10)], base + base, base[: size // 2]]
    rows = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    found = linededup.shingle_sets(rows)
    assert {r["id"]: len(set(r["shingles"])) for r in found.collect()} == {i: len(linededup.shingles_of(x)) for i, x in enumerate(lines)}
    members = found.select(F.lit(1).cast("long").alias("lead"), "id", F.lit(0).cast("long").alias("sketch"), F.col("id").alias("c"), "shingles", "part")
    sets = [set(linededup.shingles_of(x).tolist()) for x in lines]
    links = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {tuple(r) for r in linededup.links_inside(members, 80).collect()} == links


def test_signatures_do_not_depend_on_shingles_a_row(spark, monkeypatch):
    draw = random.Random(14)
    lines = spark.createDataFrame([(i, "".join(draw.choices("abcdé😀 ", k=i))) for i in range(1, 40)], "id long, line string")
    grouped = {r["id"]: (r["bands"], r["sketch"]) for r in linededup.signed_lines(lines).collect()}
    rows = linededup.shingle_rows(lines, 8)
    assert rows.count() == sum(-(-max(1, i - 4) // 8) for i in range(1, 40))
    one = linededup.shingle_rows
    monkeypatch.setattr(linededup, "shingle_rows", lambda given, together: one(given).select("id", *[F.col("h").alias(f"h{i}") for i in range(together)]))
    assert grouped == {r["id"]: (r["bands"], r["sketch"]) for r in linededup.signed_lines(lines).collect()}
