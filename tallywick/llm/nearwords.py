"""MinHash near-duplicates by bottom-k sketches from one hash function.

A text's set holds its distinct word shingles.  Its sketch is the ``k`` least
hash values.  Inverted lists of retained values generate overlaps; the share of
the union sketch held by both sides filters them; full sets confirm.

Equal sets meet first, by a digest of the set, so copies are one class.  Lists
are read through leaders: in each round every member of a list is compared with
the list's least class of the round's order only, linked classes are contracted,
and members already in their leader's component drop out.  After the rounds the
pairs between different components that share a list of rare values remain.
Lists of at most ``SHORT`` members pair their rows; longer ones, those with the same
least member together, are compared whole by blocks of members and give a forest of
links, so that no row is made per pair.
A text is entered only under the values a link cannot avoid: two sets of
similarity 0.8 share at least ``least`` values of a sketch, so at least one of
the ``s - least + 1`` values that are rarest in the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import WordHashes, blank_words, mixed, parked, released, shingle_hashes, table, texts
from tallywick.llm.components import components

SKETCH = 64
#: a set enters the lists with its rarest s - ceil(s * SHARE_NEEDED) + 1 sketch values; a pair at
#: similarity 0.8 whose smaller set lies in the larger shares Bin(64, 0.8) values, fewer than 31 with
#: probability about 4e-9 (0.6 missed about 1.3e-4 of such pairs)
SHARE_NEEDED = 0.48
#: pairs whose union sketch shares fewer values are not compared in whole
UNION_SHARE = 0.48
LEADER_ROUNDS = 2
#: longer lists are compared in blocks, without a row per pair
SHORT = 32
#: set values of a block's members together, and members of a tile that is compared at once
BLOCK_VALUES, TILE = 1 << 21, 256

_SETS = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.list_(pa.int64()))]
)
_WHOLE = pa.schema([("set_key", pa.binary()), ("shingles", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _sets(texts_: list[str | None], words: int, hashes: WordHashes):
    import xxhash

    for text in texts_:
        h = hashes.of(blank_words(text))
        s = np.unique(shingle_hashes(h, min(words, max(len(h), 1)))) if len(h) else h
        yield s, xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest and sketch (least values of a second mix) of every row.

    Fewer words than a shingle make one shingle of the whole text; a missing or
    wordless text has the empty set and no digest.
    """

    def made(batches):
        hashes = WordHashes()
        for batch in batches:
            data, out = batch.to_pydict(), []
            for doc, (s, key) in zip(data["doc_id"], _sets(data["text"], words, hashes), strict=True):
                out.append((doc, len(s), key, np.sort(mixed(s))[:SKETCH].view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SETS, strict=True)], schema=_SETS)

    return texts(docs).mapInArrow(made, "doc_id long, n_shingles long, set_key binary, sketch array<long>")


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(set_key, shingles)`` of every row with words: all hashes, sorted."""

    def made(batches):
        hashes = WordHashes()
        for batch in batches:
            out = [(key, s.tobytes()) for s, key in _sets(batch.column("text").to_pylist(), words, hashes) if key]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _WHOLE, strict=True)], schema=_WHOLE)

    return texts(docs).mapInArrow(made, "set_key binary, shingles binary")


def low_halves(s: np.ndarray) -> np.ndarray:
    """The different lower 32 bits of a set's hashes, sorted."""
    return np.unique(s.astype(np.uint32))


def _packed(rows: list[np.ndarray], common: np.ndarray) -> np.ndarray:
    """A row of bits per set: which of the sorted ``common`` values it holds, 64 to a number."""
    values, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
    hit = common[at] == values
    bits = np.zeros((len(rows), -(-len(common) // 64) * 64), np.uint8)
    bits[owner[hit], at[hit]] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of values that each set of one side shares with each of the other."""
    counts = np.zeros((len(left), len(right)), np.int64)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for i in range(0, len(common), 1 << 14):
        x, y = _packed(left, common[i : i + (1 << 14)]), _packed(right, common[i : i + (1 << 14)])
        for word in range(x.shape[1]):
            counts += np.bitwise_count(x[:, word, None] & y[None, :, word])
    return counts


class _Forest:
    """Which members of a list are joined already."""

    def __init__(self, labels: np.ndarray):
        self.parent = np.unique(labels, return_inverse=True)[1]
        self.parent = np.unique(self.parent, return_index=True)[1][self.parent].tolist()

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def roots(self, part: slice) -> np.ndarray:
        return np.fromiter(map(self.root, range(*part.indices(len(self.parent)))), np.int64)

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _block_pairs(percent: int):
    """Links of a list's two blocks, or of one block, that join its members as all of its links would.

    Whole sets (``whole``) are compared exactly: a link is returned only if it joins
    members that were not joined yet.  Sets may be given by their lower halves
    (``low``): a pair that reaches the similarity even if far more values than chance
    allows are equal in the lower half only is then sure; the pairs that may reach it
    and whose ends no sure pairs join are all returned.
    """

    def compared(members: pa.Table) -> pa.Table:
        members = members.sort_by("n")
        ids, comps, sizes, block = (members.column(c).to_numpy() for c in ("id", "c", "n", "block"))
        exact = "whole" in members.column_names
        sets = [np.frombuffer(x, np.uint64 if exact else np.uint32) for x in members.column("whole" if exact else "low").to_pylist()]
        # values whose lower halves are equal within a set are counted once: at most so many are lost
        lost = sizes - np.fromiter(map(len, sets), np.int64, len(sets))
        same = members.column("i")[0].as_py() == members.column("j")[0].as_py()
        forest, chosen, unsure = _Forest(comps), [], []
        for p in range(0, len(sets), TILE):
            for q in range(p, len(sets), TILE):
                if sizes[min(p + TILE, len(sets)) - 1] * 100 < sizes[q] * percent:
                    break  # members are in order of size: all further tiles are too large
                x, y = slice(p, p + TILE), slice(q, q + TILE)
                wanted = forest.roots(x)[:, None] != forest.roots(y)[None, :]
                if not same:
                    wanted &= block[x, None] != block[None, y]
                if p == q:
                    wanted = np.triu(wanted, 1)
                if not wanted.any():
                    continue
                both, shared = sizes[x, None] + sizes[None, y], _shared(sets[x], sets[y])
                most = shared + np.minimum(lost[x, None], lost[None, y])
                # of halves, 20 times the expected number of chance matches and 3 more
                least = shared if exact else shared - 3 - np.ceil(20 * sizes[x, None] * (sizes[None, y] / 2.0**32)).astype(np.int64)
                wanted &= 100 * most >= percent * (both - most)
                sure = 100 * least >= percent * (both - least)
                for a, b in zip(*np.nonzero(wanted & sure), strict=True):
                    if forest.join(p + int(a), q + int(b)):
                        chosen.append((p + a, q + b))
                a, b = np.nonzero(wanted & ~sure)
                unsure.append(np.stack([p + a, q + b], axis=1))
        rest = [(a, b) for a, b in np.concatenate(unsure).tolist() if forest.root(a) != forest.root(b)] if unsure else []
        pairs = np.array([*chosen, *rest], np.int64).reshape(-1, 2)
        ends = np.sort(ids[pairs], axis=1)
        return pa.Table.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=_PAIRS)

    return compared


def pairs_of_long_lists(members: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` of links that join the members of every list, of ``members(value, id, c, n, whole or low, blocks)``.

    A list is dealt over ``blocks`` blocks; each two of them, and each with itself,
    are one group, so a list of any length is spread over tasks and no row is made
    per compared pair, nor per link (see :func:`_block_pairs`).
    """
    block = F.pmod(F.xxhash64("id", "value"), F.col("blocks"))
    dealt = members.withColumn("block", block.cast("long")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    dealt = dealt.select("value", "i", "j", "id", "c", "n", "block", "whole" if "whole" in dealt.columns else "low")
    return dealt.groupBy("value", "i", "j").applyInArrow(_block_pairs(percent), "a long, b long")


def _confirm(percent: int):
    """Pairs whose union sketch and then whole sets reach the similarity."""

    def confirmed(batches):
        for batch in batches:
            keep = []
            left, right = batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()
            for a, b in zip(left, right, strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                p, q = mixed(x), mixed(y)
                p, q = np.sort(p)[:SKETCH], np.sort(q)[:SKETCH]
                union = np.union1d(p, q)[:SKETCH]
                both = np.intersect1d(np.intersect1d(p, q, True), union, True)
                if len(both) < UNION_SHARE * len(union):
                    keep.append(False)
                    continue
                shared = len(np.intersect1d(x, y, True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirmed


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(id, c)`` after new links: only the components they touch are contracted anew."""
    if comp is None:
        return components(links).select(F.col("node").alias("id"), F.col("component").alias("c"))
    if links.isEmpty():
        return comp
    for end in ("a", "b"):
        old = comp.select(F.col("id").alias(end), F.col("c").alias(f"c_{end}"))
        links = links.join(old, end, "left").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))
    moved = components(links.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))).select(F.col("node").alias("was"), F.col("component").alias("now"))
    kept = comp.join(moved, comp["c"] == moved["was"], "left").select("id", F.coalesce("now", "c").alias("c"))
    single = moved.join(comp.select(F.col("id").alias("was")), "was", "left_anti").select(F.col("was").alias("id"), F.col("now").alias("c"))
    return parked(kept.unionByName(single), "contracted")


def linked_through_lists(
    lists: DataFrame, confirmed: Callable[[DataFrame], DataFrame], whole_sets: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """``(id, c)``: components of the confirmed pairs that share a list in ``lists(id, n, value)``.

    ``n`` is the set size; sizes too far apart for the similarity are no pair.
    Leader rounds come first, then all pairs of a list between different components.
    ``whole_sets`` gives ``(id, n, whole)`` of the ids of a table: set sizes and sorted hashes,
    by which lists of more than ``SHORT`` members are compared.  Such lists with the same
    least member are compared as one: lists of one template hold much the same members,
    which are then sent, compared and linked once instead of once per list.
    """
    fits = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    comp = compared = None
    done = []
    for number in range(LEADER_ROUNDS + 1):
        if comp is None:
            current = lists.withColumn("c", F.col("id"))
        else:
            current = lists.join(comp, "id", "left").withColumn("c", F.coalesce("c", "id"))
        if number < LEADER_ROUNDS:
            order = F.struct(F.xxhash64("c", F.lit(number)), F.xxhash64("id", F.lit(number)), "id", "c", "n")
            leaders = current.groupBy("value").agg(F.min(order).alias("lead"))
            pairs = current.join(leaders, "value").where("c != lead.c").select(
                F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b"), "n", F.col("lead.n").alias("m")
            )
        else:
            open_lists = current.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("id").alias("lead"), F.count(F.lit(1)).alias("members")).where("lo != hi")
            rest = parked(current.join(open_lists.select("value", "lead", "members"), "value"), "open-lists")
            short = rest.where(F.col("members") <= SHORT)
            other = short.select("value", F.col("id").alias("id2"), F.col("c").alias("c2"), F.col("n").alias("m"))
            pairs = (
                short.join(other, "value")
                .where((F.col("c") != F.col("c2")) & (F.col("id") < F.col("id2")) & fits)
                .select(F.col("id").alias("a"), F.col("id2").alias("b"), "n", "m")
            )
            long = rest.where(F.col("members") > SHORT).select(F.col("lead").alias("value"), "id", "c").distinct()
            long = long.join(whole_sets(long.select("id").distinct()), "id")
            blocks = long.groupBy("value").agg(F.ceil(F.sum("n") / BLOCK_VALUES).alias("blocks"))
            likely = pairs_of_long_lists(long.join(blocks, "value"), percent)
        pairs = pairs.where(fits).select("a", "b")
        if number == LEADER_ROUNDS:
            pairs = pairs.unionByName(likely)
        pairs = pairs.distinct()
        # a pair that was compared is linked for good or never
        pairs = parked(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), f"pairs-{number}")
        compared = pairs if compared is None else compared.unionByName(pairs)
        comp = _merged(comp, parked(confirmed(pairs), f"links-{number}"))
        done.append(pairs)
    released(rest, *done)
    return comp


def linked_components(docs: DataFrame, sets: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """``(set_key, component_id)`` of every set that occurs; the least id of its component."""
    classes = parked(
        sets.where("set_key is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.max("sketch").alias("sketch"))
        .withColumn("id", F.xxhash64("set_key")),
        "classes",
    )
    values = classes.select("id", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    entered = (
        values.join(shared, "value")
        .groupBy("id", "n", "s")
        .agg(F.sort_array(F.collect_list(F.struct("f", "value"))).alias("held"))
        .withColumn("least", F.ceil(F.col("s") * SHARE_NEEDED).cast("int"))
        .where(F.size("held") >= F.col("least"))
        # held values are the most frequent ones: the rarest s - least + 1 less those that stand alone
        .select("id", "n", F.explode(F.expr("slice(held, 1, size(held) - least + 1)")).alias("e"))
        .select("id", "n", F.col("e.value").alias("value"))
    )
    lists = parked(entered, "lists")
    # whole sets of the entered classes only, made again from one of their texts
    chosen = classes.join(lists.select("id").distinct(), "id", "left_semi")
    sources = docs.select("doc_id", "text").join(chosen.select(F.col("doc_id").alias("from_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("from_id")), "left_semi")
    full = parked(
        whole_sets(sources, words)
        .join(chosen.select("set_key", "id", "n"), "set_key")
        .groupBy("id")
        .agg(F.max("n").alias("n"), F.max("shingles").alias("shingles")),
        "whole-sets",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        wide = pairs.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("a_set")), "a").join(
            full.select(F.col("id").alias("b"), F.col("shingles").alias("b_set")), "b"
        )
        return wide.select("a", "b", "a_set", "b_set").mapInArrow(_confirm(percent), "a long, b long")

    def members_sets(ids: DataFrame) -> DataFrame:
        return ids.join(full.select("id", "n", F.col("shingles").alias("whole")), "id")

    comp = linked_through_lists(lists, confirmed, members_sets, percent)
    released(lists, full)
    marked = classes.select("set_key", "id", "doc_id").join(comp, "id", "left").withColumn("c", F.coalesce("c", "id"))
    least = marked.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return marked.join(least, "c").select("set_key", "component_id")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the least id reachable over links.  Rows without words,
    and rows whose class has no id at all, are linked with nothing; their own id
    is their component.  Repeated rows with one id are kept together.
    """
    sets = parked(shingle_sets(docs, words), "sets")
    found = linked_components(docs, sets, words, percent)
    return (
        sets.select("doc_id", "n_shingles", "set_key")
        .join(found, "set_key", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component."""
    drop = near_duplicates(docs, words, percent).where("not kept").select(F.col("doc_id").alias("dropped_id"))
    return docs.join(drop, docs["doc_id"] == drop["dropped_id"], "left_anti")


def op9_minhash_near_dedup(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4)
