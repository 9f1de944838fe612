"""Phrase collocations mined by SETM: relational joins of occurrence lists, level by level.

Texts are lower-cased (A-Z only), cut at ``[.,;:!?\\n\\v\\f\\r]`` into pieces and
the pieces into words (runs of anything but space and tab).  A word's number is a
64-bit hash of language and word; a seed is taken by which no two words of the
table share one, so phrases of numbers are phrases of words.  An occurrence is a
row of the word numbers at its place and the places after it: a piece's words
lie in one row in order, so SETM's join with the next place is made where the
text is read, without a shuffle.  Then, for lengths 2, 3 and 4, SETM's step:

* count the phrases of the occurrences (partial counts per task, so a very
  common phrase costs one row per task) and keep the frequent ones,
* keep, by a semi-join with the frequent phrases, only occurrences whose phrase
  is frequent and whose next place begins a frequent phrase; they feed the next
  length.

Occurrences are written after length 2, when most of them are gone.

Frequent phrases of 2 to 4 words are the candidates.  A candidate's score is
the least ``floor(2000000 a / (l + r))`` over its cuts (ties: the first cut),
where ``l`` and ``r`` are the counts of the two parts; all parts are frequent,
as no part is rarer than the whole.  Integers stay exact through decimals.
Candidates lying inside a longer candidate with ``100 f(longer) >= 80 a`` go.
The first ``TOP`` per language, by score, count and phrase (UTF-8 byte order),
are taken by two rounds of per-group ranking, so no task sorts all candidates.

Defined cases: a missing text is empty; a missing language is ``und``; repeated
rows count again; a language without candidates gives no rows; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywick.llm.common import parked, released, shipped, table

#: fixed values of the contract
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: every break is read as the first of them, a tab as a space
BREAKS, BLANKS = ",.;:!?\n\x0b\f\r", " \t"
SUPPORT, LONGEST, TOP, SCALE = 30, 4, 2000, 2_000_000
#: the containment rule: 100 f(longer) >= 80 a
KEEP_NUMERATOR, KEEP_DENOMINATOR = 80, 100
#: groups of the first ranking round; each group gives at most TOP rows to the second
RANK_GROUPS = 64
#: at most so many frequent phrases are sent to all executors, more are joined by a shuffle
SENT = 500_000
#: hash seeds that are tried; two words share a number under one of them about once in 10^4 at 10^8 words
SEEDS = 8
W = [f"w{i}" for i in range(1, LONGEST + 1)]


def pieces(docs: DataFrame) -> DataFrame:
    """``lang, words`` of every piece (not written: it is as large as the text)."""
    shipped(docs.sparkSession)
    plain = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER + BREAKS + BLANKS, LOWER + BREAKS[0] * len(BREAKS) + BLANKS[0] * len(BLANKS))
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(plain, BREAKS[0], -1)).alias("body"))
    return rows.select("lang", F.array_remove(F.split("body", BLANKS[0], -1), "").alias("words"))


def word_number(lang: Column, word: Column, seed: int) -> Column:
    return F.xxhash64(lang, word, F.lit(seed))


def seed_for(counts: DataFrame) -> int:
    """A seed by which all words of ``counts(lang, word)`` have numbers of their own."""
    for seed in range(SEEDS):
        numbers = counts.groupBy(word_number(F.col("lang"), F.col("word"), seed).alias("wid")).count()
        if numbers.where("count > 1").isEmpty():
            return seed
    raise RuntimeError(f"words share numbers under each of {SEEDS} seeds")


def occurrences(docs: DataFrame, seed: int, longest: int) -> DataFrame:
    """``w1, ..., w<longest>`` of every place: its word number and those of the places after it, null beyond the piece."""
    numbered = pieces(docs).select(F.transform("words", lambda w: word_number(F.col("lang"), w, seed)).alias("ids"))
    following = [F.expr(f"slice(ids, {i}, size(ids))").alias(W[i - 1]) for i in range(1, longest + 1)]
    return numbered.select(F.explode(F.arrays_zip(*following)).alias("o")).select(*[F.col("o")[W[i]].alias(W[i]) for i in range(longest)])


def counted(places: DataFrame, k: int) -> DataFrame:
    """``w1, ..., wk, f`` of phrases seen at least SUPPORT times (a word number implies its language); written."""
    found = places.where(F.col(W[k - 1]).isNotNull()).groupBy(*W[:k]).agg(F.count(F.lit(1)).alias("f"))
    return parked(found.where(F.col("f") >= SUPPORT), f"setm-{k}-counts")


def frequent_here_and_next(places: DataFrame, phrases: DataFrame, k: int) -> DataFrame:
    """Places at which a frequent phrase of k words begins, and another one at the next place."""
    few = phrases.count() <= SENT
    for first in (0, 1):
        wanted = phrases.select(*[F.col(W[i]).alias(W[i + first]) for i in range(k)])
        places = places.join(F.broadcast(wanted) if few else wanted, W[first : first + k], "left_semi")
    return places


def mined(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases ``lang, ids, k, f`` of 1 to LONGEST words, the word numbers ``lang, wid, word`` and ``lang, n``."""
    words = pieces(docs).select("lang", F.explode("words").alias("word"))
    counts = parked(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")), "setm-words")
    seed = seed_for(counts)
    totals = parked(counts.groupBy("lang").agg(F.sum("f").alias("n")), "setm-totals")
    numbered = counts.where(F.col("f") >= SUPPORT).withColumn("wid", word_number(F.col("lang"), F.col("word"), seed))
    numbers = parked(numbered, "setm-numbers")
    released(counts)
    found = [numbers.select(F.array("wid").alias("ids"), F.lit(1).alias("k"), "f")]
    places = None
    for k in range(2, LONGEST + 1):
        level = counted(occurrences(docs, seed, k) if places is None else places, k)
        found.append(level.select(F.array(*W[:k]).alias("ids"), F.lit(k).alias("k"), "f"))
        if places is None:
            places = parked(frequent_here_and_next(occurrences(docs, seed, LONGEST), level, k), f"setm-{k}")
            written = places
        elif k < LONGEST:
            places = frequent_here_and_next(places, level, k)
    released(written)
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    languages = numbers.select(F.col("wid").alias("first"), "lang")
    phrases = phrases.withColumn("first", F.element_at("ids", 1)).join(languages, "first").drop("first")
    return parked(phrases, "setm-phrases"), numbers.select("lang", "wid", "word"), totals


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, ids, k, a, l, r, score`` of candidates, by their lowest-scoring cut."""
    candidates = phrases.where(F.col("k") >= 2).select("lang", "ids", "k", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.slice("ids", F.lit(1), F.col("cut")).alias("left"), F.expr("slice(ids, cut + 1, k - cut)").alias("right")
    )
    parts = phrases.select("lang", "ids", "f")
    priced = (
        cuts.join(parts.select("lang", F.col("ids").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("ids").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumn(
            "score",
            F.expr(f"cast(a as decimal(38, 0)) * {SCALE} div (cast(l as decimal(38, 0)) + cast(r as decimal(38, 0)))").cast("long"),
        )
    )
    best = priced.groupBy("lang", "ids", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "ids", "k", "a", "best.l", "best.r", "best.score")


def without_contained(candidates: DataFrame) -> DataFrame:
    """Drops candidates lying inside a longer candidate whose count is at least 80 % of theirs."""
    inner = candidates.where(F.col("k") >= 3).select(
        "lang", F.col("a").alias("outer"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"), "ids", "k"
    )
    inner = inner.select("lang", "outer", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"), "size", "ids").select(
        "lang", "outer", F.expr("slice(ids, start, size)").alias("ids")
    )
    strongest = inner.groupBy("lang", "ids").agg(F.max("outer").alias("outer"))
    dropped = candidates.join(strongest, ["lang", "ids"]).where(
        F.col("outer").cast("decimal(38, 0)") * KEEP_DENOMINATOR >= F.col("a").cast("decimal(38, 0)") * KEEP_NUMERATOR
    )
    return candidates.join(dropped.select("lang", "ids"), ["lang", "ids"], "left_anti")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` collocations."""
    phrases, numbers, totals = mined(docs)
    kept = parked(without_contained(scored(phrases)), "setm-kept")
    spelled = (
        kept.select("lang", "ids", F.posexplode("ids").alias("place", "wid"))
        .join(numbers, ["lang", "wid"])
        .groupBy("lang", "ids")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    ranked = kept.join(spelled, ["lang", "ids"]).drop("ids")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = ranked.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))).withColumn(
        "within", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    )
    final = first.where(F.col("within") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return final.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("a").cast("long").alias("a"), F.col("l").cast("long").alias("l"),
        F.col("r").cast("long").alias("r"), F.col("n").cast("long").alias("n"), F.col("score").cast("long").alias("score"),
    )


def op13_phrase_collocations(spark, folder: str) -> DataFrame:
    """The first 2000 collocations of each language over every whole text of ``documents``."""
    return collocations(table(spark, folder, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (
  SELECT rid, lang, unnest(string_split_regex(t, '[.,;:!?\n\x0B\f\r]')) AS piece,
         generate_subscripts(string_split_regex(t, '[.,;:!?\n\x0B\f\r]'), 1) AS pno
  FROM d),
w AS (
  SELECT rid, lang, pno, unnest(regexp_extract_all(piece, '[^ \t]+')) AS word,
         generate_subscripts(regexp_extract_all(piece, '[^ \t]+'), 1) AS pos
  FROM p),
g AS (
  SELECT lang, word AS w1, lead(word, 1) OVER s AS w2, lead(word, 2) OVER s AS w3, lead(word, 3) OVER s AS w4
  FROM w WINDOW s AS (PARTITION BY rid, pno ORDER BY pos)),
occ AS (
  SELECT lang, w1 AS phrase, 1 AS len FROM g
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM g WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM g WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM g WHERE w4 IS NOT NULL),
f AS (SELECT lang, phrase, len, count(*) AS f FROM occ GROUP BY lang, phrase, len),
totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, len, f AS a, string_split(phrase, ' ') AS parts FROM f WHERE len BETWEEN 2 AND 4 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.len, c.a, k.k, fl.f AS l, fr.f AS r,
         CAST((CAST(c.a AS HUGEINT) * 2000000) // (CAST(fl.f AS HUGEINT) + CAST(fr.f AS HUGEINT)) AS BIGINT) AS score
  FROM c, generate_series(1, 3) AS k(k), f fl, f fr
  WHERE k.k < c.len
    AND fl.lang = c.lang AND fl.phrase = array_to_string(list_slice(c.parts, 1, k.k), ' ')
    AND fr.lang = c.lang AND fr.phrase = array_to_string(list_slice(c.parts, k.k + 1, c.len), ' ')),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
kept AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (
    SELECT 1 FROM c q
    WHERE q.lang = b.lang AND q.len > b.len AND 100 * q.a >= 80 * b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept)
SELECT r.lang, CAST(r.rank AS BIGINT) AS rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l,
       CAST(r.r AS BIGINT) AS r, CAST(t.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t USING (lang)
WHERE r.rank <= 2000
"""
