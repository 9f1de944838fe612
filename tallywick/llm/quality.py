"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on statistics of a bounded sample of labelled texts;
every path from a root is a conjunction of comparisons, a rule.  A lasso
logistic fit over the rules' 0/1 values leaves few of them with a weight.  The
kept rules are compiled to column expressions, so scoring is one narrow pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import parked, shipped, table

#: at most about this many labelled rows are used for fitting; more rows do not
#: change rules over some twenty statistics
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 12, 3, 42
LASSO = 0.002
THRESHOLD = 0.7

STATISTICS = [
    "log_words", "mean_word", "distinct_share", "top_share", "repeat_share", "symbol_share", "upper_share", "digit_share",
    "stop_share", "punctuation_share", "blank_share", "line_repeat_share", "log_line", "word_end_symbols", "non_ascii_share", "bigram_distinct",
]
_UPPER, _LOWER, _DIGIT, _BLANK = (bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" \t\r\n\x0b\x0c")
_SENTENCE = b".,;:'\"()-?!"
#: fixed values: frequent short words of English, German, French and Spanish
_STOP = frozenset(
    "the of and to in a is that it for was on are as with be by this from or at le la les de des et un une en que qui dans du der die das und ist nicht von zu den mit el los las y es no por para".encode().split()
)


def text_statistics(text: str | None) -> tuple[float, ...]:
    """Statistics of a whole text; those of an empty one are zero."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    size, n = len(raw), len(words)

    def share(characters: bytes) -> float:
        return (size - len(raw.translate(None, characters))) / size

    lowered = raw.lower().split()
    counts: dict[bytes, int] = {}
    for word in lowered:
        counts[word] = counts.get(word, 0) + 1
    repeats = sum(map(bytes.__eq__, lowered, lowered[1:]))
    bigrams = len(set(zip(lowered, lowered[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower, digit, blank, sentence = map(share, (_UPPER, _LOWER, _DIGIT, _BLANK, _SENTENCE))
    high = (size - len(raw.translate(None, bytes(range(128, 256))))) / size
    symbols = max(0.0, 1.0 - upper - lower - digit - blank - sentence - high)
    letters = upper + lower
    ends = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1] in b".,") for w in words) / n
    return (
        math.log(n), size / n, len(counts) / n, max(counts.values()) / n, repeats / n, symbols, upper / letters if letters else 0.0, digit,
        sum(counts.get(w, 0) for w in _STOP) / n, sentence, blank, 1 - len(set(lines)) / len(lines), math.log(size / len(lines)), ends, high,
        bigrams / max(1, n - 1),
    )


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Adds a struct of statistics under a name no column has."""
    shipped(docs.sparkSession)

    def statistics(texts):
        return pd.DataFrame([text_statistics(t) for t in texts], columns=STATISTICS)

    measured = F.pandas_udf(statistics, ", ".join(f"{s} double" for s in STATISTICS), F.PandasUDFType.SCALAR)
    return docs.withColumn(name, measured(F.col(text).cast("string")))


@dataclass(frozen=True)
class Rule:
    """Comparisons ``(statistic, at most?, threshold)`` that must all hold, and a weight."""

    parts: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, name: str) -> Column:
        held = F.lit(True)
        for statistic, below, edge in self.parts:
            value = F.col(f"{name}.{statistic}")
            held = held & ((value <= edge) if below else (value > edge))
        return held


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, name: str) -> Column:
        """The probability of label 1 as an expression over the struct ``name``."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(name), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(tree) -> list[Rule]:
    """The path to every node below the root of a fitted tree."""
    found: list[Rule] = []

    def walk(node, parts):
        if parts:
            found.append(Rule(parts))
        if node.numDescendants():
            split = node.split()
            statistic, edge = STATISTICS[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), (*parts, (statistic, True, edge)))
            walk(node.rightChild(), (*parts, (statistic, False, edge)))

    walk(tree._call_java("rootNode"), ())
    return found


def fit(labelled: DataFrame, rows: int = TRAINING_ROWS) -> RuleModel:
    """Fits on ``text`` and ``label`` (0 or 1) of at most about ``rows`` rows.

    Where there are more, rows are taken by a hash of the text, so the choice does
    not depend on partitions.  Fewer than two rows, or one label only, give a
    model without rules that returns the share of label 1 (0.5 for no rows).
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    labelled = labelled.where("label in (0, 1)")
    count, ones = labelled.agg(F.count(F.lit(1)), F.sum(F.col("label"))).first()
    if not count or ones in (0, count):
        p = min(max((ones or 0) / count if count else 0.5, 1e-3), 1 - 1e-3)
        return RuleModel((), math.log(p / (1 - p)))
    chosen = labelled.select(F.col("text").cast("string").alias("text"), F.col("label").cast("double").alias("label"))
    if count > rows:
        chosen = chosen.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * rows / count))
    measured = parked(with_statistics(chosen, "s").select("label", "s"), "statistics").coalesce(2)
    inputs = measured.select("label", "s", array_to_vector(F.array(*[F.col(f"s.{x}") for x in STATISTICS])).alias("features")).cache()
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(inputs)
    rules = sorted({r.parts for tree in forest.trees for r in tree_rules(tree)})
    held = [F.when(Rule(parts).column("s"), 1.0).otherwise(0.0) for parts in rules]
    table_of_rules = inputs.select("label", array_to_vector(F.array(*held)).alias("features")).cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(table_of_rules)
    weights = lasso.coefficients.toArray()
    inputs.unpersist()
    table_of_rules.unpersist()
    kept = tuple(Rule(parts, float(w)) for parts, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return RuleModel(kept, float(lasso.intercept))


def held_out() -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> RuleModel:
    """Fits on at most about ``rows`` of the labels not held out, taken by a hash of the id."""
    marks = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")).where("label is not null and doc_id is not null")
    count = marks.count()
    if count > rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / count))
    # about `rows` pairs of numbers, so the texts need no shuffle
    return fit(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "label"), rows)


def scored(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; a missing text scores as an empty one."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_statistics(chosen, "s").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), model.score("s").alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_rejected(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, all their columns unchanged."""
    name = "statistics_of_text"
    while name in docs.columns:
        name += "_"
    return with_statistics(docs, name).where(model.score(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_quality_classifier(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scored(docs, trained(docs, table(spark, folder, "labels")))
