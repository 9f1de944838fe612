"""Principal components and k-means clusters on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywick.operators.features import MedianScaler


def fit_column_scaler(df: DataFrame, features: Sequence[str]) -> list[Model]:
    """Imputation and population scaling of single columns, as pipeline stages."""
    return [MedianScaler(features).fit(df)]


def fit_vector_scaler(df: DataFrame, vector: str) -> list[Model]:
    """Population scaling of a vector column without missing values, as pipeline stages.

    Spark divides by the sample standard deviation; the constant product turns
    that into the population one.
    """
    n = df.count()
    scaler = StandardScaler(inputCol=vector, outputCol="centred", withMean=True).fit(df)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    product = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * scaler.mean.size), inputCol="centred", outputCol="features"
    )
    return [scaler, product]


def fit_components(df: DataFrame, scaling: Sequence[Model], k: int = 2) -> PipelineModel:
    """PCA on the centred and scaled features."""
    scaler = PipelineModel(stages=list(scaling))
    pca = PCA(k=k, inputCol="features", outputCol="components").fit(scaler.transform(df))
    return PipelineModel(stages=[*scaling, pca])


def _signs(model: PipelineModel) -> list[float]:
    """The direction of a component is arbitrary: its first loading is made positive."""
    loadings = model.stages[-1].pc.toArray()
    return [1.0 if column[0] >= 0 else -1.0 for column in loadings.T]


def component_scores(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Scores ``pc1, pc2, ...`` next to the row's own columns."""
    signs = _signs(model)
    values = vector_to_array("components")
    scores = [(F.get(values, F.lit(i)) * sign).alias(f"pc{i + 1}") for i, sign in enumerate(signs)]
    return model.transform(df).select(*keep, *scores)


def explained_variance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Share of the variance per component and its running total; one row per component."""
    rows, total = [], 0.0
    for i, share in enumerate(model.stages[-1].explainedVariance.toArray()):
        total += float(share)
        rows.append((i + 1, float(share), total))
    return spark.createDataFrame(rows, "component int, share double, running double")


def loadings(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Weight of every variable in every component, in long form."""
    matrix = model.stages[-1].pc.toArray()
    rows = [
        (i + 1, name, float(matrix[j][i]) * sign)
        for i, sign in enumerate(_signs(model))
        for j, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, "component int, variable string, loading double")


def prepared(df: DataFrame, scaling: Sequence[Model], keep: Sequence[str]) -> DataFrame:
    """Standardised feature vectors with the columns to keep."""
    return PipelineModel(stages=list(scaling)).transform(df).select(*keep, "features")


#: rows drawn (by a seeded Bernoulli sample) to place the first centres by k-means++; only the start uses it
INIT_SAMPLE = 10_000


@dataclass
class Clusters:
    """One k-means fit: centres, inertia at them, rounds run and whether the centres stopped moving."""

    k: int
    seed: int
    centres: np.ndarray
    cost: float = math.inf
    rounds: int = 0
    converged: bool = False

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name Spark ML models use
        return list(self.centres)

    def assign(self, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The nearest centre of every row, in SQL (ties: the first centre)."""
        x = vector_to_array("features")
        distances = F.array(
            *[
                F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
                for centre in self.centres
            ]
        )
        return vectors.select(*keep, distances.alias("_d")).select(
            *keep, (F.array_position("_d", F.array_min("_d")) - 1).cast("int").alias("cluster")
        )


def _starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on the sample: each next centre drawn with probability proportional to squared distance."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    nearest = ((sample - centres[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = nearest.sum()
        pick = rng.choice(len(sample), p=nearest / total) if total > 0 else rng.integers(len(sample))
        centres.append(sample[pick])
        nearest = np.minimum(nearest, ((sample - sample[pick]) ** 2).sum(axis=1))
    return np.array(centres, dtype=np.float64)


def _round(data: DataFrame, fits: list[Clusters], width: int) -> list[tuple[int, int, float, np.ndarray]]:
    """One scan: for every fit, each row joins its nearest centre; counts, costs and sums per centre.

    Each task adds up its rows per centre and gives one row per centre; Spark
    sums those per centre, so the driver receives as many rows as there are
    centres, whatever the number of rows or tasks.
    """
    import pyarrow as pa
    from pyspark.ml.stat import Summarizer

    centres = np.concatenate([f.centres for f in fits])
    squares = (centres**2).sum(axis=1)
    bounds = np.cumsum([0] + [f.k for f in fits])
    schema = pa.schema([("centre", pa.int32()), ("n", pa.int64()), ("cost", pa.float64()), ("total", pa.list_(pa.float64()))])

    def partial(batches):
        count = np.zeros(len(centres), np.int64)
        cost = np.zeros(len(centres))
        total = np.zeros((len(centres), width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            d = np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + squares, 0.0)
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                own = low + d[:, low:high].argmin(axis=1)
                count += np.bincount(own, minlength=len(centres))
                cost += np.bincount(own, weights=d[np.arange(len(x)), own], minlength=len(centres))
                np.add.at(total, own, x)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), pa.array(cost[used]), pa.array(list(total[used]), pa.list_(pa.float64()))],
            schema=schema,
        )

    sums = data.mapInArrow(partial, "centre int, n long, cost double, total array<double>").groupBy("centre").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("total")).alias("total")
    )
    return [(r["centre"], r["n"], r["cost"], r["total"].toArray()) for r in sums.collect()]


def batched_kmeans(
    vectors: DataFrame, ks: Sequence[int], restarts: int = 10, seed: int = 42, rounds: int = 100, tol: float = 1e-6
) -> list[Clusters]:
    """Lloyd's rounds of every (k, restart) at once: one scan and one aggregation per round for all fits still moving.

    A fit stops when no centre moves more than ``tol``; one that reaches
    ``rounds`` first is reported with ``converged = False``.  A centre without
    rows stays where it was.  The inertia of every fit is taken at its final
    centres in one more scan.
    """
    data = vectors.select(vector_to_array("features").alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        first = data.first()
        if not n or first is None:
            raise ValueError("k-means needs rows")
        width = len(first["x"])
        sample = np.array([r["x"] for r in data.sample(fraction=min(1.0, 2.0 * INIT_SAMPLE / n), seed=seed).limit(INIT_SAMPLE).collect()] or [first["x"]])
        fits = [Clusters(k, seed + i, _starts(sample, k, seed + 1000 * k + i)) for k in ks for i in range(restarts)]
        moving = list(fits)
        while moving:
            found = {c: (m, total) for c, m, _, total in _round(data, moving, width)}
            offset, still = 0, []
            for fit in moving:
                new = np.array([found[offset + j][1] / found[offset + j][0] if offset + j in found else fit.centres[j] for j in range(fit.k)])
                shift = np.sqrt(((new - fit.centres) ** 2).sum(axis=1)).max()
                fit.centres, fit.rounds = new, fit.rounds + 1
                fit.converged = bool(shift <= tol)
                if not fit.converged and fit.rounds < rounds:
                    still.append(fit)
                offset += fit.k
            moving = still
        costs: dict[int, float] = {}
        for c, _, cost, _ in _round(data, fits, width):
            costs[c] = cost
        offset = 0
        for fit in fits:
            fit.cost = float(sum(costs.get(offset + j, 0.0) for j in range(fit.k)))
            offset += fit.k
        return fits
    finally:
        data.unpersist()


def best_clusters(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42, rounds: int = 100) -> Clusters:
    """K-means with several seeds; the fit with the lowest inertia wins."""
    return min(batched_kmeans(vectors, [k], restarts, seed, rounds), key=lambda fit: fit.cost)


def assigned(model: Clusters, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.assign(vectors, keep)


def silhouette(df: DataFrame, vector: str, cluster: str) -> float:
    """Mean silhouette with squared Euclidean distance.

    It is exact for that distance and linear in the rows: cluster sums replace
    the pairwise distances, which plain Euclidean distance would need.
    """
    rows = df.select(F.col(vector).alias("features"), F.col(cluster).cast("double").alias("prediction"))
    return ClusteringEvaluator().evaluate(rows)


def cluster_sweep(vectors: DataFrame, ks: Sequence[int] = range(2, 8), restarts: int = 10, seed: int = 42, rounds: int = 100) -> DataFrame:
    """Inertia and silhouette for every number of clusters; one row per k, with the best fit's rounds and convergence.

    All k and restarts are fitted together (:func:`batched_kmeans`).
    """
    fits = batched_kmeans(vectors, ks, restarts, seed, rounds)
    rows = []
    for k in ks:
        best = min((f for f in fits if f.k == k), key=lambda fit: fit.cost)
        labelled = vectors.select("features").withColumn("_row", F.monotonically_increasing_id())
        score = silhouette(labelled.join(best.assign(labelled, ["_row"]), "_row"), "features", "cluster")
        rows.append((k, best.cost, score, best.rounds, best.converged))
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, rounds int, converged boolean")


def as_vector(column: Column) -> Column:
    return array_to_vector(column.cast("array<double>"))


def cluster_export(scores: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """Row key, component scores and cluster, brought together by key."""
    return scores.join(clusters, key).select(key, *[c for c in scores.columns if c != key], "cluster")
