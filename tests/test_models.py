"""Models against closed forms, and properties where there is none."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallywick.operators import components as comp
from tallywick.operators import features as feat
from tallywick.operators import regression as reg

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    data = pd.DataFrame(rng.normal(size=(300, 3)) * [1, 5, 0.1] + [0, 3, 1], columns=COLUMNS)
    data["y"] = 2 * data["a"] - data["b"] + 4 * data["c"] + rng.normal(size=300) * 0.1
    data["key"] = np.arange(300)
    data.loc[data.index % 17 == 0, "b"] = None
    return data


@pytest.fixture(scope="module")
def rows(spark, frame):
    schema = "a double, b double, c double, y double, key int"
    values = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    values = [(a, b, c, y, int(k)) for a, b, c, y, k in values]
    return spark.createDataFrame(values, schema).cache()


def scaled(frame):
    filled = frame[COLUMNS].fillna(frame[COLUMNS].median())
    return (filled - filled.mean()) / filled.std(ddof=0)


def matrix(df, column, order="key"):
    return np.array([r[column].toArray() for r in df.orderBy(order).collect()])


def test_median_scaler_equals_numpy(rows, frame):
    found = matrix(feat.MedianScaler(COLUMNS).fit(rows).transform(rows), "features")
    assert found == pytest.approx(scaled(frame).to_numpy())


def test_scaler_and_pipeline_are_saved_and_loaded(rows, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.regression import LinearRegression

    scaler = feat.MedianScaler(COLUMNS, impute=["b"])
    scaler.write().save(str(tmp_path / "stage"))
    again = feat.MedianScaler.load(str(tmp_path / "stage"))
    assert (again.columns, again.output, again.impute) == (COLUMNS, "features", ["b"])
    model = scaler.fit(rows)
    model.write().save(str(tmp_path / "model"))
    loaded = feat.MedianScalerModel.load(str(tmp_path / "model"))
    assert loaded.medians == model.medians and loaded.stats == model.stats
    assert matrix(loaded.transform(rows), "features") == pytest.approx(matrix(model.transform(rows), "features"))
    fitted = Pipeline(stages=[feat.MedianScaler(COLUMNS), LinearRegression(labelCol="y")]).fit(rows)
    fitted.write().save(str(tmp_path / "pipeline"))
    scored = PipelineModel.load(str(tmp_path / "pipeline")).transform(rows).orderBy("key")
    assert [r["prediction"] for r in scored.collect()] == pytest.approx([r["prediction"] for r in fitted.transform(rows).orderBy("key").collect()])


def test_median_scaler_edges(spark):
    data = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "key int, flat double, none double")
    found = matrix(feat.MedianScaler(["flat", "none"]).fit(data).transform(data), "features")
    assert (found == 0).all()
    later = spark.createDataFrame([(1, None, 2.0)], "key int, flat double, none double")
    assert matrix(feat.MedianScaler(["flat", "none"]).fit(data).transform(later), "features").tolist() == [[0.0, 2.0]]


def test_medians_and_standardised_columns(rows, frame):
    filled = feat.with_medians_filled(rows, COLUMNS).orderBy("key").toPandas()
    assert filled["b"].to_numpy() == pytest.approx(frame["b"].fillna(frame["b"].median()).to_numpy())
    std = feat.standardised_columns(rows, ["a"]).orderBy("key").toPandas()["a_std"]
    assert std.to_numpy() == pytest.approx(((frame["a"] - frame["a"].mean()) / frame["a"].std(ddof=0)).to_numpy())


def test_ordinary_least_squares_equals_the_normal_equations(rows, frame):
    models, scores = reg.train(rows, "key", COLUMNS, "y", {"linear": reg.linear_model("y")})
    parts = {r["key"]: r["part"] for r in feat.split_by_key(rows, "key").collect()}
    train = frame["key"].map(parts) == "train"
    assert 0.7 < train.mean() < 0.9
    medians = frame[train][COLUMNS].median()
    filled = frame[COLUMNS].fillna(medians)
    design = np.column_stack([np.ones(len(filled)), filled])
    beta = np.linalg.lstsq(design[train], frame["y"][train], rcond=None)[0]
    expected = design @ beta
    found = reg.scored(models["linear"], rows, ["key"]).orderBy("key").toPandas()["prediction"]
    assert found.to_numpy() == pytest.approx(expected, rel=1e-8)
    error = (frame["y"] - expected)[~train]
    row = scores.first()
    assert row["mae"] == pytest.approx(error.abs().mean())
    assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert row["r2"] == pytest.approx(1 - (error**2).mean() / frame["y"][~train].var(ddof=0))


@pytest.mark.parametrize("with_gap", [False, True])
def test_targets_trained_together_equal_each_alone(rows, with_gap):
    other = F.col("y") * 2 + F.col("a")
    both = rows.withColumn("z", F.when(F.col("key") % 7 != 0, other) if with_gap else F.coalesce(other, F.lit(0.0)))
    estimators = {t: {"linear": reg.linear_model(t)} for t in ("y", "z")}
    models, scores = reg.train_targets(both, "key", COLUMNS, estimators)
    found = {r["target"]: r for r in scores.collect()}
    for target in estimators:
        alone, score = reg.train(both, "key", COLUMNS, target, estimators[target])
        row = score.first()
        assert found[target]["n"] == row["n"] and found[target]["rmse"] == pytest.approx(row["rmse"], rel=1e-8)
        for column, stats in alone["linear"].stages[0].stats.items():
            assert models[target]["linear"].stages[0].stats[column] == pytest.approx(stats)


def test_column_medians_shuffle_no_row(spark, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of unknown size
    try:
        plan = feat.column_medians(rows, COLUMNS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan


def test_leaky_preparation_uses_all_rows(rows, frame):
    models, _ = reg.train(rows, "key", COLUMNS, "y", {"linear": reg.linear_model("y")}, leaky=True)
    assert models["linear"].stages[0].stats["a"][0] == pytest.approx(frame["a"].mean())
    clean, _ = reg.train(rows, "key", COLUMNS, "y", {"linear": reg.linear_model("y")})
    assert clean["linear"].stages[0].stats["a"][0] != pytest.approx(frame["a"].mean(), abs=1e-9)


def test_forest_and_importances(spark, rows):
    forest = reg.forest_model("y", trees=15, depth=6)
    models, scores = reg.train(rows, "key", COLUMNS, "y", {"forest": forest})
    assert scores.first()["r2"] > 0.8
    found = reg.importances(spark, models["forest"], COLUMNS).collect()
    assert sum(r["importance"] for r in found) == pytest.approx(1)
    assert found[0]["feature"] == "b" and found == sorted(found, key=lambda r: -r["importance"])


def test_forest_defaults():
    forest = reg.forest_model("y")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (500, 30, "all")


def test_folds(rows):
    scores = reg.fold_scores(rows, "key", COLUMNS, "y", reg.linear_model("y"), folds=3)
    found = scores.collect()
    assert [r["fold"] for r in found] == [0, 1, 2] and sum(r["n"] for r in found) == 300
    summary = reg.fold_summary(scores).first()
    r2 = [r["r2"] for r in found]
    assert (summary["mean_r2"], summary["std_r2"]) == pytest.approx((np.mean(r2), np.std(r2)))


def test_grid_search_prefers_the_better_setting(rows):
    model, table = reg.grid_search(
        rows, "key", COLUMNS, "y", reg.forest_model("y", trees=5, depth=5), {"maxDepth": [1, 5]}, folds=2
    )
    found = {r["maxDepth"]: r for r in table.collect()}
    assert found["5"]["best"] and not found["1"]["best"] and found["5"]["mean_r2"] > found["1"]["mean_r2"]
    assert reg.scored(model, rows, ["key"]).count() == 300


def test_metrics_skip_rows_without_target(spark):
    data = spark.createDataFrame([(1.0, 1.5), (3.0, 2.5), (None, 9.0)], "y double, f double")
    row = reg.regression_metrics(data, "y", "f").first()
    assert (row["n"], row["mae"], row["rmse"], row["r2"]) == (2, 0.5, 0.5, 0.75)
    constant = spark.createDataFrame([(1.0, 1.5), (1.0, 2.5)], "y double, f double")
    assert reg.regression_metrics(constant, "y", "f").first()["r2"] is None


def test_components_equal_numpy(spark, rows, frame):
    model = comp.fit_components(rows, comp.fit_column_scaler(rows, COLUMNS))
    z = scaled(frame).to_numpy()
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = np.argsort(values)[::-1][:2]
    top = vectors[:, order] * np.sign(vectors[0, order])
    scores = comp.component_scores(model, rows, ["key"]).orderBy("key").toPandas()[["pc1", "pc2"]].to_numpy()
    assert scores == pytest.approx(z @ top)
    share = comp.explained_variance(spark, model).collect()
    assert [r["share"] for r in share] == pytest.approx(list(values[order] / values.sum()))
    assert share[1]["running"] == pytest.approx(share[0]["share"] + share[1]["share"])
    weights = {(r["component"], r["variable"]): r["loading"] for r in comp.loadings(spark, model, COLUMNS).collect()}
    assert weights[2, "c"] == pytest.approx(top[2, 1]) and len(weights) == 6


def test_vector_scaler_equals_column_scaler(rows):
    complete = feat.with_medians_filled(rows, COLUMNS).withColumn("v", comp.as_vector(F.array(*COLUMNS)))
    by_vector = matrix(comp.prepared(complete, comp.fit_vector_scaler(complete, "v"), ["key"]), "features")
    by_column = matrix(comp.prepared(complete, comp.fit_column_scaler(complete, COLUMNS), ["key"]), "features")
    assert by_vector == pytest.approx(by_column)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(40, 2)) * 0.3 + centre for centre in ([0, 0], [5, 0], [0, 5])])
    return points, spark.createDataFrame([(i, Vectors.dense(p), i // 40) for i, p in enumerate(points)], ["key", "features", "label"])


def test_clusters(blobs):
    points, vectors = blobs
    model = comp.best_clusters(vectors, 3, restarts=3)
    centres = np.array(model.clusterCenters())
    found = np.array([r["cluster"] for r in comp.assigned(model, vectors, ["key"]).orderBy("key").collect()])
    distances = ((points[:, None] - centres) ** 2).sum(axis=2)
    assert (distances.argmin(axis=1) == found).all()
    assert model.cost == pytest.approx(distances.min(axis=1).sum())
    assert model.converged and model.rounds >= 1
    assert all(len(set(found[i : i + 40])) == 1 for i in (0, 40, 80))


def test_silhouette_equals_all_pairs(blobs):
    points, vectors = blobs
    labels = np.repeat([0, 1, 2], 40)
    d = ((points[:, None] - points) ** 2).sum(axis=2)
    scores = []
    for i in range(len(points)):
        inside = d[i, labels == labels[i]].sum() / 39
        outside = min(d[i, labels == k].mean() for k in {0, 1, 2} - {labels[i]})
        scores.append((outside - inside) / max(inside, outside))
    assert comp.silhouette(vectors, "features", "label") == pytest.approx(np.mean(scores))


def test_sweep_and_export(blobs):
    _, vectors = blobs
    table = comp.cluster_sweep(vectors, ks=[2, 3, 4], restarts=2).collect()
    assert [r["k"] for r in table] == [2, 3, 4]
    assert max(table, key=lambda r: r["silhouette"])["k"] == 3
    assert table[0]["inertia"] > table[1]["inertia"]
    assert all(r["converged"] for r in table)
    scores = vectors.select("key", F.lit(0.5).alias("pc1"))
    out = comp.cluster_export(scores, vectors.select("key", F.col("label").alias("cluster")), "key")
    assert out.columns == ["key", "pc1", "cluster"] and out.count() == 120


def test_batched_fits_equal_spark_ml(blobs):
    """Every restart of every k reaches the inertia Spark ML's k-means reaches from the same data."""
    from pyspark.ml.clustering import KMeans

    _, vectors = blobs
    fits = comp.batched_kmeans(vectors, [2, 3], restarts=4, seed=3)
    assert len(fits) == 8 and all(f.converged for f in fits)
    for k in (2, 3):
        theirs = min(KMeans(k=k, seed=s, tol=1e-6).fit(vectors).summary.trainingCost for s in range(4))
        ours = min(f.cost for f in fits if f.k == k)
        assert ours == pytest.approx(theirs, rel=1e-9)


def test_grid_search_equals_cross_validation(rows):
    """Sharing each fold's scaler among settings gives Spark's CrossValidator's numbers."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    forest = reg.forest_model("y", trees=5, depth=3)
    grid = {"maxDepth": [2, 4]}
    _, table = reg.grid_search(rows, "key", COLUMNS, "y", forest, grid, folds=3)
    prepared = feat.with_fold(rows.na.drop(subset=["y"]), "key", 3)
    gaps = feat.columns_with_gaps(prepared, COLUMNS)
    settings = ParamGridBuilder().addGrid(forest.getParam("maxDepth"), [2, 4]).build()
    theirs = CrossValidator(
        estimator=reg.pipeline(COLUMNS, forest, gaps), estimatorParamMaps=settings,
        evaluator=RegressionEvaluator(labelCol="y", metricName="r2"), numFolds=3, foldCol="fold",
    ).fit(prepared)
    ours = {r["maxDepth"]: (r["mean_r2"], r["std_r2"]) for r in table.collect()}
    assert [*ours["2"], *ours["4"]] == pytest.approx([x for pair in zip(theirs.avgMetrics, theirs.stdMetrics) for x in pair])
