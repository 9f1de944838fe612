"""Regression, principal components and clusters."""

from pyspark.sql import functions as F

from tallywick.operators import components as comp
from tallywick.operators import regression as reg
from tallywick.operators.joining import compared
from tallywick.operators.shaping import group_means
from tallywick.plans.features import HASH
from tallywick.plans.registry import query, steady, steady_query
from tallywick.sources.files import table

FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
TARGET = "l_extendedprice"


def _lines(spark, folder):
    """Every line with its part's features and a key of its own."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size")
    return lines.join(parts, "l_partkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"), TARGET, *FEATURES
    )


@query(
    "regression_metrics",
    steady_query(
        """SELECT count(*) AS n, avg(abs(y - f)) AS mae, sqrt(avg((y - f) ** 2)) AS rmse,
                  1 - sum((y - f) ** 2) / sum((y - m) ** 2) AS r2
           FROM (SELECT l_extendedprice AS y, l_quantity * 2000 AS f, avg(l_extendedprice) OVER () AS m FROM lineitem)""",
        ["n"],
        ["mae", "rmse", "r2"],
    ),
)
def regression_metrics(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    return steady(reg.regression_metrics(lines, "l_extendedprice", "guess"))


TWO = ["size", "price"]
TWO_TARGET = "acctbal"
# customers with two features that vary by customer; the target depends on both
CUSTOMER_SQL = """
    SELECT c_custkey, n::DOUBLE AS size, total / n AS price, c_acctbal + 0.01 * total AS acctbal
    FROM customer JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
    ON c_custkey = o_custkey
"""


def _customers(spark, folder):
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    totals = orders.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return table(spark, folder, "customer").join(totals, "c_custkey").select(
        "c_custkey",
        F.col("n").cast("double").alias("size"),
        (F.col("total") / F.col("n")).alias("price"),
        (F.col("c_acctbal") + 0.01 * F.col("total")).alias("acctbal"),
    )


KEY_HASH = HASH.format(key="c_custkey")


def _line_of(source: str) -> str:
    """Closed-form least squares with two features, as one row ``a, b1, b2``."""
    return f"""
        SELECT my - b1 * m1 - b2 * m2 AS a, b1, b2 FROM (
            SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
                   (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
            FROM (SELECT avg(size) AS m1, avg(price) AS m2, avg(acctbal) AS my, var_pop(size) AS s11,
                         var_pop(price) AS s22, covar_pop(size, price) AS s12, covar_pop(size, acctbal) AS s1y,
                         covar_pop(price, acctbal) AS s2y FROM {source}))"""


SPLIT_SQL = f"""
    WITH c AS ({CUSTOMER_SQL}), s AS (SELECT *, {KEY_HASH} % 100 < 80 AS train FROM c),
    fit AS ({_line_of("(SELECT * FROM s WHERE train)")})
"""


@query(
    "linear_predictions",
    f"""{SPLIT_SQL} SELECT c_custkey, round(acctbal, 4) AS acctbal, round(a + b1 * size + b2 * price, 4) AS prediction
        FROM s, fit WHERE NOT train""",
)
def linear_predictions(spark, folder):
    """Predicted against actual on the rows the model has not seen."""
    customers = _customers(spark, folder)
    models, _ = reg.train(customers, "c_custkey", TWO, TWO_TARGET, {"linear": reg.linear_model(TWO_TARGET)})
    holdout = reg.split_by_key(customers, "c_custkey").where("part = 'test'")
    rows = reg.scored(models["linear"], holdout, ["c_custkey", TWO_TARGET])
    return rows.select("c_custkey", F.round("acctbal", 4).alias("acctbal"), F.round("prediction", 4).alias("prediction"))


@query(
    "linear_model_scores",
    steady_query(
        f"""{SPLIT_SQL}, p AS (SELECT acctbal AS y, a + b1 * size + b2 * price AS f FROM s, fit WHERE NOT train)
            SELECT 'acctbal' AS target, 'linear' AS model, count(*) AS n, avg(abs(y - f)) AS mae,
                   sqrt(avg((y - f) ** 2)) AS rmse, 1 - avg((y - f) ** 2) / var_pop(y) AS r2 FROM p""",
        ["target", "model", "n"],
        ["mae", "rmse", "r2"],
    ),
)
def linear_model_scores(spark, folder):
    estimators = {"linear": reg.linear_model(TWO_TARGET)}
    return steady(reg.train(_customers(spark, folder), "c_custkey", TWO, TWO_TARGET, estimators)[1])


def _fold_sql(fold: int) -> str:
    fit = _line_of(f"(SELECT * FROM s WHERE fold <> {fold})")
    return f"""SELECT {fold} AS fold, count(*) AS n,
                      1 - avg((acctbal - (a + b1 * size + b2 * price)) ** 2) / var_pop(acctbal) AS r2
               FROM s, ({fit}) WHERE fold = {fold}"""


FOLDS_SQL = f"WITH c AS ({CUSTOMER_SQL}), s AS (SELECT *, {KEY_HASH} % 5 AS fold FROM c) " + " UNION ALL ".join(
    map(_fold_sql, range(5))
)


@query("fold_scores_linear", steady_query(FOLDS_SQL, ["fold", "n"], ["r2"]))
def fold_scores_linear(spark, folder):
    return steady(reg.fold_scores(_customers(spark, folder), "c_custkey", TWO, TWO_TARGET, reg.linear_model(TWO_TARGET)))


@query(
    "fold_summary_linear",
    steady_query(
        f"WITH f AS ({FOLDS_SQL}) SELECT count(*) AS folds, avg(r2) AS mean_r2, stddev_pop(r2) AS std_r2 FROM f",
        ["folds"],
        ["mean_r2", "std_r2"],
    ),
)
def fold_summary_linear(spark, folder):
    scores = reg.fold_scores(_customers(spark, folder), "c_custkey", TWO, TWO_TARGET, reg.linear_model(TWO_TARGET))
    return steady(reg.fold_summary(scores))


def _small_forest(target, depth=6):
    return reg.forest_model(target, trees=20, depth=depth)


@query("model_scores")
def model_scores(spark, folder):
    estimators = {"linear": reg.linear_model(TARGET), "forest": _small_forest(TARGET)}
    return reg.train(_lines(spark, folder), "line", FEATURES, TARGET, estimators)[1]


@query("model_comparison")
def model_comparison(spark, folder):
    """Both models on two targets, side by side per target."""
    lines = _lines(spark, folder).withColumn("revenue", F.col(TARGET) * (1 - F.col("l_discount")))
    estimators = {t: {"linear": reg.linear_model(t), "forest": _small_forest(t, depth=4)} for t in (TARGET, "revenue")}
    both = reg.train_targets(lines, "line", FEATURES, estimators)[1]
    linear, forest = (both.where(F.col("model") == m).drop("model", "n") for m in ("linear", "forest"))
    return compared(linear, forest, "target", ("_linear", "_forest"))


@query("fold_scores_forest")
def fold_scores_forest(spark, folder):
    return reg.fold_scores(_customers(spark, folder), "c_custkey", TWO, TWO_TARGET, _small_forest(TWO_TARGET))


@query("grid_search")
def grid_search(spark, folder):
    grid = {"maxDepth": [3, 6], "minInstancesPerNode": [1, 5]}
    return reg.grid_search(
        _customers(spark, folder), "c_custkey", TWO, TWO_TARGET, reg.forest_model(TWO_TARGET, trees=10, depth=6), grid
    )[1]


@query("importances")
def importances(spark, folder):
    models, _ = reg.train(_lines(spark, folder), "line", FEATURES, TARGET, {"forest": _small_forest(TARGET)})
    return reg.importances(spark, models["forest"], FEATURES)


@query("importances_compared")
def importances_compared(spark, folder):
    """What matters for two targets, side by side."""
    lines = _lines(spark, folder).withColumn("revenue", F.col(TARGET) * (1 - F.col("l_discount")))
    models, _ = reg.train_targets(lines, "line", FEATURES, {t: {"forest": _small_forest(t, depth=4)} for t in (TARGET, "revenue")})
    sides = [reg.importances(spark, found["forest"], FEATURES) for found in models.values()]
    return compared(*sides, "feature", ("_price", "_revenue"))


@query(
    "scored_table_linear",
    f"""{SPLIT_SQL} SELECT c_custkey, round(a + b1 * size + b2 * price, 4) AS prediction FROM s, fit""",
)
def scored_table_linear(spark, folder):
    """A model trained on a part of the table, applied to all of it."""
    customers = _customers(spark, folder)
    models, _ = reg.train(customers, "c_custkey", TWO, TWO_TARGET, {"linear": reg.linear_model(TWO_TARGET)})
    rows = reg.scored(models["linear"], customers, ["c_custkey"])
    return rows.select("c_custkey", F.round("prediction", 4).alias("prediction"))


@query("scored_table")
def scored_table(spark, folder):
    lines = _lines(spark, folder)
    models, _ = reg.train(lines, "line", FEATURES, TARGET, {"forest": _small_forest(TARGET, depth=4)})
    return reg.scored(models["forest"], lines, ["line", TARGET])


# with two standardised columns the components are known in closed form
PAIR_SQL = f"""
    WITH c AS ({CUSTOMER_SQL}),
    z AS (SELECT c_custkey, (size - avg(size) OVER ()) / stddev_pop(size) OVER () AS z1,
                 (acctbal - avg(acctbal) OVER ()) / stddev_pop(acctbal) OVER () AS z2 FROM c),
    k AS (SELECT corr(size, acctbal) AS r FROM c)
"""
PAIR = ["size", "acctbal"]


def _pair_components(customers):
    return comp.fit_components(customers, comp.fit_column_scaler(customers, PAIR))


@query(
    "component_scores",
    steady_query(
        f"""{PAIR_SQL} SELECT c_custkey, (z1 + z2) / sqrt(2) AS pc1, (z1 - z2) / sqrt(2) AS pc2 FROM z""",
        ["c_custkey"],
        ["pc1", "pc2"],
        digits=6,
    ),
)
def component_scores(spark, folder):
    customers = _customers(spark, folder)
    return steady(comp.component_scores(_pair_components(customers), customers, ["c_custkey"]), digits=6)


@query(
    "explained_variance",
    steady_query(
        f"""{PAIR_SQL} SELECT 1 AS component, (1 + r) / 2 AS share, (1 + r) / 2 AS running FROM k
            UNION ALL SELECT 2, (1 - r) / 2, 1.0 FROM k""",
        ["component"],
        ["share", "running"],
    ),
)
def explained_variance(spark, folder):
    return steady(comp.explained_variance(spark, _pair_components(_customers(spark, folder))))


@query(
    "loadings",
    """SELECT * FROM (VALUES (1, 'size', 0.70710678::DOUBLE), (1, 'acctbal', 0.70710678::DOUBLE),
              (2, 'size', 0.70710678::DOUBLE), (2, 'acctbal', -0.70710678::DOUBLE)) t(component, variable, loading)
       WHERE (SELECT count(*) FROM customer) > 0""",
)
def loadings(spark, folder):
    return steady(comp.loadings(spark, _pair_components(_customers(spark, folder)), PAIR))


def _vectors(spark, folder):
    """The embeddings as vectors, and the fitted stages that scale them."""
    rows = table(spark, folder, "embeddings").select("vec_id", "label", comp.as_vector(F.col("embedding")).alias("v"))
    return rows, comp.fit_vector_scaler(rows, "v")


@query("embedding_components")
def embedding_components(spark, folder):
    rows, scaling = _vectors(spark, folder)
    return comp.component_scores(comp.fit_components(rows, scaling), rows, ["vec_id"])


@query("embedding_explained_variance")
def embedding_explained_variance(spark, folder):
    return comp.explained_variance(spark, comp.fit_components(*_vectors(spark, folder)))


@query("embedding_loadings")
def embedding_loadings(spark, folder):
    model = comp.fit_components(*_vectors(spark, folder))
    return comp.loadings(spark, model, [f"x{i}" for i in range(model.stages[-1].pc.numRows)])


@query("clusters")
def clusters(spark, folder):
    vectors = comp.prepared(*_vectors(spark, folder), ["vec_id"])
    return comp.assigned(comp.best_clusters(vectors, 3), vectors, ["vec_id"])


@query("cluster_sweep")
def cluster_sweep(spark, folder):
    return comp.cluster_sweep(comp.prepared(*_vectors(spark, folder), ["vec_id"]))


@query(
    "silhouette_of_labels",
    """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
       d AS (SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS n,
                    sum(list_dot_product(a.e, a.e) + list_dot_product(b.e, b.e) - 2 * list_dot_product(a.e, b.e)) AS s
             FROM v a CROSS JOIN v b GROUP BY ALL),
       p AS (SELECT vec_id, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS inside,
                    min(CASE WHEN own <> other THEN s / n END) AS outside FROM d GROUP BY vec_id)
       SELECT round(avg(coalesce((outside - inside) / greatest(outside, inside), 0)), 6) AS silhouette FROM p""",
)
def silhouette_of_labels(spark, folder):
    """Silhouette of given labels; the twin compares all pairs of vectors."""
    rows = table(spark, folder, "embeddings").select(comp.as_vector(F.col("embedding")).alias("v"), "label")
    value = comp.silhouette(rows, "v", "label")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


WIDTH = 64


@query(
    "cluster_profiles",
    steady_query(
        "SELECT label, count(*) AS n, "
        + ", ".join(f"avg(embedding[{i + 1}]) AS x{i}" for i in range(WIDTH))
        + " FROM embeddings GROUP BY label",
        ["label", "n"],
        [f"x{i}" for i in range(WIDTH)],
    ),
)
def cluster_profiles(spark, folder):
    """Mean of every one of the 64 coordinates per label, with the label's size."""
    rows = table(spark, folder, "embeddings")
    chosen = {f"x{i}": F.get("embedding", F.lit(i)).cast("double") for i in range(WIDTH)}
    return steady(group_means(rows.withColumns(chosen), "label", list(chosen)))


@query("cluster_export")
def cluster_export(spark, folder):
    rows, scaling = _vectors(spark, folder)
    scores = comp.component_scores(comp.fit_components(rows, scaling), rows, ["vec_id"])
    vectors = comp.prepared(rows, scaling, ["vec_id"])
    found = comp.assigned(comp.best_clusters(vectors, 3), vectors, ["vec_id"])
    return comp.cluster_export(scores, found, "vec_id")
