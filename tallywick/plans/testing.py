"""Hypothesis tests."""

from pyspark.sql import functions as F

from tallywick.operators import testing as ops
from tallywick.operators.grouping import full_crosstab
from tallywick.operators.runs import as_json, from_json_rows
from tallywick.plans import tails_sql
from tallywick.plans.registry import query, steady, steady_query
from tallywick.sources.files import table

LINE_PAIRS = [("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "constant")]


def _grid_sql(x: str, y: str, source: str) -> str:
    """All cells of a crosstab with their expected counts, empty cells included."""
    return f"""
        SELECT '{x}' AS x, '{y}' AS y, a.v AS a, b.v AS b, coalesce(c.n, 0) AS n, a.n * (b.n / t.n) AS e, t.n AS total
        FROM (SELECT {x}::VARCHAR AS v, count(*)::DOUBLE AS n FROM {source} GROUP BY 1) a
        CROSS JOIN (SELECT {y}::VARCHAR AS v, count(*)::DOUBLE AS n FROM {source} GROUP BY 1) b
        CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM {source}) t
        LEFT JOIN (SELECT {x}::VARCHAR AS a, {y}::VARCHAR AS b, count(*)::DOUBLE AS n FROM {source} GROUP BY 1, 2) c
            ON c.a = a.v AND c.b = b.v"""


def _chi_square_sql(grids: str, yates: bool) -> str:
    gap = "abs(o - e)"
    if yates:
        gap = f"CASE WHEN dof = 1 THEN {gap} - least(0.5, {gap}) ELSE {gap} END"
    return f"""
        WITH grid AS ({grids}),
        sized AS (SELECT x, y, count(DISTINCT a) AS r, count(DISTINCT b) AS k, max(total)::BIGINT AS n, min(e) AS min_expected
                  FROM grid GROUP BY x, y),
        freed AS (SELECT *, (r - 1) * (k - 1) AS dof FROM sized),
        summed AS (SELECT f.x, f.y, sum(({gap}) ** 2 / e) AS chi2
                   FROM freed f JOIN (SELECT x, y, n AS o, e FROM grid) g USING (x, y) GROUP BY f.x, f.y),
        stats AS (SELECT f.*, CASE WHEN dof >= 1 THEN chi2 END AS statistic FROM freed f JOIN summed USING (x, y))
        SELECT x, y, n, statistic, CASE WHEN dof >= 1 THEN dof END AS dof,
               CASE WHEN dof >= 1 THEN {tails_sql.chi2_upper("statistic", "dof")} END AS p,
               sqrt(statistic / n / greatest(least(r - 1, k - 1), 1)) AS cramers_v,
               min_expected, min_expected < 5 AS low_expected
        FROM stats"""


CHI_PLAIN = ["x", "y", "n", "dof", "low_expected"]
CHI_DOUBLES = ["statistic", "p", "cramers_v", "min_expected"]
LINES = "(SELECT *, 1 AS constant FROM lineitem)"


@query(
    "chi_square",
    steady_query(
        _chi_square_sql(" UNION ALL ".join(_grid_sql(x, y, LINES) for x, y in LINE_PAIRS), yates=False),
        CHI_PLAIN,
        CHI_DOUBLES,
    ),
)
def chi_square(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("constant", F.lit(1))
    return steady(ops.chi_square(lines, LINE_PAIRS, correction=False))


@query(
    "chi_square_yates",
    steady_query(
        _chi_square_sql(_grid_sql("quality", "toxic", "labels"), yates=True),
        CHI_PLAIN,
        CHI_DOUBLES,
    ),
)
def chi_square_yates(spark, folder):
    return steady(ops.chi_square(table(spark, folder, "labels"), [("quality", "toxic")]))


@query(
    "chi_square_empty_cells",
    steady_query(
        _chi_square_sql(_grid_sql("user_id", "bucket", "(SELECT *, floor(value / 20) AS bucket FROM events)"), yates=False),
        CHI_PLAIN,
        CHI_DOUBLES,
    ),
)
def chi_square_empty_cells(spark, folder):
    events = table(spark, folder, "events").withColumn("bucket", F.floor(F.col("value") / 20))
    return steady(ops.chi_square(events, [("user_id", "bucket")], correction=False))


KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "expected_counts",
    steady_query(
        f"""WITH g AS ({_grid_sql("user_id", "event_type", "events")})
            SELECT a::BIGINT AS user_id, b AS event_type, n::BIGINT AS n, e AS expected FROM g""",
        ["user_id", "event_type", "n"],
        ["expected"],
    ),
)
def expected_counts(spark, folder):
    grid = full_crosstab(table(spark, folder, "events"), "user_id", "event_type", KINDS)
    return steady(ops.expected_counts(grid, "user_id", "event_type"))


def _welch_sql(test: str, value: str, group: str, source: str) -> str:
    return f"""
        SELECT '{test}' AS test, 'welch' AS kind, 2 AS groups, n1 + n2 AS n, t AS statistic, dof, NULL::DOUBLE AS dof2,
               {tails_sql.t_two_sided("t", "dof")} AS p, d AS effect, 'cohen_d' AS effect_name
        FROM (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
                     (v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)) AS dof,
                     (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS d
              FROM (SELECT count(*) AS n1, avg({value}) AS m1, var_samp({value}) AS v1 FROM {source}
                    WHERE {group} = (SELECT min({group}) FROM {source})),
                   (SELECT count(*) AS n2, avg({value}) AS m2, var_samp({value}) AS v2 FROM {source}
                    WHERE {group} = (SELECT max({group}) FROM {source})))"""


def _anova_sql(test: str, value: str, group: str, source: str) -> str:
    return f"""
        SELECT '{test}' AS test, 'anova' AS kind, groups, n, f AS statistic, d1 AS dof, d2 AS dof2,
               {tails_sql.f_upper("f", "d1", "d2")} AS p, f * d1 / (f * d1 + d2) AS effect, 'eta_squared' AS effect_name
        FROM (SELECT groups, n, d1, d2, (between_ss / d1) / (within_ss / d2) AS f FROM (
            SELECT count(DISTINCT {group}) AS groups, count(*) AS n, (count(DISTINCT {group}) - 1)::DOUBLE AS d1,
                   (count(*) - count(DISTINCT {group}))::DOUBLE AS d2, sum((gm - m) ** 2) AS between_ss,
                   sum(({value} - gm) ** 2) AS within_ss
            FROM (SELECT {group}, {value}, avg({value}) OVER (PARTITION BY {group}) AS gm, avg({value}) OVER () AS m
                  FROM {source})))"""


TESTS = [
    ("price by status", "o_totalprice", "o_orderstatus"),
    ("price by priority", "o_totalprice", "o_orderpriority"),
    ("price by pending", "o_totalprice", "pending"),
    ("price by nothing", "o_totalprice", "constant"),
]
ORDERS = "(SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'yes' ELSE 'no' END AS pending FROM orders)"
MEANS_SQL = f"""
    {_anova_sql("price by status", "o_totalprice", "o_orderstatus", "orders")}
    UNION ALL {_anova_sql("price by priority", "o_totalprice", "o_orderpriority", "orders")}
    UNION ALL {_welch_sql("price by pending", "o_totalprice", "pending", ORDERS)}
    UNION ALL SELECT 'price by nothing', 'none', 1, count(*), NULL, NULL, NULL, NULL, NULL, NULL FROM orders"""


def _orders(spark, folder):
    pending = F.when(F.col("o_orderstatus") == "P", F.lit("yes")).otherwise(F.lit("no"))
    return table(spark, folder, "orders").withColumn("pending", pending).withColumn("constant", F.lit(1))


@query(
    "mean_tests",
    steady_query(MEANS_SQL, ["test", "kind", "groups", "n", "effect_name"], ["statistic", "dof", "dof2", "p", "effect"]),
)
def mean_tests(spark, folder):
    return steady(ops.mean_tests(_orders(spark, folder), TESTS))


@query(
    "event_value_by_type",
    steady_query(
        _anova_sql("value by type", "value", "event_type", "events"),
        ["test", "kind", "groups", "n", "effect_name"],
        ["statistic", "dof", "dof2", "p", "effect"],
    ),
)
def event_value_by_type(spark, folder):
    return steady(ops.mean_tests(table(spark, folder, "events"), [("value by type", "value", "event_type")]))


@query(
    "decisions",
    f"""WITH m AS ({MEANS_SQL}) SELECT test, CASE WHEN p IS NULL THEN 'not applicable'
            WHEN p < 0.2 THEN 'differs' ELSE 'same' END AS decision FROM m""",
)
def decisions(spark, folder):
    rows = ops.mean_tests(_orders(spark, folder), TESTS)
    text = ops.decision(F.col("p"), 0.2, "differs", "same", "not applicable")
    return rows.select("test", text.alias("decision"))


@query(
    "test_report",
    steady_query(
        f"""WITH c AS ({_chi_square_sql(_grid_sql("o_orderstatus", "o_orderpriority", "orders"), yates=True)}),
            m AS ({MEANS_SQL}),
            r AS (SELECT x || ' x ' || y AS test, 'chi_square' AS kind, n, statistic, dof::DOUBLE AS dof, NULL::DOUBLE AS dof2,
                         p, cramers_v AS effect, 'cramers_v' AS effect_name,
                         CASE WHEN coalesce(low_expected, true) THEN 'low expected counts'
                              || coalesce('; smallest expected count: ' || printf('%.2f', min_expected), '') ELSE '' END AS notes
                  FROM c
                  UNION ALL SELECT test, kind, n, statistic, dof, dof2, p, effect, effect_name,
                         CASE WHEN groups < 2 THEN 'fewer than two groups with data' ELSE '' END FROM m)
            SELECT *, CASE WHEN p IS NULL THEN 'not applicable' WHEN p < 0.05 THEN 'rejected' ELSE 'not rejected' END
                AS decision FROM r""",
        ["test", "kind", "n", "effect_name", "notes", "decision"],
        ["statistic", "dof", "dof2", "p", "effect"],
    ),
)
def test_report(spark, folder):
    report = ops.test_report(_orders(spark, folder), [("o_orderstatus", "o_orderpriority")], TESTS)
    return steady(report.withColumn("notes", F.array_join("notes", "; ")))


@query(
    "results_through_json",
    steady_query(
        _anova_sql("price by status", "o_totalprice", "o_orderstatus", "orders"),
        ["test", "kind", "groups", "n", "effect_name"],
        ["statistic", "dof", "dof2", "p", "effect"],
    ),
)
def results_through_json(spark, folder):
    """Test results written as JSON objects and read back."""
    results = ops.mean_tests(_orders(spark, folder), TESTS[:1])
    return steady(from_json_rows(as_json(results), "json", results.schema))


test_report.__test__ = False
