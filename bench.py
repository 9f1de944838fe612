"""Times headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Every query runs once, after a small warm-up, and all its rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallywick.plans import QUERIES
from tallywick.session import local_session

HEADLINES = [
    "numeric_summary",
    "quartiles",
    "category_frequencies",
    "missing_counts",
    "duplicates_removed",
    "typed_columns",
    "attrition",
    "cleaning_chain",
    "standardised_source",
    "wide_means",
    "star_chain",
    "inner_chain",
    "outer_chain",
    "outer_chain_by_pivot",
    "resolved_names",
    "crosstab_with_missing",
    "row_percents",
    "group_summary",
    "stacked_group_summaries",
    "pearson",
    "spearman",
    "correlation_matrix",
    "line_fits",
    "chi_square",
    "mean_tests",
    "test_report",
    "histogram",
    "grouped_boxes",
    "density",
    "scatter_bins",
    "z_scores",
    "medians_filled",
    "linear_model_scores",
    "fold_scores_linear",
    "model_scores",
    "component_scores",
    "embedding_components",
    "clusters",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=max(int(cores), 1), name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("category_frequencies", "pearson"):  # JVM and code generation start-up
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
