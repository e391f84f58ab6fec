"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query is run whole into the no-op sink,
so results are computed for all rows and columns without being collected. BENCH_RUNS runs per query (default 2);
the fastest one counts.
"""

import json
import os
import sys
import tempfile
import time

from tabwright.catalog import QUERIES
from tabwright.session import local_session

HEADLINE = (
    "describe_numeric",
    "top_values",
    "group_transform_mean",
    "char_bins",
    "binning_many_columns",
    "winsorize",
    "target_encoding",
    "random_impute",
    "assign_fold",
    "split_separate_folds",
    "undersample",
    "spearman",
    "auc_binary",
    "auc_one_vs_rest",
    "roc_curve",
    "chi_square",
    "association_metric_complete",
    "importance_class",
    "importance_multiclass",
    "importance_regression",
    "distribution_profile_regression",
    "permutation_importance",
    "partial_dependence",
    "shap_linear_multiclass",
    "model_boosted_trees_class",
    "staged_tree_search",
    "shap_trees",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", tempfile.mkdtemp(prefix="bench-"))
    timings = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        timings[name] = round(best, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
