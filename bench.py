"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma separated names, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import local_session  # noqa: E402
from millrace.suite import registry  # noqa: E402

HEADLINE = """scan_csv_gz filter_predicate join_left_key join_chain_left merge_prediction_runs
agg_sum_single_key crosstab pivot_indicator_sum pivot_dept_scan string_agg_distinct count_distinct_per_column
percentiles drop_duplicates_keep add_row_id find_scale_denominator undo_feature_scaling tokenize_binary
split_explode_tokens impute_mean_mode impute_median label_encode_sorted qcut utilization_features winsorize
outlier_vote near_zero_variance select_percentile_anova events_per_hour events_day_spread device_training_set
bag_of_items feature_triples_sparse sparse_block_stack store_features stratified_kfold sample_fixed_n
roc_auc mean_roc fit_random_forest_classifier fit_logistic_regression fit_naive_bayes fit_knn_classifier
fit_gbt_binary fit_per_group_ols average_submissions""".split()

WARM_UP = ["percentiles", "string_agg_distinct", "fit_knn_classifier", "events_per_hour"]
LONG = 6.0
"""A query is timed up to three times, within so many seconds; the median counts."""


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    registry.load()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session("bench", cores)

    def timed(name: str) -> float:
        begin = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    for name in WARM_UP:
        timed(name)
    seconds = {}
    for name in names:
        runs = [timed(name)]
        while len(runs) < 3 and sum(runs) < LONG:
            runs.append(timed(name))
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").split("sf")[-1]}))


if __name__ == "__main__":
    main()
