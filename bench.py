"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Every query is planned and run to the end with its rows thrown away (``noop`` sink): one warm-up
run, then the median of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saltmarsh.plans import QUERIES  # noqa: E402
from saltmarsh.session import local_session  # noqa: E402

HEADLINE = """
scan_columnar filter_expr filter_outliers_quantile interaction_features semi_join_isin anti_join lookup_join nearest_join
knn_join cosine_top_n group_agg count_distinct describe_skew quantiles_exact boxplot_stats mode_per_key gini chi2_contributions
customer_rollup rfm_score customer_value_report utility_score duplicates_report window_count cumulative_share_pareto lag_fill
ema macd top_n_per_group purged_group_split expanding_time_split minibatch_ranges top_k split_stratified distinct_rows
text_normalize html_to_text tokenize_counts boxcox bag_of_words rare_to_other standard_scale rmse_mae threshold_sweep roc_auc
silhouette impute_chained stream_score pca_project multilabel_fit impute_regression residual_refit threshold_utility rank_encode_fitted
bag_of_words_fitted fill_scale_fitted rfm_fitted out_of_fold
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
