"""Shapes of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from saltmarsh.operators import encode, relational, scale, stats
from saltmarsh.plans import QUERIES
from saltmarsh.sources import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_ALLOWED = {"knn_join", "knn_join_manhattan", "nn_label_transfer", "cosine_top_n", "reco_lookup", "knn_multilabel", "knn_regress",
                  "codebook_histogram", "classification_report", "pca_project", "impute_regression", "support_vs_precision", "confusion_matrix", "misclassified_pairs"}
FAST = ["filter_expr", "lookup_join", "semi_join_isin", "anti_join", "chi2_contributions", "crosstab_margins", "window_count", "standard_scale",
        "filter_outliers_quantile", "pair_similarity", "threshold_sweep", "tokenize_counts", "bag_of_words", "silhouette", "top_n_per_group",
        "ema", "nearest_join", "purged_group_split", "split_stratified", "customer_rollup", "rfm_score", "pairwise_distance"]


@pytest.mark.parametrize("name", FAST)
def test_no_products_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not any(op in text for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapCoGroups"))


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["semi_join_isin"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,490000.0)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_top_n_is_limited_before_the_shuffle(spark, sf):
    text = plan(QUERIES["top_n_per_group"](spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_quantile_bounds_reach_the_scan(spark, sf):
    text = plan(relational.within_quantiles(table(spark, sf, "lineitem"), "l_extendedprice"))
    assert "GreaterThanOrEqual(l_extendedprice" in text and "LessThanOrEqual(l_ext" in text and "Join" not in text


def test_statistics_are_subqueries_not_joins(spark, sf):
    text = plan(scale.standard_scale(table(spark, sf, "lineitem"), ["l_quantity"]))
    assert "Subquery" in text and "Join" not in text


def test_pareto_has_no_single_partition_window_over_rows(spark, sf):
    # the only window without keys runs over the carry table, one row per sort partition
    revenue = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("r"))
    text = plan(stats.running_total(revenue, [F.desc("r"), "o_custkey"], "r", "cum"))
    assert "hashpartitioning(__part" in text


def test_multi_hot_needs_no_shuffle(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w"))
    assert "Exchange" not in plan(encode.multi_hot(docs, F.col("w"), ["a", "b"], "has"))
