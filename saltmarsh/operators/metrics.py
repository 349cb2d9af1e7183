"""Evaluation metrics as relational aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .ordering import attach_groups, running_total
from .stats import one_row, quantile_values


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def with_group_mean(df: DataFrame, by: str, y: str, name: str = "prediction") -> DataFrame:
    """A baseline prediction: the mean of ``y`` in the row's group."""
    return attach_groups(df.where(F.col(by).isNotNull()), df.groupBy(by).agg(F.avg(y).alias(name)), [by])


def rmse_mae(df: DataFrame, y: str, p: str) -> DataFrame:
    e = F.col(y) - F.col(p)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def residual_weights(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """Rows whose weight ``(max|r| - |r|) / max|r|`` is above the threshold; none if the fit is perfect."""
    rows = df.withColumn("abs_residual", F.abs(F.col(y) - F.col(p)))
    top = one_row(rows, m=F.max("abs_residual"))["m"]
    return rows.withColumn("weight", (top - F.col("abs_residual")) / F.nullif(top, F.lit(0.0))).where(F.col("weight") > threshold)


def error_cut(df: DataFrame, y: str, p: str, percent: float, threshold: float) -> DataFrame:
    """Around the ``percent`` quantile of the absolute error: mean of the best and of the worst errors
    and the percentage of the best ones below ``threshold``."""
    errors = durable(df.select(F.abs(F.col(y) - F.col(p)).alias("e")))  # read once per pass below
    (cut,) = quantile_values(errors, "e", [percent])
    best = F.col("e") <= cut
    return errors.agg(
        (F.avg(F.when(best, (F.col("e") < threshold).cast("double"))) * 100).alias("percent_below"),
        F.avg(F.when(best, F.col("e"))).alias("best_mean"),
        F.avg(F.when(~best, F.col("e"))).alias("worst_mean"))


def label_counts(df: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """TP, FP, FN and support per ``(truth, prediction)`` pair of 0/1 columns, in one pass."""
    def one(t, p):
        t_, p_ = F.col(t) == 1, F.col(p) == 1
        n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
        return F.struct(F.lit(t).alias("label"), n(t_ & p_).alias("tp"), n(~t_ & p_).alias("fp"),
                        n(t_ & ~p_).alias("fn"), n(t_).alias("support"))
    return df.agg(F.array(*[one(t, p) for t, p in labels]).alias("l")).select(F.explode("l").alias("r")).select("r.*")


def class_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """TP, FP, FN and support per class of a multi-class prediction, from the confusion counts."""
    cells = df.groupBy(actual, predicted).agg(F.count("*").alias("n"))
    a = cells.select(F.col(actual).alias("label"), F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0).alias("tp"),
                     F.lit(0).alias("fp"), F.when(F.col(actual) != F.col(predicted), F.col("n")).otherwise(0).alias("fn"))
    b = cells.where(F.col(actual) != F.col(predicted)).select(
        F.col(predicted).alias("label"), F.lit(0).alias("tp"), F.col("n").alias("fp"), F.lit(0).alias("fn"))
    s = a.unionByName(b).groupBy("label").agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn")])
    return s.withColumn("support", F.col("tp") + F.col("fn"))


def with_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from TP, FP, FN; 0/0 counts as 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("*", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
                         _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def micro_macro(counts: DataFrame) -> DataFrame:
    per = with_scores(counts)
    s = per.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return s.select(_ratio(tp, tp + fp).alias("micro_precision"), _ratio(tp, tp + fn).alias("micro_recall"),
                    _ratio(2 * tp, 2 * tp + fp + fn).alias("micro_f1"), "macro_precision", "macro_recall", "macro_f1")


def never_predicted(counts: DataFrame) -> DataFrame:
    """Labels with true rows and no predicted row."""
    return counts.where((F.col("tp") + F.col("fp") == 0) & (F.col("support") > 0)).select("label", "support")


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts, share of the actual class, and the count with the diagonal set to 0."""
    cells = df.groupBy(actual, predicted).agg(F.count("*").alias("n"))
    totals = cells.groupBy(actual).agg(F.sum("n").alias("_t"))
    return cells.join(totals, actual).select(
        actual, predicted, "n", (F.col("n") / F.col("_t")).alias("share"),
        F.when(F.col(actual) == F.col(predicted), 0).otherwise(F.col("n")).alias("n_wrong"))


def misclassified(df: DataFrame, actual: str, predicted: str, k: int = 50) -> DataFrame:
    wrong = df.where(F.col(actual) != F.col(predicted)).groupBy(actual, predicted).agg(F.count("*").alias("n"))
    return wrong.orderBy(F.desc("n"), actual, predicted).limit(k)


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Rank-sum AUC from positives and negatives per distinct score; null if a class is absent."""
    per = df.groupBy(score).agg(F.sum((F.col(y) == 1).cast("long")).alias("_pos"), F.sum((F.col(y) == 0).cast("long")).alias("_neg"))
    cum = running_total(per, [score], "_neg", "_below")
    won = F.col("_pos") * (F.col("_below") - F.col("_neg") / 2.0)
    return cum.agg((F.sum(won) / F.nullif(F.sum("_pos").cast("double") * F.sum("_neg"), F.lit(0.0))).alias("auc"))


def brier(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))


def threshold_sweep(df: DataFrame, y: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """TP, FP, FN, precision, recall and F1 for several thresholds in one pass over the rows."""
    def one(t):
        hit = F.col(score) >= t
        n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
        return F.struct(F.lit(t).alias("threshold"), n(hit & (F.col(y) == 1)).alias("tp"),
                        n(hit & (F.col(y) == 0)).alias("fp"), n(~hit & (F.col(y) == 1)).alias("fn"))
    counts = df.agg(F.array(*[one(float(t)) for t in thresholds]).alias("l")).select(F.explode("l").alias("r")).select("r.*")
    return with_scores(counts)


def utility_sweep(df: DataFrame, day: Column, weight: Column, resp: Column, score: Column, thresholds: Sequence[float]) -> DataFrame:
    """Trading utility of acting at each threshold: one pass over the rows gives the daily sums of all thresholds.

    A row per threshold with the number of actions, the total, the capped ratio and the utility; days
    without an action count as days with a total of 0. No rows give no thresholds.
    """
    cuts = [float(t) for t in thresholds]
    gain = weight * resp
    daily = df.groupBy(day.alias("_day")).agg(*[F.sum(F.when(score >= t, gain).otherwise(0.0)).alias(f"_p{i}") for i, t in enumerate(cuts)],
                                              *[F.count_if(score >= t).alias(f"_n{i}") for i, t in enumerate(cuts)])
    one = daily.select(F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_p{i}").alias("p"), F.col(f"_n{i}").alias("n"))
                                           for i, t in enumerate(cuts)])).alias("c")).select("c.*")
    s = one.groupBy("threshold").agg(F.sum("n").alias("actions"), F.sum("p").alias("p"), F.sum(F.col("p") * F.col("p")).alias("pp"), F.count("*").alias("d"))
    t = F.coalesce(F.col("p") / F.sqrt(F.nullif(F.col("pp"), F.lit(0.0))) * F.sqrt(250 / F.col("d")), F.lit(0.0))
    capped = F.least(F.greatest(t, F.lit(0.0)), F.lit(6.0))
    return s.select("threshold", "actions", "p", t.alias("t"), (capped * F.col("p") + F.lit(0.0)).alias("u"))
