"""Counts attached to rows, cumulative shares, ranks and top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import attach_groups, previous_value, running_total


def attach_counts(df: DataFrame, counts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows per key on every row, for several keys: ``{name: key columns}``.

    Counts are combined before the shuffle and joined back, so a hot key is not gathered in one
    task as a window would do.
    """
    out = df
    for name, by in counts.items():
        out = attach_groups(out, df.groupBy(*by).agg(F.count("*").alias(name)), by)
    return out


def cumulative_share(df: DataFrame, key: str, value: str, limit: float = 0.8) -> DataFrame:
    """Descending cumulative sum of a non-negative value, its share, and whether it is below ``limit``.

    The share is null where the total is 0.
    """
    total = df.agg(F.sum(value).alias("t")).scalar()
    cum = running_total(df.select(key, value), [F.desc(value), F.asc(key)], value, "cum")
    return cum.withColumn("cum_share", F.col("cum") / F.nullif(total, F.lit(0))).withColumn(
        "in_core", (F.col("cum") < total * F.lit(limit)).cast("int"))


def previous_flag(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    """The previous row's value, 0 at the start of each series."""
    return previous_value(df, by, order, column, 0, name)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group. Spark keeps only ``n`` rows per group and task before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def value_at_rank(df: DataFrame, value: str, share: float) -> DataFrame:
    """The value at descending 0-based rank ``floor(share * n)``, from counts of distinct values."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    cum = running_total(counts, [F.desc(value)], "_n", "_hi")
    at = F.floor(df.agg(F.count("*").alias("n")).scalar() * F.lit(share))
    return cum.where((F.col("_hi") - F.col("_n") <= at) & (at < F.col("_hi"))).select(F.col(value))


def rank_table(df: DataFrame, category: str, target: str) -> DataFrame:
    """0-based rank of each category by ascending mean target; the name breaks ties."""
    means = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.avg(target).alias("mean_target"))
    ranked = running_total(means, ["mean_target", category], F.lit(1), "_r")
    return ranked.select(category, "mean_target", (F.col("_r") - 1).alias("rank"))


def rank_encode(df: DataFrame, category: str, target: str, name: str) -> DataFrame:
    """Category replaced by its rank; categories unseen at fit give null."""
    dim = rank_table(df, category, target).select(category, F.col("rank").alias(name))
    return attach_groups(df, dim, [category], "left")


def top_value_flag(df: DataFrame, key: str, value: Column, n: int, name: str) -> DataFrame:
    """1 on the rows of the ``n`` keys with the highest total value."""
    best = df.groupBy(key).agg(F.sum(value).alias("_v")).orderBy(F.desc("_v"), F.asc(key)).limit(n)
    marks = F.broadcast(best.select(key, F.lit(1).alias(name)))  # n rows at most
    return df.join(marks, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def best_row_per_metric(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """The key with the highest value of each metric, in one pass; the smallest key wins a tie."""
    best = df.agg(*[F.max(F.struct(F.col(m).alias("v"), (-F.col(key)).alias("k"))).alias(m) for m in metrics])
    return best.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), (-F.col(f"{m}.k")).alias(key), F.col(f"{m}.v").alias("value"))
        for m in metrics])).alias("r")).select("r.*")
