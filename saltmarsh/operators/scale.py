"""Scaling, imputation by constants, Box-Cox."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import boxcox
from .stats import one_row, quantile_table


def _replace(df: DataFrame, new: Mapping) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    fit = df if fit_on is None else fit_on
    s = one_row(fit, **{f"m_{c}": F.avg(c) for c in columns}, **{f"s_{c}": F.stddev_pop(c) for c in columns})
    return _replace(df, {c: (F.col(c) - s[f"m_{c}"]) / F.when(s[f"s_{c}"] == 0, 1.0).otherwise(s[f"s_{c}"])
                         for c in columns})


def minmax_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    fit = df if fit_on is None else fit_on
    s = one_row(fit, **{f"lo_{c}": F.min(c) for c in columns}, **{f"hi_{c}": F.max(c) for c in columns})
    return _replace(df, {c: (F.col(c) - s[f"lo_{c}"]) / F.when(s[f"hi_{c}"] == s[f"lo_{c}"], 1.0)
                         .otherwise(s[f"hi_{c}"] - s[f"lo_{c}"]) for c in columns})


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    s = one_row(df, **{c: F.avg(c) for c in columns})
    return _replace(df, {c: F.coalesce(F.col(c).cast("double"), s[c]) for c in columns})


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    m = quantile_table(df, columns, [0.5])
    return _replace(df, {c: F.coalesce(F.col(c).cast("double"), m[c][0]) for c in columns})


def boxcox_lambda(df: DataFrame, column: str, grid: Sequence[float]) -> DataFrame:
    """Profile log-likelihood of every ``lambda`` of the grid over a positive column, in one pass.

    One logarithm per row; the powers follow by ``exp``, which is much cheaper than ``pow``. The
    row is repeated per lambda inside its task and combined there: one row per lambda is shuffled.
    """
    logs = df.where(F.col(column).isNotNull()).select(F.log(column).alias("_log"))
    each = logs.select("_log", F.explode(F.array(*[F.lit(float(v)) for v in grid])).alias("lam"))
    y = F.when(F.col("lam") == 0, F.col("_log")).otherwise((F.exp(F.col("lam") * F.col("_log")) - 1) / F.col("lam"))
    s = each.groupBy("lam").agg(F.count("*").alias("n"), F.var_pop(y).alias("v"), F.sum("_log").alias("sl"))
    return s.select("lam", (-F.col("n") / 2.0 * F.log("v") + (F.col("lam") - 1) * F.col("sl")).alias("llf"))


def boxcox_transform(df: DataFrame, column: str, grid: Sequence[float], name: str) -> DataFrame:
    """Shift to positive values, take the best lambda of the grid, transform. Keeps shift and lambda."""
    shift = one_row(df, s=F.abs(F.min(column)) + 1)["s"]
    shifted = df.withColumn("_x", F.col(column) + shift)
    best = boxcox_lambda(shifted, "_x", grid).agg(F.max_by("lam", F.struct("llf", -F.col("lam"))).alias("l")).scalar()
    return shifted.withColumn("lam", best).withColumn(name, boxcox(F.col("_x"), F.col("lam"))).withColumn(
        "shift", shift).drop("_x")
