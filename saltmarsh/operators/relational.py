"""Selections, predicates, joins and set operations on DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import one_row, quantile_values


# --- columns -------------------------------------------------------------------------------

def select_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Columns starting with any of ``prefixes``, sorted by name."""
    return df.select(*sorted(c for c in df.columns if c.startswith(tuple(prefixes))))


def drop_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Column names split into ``quantitative`` and ``qualitative``."""
    kinds: dict[str, list[str]] = {"quantitative": [], "qualitative": []}
    for field in df.schema:
        kinds["quantitative" if isinstance(field.dataType, T.NumericType) else "qualitative"].append(field.name)
    return kinds


def drop_sparse_columns(df: DataFrame, minimum: float = 0.01, per_column: Mapping[str, float] | None = None) -> DataFrame:
    """Drop columns whose non-null share is below their minimum. One pass; one row comes back."""
    limits = {c: (per_column or {}).get(c, minimum) for c in df.columns}
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if shares[c] is None or shares[c] >= limits[c]])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def patch_cell(df: DataFrame, key: str, key_value, column: str, value) -> DataFrame:
    return df.withColumn(column, F.when(F.col(key) == key_value, F.lit(value)).otherwise(F.col(column)))


def strip_strings(df: DataFrame) -> DataFrame:
    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.trim(c).alias(c) if c in strings else F.col(c) for c in df.columns])


# --- predicates ----------------------------------------------------------------------------

def contains_any(column: str, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """True where the text matches any pattern; null text is false."""
    flag = "(?i)" if ignore_case else ""
    return F.coalesce(F.col(column).rlike(flag + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def within_quantiles(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows whose value is inside the two quantiles, both included."""
    lo, hi = quantile_values(df, column, [low, high])
    return df.where(F.col(column).between(lo, hi))


def without_zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 4.0) -> DataFrame:
    """Rows where every column is within ``limit`` population deviations of its mean; none if a column is constant."""
    stats = one_row(df, **{f"{c}_m": F.avg(c) for c in columns}, **{f"{c}_s": F.stddev_pop(c) for c in columns})
    for c in columns:
        df = df.where(F.abs((F.col(c) - stats[f"{c}_m"]) / F.nullif(stats[f"{c}_s"], F.lit(0.0))) <= limit)
    return df


# --- joins ---------------------------------------------------------------------------------

def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_anti")


def membership_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """0/1 column: does the key occur in ``keys``? Left without a hint, so the size decides the join."""
    marks = keys.select(*on).distinct().withColumn(name, F.lit(1))
    return df.join(marks, list(on), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach the columns of a dimension keyed by ``on``; unknown keys give nulls."""
    return df.join(dim, list(on), "left")


def align(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Side-by-side result of two keyed tables, keeping keys of either."""
    return left.join(right, list(on), "full")


# --- sets, order, sampling -----------------------------------------------------------------

def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def argmax_row(df: DataFrame, score: str, tie: str) -> DataFrame:
    """The row with the highest score; the smallest ``tie`` wins among equals."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(1)


def md5_key(column: str, seed: int) -> Column:
    """Repeatable pseudo-random order of rows, the same on every cluster size."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(column).cast("string")))


def split_random(df: DataFrame, key: str, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the hash of the row key falls in the lowest ``test_share``."""
    span = 16**7
    draw = F.conv(F.substring(md5_key(key, seed), 1, 7), 16, 10).cast("long")
    return df.withColumn("is_test", (draw < F.lit(int(span * test_share))).cast("int"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows, repeatable."""
    return df.orderBy(md5_key(key, seed), key).limit(n)
