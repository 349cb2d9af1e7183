"""Whole-table statistics: exact quantiles, ranks, moments, correlation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import estimated_bytes
from .ordering import running_total

# Spark's ``percentile`` keeps all distinct values of a group in one buffer. Above this
# estimated input size exact quantiles are found by other means.
PERCENTILE_BUFFER_BYTES = 16 << 20
SKETCH_ACCURACY = 10_000  # rank error of ``percentile_approx``: at most n / accuracy


def one_row(df: DataFrame, **named: Column) -> dict[str, Column]:
    """Whole-table aggregates as scalar-subquery columns, for use in any other frame."""
    row = df.agg(F.struct(*[c.alias(n) for n, c in named.items()]).alias("s")).scalar()
    return {n: row[n] for n in named}


def _picks(cum: DataFrame, by: Sequence[str], wanted: Column) -> DataFrame:
    """Interpolated values at the positions ``wanted`` (an array of 0-based ranks with fraction)
    from distinct values ``_x`` that hold the ranks ``_lo .. _hi - 1``."""
    hits = F.filter(F.transform(wanted, lambda at, i: F.struct(
        i.alias("i"), (at - F.floor(at)).alias("f"),
        ((F.col("_lo") <= F.floor(at)) & (F.floor(at) < F.col("_hi"))).alias("low"),
        ((F.col("_lo") <= F.ceil(at)) & (F.ceil(at) < F.col("_hi"))).alias("high"))), lambda h: h["low"] | h["high"])
    found = cum.select(*by, "_x", F.explode(hits).alias("h")).groupBy(*by, "h.i").agg(
        F.max(F.when(F.col("h.low"), F.col("_x"))).alias("a"), F.max(F.when(F.col("h.high"), F.col("_x"))).alias("b"),
        F.max("h.f").alias("f"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * (1 - F.col("f")) + F.col("b") * F.col("f"))
    ordered = F.sort_array(F.collect_list(F.struct("i", value.alias("q"))))  # one entry per requested quantile
    return found.groupBy(*by).agg(F.transform(ordered, lambda s: s["q"]).alias("q"))


def quantiles(
    df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (), max_buffer: int | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``by`` columns plus an array ``q``."""
    limit = PERCENTILE_BUFFER_BYTES if max_buffer is None else max_buffer
    rows = df.select(*by, F.col(column).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    at = F.array(*[F.lit(float(p)) for p in probs])
    if estimated_bytes(rows) <= limit:
        return rows.groupBy(*by).agg(F.percentile("_x", at).alias("q"))
    if not by:
        return _bracketed(df, {column: list(probs)}).select(F.col(column).alias("q"))
    counts = rows.groupBy(*by, "_x").agg(F.count("*").alias("_n"))
    cum = running_total(counts, ["_x"], "_n", "_hi", by=by).withColumn("_lo", F.col("_hi") - F.col("_n"))
    totals = cum.groupBy(*by).agg(F.sum("_n").alias("_t"))
    cum = cum.join(totals, list(by))
    return _picks(cum, by, F.transform(at, lambda p: (F.col("_t") - 1) * p))


def _bracketed(df: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """Exact quantiles of large columns without sorting them: one row, one array per column.

    A sketch gives, for each quantile, two values that enclose it and only a few rows in ten
    thousand. Exact counts below them turn the quantile into a rank among the enclosed values, and
    only those are grouped and sorted. Should a sketch ever miss, the whole column is ranked.
    """
    eps, flat = 2.0 / SKETCH_ACCURACY, [(c, p) for c, ps in wanted.items() for p in ps]
    data = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    sketch = data.agg(*[F.count(c).alias(f"n_{c}") for c in wanted], *[
        F.percentile_approx(c, [max(0.0, min(1.0, p + e)) for p in ps for e in (-eps, eps)], SKETCH_ACCURACY).alias(c)
        for c, ps in wanted.items()]).first()
    bounds = [(c, p, sketch[c][2 * wanted[c].index(p)], sketch[c][2 * wanted[c].index(p) + 1])
              for c, p in flat] if all(sketch[c] for c in wanted) else []
    if not bounds:
        return df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for p in ps])).alias(c) for c, ps in wanted.items()])
    counts = data.agg(*[x for i, (c, _, lo, hi) in enumerate(bounds) for x in (
        F.count_if(F.col(c) < lo).alias(f"b{i}"), F.count_if(F.col(c) <= hi).alias(f"u{i}"))]).first()
    rank = [(sketch[f"n_{c}"] - 1) * p for c, p, _, _ in bounds]
    safe = all(counts[f"b{i}"] <= math.floor(r) and counts[f"u{i}"] > math.ceil(r) for i, r in enumerate(rank))
    if not safe:
        bounds = [(c, p, -math.inf, math.inf) for c, p, _, _ in bounds]
    below = [counts[f"b{i}"] if safe else 0 for i in range(len(bounds))]
    inside = F.array_compact(F.array(*[
        F.when(F.col(c).between(lo, hi), F.struct(F.lit(i).alias("b"), F.col(c).alias("x")))
        for i, (c, _, lo, hi) in enumerate(bounds)]))
    held = data.select(F.explode(inside).alias("h")).groupBy(F.col("h.b").alias("_b"), F.col("h.x").alias("_x")).agg(
        F.count("*").alias("_n"))
    cum = running_total(held, ["_x"], "_n", "_hi", by=["_b"]).withColumn("_lo", F.col("_hi") - F.col("_n"))
    targets = F.array(*[F.lit(float(r - b)) for r, b in zip(rank, below)])
    found = _picks(cum, ["_b"], F.array(F.get(targets, F.col("_b"))))
    return found.agg(*[F.array(*[F.max(F.when(F.col("_b") == flat.index((c, p)), F.get("q", F.lit(0)))) for p in ps]).alias(c)
                       for c, ps in wanted.items()])


def quantile_values(df: DataFrame, column: str, probs: Sequence[float], max_buffer: int | None = None) -> list[Column]:
    """Quantiles of the whole table as literals."""
    return quantile_table(df, [column], probs, max_buffer)[column]


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   max_buffer: int | None = None) -> dict[str, list[Column]]:
    """Quantiles of several columns as literals; the passes are shared by all columns.

    They are computed here, once: as literals, conditions on them reach the scan, and an expensive
    subquery is not run again for each place that mentions it.
    """
    limit = PERCENTILE_BUFFER_BYTES if max_buffer is None else max_buffer
    if estimated_bytes(df.select(*columns)) > limit:
        found = _bracketed(df, {c: [float(p) for p in probs] for c in columns})
    else:
        at = F.array(*[F.lit(float(p)) for p in probs])
        found = df.agg(*[F.percentile(F.col(c).cast("double"), at).alias(c) for c in columns])
    row = found.first()
    return {c: [F.lit(row[c][i] if row[c] else None).cast("double") for i in range(len(probs))] for c in columns}


def sample_skewness(column: Column | str) -> Column:
    """Bias-corrected skewness; Spark's ``skewness`` is the population form. Null below three values."""
    n = F.count(column)
    return F.skewness(column) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, median, std, min, quartiles, max, skewness."""
    one_pass = df.agg(*[
        F.struct(
            F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            sample_skewness(c).alias("skew"),
        ).alias(c) for c in columns
    ])
    quarts = quantile_table(df, columns, [0.25, 0.5, 0.75])
    rows = one_pass.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.n").alias("n"), F.col(f"{c}.mean").alias("mean"),
                 F.col(f"{c}.std").alias("std"), F.col(f"{c}.min").alias("min"), quarts[c][0].alias("q1"),
                 quarts[c][1].alias("median"), quarts[c][2].alias("q3"), F.col(f"{c}.max").alias("max"),
                 F.col(f"{c}.skew").alias("skew")) for c in columns
    ])).alias("r"))
    return rows.select("r.*")


def completeness(df: DataFrame) -> DataFrame:
    """Share of non-null values per column, in percent; null on an empty table."""
    one = df.agg(*[(F.count(c) * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "percent_complete")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one pass: ``(a, b, r)``."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs
    ])).alias("p")).select("p.*")


def average_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """``(column, name)``: the mid-rank of each distinct value, from its count and those below."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    cum = running_total(counts, [column], "_n", "_hi")
    return cum.select(column, (F.col("_hi") - (F.col("_n") - 1) / 2.0).alias(name))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns; null if one is constant."""
    pairs = df.select(a, b).na.drop().groupBy(a, b).agg(F.count("*").alias("_w"))
    ra, rb = average_ranks(df.select(a, b).na.drop(), a, "_ra"), average_ranks(df.select(a, b).na.drop(), b, "_rb")
    ranked = pairs.join(ra, a).join(rb, b)
    w, x, y = F.col("_w"), F.col("_ra"), F.col("_rb")
    s = ranked.agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
                   F.sum(w * x * y).alias("sxy"), F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"))
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return s.select((cov / F.nullif(F.sqrt(vx * vy), F.lit(0.0))).alias("rho"))


def gini(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Gini coefficient per group. Equal values share a cumulative count, so hot values cost nothing."""
    epsilon = 1e-7  # fixed value: added so that no value is zero
    rows = df.select(*by, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counts = rows.groupBy(*by, "_x").agg(F.count("*").alias("_c"))
    totals = counts.groupBy(*by).agg(F.sum("_c").alias("_n"), F.min("_x").alias("_min"))
    cum = running_total(counts, ["_x"], "_c", "_hi", by=by)
    if by:
        cum = cum.join(totals, list(by))
    else:
        t = totals.select(F.struct("_n", "_min").alias("s")).scalar()
        cum = cum.withColumn("_n", t["_n"]).withColumn("_min", t["_min"])
    x = F.col("_x") - F.least(F.col("_min"), F.lit(0.0)) + epsilon
    below = F.col("_hi") - F.col("_c")
    weighted = x * F.col("_c") * (2 * below + F.col("_c") - F.col("_n"))
    return cum.groupBy(*by).agg((F.sum(weighted) / (F.max("_n") * F.sum(x * F.col("_c")))).alias("gini"))


def entropy(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Shannon entropy of each group's shares ``value / sum(value)``; zero shares and sums add nothing."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_c"))
    totals = counts.groupBy(*by).agg(F.sum(F.col(value) * F.col("_c")).alias("_t"))
    p = F.col(value) / F.nullif(F.col("_t"), F.lit(0))
    term = F.when(p > 0, -p * F.log(p) * F.col("_c")).otherwise(F.lit(0.0))
    return counts.join(totals, list(by)).groupBy(*by).agg(F.sum(term).alias("entropy"))


def histogram(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    """Rows per bucket; null buckets (outside the edges) are left out."""
    return df.select(bucket.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
