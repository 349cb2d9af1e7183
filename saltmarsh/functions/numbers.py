"""Numeric Column expressions: bins, scales, flags, row-wise blends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(column: Column | str, digits: int) -> Column:
    """Half-up rounded double without a negative zero; plain double arithmetic, so other engines
    that do the same steps get the same bits."""
    c = F.col(column) if isinstance(column, str) else column
    scale = 10.0**digits
    return F.floor(c.cast("double") * scale + 0.5) / scale


def cut_fixed(x: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval (lo, hi] that holds ``x``; null outside all of them."""
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        hit = (x > F.lit(float(lo))) & (x <= F.lit(float(hi)))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def cut_edges(x: Column, edges: Sequence[Column]) -> Column:
    """1-based interval number for right-closed intervals, the lowest edge included."""
    out = F.when(x.isNull() | (x < edges[0]) | (x > edges[-1]), F.lit(None).cast("int"))
    for i, hi in enumerate(edges[1:], start=1):
        out = out.when(x <= hi, F.lit(i))
    return out


def log10_positive(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def powers(name: str, degree: int) -> list[Column]:
    """``x**2 .. x**degree`` with the suffix ``_DEGn``."""
    return [F.pow(F.col(name), n).alias(f"{name}_DEG{n}") for n in range(2, degree + 1)]


def cross_terms(names: Sequence[str]) -> list[Column]:
    """All products of two columns, squares included, as ``a_x_b``."""
    return [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for i, a in enumerate(names) for b in names[i:]]


def boxcox(x: Column, lam: Column) -> Column:
    return F.when(lam == 0, F.log(x)).otherwise((F.exp(lam * F.log(x)) - 1) / lam)


def boxcox_inverse(y: Column, lam: Column) -> Column:
    return F.when(lam == 0, F.exp(y)).otherwise(F.pow(lam * y + 1, 1 / lam))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def safe_ratio(a: Column, b: Column) -> Column:
    return a / (b + F.lit(1e-5))


def three_way(p: Column, t: float) -> Column:
    """0 below one half, 1 above ``t``, -1 between."""
    return F.when(p < 0.5, 0).when(p > t, 1).otherwise(-1)


def map_value(x: Column, mapping: Mapping[str, int]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(x == k, F.lit(v)) if out is None else out.when(x == k, F.lit(v))
    return out


def row_median(columns: Sequence[Column]) -> Column:
    """Median of several scores in one row."""
    s, n = F.array_sort(F.array(*columns)), len(columns)
    return s[n // 2] if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2


def row_mean(columns: Sequence[Column]) -> Column:
    return sum(columns[1:], columns[0]) / len(columns)
