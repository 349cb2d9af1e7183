"""Principal components, chained imputation and least squares from product sums.

A task adds up the products of its rows' columns (a small matrix), Spark adds up the matrices, and the
driver solves systems of the size of the column list. No row is ever sent there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable, ship_package


def _block(batch, columns: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])


def product_sums(df: DataFrame, columns: Sequence[str], prepare: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Sums of products of all pairs of (1, columns) over the rows, as a matrix; one pass.

    ``prepare`` maps a block of rows (nulls as NaN) to the block that counts; by default rows with a null are left out.
    """
    ship_package(df.sparkSession)
    p = len(columns) + 1

    def run(batches):
        total = np.zeros((p, p))
        for batch in batches:
            x = _block(batch, columns)
            x = x[~np.isnan(x).any(1)] if prepare is None else prepare(x)
            one = np.column_stack([np.ones(len(x)), x])
            total += one.T @ one
        i, j = (v.ravel() for v in np.indices((p, p)))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    some = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    out = np.zeros((p, p))
    for r in some.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # p * p rows
        out[r.i, r.j] = r.s
    return out


def _centre(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation per column (1 where it is constant or absent), from the observed values."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return (np.array([float(row[f"m{i}"] or 0.0) for i in range(len(columns))]),
            np.array([float(row[f"s{i}"] or 1.0) or 1.0 for i in range(len(columns))]))


def pca_project(df: DataFrame, columns: Sequence[str], k: int, prefix: str = "pc", standardise: bool = True) -> tuple[DataFrame, DataFrame]:
    """``df`` with its projections on the first ``k`` principal components, and (component, ratio, loadings).

    Columns are centred and, with ``standardise``, divided by their population deviation. The sign of a
    component makes its largest loading positive (of equally large ones the first). A row with a null in
    a column takes no part in the fit and has null projections. ``ratio`` is the share of the variance, null without any.
    """
    columns = list(columns)
    mean, width = _centre(df.dropna(subset=columns), columns)
    if not standardise:
        width = np.ones(len(columns))

    def scaled(x):
        x = x[~np.isnan(x).any(1)]
        return (x - mean) / width

    g = product_sums(df, columns, scaled)
    n = max(g[0, 0], 1.0)
    values, vectors = np.linalg.eigh(g[1:, 1:] / n - np.outer(g[0, 1:], g[0, 1:]) / n ** 2)
    order = np.argsort(-values, kind="stable")[:k]
    out, rows, total = df, [], float(np.clip(values, 0, None).sum())
    for at, o in enumerate(order):
        w = vectors[:, o]
        size = np.abs(w)
        w = w * np.sign(w[np.flatnonzero(size >= size.max() - 1e-9)[0]])
        z = [(F.col(c) - float(m)) / float(s) * float(v) for c, m, s, v in zip(columns, mean, width, w)]
        out = out.withColumn(f"{prefix}{at + 1}", sum(z[1:], z[0]))
        rows.append((at + 1, max(float(values[o]), 0.0) / total if total else None, [float(v) for v in w]))
    return out, df.sparkSession.createDataFrame(rows, "component int, ratio double, loadings array<double>")


def spread(df: DataFrame, column: str, width: int, prefix: str = "x") -> tuple[DataFrame, list[str]]:
    """The first ``width`` entries of an array column as columns of their own."""
    names = [f"{prefix}{i}" for i in range(width)]
    return df.select("*", *[F.get(column, F.lit(i)).cast("double").alias(c) for i, c in enumerate(names)]), names


def _filled(x: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Standardised rows with their nulls (NaN) filled by the steps so far; a null without a step is the mean, 0."""
    hole = np.isnan(x)
    z = np.where(hole, 0.0, x)
    for i, w in steps:
        rows = hole[:, i]
        z[rows, i] = w[0] + z[rows] @ w[1:]
    return z


def impute_chained(df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-9) -> DataFrame:
    """Fill nulls by repeated least-squares regression of each column with nulls on all others, from the means.

    Every step of a round reads the stored table once: the rows that have the column, other columns as
    filled so far, give the product sums of its regression. Rounds end when no coefficient moves by more than
    ``tolerance`` (of a deviation), or after ``rounds``. The fills are worked out row by row from the
    coefficients of all steps, so no intermediate table is written and nothing depends on the patterns of nulls.
    A column without any value becomes 0. Columns become double; rows are kept.
    """
    columns = list(columns)
    stored = durable(df)
    mean, width = _centre(stored, columns)
    counts = stored.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    holed = [i for i in range(len(columns)) if counts[f"c{i}"]]
    steps: list[tuple[int, np.ndarray]] = []
    previous: dict[int, np.ndarray] = {}
    for _ in range(rounds):
        moved = 0.0
        for i in holed:
            def known(x, i=i, steps=tuple(steps)):
                z = (x - mean) / width
                return _filled(z[~np.isnan(z[:, i])], steps)

            g = product_sums(stored, columns, known)
            others = [a for a in range(len(columns) + 1) if a != i + 1]
            w = np.zeros(len(columns) + 1)
            w[others] = np.linalg.lstsq(g[np.ix_(others, others)], g[others, i + 1], rcond=None)[0]
            moved = max(moved, np.abs(w - previous[i]).max() if i in previous else np.inf)
            previous[i] = w
            steps.append((i, w))
        if moved <= tolerance:
            break
    ship_package(df.sparkSession)
    schema = stored.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in stored.columns]).schema

    def fill(batches):
        for batch in batches:
            z = _filled((_block(batch, columns) - mean) / width, steps)
            x = z * width + mean
            new = []
            for c, old in zip(batch.schema.names, batch.columns):
                if c in columns:  # observed values stay as they are, to the bit
                    i = columns.index(c)
                    was = old.to_numpy(zero_copy_only=False).astype(np.float64)
                    old = pa.array(np.where(np.isnan(was), x[:, i], was))
                new.append(old)
            yield pa.RecordBatch.from_arrays(new, names=batch.schema.names)

    return stored.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in stored.columns]).mapInArrow(fill, schema)


def weighted_line(df: DataFrame, x: str, y: str, weight: str | Column) -> DataFrame:
    """Slope, intercept and number of rows of a weighted least-squares line, in one aggregate.

    Rows with a null in any of the three are left out; without two different x the slope and intercept are null.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.cast("double").alias("w")).dropna()
    s = rows.agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("x")).alias("wx"), F.sum(F.col("w") * F.col("y")).alias("wy"),
                 F.sum(F.col("w") * F.col("x") * F.col("x")).alias("wxx"), F.sum(F.col("w") * F.col("x") * F.col("y")).alias("wxy"))
    slope = (F.col("w") * F.col("wxy") - F.col("wx") * F.col("wy")) / F.nullif(F.col("w") * F.col("wxx") - F.col("wx") * F.col("wx"), F.lit(0.0))
    return s.withColumn("slope", slope).select("n", "slope", ((F.col("wy") - F.col("slope") * F.col("wx")) / F.nullif(F.col("w"), F.lit(0.0))).alias("intercept"))
