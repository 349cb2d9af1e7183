"""Row order across the whole table without a one-task window.

``lay_out`` sorts globally (range partitions that split hot keys, as the tie-breaker is part
of the sort key), stores the result and labels each row with its sort partition and its
position there. Everything else combines a window inside one sort partition with a carry
table that holds one row per sort partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

PART, POS = "__part", "__pos"
_POS_BITS = 33  # monotonically_increasing_id: partition number above, row offset below


def lay_out(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by ``order``, stored, with columns ``__part`` and ``__pos``."""
    stored = durable(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()))
    return (
        stored.withColumn(PART, F.shiftright("__mid", _POS_BITS))
        .withColumn(POS, F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("__mid")
    )


def _carry(parts: DataFrame, column: Column, name: str, following: bool = False) -> DataFrame:
    """Aggregate over all earlier (or later) sort partitions; one row per partition."""
    w = Window.orderBy(F.desc(PART) if following else F.asc(PART))
    return parts.withColumn(name, column.over(w.rowsBetween(Window.unboundedPreceding, -1)))


def with_index(laid: DataFrame, name: str = "idx") -> DataFrame:
    """0-based position of each row in the global order of a laid-out table."""
    parts = laid.groupBy(PART).agg(F.count("*").alias("_n"))
    parts = _carry(parts, F.sum("_n"), "__before").select(PART, F.coalesce("__before", F.lit(0)).alias("__before"))
    return laid.join(F.broadcast(parts), PART).withColumn(name, F.col("__before") + F.col(POS)).drop("__before")


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group values back on; rows with a null key meet the group of nulls and are kept."""
    renamed = groups.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    return df.join(renamed, same, how).drop(*[f"__key_{k}" for k in keys])


#: groups up to this number of rows are sent to all tasks; counted before the join
SMALL_GROUPS = 100_000


def attach_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """As ``join_groups``, without moving ``df`` where the groups are few.

    The groups are stored and counted first: up to ``SMALL_GROUPS`` rows they are broadcast, so a key that
    holds a third of the rows of ``df`` never meets in one task. More groups are joined by key, where
    adaptive execution splits the hot ones.
    """
    groups = durable(groups)
    small = groups.limit(SMALL_GROUPS + 1).count() <= SMALL_GROUPS
    return join_groups(df, F.broadcast(groups) if small else groups, keys, how)


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """``df`` plus its 0-based position in ``order`` (which must be a total order)."""
    return with_index(lay_out(df, order), name).drop(PART, POS)


def group_row_index(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "idx"
) -> DataFrame:
    """0-based position inside each group; a hot group is spread over many sort partitions."""
    indexed = with_index(lay_out(df, [*by, *order]), "__i").drop(PART, POS)
    starts = indexed.groupBy(*by).agg(F.min("__i").alias("__start"))
    return join_groups(indexed, starts, by).withColumn(name, F.col("__i") - F.col("__start")).drop("__i", "__start")


def running_total(
    df: DataFrame,
    order: Sequence[Column | str],
    value: Column | str,
    name: str = "running",
    by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sum of a non-negative ``value`` in ``order``, per group if ``by``."""
    laid = lay_out(df.withColumn("__v", F.col(value) if isinstance(value, str) else value), [*by, *order])
    parts = laid.groupBy(PART).agg(F.sum("__v").alias("__s"))
    parts = _carry(parts, F.sum("__s"), "__before").select(PART, "__before")
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    out = laid.join(F.broadcast(parts), PART).withColumn(
        name, F.sum("__v").over(inside) + F.coalesce("__before", F.lit(0))
    )
    if by:
        starts = out.groupBy(*by).agg(F.min(F.col(name) - F.col("__v")).alias("__start"))
        out = join_groups(out, starts, by).withColumn(name, F.col(name) - F.col("__start")).drop("__start")
    return out.drop(PART, POS, "__before", "__v")


def previous_value(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    column: str,
    default,
    name: str,
) -> DataFrame:
    """Value of ``column`` in the preceding row of the same group, ``default`` at the start."""
    laid = lay_out(df, [*by, *order]).withColumn("__row", F.struct(*by, column))
    parts = laid.groupBy(PART).agg(F.max_by("__row", POS).alias("__last"))
    parts = parts.withColumn("__before", F.lag("__last").over(Window.orderBy(PART))).select(PART, "__before")
    prev = F.coalesce(F.lag("__row").over(Window.partitionBy(PART).orderBy(POS)), F.col("__before"))
    out = laid.join(F.broadcast(parts), PART).withColumn("__prev", prev)
    same = F.lit(True)
    for key in by:
        same = same & F.col(f"__prev.{key}").eqNullSafe(F.col(key))
    return out.withColumn(name, F.when(F.col("__prev").isNotNull() & same, F.col(f"__prev.{column}"))
                          .otherwise(F.lit(default))).drop(PART, POS, "__row", "__prev", "__before")


def nearest_mark(df: DataFrame, value: str, marks: DataFrame, mark: str, name: str) -> DataFrame:
    """Closest ``mark`` to each ``value``; of two equally close marks the smaller one.

    Both sides are merged into one sorted run, so neither has to fit in memory.
    """
    rows = df.select(F.col(value).alias("_x"), F.lit(None).cast(marks.schema[mark].dataType).alias("_m"),
                     F.struct(*df.columns).alias("__row"))
    bounds = marks.select(F.col(mark).alias("_x"), F.col(mark).alias("_m"),
                          F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"))
    laid = lay_out(rows.unionByName(bounds), ["_x", F.col("_m").asc_nulls_last()])
    parts = laid.groupBy(PART).agg(F.max("_m").alias("_hi"), F.min("_m").alias("_lo"))
    parts = _carry(parts, F.max("_hi"), "_left")
    parts = _carry(parts, F.min("_lo"), "_right", following=True).select(PART, "_left", "_right")
    # both frames grow from their start, one row at a time; a frame that shrinks to its end would
    # be evaluated anew for every row
    upward = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    downward = Window.partitionBy(PART).orderBy(F.desc(POS)).rowsBetween(Window.unboundedPreceding, 0)
    left, right = F.max("_m").over(upward), F.min("_m").over(downward)
    out = laid.join(F.broadcast(parts), PART).select(
        "__row", "_x", F.coalesce(left, "_left").alias("_l"), F.coalesce(right, "_right").alias("_r")
    ).where(F.col("__row").isNotNull())
    closer_right = F.col("_l").isNull() | ((F.col("_r") - F.col("_x")) < (F.col("_x") - F.col("_l")))
    return out.select("__row.*", F.when(F.col("_r").isNotNull() & closer_right, F.col("_r"))
                      .otherwise(F.col("_l")).alias(name))
