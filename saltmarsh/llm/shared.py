"""Helpers of the operators here: stored tables, worker code, hot keys, connected components."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\x0c\r"
HOT_GROUPS = 1024
#: size of what a worker gets at once, at most (or one row)
BATCH_SIZE = "8m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that worker code can import it wherever the driver was started.

    Arrow batches are bounded in bytes as well, as texts may be long.
    """
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(batch).rstrip("b") == str(64 << 20):  # the default
        spark.conf.set(batch, BATCH_SIZE)
    sc = spark.sparkContext
    if getattr(sc, "_saltmarsh_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    handle, path = tempfile.mkstemp(prefix="saltmarsh-", suffix=".zip")
    with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "saltmarsh")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    atexit.register(lambda: os.path.exists(path) and os.unlink(path))
    sc._saltmarsh_shipped = True


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a parquet table in the shared folder and read it back: lineage ends there. Also its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """As ``stored_at``, the table alone."""
    return stored_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table all of whose readers have been stored themselves."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """Left join of ``groups`` (unique, non-null ``key``) onto ``rows`` without a hot task.

    A group with more than one row in 1024 of the counted total is hot; as sizes add up to that total
    there are at most 1024, which are broadcast. Rows of hot groups carry a salt made from column
    ``spread`` into the shuffled join of the others, so they spread out and meet nothing there.
    ``groups`` should be stored, as it is read three times.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    values = [c for c in groups.columns if c != key]
    limit = total / HOT_GROUPS
    hot = groups.where(F.col(size) > limit).select(
        F.col(key).alias("__hot_key"), *[F.col(c).alias(f"__hot_{c}") for c in values])
    cold = groups.where(F.col(size) <= limit).select(
        F.col(key).alias("__cold_key"), F.lit(0).cast("long").alias("__cold_salt"), *[F.col(c).alias(f"__cold_{c}") for c in values])
    is_hot = F.col("__hot_key").isNotNull()
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left").withColumn(
        "__salt", F.when(is_hot, F.shiftright(F.abs(F.xxhash64(spread)), 1) + 1).otherwise(0))
    out = out.join(cold, (F.col(key) == F.col("__cold_key")) & (F.col("__salt") == F.col("__cold_salt")), "left")
    return out.select(*rows.columns, *[F.when(is_hot, F.col(f"__hot_{c}")).otherwise(F.col(f"__cold_{c}")).alias(c) for c in values])


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 64) -> DataFrame:
    """Rows (node, component): the smallest node reachable over ``edges``; nodes without an edge are absent.

    Alternates large-star and small-star steps: every edge is replaced by one to the smallest neighbour,
    so the number of edges never grows and a chain halves in every round. Each round is stored; it ends
    when an edge set reproduces itself (count and a sum of hashes agree).
    """
    now = stored(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(now)
    for _ in range(rounds):
        if not before[0]:
            break
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where("u != v").distinct(), "small-star")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def own_columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The named columns of ``df``, whatever else it carries."""
    return [df[n] for n in names]
