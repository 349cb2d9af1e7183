"""The parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def use_all_slots(df: DataFrame) -> DataFrame:
    """Spread a table that is stored in fewer splits than there are task slots.

    Meant for small tables with much work per row (text); a large table has splits enough and
    comes back unchanged, without a shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
