"""Categorical and text encodings; long or fixed-width, never one column per word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import attach_groups, running_total


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """0/1 column per fitted category; a category absent from the data is a zero column."""
    return df.select("*", *[F.coalesce((F.col(column) == c).cast("int"), F.lit(0)).alias(f"{column}_{c}")
                            for c in categories])


def multi_hot(df: DataFrame, items: Column, vocabulary: Sequence[str], prefix: str) -> DataFrame:
    """0/1 column per vocabulary item; a null list is all zeros. No shuffle: the list is tested in place."""
    return df.select("*", *[F.coalesce(F.array_contains(items, v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
                            for v in vocabulary])


def merged_items(columns: Sequence[Column]) -> Column:
    """One list from several columns; null if any of them is null."""
    ok = columns[0].isNotNull()
    for c in columns[1:]:
        ok = ok & c.isNotNull()
    return F.when(ok, F.array(*columns))


def document_terms(df: DataFrame, key: str, words: Column) -> DataFrame:
    """``(key, word, n)`` in long form."""
    return df.select(key, F.explode(words).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))


def bag_of_words(df: DataFrame, key: str, words: Column, min_df: float = 0.0, max_features: int | None = None) -> DataFrame:
    """Term counts of words found in at least ``min_df`` (share) of the documents; optionally only
    the ``max_features`` most frequent ones.

    The vocabulary comes first, from counts combined before the shuffle; the per-document counts
    then move its words only.
    """
    n_docs = df.agg(F.count("*").alias("n")).scalar()
    if min_df > 0:
        seen = df.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
        vocab = seen.where(F.col("df") >= n_docs * F.lit(float(min_df))).select("word")
    else:
        vocab = None
    if max_features:
        total = df.select(F.explode(words).alias("word"))
        if vocab is not None:
            total = total.join(vocab, "word", "left_semi")
        total = total.groupBy("word").agg(F.count("*").alias("total"))
        vocab = total.orderBy(F.desc("total"), F.asc("word")).limit(max_features).select("word")
    rows = df.select(key, F.explode(words).alias("word"))
    if vocab is not None:
        rows = rows.join(vocab, "word", "left_semi")
    return rows.groupBy(key, "word").agg(F.count("*").alias("n"))


def frequent_categories(df: DataFrame, column: str, percent: float) -> DataFrame:
    """Categories whose descending cumulative percentage stays below ``percent``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*").alias("t")).scalar()
    cum = running_total(counts, [F.desc("_n"), F.asc(column)], "_n", "_cum")
    return cum.where(F.col("_cum") / total * 100 < percent).select(column)


def rare_to_other(df: DataFrame, column: str, percent: float, name: str, other: str = "OTHERS") -> DataFrame:
    kept = frequent_categories(df, column, percent).withColumn("_keep", F.lit(1))
    return attach_groups(df, kept, [column], "left").withColumn(
        name, F.when(F.col(column).isNull() | F.col("_keep").isNotNull(), F.col(column)).otherwise(other)).drop("_keep")


def label_table(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Dense 0-based code per label in sorted order."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return running_total(labels, [column], F.lit(1), "_r").select(column, (F.col("_r") - 1).alias(name))


def label_index(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    return attach_groups(df, label_table(df, column, name), [column], "left")
