"""Multinomial naive Bayes for all labels at once, from long-form word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .ordering import attach_groups


def fit_multilabel(words: DataFrame, tags: DataFrame, key: str, smoothing: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Tables (word, base, gains) and (label, prior, per_word) of one two-class model per label.

    ``words`` has (key, word, n) of the training rows, ``tags`` (key, label) of the labels each row has,
    ``label`` null for a row without any; its keys are the training rows. Every model shares the vocabulary.
    The log odds of a label add up, over the words of a row, n times ln p(word | label) / p(word | no label).
    For a word never seen with the label that is ``base`` (the same for all labels) plus ``per_word`` of
    the label; ``gains`` holds the difference for the labels it was seen with. So the tables grow with
    the pairs that occur, not with labels times words. One ``groupBy(label, word)`` fits everything.
    """
    rows = tags.select(key).distinct()
    known = durable(words.join(rows, key, "left_semi"))
    total = known.groupBy("word").agg(F.sum("n").alias("n"))
    pairs = durable(known.join(tags.where(F.col("label").isNotNull()).distinct(), key).groupBy("label", "word").agg(F.sum("n").alias("n_with")))
    size = total.agg(F.count("*").alias("v"), F.sum("n").alias("n")).select(F.struct("v", "n").alias("s")).scalar()
    n_rows = rows.agg(F.count("*").alias("n")).scalar()
    per_label = tags.where(F.col("label").isNotNull()).distinct().groupBy("label").agg(F.count("*").alias("rows"))
    counts = pairs.groupBy("label").agg(F.sum("n_with").alias("words"))
    a = F.lit(float(smoothing))
    inside = F.col("words") + a * size["v"]
    outside = (size["n"] - F.col("words")) + a * size["v"]
    labels = per_label.join(counts, "label", "left").fillna({"words": 0}).select(
        "label", (F.log(F.col("rows") / n_rows) - F.log((n_rows - F.col("rows")) / n_rows)).alias("prior"),
        (F.log(outside) - F.log(inside)).alias("per_word"))
    base = F.log(a) - F.log(F.col("n") + a)
    gain = F.log(F.col("n_with") + a) - F.log(F.col("n") - F.col("n_with") + a) - base
    gains = pairs.join(total, "word").select("word", F.struct("label", gain.alias("gain")).alias("g")).groupBy("word").agg(F.collect_list("g").alias("gains"))
    return total.join(gains, "word", "left").select("word", base.alias("base"), "gains"), durable(labels)


#: models of up to this number of labels are added up in a column per label, larger ones in a row per label
WIDE = 64


def score_multilabel(words: DataFrame, rows: DataFrame, model: tuple[DataFrame, DataFrame], key: str) -> DataFrame:
    """(key, label, p) for every row of ``rows`` and every label; words unknown to the model count for nothing.

    A label that all or no training rows have has no odds and gives null.
    """
    by_word, labels = model
    few = labels.limit(WIDE + 1).collect()  # one entry per label
    if 0 < len(few) <= WIDE:
        out = _odds_by_columns(words, rows, by_word, few, labels.schema["label"].dataType, key)
    else:
        out = _odds_by_rows(words, rows, by_word, labels, key)
    return out.select(key, "label", (1 / (1 + F.exp(-F.col("odds")))).alias("p"))


def _odds_by_columns(words: DataFrame, rows: DataFrame, by_word: DataFrame, labels: list, label_type, key: str) -> DataFrame:
    """A word of a row moves once, with the gains of all labels, and a row's sums come from one aggregation."""
    of_label = F.map_from_entries("gains")
    wide = by_word.select("word", F.struct("base", *[
        F.coalesce(F.try_element_at(of_label, F.lit(l["label"]).cast(label_type)), F.lit(0.0)).alias(f"g{i}") for i, l in enumerate(labels)]).alias("w"))
    known = attach_groups(words, wide, ["word"])
    sums = known.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("w.base")).alias("base"),
                                  *[F.sum(F.col("n") * F.col(f"w.g{i}")).alias(f"g{i}") for i in range(len(labels))])
    number = lambda c, zero: F.coalesce(F.col(c), F.lit(zero))
    odds = [F.struct(F.lit(l["label"]).cast(label_type).alias("label"), (
        F.lit(l["prior"]).cast("double") + number("base", 0.0) + number("n", 0) * F.lit(l["per_word"]).cast("double") + number(f"g{i}", 0.0)).alias("odds"))
        for i, l in enumerate(labels)]
    return rows.select(key).join(sums, key, "left").select(key, F.explode(F.array(*odds)).alias("l")).select(key, "l.label", "l.odds")


def _odds_by_rows(words: DataFrame, rows: DataFrame, by_word: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    known = durable(attach_groups(words, by_word, ["word"]).select(key, "n", "base", "gains"))
    plain = known.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("base")).alias("base"))
    gains = known.select(key, "n", F.explode("gains").alias("g")).groupBy(key, "g.label").agg(F.sum(F.col("n") * F.col("g.gain")).alias("gain"))
    every = labels.agg(F.collect_list(F.struct("label", "prior", "per_word")).alias("l")).scalar()
    odds = rows.select(key).join(plain, key, "left").select(
        key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("base", F.lit(0.0)).alias("base"), F.explode(every).alias("l")).select(
        key, "l.label", (F.col("l.prior") + F.col("base") + F.col("n") * F.col("l.per_word")).alias("odds"))
    return odds.join(gains, [key, "label"], "left").select(key, "label", (F.col("odds") + F.coalesce("gain", F.lit(0.0))).alias("odds"))
