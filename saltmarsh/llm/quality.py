"""Quality by importance resampling: two hashed n-gram models and Gumbel top-k.

Both models count hashed 4-grams of bytes and, as a second family, whether a word repeats the word
before it: the raw model over all documents, the target model over the good documents of a bounded
sample of labels, smoothed by ``PRIOR`` pseudo-counts of the raw model. A document's log weight is the
mean log ratio (target over raw) of its grams plus that of its words, for ``LENGTH`` of them, so that
long documents do not weigh more than short ones. Adding Gumbel noise drawn from its id and keeping the
k largest sums samples k documents without replacement in proportion to their weights; k is the number
of documents above the log weight that best tells the good labels of the sample from the bad ones.
"""

from __future__ import annotations

from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, stored, texts_of

BUCKETS = 1 << 16
#: labelled documents that fit the target model and the cut, at most; the smallest id hashes are taken
MAX_LABELS = 20_000
PRIOR, LENGTH = 1 << 14, 1000
SEED = 5
_FLUSH = 1 << 20


def grams(text: bytes) -> np.ndarray:
    """Bucket of every run of four bytes."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.empty(0, np.uint32)
    four = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))
    return (four * np.uint32(2654435761)) >> np.uint32(16)


def repeats(text: bytes) -> tuple[int, int]:
    """Words equal to the word before them, and words that are not."""
    words = text.split()
    same = sum(map(eq, words, islice(words, 1, None)))
    return same, len(words) - same


def _count(batches):
    """Counts of each bucket in raw and target; the last two buckets are the word family."""
    counts = np.zeros((2, BUCKETS + 2), np.int64)
    held: list[list[np.ndarray]] = [[], []]
    size = [0, 0]

    def flush(i):
        if held[i]:
            counts[i, :BUCKETS] += np.bincount(np.concatenate(held[i]), minlength=BUCKETS)
            held[i], size[i] = [], 0

    for batch in batches:
        for text, good in zip(texts_of(batch.column("text")), batch.column("good").to_pylist()):
            g, r = grams(text), repeats(text)
            for i in (0, 1) if good else (0,):
                held[i].append(g)
                size[i] += len(g)
                counts[i, BUCKETS:] += r
                if size[i] > _FLUSH:
                    flush(i)
    flush(0)
    flush(1)
    at = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bucket", "raw", "target"])


def label_sample(labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Rows (id, good), ``max_labels`` at most. Good: all labels of the id have quality 1; null ids and qualities are ignored."""
    known = labels.where(labels["doc_id"].isNotNull() & labels["quality"].isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).select(F.col("doc_id").alias("__id"), (F.col("q") == 1).alias("__good"))


def fit(docs: DataFrame, sample: DataFrame) -> np.ndarray | None:
    """Log ratio per bucket; None if no document of ``docs`` is labelled good in the sample.

    The raw counts cover every row and whole text of ``docs``.
    """
    ship(docs.sparkSession)
    # the sample has a bounded number of rows
    marked = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("__id"), "left")
    counts = marked.select("text", F.coalesce("__good", F.lit(False)).alias("good")).mapInArrow(_count, "bucket int, raw long, target long")
    rows = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # BUCKETS + 2 rows at most
    n = np.zeros((2, BUCKETS + 2))
    n[0, rows["bucket"]], n[1, rows["bucket"]] = rows["raw"], rows["target"]
    if not n[1].any():
        return None
    ratio = np.zeros(BUCKETS + 2)
    for part in (slice(0, BUCKETS), slice(BUCKETS, BUCKETS + 2)):
        raw = n[0, part] / max(1, n[0, part].sum())
        target = (n[1, part] + PRIOR * raw) / (n[1, part].sum() + PRIOR)
        ratio[part] = np.log(np.divide(target, raw, out=np.ones_like(raw), where=raw > 0))
    return ratio


def gumbel(doc_id: int | None, seed: int) -> float:
    """Standard Gumbel noise that depends on the id alone."""
    u = (xxhash.xxh64_intdigest(str(doc_id).encode(), seed=seed) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def log_weight(text: bytes, ratio: np.ndarray) -> float:
    g, (same, new) = grams(text), repeats(text)
    words = same * ratio[BUCKETS] + new * ratio[BUCKETS + 1]
    return float(LENGTH * (ratio[g].sum() / max(1, len(g)) + words / max(1, same + new)))


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the range of cuts that tell good from bad best, each class counting alike."""
    if not len(good) or not len(bad):
        return float("-inf")
    at = np.unique(np.concatenate([good, bad]))
    right = np.searchsorted(np.sort(bad), at, "right") / len(bad) - np.searchsorted(np.sort(good), at, "right") / len(good)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    last = best[0]
    while last + 1 in best:
        last += 1
    return float((at[best[0]] + at[min(last + 1, len(at) - 1)]) / 2)


def scores(docs: DataFrame, ratio: np.ndarray | None, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, log_weight, key): key is the log weight plus noise."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            w = [0.0 if ratio is None else log_weight(t, ratio) for t in texts_of(batch.column("text"))]
            key = [a + gumbel(i, seed) for i, a in zip(ids, w)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(w, pa.float64()), pa.array(key, pa.float64())], ["doc_id", "log_weight", "key"])

    ship(docs.sparkSession)
    some = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return some.mapInArrow(run, f"doc_id {some.schema['doc_id'].dataType.simpleString()}, log_weight double, key double")


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """Exact k-th largest value (k from 1) of a stored table, by counts in ever narrower bins."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        step = (high - low) / bins
        at = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1)) if step else F.lit(0)
        rows = df.where(F.col(column).between(low, high)).groupBy(at.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("bin")).collect()  # bins rows at most
        for r in rows:
            if above + r["n"] >= k:
                break
            above += r["n"]
        if len(rows) == 1:  # values closer together than bins can tell apart: at most two neighbours remain
            top = df.where(F.col(column) == high).count()
            return high if above + top >= k else df.where((F.col(column) < high) & (F.col(column) >= low)).agg(F.max(column)).first()[0]
        low, high = r["lo"], r["hi"]
    return low


def resample(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_weight, key, kept.

    Null and empty texts have log weight 0. Rows that tie with the last one kept are kept too. Without
    any good label all weights are 0 and all rows stay; without any bad one all rows stay as well. Rows that repeat an id share their noise.
    """
    got, threshold, _ = decide(docs, labels, max_labels, seed)
    return got.select("doc_id", "log_weight", "key", (F.col("key") >= threshold).alias("kept"))


def decide(docs: DataFrame, labels: DataFrame, max_labels: int, seed: int) -> tuple[DataFrame, float, np.ndarray | None]:
    """The stored scores, the key of the last document kept, and the fitted log ratios."""
    sample = stored(label_sample(labels, max_labels), "labels")
    ratio = fit(docs, sample)
    got = stored(scores(docs, ratio, seed), "weights")
    if ratio is None:
        return got, float("-inf"), None
    marked = got.join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(
        F.first("__good").alias("good"), F.min("log_weight").alias("w")).toPandas()  # one row per label of the sample at most
    good = marked["good"].to_numpy(bool)
    cut = best_cut(marked["w"].to_numpy()[good], marked["w"].to_numpy()[~good])
    k = got.where(F.col("log_weight") > cut).count()
    return got, kth_largest(got, "key", k) if k else float("inf"), ratio


def good_documents(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with all their columns; texts are weighed again, not shuffled."""
    _, threshold, ratio = decide(docs, labels, max_labels, seed)
    if ratio is None:
        return docs

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))
            yield batch.filter(pa.array([log_weight(t, ratio) + gumbel(i, seed) >= threshold for i, t in zip(ids, texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
