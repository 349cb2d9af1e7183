"""Lines that repeat across documents, found by a pair of Bloom filters.

The 8-byte hashes of line keys, counted inside each Arrow batch, are dealt to shards. A shard streams
them through two filters: a first sighting enters the once-seen filter, a second one the twice-seen
filter, and a hash that meets the twice-seen filter again has been seen three times: a suspect. Filters
only err towards more suspects. The rows of suspects alone go on to the exact count, on 128-bit keys.
Line texts are never shuffled; a document's text moves once, to meet the keys it must lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, ascii_lower, attach, ship, stored

MIN_KEY, MIN_DOCS = 20, 3
LAYER_KEYS, BITS_PER_KEY, PROBES = 1 << 20, 16, 4
SPARK_SEED = 42
SECOND = "second"
_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


def key_hashes(key: bytes) -> tuple[int, int]:
    """What ``xxhash64(key)`` and ``xxhash64('second', key)`` give in SQL, as signed numbers."""
    two = xxhash.xxh64_intdigest(SECOND.encode(), seed=SPARK_SEED)
    pair = xxhash.xxh64_intdigest(key, seed=SPARK_SEED), xxhash.xxh64_intdigest(key, seed=two)
    return tuple(v - (1 << 64) if v >> 63 else v for v in pair)


class BloomLayers:
    """A Bloom filter that grows by layers of ``LAYER_KEYS`` keys each, so its error rate stays."""

    def __init__(self, layer_keys: int = LAYER_KEYS):
        self.room, self.layers, self.left = layer_keys, [], 0
        self.n_bits = np.uint64(layer_keys * BITS_PER_KEY)

    def _places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(33)) | np.uint64(1)
        for i in range(PROBES):
            yield (h + np.uint64(i) * step + np.uint64(i * i)) % self.n_bits

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h), bool)
        for bits in self.layers:
            here = np.ones(len(h), bool)
            for p in self._places(h):
                here &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            found |= here
        return found

    def add(self, h: np.ndarray) -> None:
        while len(h):
            if not self.left:
                self.layers.append(np.zeros(self.room * BITS_PER_KEY // 8, np.uint8))
                self.left = self.room
            part, h = h[: self.left], h[self.left:]
            for p in self._places(part):
                np.bitwise_or.at(self.layers[-1], p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
            self.left -= len(part)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _count_in_batch(batches):
    for batch in batches:
        h, n = np.unique(batch.column("h1").to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.minimum(n, 3).astype(np.int32))], ["h1", "n"])


def _suspects(least: int):
    def run(batches):
        seen = [BloomLayers() for _ in range(least - 1)]  # seen[i]: hashes met more than i times
        for batch in batches:
            h, where = np.unique(batch.column("h1").to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.bincount(where, weights=batch.column("n").to_numpy(zero_copy_only=False), minlength=len(h))
            key = _mixed(h.view(np.uint64))
            times = n
            for level in seen:
                times = times + level.has(key)
            for i, level in enumerate(seen):
                new = (times > i) & ~level.has(key)
                level.add(key[new])
            if (hit := h[times >= least]).size:
                yield pa.RecordBatch.from_arrays([pa.array(hit)], ["h1"])
    return run


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_key: int = MIN_KEY) -> DataFrame:
    """Rows (doc_id, keys): per document the 128-bit keys of the lines it must lose."""
    spark = docs.sparkSession
    ship(spark)
    keys = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(docs["text"], F.lit("")), "\n"), line_key),
                                     lambda k: F.length(k) >= min_key))
    lines = docs.select(docs["doc_id"].alias("doc_id"), F.explode(keys).alias("k")).select(
        "doc_id", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(SECOND), "k").alias("h2"))
    counted = lines.select("h1").mapInArrow(_count_in_batch, "h1 long, n int")
    suspects = stored(counted.repartition("h1").mapInArrow(_suspects(min_docs), "h1 long").distinct(), "suspects")
    rows = stored(lines.join(suspects, "h1", "left_semi").distinct(), "suspect-lines")
    found = rows.groupBy("h1", "h2").agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("last"))
    found = found.where(F.col("docs") >= min_docs).select(F.struct("h1", "h2").alias("key"), "docs", "last")
    marked = attach(rows.select("doc_id", F.struct("h1", "h2").alias("key")), stored(found, "repeats"), "key", "docs", "doc_id")
    return marked.where("doc_id < last").groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def split_kept(text: str, drop: set[tuple[int, int]], min_key: int = MIN_KEY) -> tuple[int, list[str]]:
    """Number of lines, and the lines that stay."""
    lines = text.split("\n")
    if not drop:
        return len(lines), lines
    kept = []
    for line in lines:
        key = line.encode().translate(_TABLE).strip(BLANKS.encode())
        if len(key) >= min_key and len(key.decode()) >= min_key and key_hashes(key) in drop:
            continue
        kept.append(line)
    return len(lines), kept


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_key: int = MIN_KEY) -> DataFrame:
    """``docs`` with __n_lines, __n_dropped, __kept (the text left) and __sha (its SHA-256).

    A line's key is the line with blanks stripped at both ends and A-Z lower-cased. Keys of ``min_key``
    code points or more in at least ``min_docs`` documents lose all their lines but those in the largest
    doc_id that has one. A null or empty text is one empty line. Rows that repeat a doc_id are one
    document: a key counts once for them and stays in all of them. Rows with a null doc_id lose nothing
    and count for nothing.
    """
    losses = repeated_lines(docs, min_docs, min_key).select(F.col("doc_id").alias("__doc"), F.col("keys").alias("__keys"))
    joined = docs.join(losses, docs["doc_id"] == F.col("__doc"), "left").drop("__doc")
    at = joined.columns.index("text") if joined.columns.count("text") == 1 else None
    if at is None:
        raise ValueError("documents need one column named text")
    schema = joined.drop("__keys").schema.add("__n_lines", "long").add("__n_dropped", "long").add("__kept", "string").add("__sha", "string")

    def cut(batches):
        for batch in batches:
            keys = batch.column("__keys").to_pylist()
            n_lines, n_dropped, texts, shas = [], [], [], []
            for text, ks in zip(batch.column("text").to_pylist(), keys):
                n, kept = split_kept(text or "", {(k["h1"], k["h2"]) for k in ks} if ks else set(), min_key)
                n_lines.append(n)
                n_dropped.append(n - len(kept))
                texts.append("\n".join(kept))
                shas.append(hashlib.sha256(texts[-1].encode()).hexdigest())
            columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "__keys"]
            names = [n for n in batch.schema.names if n != "__keys"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string()), pa.array(shas, pa.string())],
                names=[*names, "__n_lines", "__n_dropped", "__kept", "__sha"])

    return joined.mapInArrow(cut, schema)
