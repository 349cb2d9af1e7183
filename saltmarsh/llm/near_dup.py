"""Near-duplicates by HyperMinHash sketches.

A document's set is that of its distinct five-word shingles, as 64-bit hashes. The top 7 bits of a hash
choose one of 128 buckets; of the smallest rest in a bucket the register keeps the number of leading
zeros (6 bits) and the 10 bits behind the first one, 16 bits in all. Four registers make one of 32 bands
and are together the 64-bit band key; for banding alone, empty registers are filled from the first
non-empty one in a fixed random order of that register. At a similarity of 0.75 a pair misses all bands
about once in 200 000 times.

Documents with equal sets are one class, and only classes are compared. A band bucket never emits its
pairs: first every member meets the smallest one; members that ended in the same component by confirmed
links are done, and only where a bucket still holds several components are its members looked at again.
Their shingles are counted and ordered, rarest first. Two sets that reach the similarity share one of their
first ``n - ceil(0.75 n) + 1`` shingles in any common order, so members meet only over such a shingle; shingles
that one set alone has use up places of that list and bring nobody together, and those of a passage that
many documents share come last. Of shingles that the same members share the first is enough. There again every
member first meets the smallest, and then members outside the largest component meet the members of other
components. What stands before the shingle they meet over is not shared, so its places in both lists bound the
intersection, and pairs that can't reach the similarity are never formed.

Pairs must pass the exact bound on set sizes, then the Jaccard estimate of their registers, corrected for
registers that agree by chance and with six standard deviations to spare; the links themselves are
confirmed on the full sets of both texts.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attach, components, ship, stored, texts_of
from .text import mix, shingle_set

BUCKET_BITS, MANTISSA_BITS, ROWS = 7, 10, 4
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // ROWS
PERCENT = 75
SPARE = 6.0
#: expected share of agreeing registers of unrelated sets is this times 2^-mantissa bits, for sets of equal size
CHANCE = 0.169919487159739

_U = np.uint64


def registers(shingles: np.ndarray) -> np.ndarray:
    """The 128 registers of a set given as ascending hashes; 0 is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(shingles):
        return out
    bucket = shingles >> _U(64 - BUCKET_BITS)
    first = np.flatnonzero(np.diff(bucket, prepend=bucket[0] + _U(1)))
    rest = (shingles[first] << _U(BUCKET_BITS)) | _U(1)
    zeros = 63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64)
    zeros = np.clip(zeros, 0, 62)
    behind = (rest << (zeros + 1).astype(np.uint64)) >> _U(64 - MANTISSA_BITS)
    out[bucket[first].astype(np.int64)] = ((zeros + 1).astype(np.uint64) << _U(MANTISSA_BITS) | behind).astype(np.uint16)
    return out


def _fill_order() -> np.ndarray:
    return np.argsort(np.random.default_rng(11).random((BUCKETS, BUCKETS)), axis=1)


def band_keys(regs: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Per sketch (row) its 32 band keys; every sketch has a non-empty register."""
    full = regs != 0
    donor = np.take_along_axis(order[None], full[:, order].argmax(2)[:, :, None], 2)[:, :, 0]
    filled = np.where(full, regs, np.take_along_axis(regs, donor, 1))
    packed = np.ascontiguousarray(filled).view("<u8")
    return mix(packed ^ mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None])


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrected Jaccard estimate of sketch pairs (rows), and the number of registers it rests on."""
    used = ((a != 0) | (b != 0)).sum(1)
    same = ((a == b) & (a != 0)).sum(1)
    ratio = np.maximum(n_a, n_b) / np.minimum(n_a, n_b)
    chance = CHANCE * BUCKETS / (1 << MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, same - chance) / used, used


def _sketch(batches):
    for batch in batches:
        n, keys, regs = [], [], []
        for text in texts_of(batch.column("text")):
            s = shingle_set(text)
            n.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            regs.append(registers(s).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())],
                                         ["doc_id", "n_shingles", "set_key", "regs"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _bands(batches):
    order = _fill_order()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keys = band_keys(_matrix(part.column("regs")), order).view(np.int64)
            ids = np.repeat(part.column("cid").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["bucket", "cid"])


def _likely(percent: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
            j, used = estimate(_matrix(batch.column("regs_a")), _matrix(batch.column("regs_b")), n_a, n_b)
            t = percent / 100
            ok = j + SPARE * np.sqrt(t * (1 - t) / used) >= t
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))
    return run


def _confirmed(percent: int):
    def run(batches):
        sets = _Sets()
        for batch in batches:
            ok = []
            for ta, tb in zip(texts_of(batch.column("text_a")), texts_of(batch.column("text_b"))):
                x, y = sets.of(ta), sets.of(tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


class _Sets:
    """The shingle sets of the last texts asked for."""

    def __init__(self, room: int = 64):
        self.room, self.sets = room, OrderedDict()

    def of(self, text: bytes) -> np.ndarray:
        if text not in self.sets:
            self.sets[text] = shingle_set(text)
            if len(self.sets) > self.room:
                self.sets.popitem(last=False)
        return self.sets[text]


def _entries(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # a batch of texts has far more shingles than rows
            part = batch.slice(at, 256)
            ids = part.column("doc_id")
            sets = [shingle_set(t) for t in texts_of(part.column("text"))]
            sizes = np.array([len(x) for x in sets], np.int64)
            names = np.array([int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in sets], np.int64)
            row = np.repeat(np.arange(len(sets)), sizes)
            h = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(names[row]), pa.array(sizes[row]), pa.array(h)], ["cid", "set", "n", "h"])


def _unsettled(named: DataFrame) -> DataFrame:
    """Rows (bucket, cid, label) of buckets with several labels, with the most frequent one as ``main``."""
    parts = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    several = parts.groupBy("bucket").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("main")).where("labels > 1")
    return named.join(several.select("bucket", "main"), "bucket")


def _sharing(rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Rows (bucket, cid, n, behind), a bucket for each shingle among the first ones of several of the documents
    ``rows`` (cid): the size of the set, and how many of its shingles are not before this one.

    Shingles are ordered by the number of these documents' sets that hold them, then by hash. Of buckets with the
    same members (by count and two sums of hashes) the first is left.
    """
    wanted = rows.select(F.col("cid").alias("doc_id")).distinct()
    entries = stored(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_entries, "cid long, set long, n long, h long"), "shingles")
    counts = stored(entries.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "shingle-counts")
    common = attach(entries, counts, "h", "df", spread="cid").where("df is not null")
    lists = common.groupBy("cid", "set", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("l"))
    first = F.expr(f"({100 - percent} * n) div 100 + 1")  # of all shingles; those of one set alone come before the listed ones
    some = F.slice("l", 1, F.greatest(F.lit(0), first - (F.col("n") - F.size("l"))).cast("int"))
    firsts = stored(lists.select("cid", "n", F.size("l").alias("m"), F.posexplode(some).alias("i", "s")).select(
        F.col("s.h").alias("bucket"), F.col("s.df").alias("df"), "cid", "n", (F.col("m") - F.col("i")).cast("long").alias("behind")), "first-shingles")
    sums = [F.sum(F.xxhash64(F.lit(i), "cid").cast("decimal(20,0)")).alias(f"s{i}") for i in range(2)]
    shared = firsts.groupBy("bucket", "df").agg(F.count("*").alias("m"), F.min("cid").alias("low"), F.max("cid").alias("high"), *sums)
    chosen = shared.where("low < high").groupBy("m", "s0", "s1").agg(F.min(F.struct("df", "bucket")).alias("b"))
    return firsts.join(chosen.select("b.bucket"), "bucket").select("bucket", "cid", "n", "behind").distinct()


def _reach(percent: int):
    """Whether sets of n and x_n shingles that first share one with ``behind`` and ``x_behind`` left can be similar enough."""
    return F.lit(100 + percent) * F.least("behind", "x_behind") >= F.lit(percent) * (F.col("n") + F.col("x_n"))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of each cid, its own id if it has none."""
    return rows.join(labels.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "label", F.coalesce("component", "cid")).drop("component")


def _links(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on the full sets."""
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("cid").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("regs").alias(f"regs_{side}")), side)
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    likely = stored(pairs.mapInArrow(_likely(percent), "a long, b long"), "likely-pairs")
    wanted = stored(likely.select(F.col("a").alias("doc_id")).unionAll(likely.select("b")).distinct(), "wanted")
    found = stored(texts.join(wanted, "doc_id", "left_semi"), "wanted-texts")
    for side in "ab":
        likely = likely.join(found.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)
    return stored(likely.mapInArrow(_confirmed(percent), "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets; the
    component_id is the smallest doc_id reachable over links. A text with fewer than five words is one
    shingle; null texts and texts without words have an empty set and are linked with nothing. Rows that
    repeat a doc_id are one document, linked by any of its texts. A null doc_id is never smaller than
    another id: such a row takes the component of its equals, or null, and is kept only then.
    """
    ship(docs.sparkSession)
    some = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    rows = stored(some.mapInArrow(_sketch, "doc_id long, n_shingles long, set_key binary, regs binary"), "sketches")
    classes = stored(rows.where("n_shingles > 0").groupBy("set_key", "n_shingles", "regs").agg(
        F.min("doc_id").alias("cid"), F.count("*").alias("size")), "classes")
    sketches = classes.where("cid is not null").select("cid", "n_shingles", "regs")

    bands = sketches.select("cid", "regs").mapInArrow(_bands, "bucket long, cid long")
    shared = stored(bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("cid").alias("hub")).where("n > 1").drop("n"), "buckets")
    members = stored(bands.join(shared, "bucket"), "members")
    stars = stored(members.where("cid != hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct(), "stars")
    links = _links(stars, sketches, some, percent)

    labels = components(links)
    named = _named(members.select("bucket", "cid").distinct(), labels)
    again = stored(_unsettled(stored(named, "labelled-members")).select("cid").distinct(), "open-members")
    sharing = stored(_sharing(again, some, percent), "sharing-members")

    # over rare shingles, too, first with the smallest member only
    hubs = sharing.groupBy("bucket").agg(F.min_by(F.struct(F.col("cid").alias("hub"), F.col("n").alias("x_n"), F.col("behind").alias("x_behind")),
                                                  F.struct("cid", "n", "behind")).alias("h")).select("bucket", "h.*")
    met = _unsettled(stored(_named(sharing, labels), "sharing-labels")).join(hubs, "bucket").where((F.col("cid") != F.col("hub")) & _reach(percent))
    met = met.select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    known = stored(labels.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(
        _links(stored(met.join(stars, ["a", "b"], "left_anti"), "star-pairs"), sketches, some, percent)), "star-links")
    labels = components(known)

    left = stored(_unsettled(stored(_named(sharing, labels), "sharing-labels")), "open-sharing")
    rest = left.where("label != main").select("bucket", *[F.col(c).alias(f"x_{c}") for c in ("cid", "label", "n", "behind")])
    pairs = rest.join(left.select("bucket", "cid", "label", "n", "behind"), "bucket").where((F.col("label") != F.col("x_label")) & _reach(percent))
    pairs = pairs.select(F.least("x_cid", "cid").alias("a"), F.greatest("x_cid", "cid").alias("b")).distinct()
    more = _links(stored(pairs.join(stars.unionAll(met), ["a", "b"], "left_anti"), "other-pairs"), sketches, some, percent)

    labels = stored(components(known.unionAll(more)), "components")
    final = classes.join(labels, F.col("cid") == F.col("node"), "left").select(
        "set_key", "size", F.coalesce("component", "cid").alias("component_id"))
    out = attach(rows.select("doc_id", "n_shingles", "set_key"), stored(final, "class-components"), "set_key", "size", spread="doc_id")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document stays: those with the smallest doc_id of their component.

    Rows without a doc_id can't be told apart and stay.
    """
    gone = stored(near_duplicates(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "dropped")
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
