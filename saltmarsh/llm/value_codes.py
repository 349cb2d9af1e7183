"""Codes for vector parts, with squared distances looked up by value.

Vectors become integers and are cut into equal parts; every part position has a codebook. The integers of
a dimension in a block of rows are few, so the block keeps a dictionary of them: the squared difference of
every distinct integer to that dimension of all entries is tabulated once, and the distance of a part to
all entries is a sum of table rows gathered by dictionary code. Codebooks are refined by per-task sums,
which Spark adds up exactly; what reaches the driver is one number per entry and component.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import attach, ship, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: integers beyond this make squared distances of very wide vectors pass 64 bits
LARGEST = 1 << 24
BLOCK = 4096


def usable(vector: Column) -> Column:
    """True for a vector that has components, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def nearest(ints: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry per row and part (ties to the lower index), and the summed squared distance per row.

    ``ints`` is (rows, components), ``books`` (parts, entries, components of a part).
    """
    n, (parts, entries, width) = len(ints), books.shape
    codes, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
    for at in range(0, n, BLOCK):
        block = ints[at:at + BLOCK]
        rows = np.arange(len(block))
        for p in range(parts):
            total = np.zeros((len(block), entries), np.int64)
            for j in range(width):
                values, where = np.unique(block[:, p * width + j], return_inverse=True)
                table = (values[:, None] - books[p, :, j][None, :]) ** 2
                total += table[where]
            best = total.argmin(1)
            codes[at:at + BLOCK, p] = best
            error[at:at + BLOCK] += total[rows, best]
    return codes, error


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"vector components beyond {LARGEST // SCALE} are not supported")
    return flat.reshape(len(column), -1)


def _sums(books: np.ndarray):
    """Per task: how many parts went to each entry, and the sum of each of their components."""
    def run(batches):
        parts, entries, width = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ints = _matrix(batch.column("ints"))
            codes, _ = nearest(ints, books)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], ints[:, p * width:(p + 1) * width])
        p, e, j = (x.ravel() for x in np.indices(books.shape))
        used = count[p, e] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(p[used], pa.int32()), pa.array(e[used], pa.int32()), pa.array(j[used], pa.int32()),
             pa.array(count[p, e][used]), pa.array(total[p, e, j][used])], ["part", "entry", "place", "n", "s"])
    return run


def _refined(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    sums = kept.select("ints").mapInArrow(_sums(books), "part int, entry int, place int, n long, s long")
    new = books.copy()
    for r in sums.groupBy("part", "entry", "place").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).toLocalIterator():
        new[r.part, r.entry, r.place] = int(r.s) // r.n
    return new


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """Rows (vec_id, label, code, error) and the codebooks (parts, entries, components), None without vectors.

    Rows whose vector is null, empty, or holds null or non-finite components are dropped. A component x
    is floor(256 * x). A codebook starts as that part of the first ``entries`` vectors by id (nulls last,
    then by vector; all vectors if there are fewer), each of ``rounds`` rounds moves every used entry to
    the floor of the mean of its parts, and unused entries stay. Rows that repeat an id are coded one by
    one. Vectors of different lengths, or of a length that ``parts`` does not divide, raise ValueError.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = vectors[vector_col]
    kept = stored(vectors.where(usable(v)).select(
        vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("ints")), "integer-vectors")
    out = F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    sizes = kept.agg(F.min(F.size("ints")).alias("least"), F.max(F.size("ints")).alias("most")).first()
    if sizes.least is None:
        return kept.select("vec_id", "label", *out), None
    if sizes.least != sizes.most or sizes.most % parts:
        raise ValueError(f"vectors of {sizes.least} to {sizes.most} components can't be cut into {parts} equal parts")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.array([r.ints for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _refined(kept, books)

    def code(batches):
        for batch in batches:
            if batch.num_rows:
                codes, error = nearest(_matrix(batch.column("ints")), books)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array([bytes(c).hex() for c in codes.astype(np.uint8)]), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    return kept.mapInArrow(code, kept.select("vec_id", "label", *out).schema), books


def coded_vectors(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256; see ``compress``.

    ``label_error`` adds ``error`` up over equal labels, with null labels as one group.
    """
    coded, books = compress(vectors)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest() if books is not None else None
    coded = stored(coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))), "codes")
    totals = stored(coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    return attach(coded, totals, "key", "n", spread="vec_id").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))
