"""Exact nearest-neighbour joins.

Equal vectors are handled once: the search runs over distinct vectors, each carrying its ``k``
smallest ids, so a vector copied a billion times costs as much as a single one.

* If the distinct data vectors are few (size checked), they are broadcast and every task
  streams its queries past them.
* Beyond that size both sides are laid out around pivots and packed into pieces, each with the ball
  that holds it. Groups of pieces meet in a grid, so a vector moves once per group of the other
  side and a task holds two groups of bounded size. Inside a meeting the pieces closest to the queries
  come first; the triangle inequality rules out pieces and queries that cannot come closer than the
  k-th neighbour so far, a rough score rules out most of the rest, and what is left is measured
  exactly. Per query and meeting only ``k`` candidates leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, ship_package
from .ordering import PART, POS, lay_out

BROADCAST_BYTES = 8 << 20
#: rows of a piece of the data and of the queries, and bytes of the vectors of one side of a meeting
CHUNK_ROWS = 1024
QUERY_ROWS = 1024
GROUP_BYTES = 16 << 20
#: candidates measured at once, and rows of a rough score
EXACT_PAIRS, ROUGH_ROWS = 1 << 16, 256
SLACK = 1e-9
#: rows of a piece from which sums of whole numbers are worth their calls, and the largest such sum
WHOLE_ROWS, LARGEST = 256, 32767


def as_vector(column: Column) -> Column:
    """The float array widened to doubles, with -0.0 as 0.0 so that equal vectors group together."""
    return F.transform(column, lambda v: v.cast("double") + F.lit(0.0))


def unit_vector(column: Column) -> Column:
    """Scaled to length 1; Euclidean order on unit vectors is cosine order."""
    def scaled(squares):  # the finish step sees the norm once per row, not once per element
        norm = F.when(squares == 0, F.lit(1.0)).otherwise(F.sqrt(squares))
        return F.transform(column, lambda v: v / norm)
    return F.aggregate(F.transform(column, lambda v: F.struct(v.alias("v"))), F.lit(0.0),
                       lambda a, s: a + s["v"] * s["v"], scaled)


def _distances(data: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    diff = data - q
    return np.abs(diff).sum(axis=1) if metric == "manhattan" else np.sqrt((diff * diff).sum(axis=1))


def _edges(rough: np.ndarray, known: np.ndarray, k: int, slack: np.ndarray) -> np.ndarray:
    """Per row the rough score up to which a column may be among the k nearest: from the k-th so far where there is one."""
    new = np.flatnonzero(known == np.inf)
    if len(new) and rough.shape[1] > k:
        known = known.copy()
        known[new] = np.partition(rough[new], k - 1, axis=1)[:, k - 1] + slack[new]
    return known + slack


def _at(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the true values; one flat search is several times as fast as one by axes."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def _candidates(q: np.ndarray, data: np.ndarray, center: np.ndarray, kth: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, row) that a rough score in single precision cannot rule out; what it cannot compare stays.

    Both sides are moved to the ``center`` of the data, where their differences are large against their sizes.
    """
    rows, columns, dim = [], [], data.shape[1]
    norm = (lambda m: (m * m).sum(axis=1)) if metric == "euclidean" else (lambda m: np.abs(m).sum(axis=1))
    moved = data - center
    size, lost = norm(moved), norm(data).max() * 1e-15 * (dim + 8)  # digits lost by moving
    if metric == "euclidean":  # the squared distance less the query's own square
        table = np.column_stack([-2.0 * moved, size]).astype(np.float32).T
    else:  # half the distance, less half the query's sum: the sum of max(x, y) less half the row's sum
        table, shift = np.ascontiguousarray(moved.T, dtype=np.float32), (moved.sum(axis=1) / 2).astype(np.float32)
        score, step = (np.empty((min(ROUGH_ROWS, len(q)), len(data)), np.float32) for _ in range(2))
    for at in range(0, len(q), ROUGH_ROWS):
        some, far = q[at:at + ROUGH_ROWS] - center, kth[at:at + ROUGH_ROWS]
        own = norm(some)
        if metric == "euclidean":
            rough = np.column_stack([some, np.ones(len(some))]).astype(np.float32) @ table
            known = far * far * (1 + SLACK) - own
        else:
            narrow, rough, more = some.astype(np.float32), score[:len(some)], step[:len(some)]
            rough[:] = -shift
            for d in range(dim):
                rough += np.maximum(narrow[:, d, None], table[d], out=more)
            known = (far * (1 + SLACK) + some.sum(axis=1)) / 2
        slack = 2.0**-22 * (dim + 8) * (own + size.max()) + lost + norm(q[at:at + ROUGH_ROWS]) * 1e-15 * (dim + 8)
        i, j = _at(~(rough > _edges(rough, known, k, slack).astype(np.float32)[:, None]))
        rows.append(i + at)
        columns.append(j)
    return np.concatenate(rows), np.concatenate(columns)


def _measured(q: np.ndarray, data: np.ndarray, i: np.ndarray, j: np.ndarray, metric: str) -> np.ndarray:
    """Exact distances of the pairs."""
    out = np.empty(len(i))
    for at in range(0, len(i), EXACT_PAIRS):
        out[at:at + EXACT_PAIRS] = _distances(q[i[at:at + EXACT_PAIRS]], data[j[at:at + EXACT_PAIRS]], metric)
    return out


def _ball(data: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    center = data.mean(axis=0)
    return center, float(_distances(data, center, metric).max())


class _Best:
    """The k nearest so far of ``n`` rows, ties by id."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.kth = n, k, np.full(n, np.inf)
        self.found, self.waiting = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), []

    def add(self, row: np.ndarray, vid: np.ndarray, dist: np.ndarray) -> None:
        self.waiting.append((row, vid, dist))
        if 2 * sum(len(w[0]) for w in self.waiting) >= self.n * self.k:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.waiting:
            row, vid, dist = (np.concatenate(c) for c in zip(self.found, *self.waiting))
            order = np.lexsort((vid, dist, row))
            row, vid, dist = row[order], vid[order], dist[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            last = rank == self.k - 1
            self.kth[row[last]] = dist[last]
            self.found, self.waiting = tuple(c[rank < self.k] for c in (row, vid, dist)), []
        return self.found


def _lowest(q: np.ndarray, ball: tuple, metric: str) -> np.ndarray:
    """Per row of ``q`` what no row of the ball can come below."""
    center, radius = ball
    return _distances(q, center, metric) * (1 - SLACK) - radius * (1 + SLACK)


def _look(best: _Best, rows: np.ndarray, q: np.ndarray, piece: tuple, metric: str) -> None:
    """Add the candidates of the given rows of ``q`` in the piece."""
    ids, data, (center, _) = piece
    i, j = _candidates(q[rows], data, center, best.kth[rows], best.k, metric)
    best.add(rows[i], ids[j], _measured(q, data, rows[i], j, metric))


def _nearest(q: np.ndarray, pieces: Sequence[tuple], k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, id, exact distance) of the k nearest rows of all pieces ``(ids, vectors, ball)``, ties by id."""
    low = np.stack([_lowest(q, ball, metric) for _, _, ball in pieces])
    best = _Best(len(q), k)
    for p in np.argsort(low.min(axis=1)):
        open_rows = np.flatnonzero(~(low[p] > best.kth))
        if len(open_rows):
            with np.errstate(over="ignore", invalid="ignore"):
                _look(best, open_rows, q, pieces[p], metric)
    return best.settle()


def _steps(parts: Sequence[np.ndarray]) -> tuple[np.ndarray, float] | None:
    """Origin and width of the steps in which vectors are whole numbers whose sums stay below ``LARGEST``; none if they
    would be coarse or there are vectors that can't be counted. Outliers are cut off, which ``_coded`` tells."""
    dim = parts[0].shape[1]
    if not dim or dim > LARGEST // 256 or not all(np.isfinite(p).all() for p in parts):
        return None
    low, high = np.min([p.min(axis=0) for p in parts], axis=0), np.max([p.max(axis=0) for p in parts], axis=0)
    center = np.mean([p.mean(axis=0) for p in parts], axis=0)
    spread = np.max([np.abs(p - center).mean(axis=0) for p in parts])
    width = float(min((high - low).max(), 16 * spread))
    step = width / (LARGEST // dim)
    if not np.isfinite(width) or not step > 1e-300:
        return None
    return np.where(high - low <= width, low, center - width / 2), step


def _coded(data: np.ndarray, origin: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors in whole steps, a row per dimension; half their sums, and half the steps lost by rounding and cutting off."""
    whole = np.clip(np.rint((data - origin) / step), 0, LARGEST // data.shape[1])
    digits = (np.abs(data).sum(axis=1) + np.abs(origin).sum()) * 1e-15 * (data.shape[1] + 8)
    lost = np.abs(data - (origin + step * whole)).sum(axis=1) + digits
    return np.ascontiguousarray(whole.T, dtype=np.uint16), whole.sum(axis=1) / 2, lost / step / 2


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over the dimensions of the larger of ``a[:, i]`` and ``b[:, (i + s) % n]``, by s and i: all rows of the
    one beside as many of the other, turned by one each time, so that no step has less than a row of numbers."""
    n, rows = b.shape[1], a.shape[1]
    turned = np.concatenate([b, b[:, :rows]], axis=1)
    out, larger = np.empty((n, rows), np.uint16), np.empty(a.shape, np.uint16)
    for s in range(n):
        np.maximum(a, turned[:, s:s + rows], out=larger)
        np.add.reduce(larger, axis=0, dtype=np.uint16, out=out[s])
    return out


def _close(a: tuple, b: tuple, far_a: np.ndarray, far_b: np.ndarray | None, step: float, k: int) -> tuple:
    """Positions (row of ``a``, row of ``b``) that may be among the k nearest of the first, and of the second unless it
    has no distances; ``a`` and ``b`` as ``_coded``, ``a`` with no more rows. ``far`` are the k-th distances so far.

    Half the distance in steps is the sum of the larger numbers less half of all numbers.
    """
    (table, half_a, lost_a), (other, half_b, lost_b) = a, b
    sums, n, rows = _sums(table, other), len(half_b), len(half_a)
    turned = lambda x: np.lib.stride_tricks.sliding_window_view(np.concatenate([x, x[:rows]]), rows)[:n]
    short = lambda x: np.clip(np.floor(x) + 1, 0, LARGEST).astype(np.uint16)
    new = np.flatnonzero(far_a == np.inf)
    if len(new) and n >= k:
        score = sums[:, new] - turned((half_b - lost_b).astype(np.float32))[:, new]
        far_a = far_a.copy()
        far_a[new] = 2 * step * (np.partition(score, k - 1, axis=0)[k - 1] - (half_a - lost_a)[new] + 1)
    edge = short(half_a + lost_a + far_a * (1 + SLACK) / (2 * step)) + turned(short(half_b + lost_b))
    s, i = _at(sums <= edge)
    found = i, (i + s) % n
    if far_b is None:
        return found, None
    new = np.flatnonzero(far_b == np.inf)
    if len(new) and rows >= k:
        every = np.arange(rows)
        score = sums[(new[:, None] - every) % n, every] - (half_a - lost_a).astype(np.float32)
        far_b = far_b.copy()
        far_b[new] = 2 * step * (np.partition(score, k - 1, axis=1)[:, k - 1] - (half_b - lost_b)[new] + 1)
    edge = turned(short(half_b + lost_b + far_b * (1 + SLACK) / (2 * step))) + short(half_a + lost_a)
    s, i = _at(sums <= edge)
    return found, (i, (i + s) % n)


def _nearest_of_each(left: list[tuple], right: list[tuple], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id of the row, id, exact Manhattan distance) of the k nearest of every row of ``left`` in ``right`` and of every
    row of ``right`` in ``left``, or of every row of ``left`` in ``left`` if there is no ``right``.

    A pair of rows is looked at once for both.
    """
    metric, pieces, m = "manhattan", [*left, *right], len(left)
    best = [_Best(len(ids), k) for ids, _, _ in pieces]
    scale = _steps([data for _, data, _ in pieces])
    coded = [_coded(data, *scale) for _, data, _ in pieces] if scale else None
    meet = [(x, y) for x in range(m) for y in (range(m, len(pieces)) if right else range(x, m))]
    low = {(x, y): _lowest(pieces[x][1], pieces[y][2], metric) for a, b in meet for x, y in ((a, b), (b, a))}
    least = {(x, y): min(low[x, y].min(), low[y, x].min()) for x, y in meet}
    with np.errstate(over="ignore", invalid="ignore"):
        for x, y in sorted(meet, key=least.__getitem__):
            if len(pieces[x][0]) > len(pieces[y][0]):
                x, y = y, x
            (ids_x, vec_x, _), (ids_y, vec_y, _) = pieces[x], pieces[y]
            open_x, open_y = (np.flatnonzero(~(low[p] > best[p[0]].kth)) for p in ((x, y), (y, x)))
            if x == y:
                open_y = open_y[:0]
            if coded and len(ids_x) >= WHOLE_ROWS and 2 * (len(open_x) * len(ids_y) + len(open_y) * len(ids_x)) >= len(ids_x) * len(ids_y):
                one, two = _close(coded[x], coded[y], best[x].kth, None if x == y else best[y].kth, scale[1], k)
                best[x].add(one[0], ids_y[one[1]], _measured(vec_x, vec_y, *one, metric))
                if two:
                    best[y].add(two[1], ids_x[two[0]], _measured(vec_y, vec_x, *two[::-1], metric))
                continue
            if len(open_x):
                _look(best[x], open_x, vec_x, pieces[y], metric)
            if len(open_y):
                _look(best[y], open_y, vec_y, pieces[x], metric)
    for (ids, _, _), b in zip(pieces, best):
        row, vid, dist = b.settle()
        yield ids[row], vid, dist


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def _distinct_vectors(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``(vid, vec, ids)``: distinct vectors with their k smallest ids in order."""
    w = Window.partitionBy("vec").orderBy("id")
    kept = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).withColumn(
        "_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return kept.groupBy("vec").agg(F.min("id").alias("vid"), F.sort_array(F.collect_list("id")).alias("ids"))


def _broadcast_search(queries: DataFrame, data: DataFrame, k: int, metric: str) -> DataFrame:
    table = data.select("vid", "vec").orderBy("vid").toArrow()
    ids = table.column("vid").to_numpy()
    flat = table.column("vec").combine_chunks()
    matrix = np.asarray(flat.flatten()).reshape(len(ids), -1)
    shared = queries.sparkSession.sparkContext.broadcast((ids, matrix))
    query_rows, chunk_rows = QUERY_ROWS, CHUNK_ROWS

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, rows = shared.value
        cuts = [slice(at, at + chunk_rows) for at in range(0, len(known), chunk_rows)]
        pieces = [(known[c], rows[c], _ball(rows[c], metric)) for c in cuts]
        for pdf in batches:
            for at in range(0, len(pdf) if pieces else 0, query_rows):
                some = pdf.iloc[at:at + query_rows]
                i, vid, dist = _nearest(_matrix(some["vec"]), pieces, k, metric)
                yield pd.DataFrame({"qid": some["qid"].to_numpy()[i], "vid": vid, "distance": dist})

    return queries.mapInPandas(search, "qid long, vid long, distance double")


def _assign(df: DataFrame, key: str, pivots: np.ndarray, metric: str) -> DataFrame:
    """Cell (nearest pivot) and distance to it, both of them only to bring close rows together."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                rows = _matrix(pdf["vec"])
                d = np.stack([_distances(rows, p, metric) for p in shared.value], axis=1)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype(np.int32), r=d[np.arange(len(d)), cell])

    return df.select(key, "vec").mapInPandas(run, f"{key} long, vec array<double>, cell int, r double")


def _grid(n: int, dim: int, rows: int, slots: int) -> int:
    """Number of groups of a side: of at most ``GROUP_BYTES`` each, and enough of them to keep the task slots busy."""
    return max(1, -(-n * dim * 8 // GROUP_BYTES), min(-(-n // rows), int((8 * slots) ** 0.5)))


def _pieces(df: DataFrame, key: str, pivots: np.ndarray, metric: str, rows: int, groups: int) -> DataFrame:
    """``(grp, ids, vecs)``: the rows around each pivot by their distance to it, ``rows`` at a time, as bytes."""
    laid = lay_out(_assign(df, key, pivots, metric), ["cell", "r", key]).select(
        PART, F.floor(F.col(POS) / rows).alias("blk"), F.col(key).alias("id"), "vec")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({PART: pdf[PART].iloc[:1], "blk": pdf["blk"].iloc[:1], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "vecs": [_matrix(pdf["vec"]).tobytes()]})

    packed = laid.groupBy(PART, "blk").applyInPandas(pack, f"{PART} long, blk long, ids binary, vecs binary")
    return packed.select(F.pmod(F.col(PART) + F.col("blk"), F.lit(groups)).cast("int").alias("grp"), "ids", "vecs")


def _meetings(asked: DataFrame, n_asked: int, known: DataFrame, n_known: int) -> DataFrame:
    """Every group of ``asked`` beside every group of ``known``, the packed rows of both told apart by ``side``."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = asked.withColumnRenamed("grp", "a").withColumn("b", every(n_known)).withColumn("side", F.lit(0))
    b = known.withColumnRenamed("grp", "b").withColumn("a", every(n_asked)).withColumn("side", F.lit(1))
    return a.unionByName(b).repartition(n_asked * n_known, "a", "b")


def _unpacked(pdf: pd.DataFrame, side: int, *more: str) -> list[tuple]:
    """(ids, vectors, further columns) of the packed rows of one side."""
    out = []
    for ids, vecs, *rest in pdf.loc[pdf["side"] == side, ["ids", "vecs", *more]].itertuples(index=False):
        ids = np.frombuffer(ids, np.int64)
        out.append((ids, np.frombuffer(vecs).reshape(len(ids), -1), *(np.frombuffer(x, np.int64) for x in rest)))
    return out


def _pivots(data: DataFrame, n_data: int) -> np.ndarray:
    n_pivots = int(min(1024, max(8, n_data**0.5 / 4)))
    rows = data.select("vec").orderBy(F.xxhash64("vid"), "vid").limit(n_pivots).toArrow()
    return np.asarray(rows.column("vec").combine_chunks().flatten()).reshape(rows.num_rows, -1)


def _grid_search(queries: DataFrame, n_queries: int, data: DataFrame, n_data: int, dim: int, k: int, metric: str) -> DataFrame:
    pivots = _pivots(data, n_data)
    slots = data.sparkSession.sparkContext.defaultParallelism
    n_a, n_b = _grid(n_queries, dim, QUERY_ROWS, slots), _grid(n_data, dim, CHUNK_ROWS, slots)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = [(ids, rows, _ball(rows, metric)) for ids, rows in _unpacked(pdf, 1)]
        out = [pd.DataFrame({"qid": np.empty(0, np.int64), "vid": np.empty(0, np.int64), "distance": np.empty(0)})]
        for qids, q in _unpacked(pdf, 0) if pieces else []:
            i, vid, dist = _nearest(q, pieces, k, metric)
            out.append(pd.DataFrame({"qid": qids[i], "vid": vid, "distance": dist}))
        return pd.concat(out)

    met = _meetings(_pieces(queries, "qid", pivots, metric, QUERY_ROWS, n_a), n_a,
                    _pieces(data, "vid", pivots, metric, CHUNK_ROWS, n_b), n_b)
    return met.groupBy("a", "b").applyInPandas(search, "qid long, vid long, distance double")


def _self_search(data: DataFrame, n_data: int, dim: int, k: int) -> DataFrame:
    """As ``_grid_search`` of the data in itself by Manhattan distance; two groups meet once, for the rows of both."""
    metric, slots = "manhattan", data.sparkSession.sparkContext.defaultParallelism
    n = _grid(n_data, dim, CHUNK_ROWS, 2 * slots)
    packed = durable(_pieces(data, "vid", _pivots(data, n_data), metric, CHUNK_ROWS, n))
    a = packed.withColumnRenamed("grp", "a").withColumn("b", F.explode(F.sequence("a", F.lit(n - 1)))).withColumn("side", F.lit(0))
    b = packed.withColumnRenamed("grp", "b").where("b > 0").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("b") - 1))).withColumn("side", F.lit(1))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = ([(ids, rows, _ball(rows, metric)) for ids, rows in _unpacked(pdf, side)] for side in (0, 1))
        out = [pd.DataFrame({"qid": np.empty(0, np.int64), "vid": np.empty(0, np.int64), "distance": np.empty(0)})]
        if left and (right or pdf["a"].iloc[0] == pdf["b"].iloc[0]):
            out += [pd.DataFrame({"qid": qid, "vid": vid, "distance": dist}) for qid, vid, dist in _nearest_of_each(left, right, k)]
        return pd.concat(out)

    met = a.unionByName(b).repartition(n * (n + 1) // 2, "a", "b")
    return met.groupBy("a", "b").applyInPandas(search, "qid long, vid long, distance double")


def knn_join(
    queries: DataFrame, data: DataFrame, k: int, *, query_key: str, data_key: str, vector: str,
    metric: str = "euclidean", broadcast_bytes: int | None = None,
) -> DataFrame:
    """The exact k nearest data rows of every query row: ``(query_key, neighbor, distance, rank)``.

    Ranks are 1-based; equal distances are ordered by neighbour id. ``metric`` is ``euclidean``
    or ``manhattan``; for ``cosine`` pass it as such and read ``distance`` as ``1 - cosine``.
    """
    ship_package(data.sparkSession)
    cosine = metric == "cosine"
    metric = "euclidean" if cosine else metric
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    shape = (lambda c: unit_vector(as_vector(c))) if cosine else as_vector
    qs = queries.where(F.col(vector).isNotNull()).select(F.col(query_key).cast("long").alias("id"), shape(F.col(vector)).alias("vec"))
    ds = data.where(F.col(vector).isNotNull()).select(F.col(data_key).cast("long").alias("id"), shape(F.col(vector)).alias("vec"))
    distinct_q = durable(qs.groupBy("vec").agg(F.min("id").alias("qid")))
    distinct_d = durable(_distinct_vectors(ds, "id", "vec", k))
    size = distinct_d.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim"), F.count("vid").alias("named")).first()
    if size["n"] * (size["dim"] or 1) * 8 <= limit:
        found = _broadcast_search(distinct_q, distinct_d, k, metric)
    elif metric == "manhattan" and queries is data and query_key == data_key and size["named"] == size["n"]:
        found = _self_search(distinct_d, size["n"], size["dim"], k)  # qid is vid
    else:
        found = _grid_search(distinct_q, distinct_q.count(), distinct_d, size["n"], size["dim"], k, metric)
    # ``vid`` is the smallest id of its vector, so the k nearest ids are among those of the k first vectors
    first = Window.partitionBy("qid").orderBy("distance", "vid")
    found = found.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k).drop("_r")
    # equal vectors back to their ids, then the best k per query vector
    listed = found.join(distinct_d.select("vid", "ids"), "vid").select(
        "qid", "distance", F.explode("ids").alias("neighbor"))
    w = Window.partitionBy("qid").orderBy("distance", "neighbor")
    best = listed.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    lists = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor", "distance"))).alias("l"))
    # one short list per distinct query vector, handed to all rows that share the vector
    owners = qs.join(distinct_q, "vec").select(F.col("id").alias(query_key), "qid")
    out = owners.join(lists, "qid").select(query_key, F.explode("l").alias("x")).select(
        query_key, F.col("x.neighbor").alias("neighbor"), F.col("x.distance").alias("distance"), F.col("x.rank").alias("rank"))
    if cosine:
        out = out.withColumn("distance", F.col("distance") * F.col("distance") / 2)
    return out


def label_transfer(neighbors: DataFrame, data: DataFrame, query_key: str, data_key: str, label: str) -> DataFrame:
    """Label of the nearest row."""
    first = neighbors.where(F.col("rank") == 1)
    return first.join(data.select(F.col(data_key).alias("neighbor"), label), "neighbor").select(
        query_key, "neighbor", "distance", label)


def neighbor_mean(neighbors: DataFrame, data: DataFrame, query_key: str, data_key: str, value: str,
                  skip_first: bool = False) -> DataFrame:
    """Mean of a value over the neighbours, optionally without the first one (the row itself)."""
    used = neighbors.where(F.col("rank") > 1) if skip_first else neighbors
    return used.join(data.select(F.col(data_key).alias("neighbor"), F.col(value).alias("_v")), "neighbor").groupBy(
        query_key).agg(F.avg("_v").alias("prediction"))


def pair_similarity(df: DataFrame, key: str, a, b, features: Sequence[str]) -> DataFrame:
    """Per feature ``1 - |a - b|`` of two rows after min-max scaling, for features where ``a + b > 0``."""
    from .scale import minmax_scale
    two = minmax_scale(df, features).where(F.col(key).isin(a, b)).unpivot([key], list(features), "feature", "v")
    wide = two.groupBy("feature").agg(F.max(F.when(F.col(key) == a, F.col("v"))).alias("va"),
                                      F.max(F.when(F.col(key) == b, F.col("v"))).alias("vb"))
    return wide.where(F.col("va") + F.col("vb") > 0).select(
        "feature", (1 - F.abs(F.col("va") - F.col("vb"))).alias("similarity")).orderBy(F.desc("similarity"), "feature")


def recommendations_json(neighbors: DataFrame, names: DataFrame, query_key: str, item, name_key: str, name: str) -> DataFrame:
    """Recommendations of one item, the item itself left out, as one JSON text."""
    mine = neighbors.where((F.col(query_key) == item) & (F.col("neighbor") != F.col(query_key)))
    named = mine.join(names.select(F.col(name_key).alias("neighbor"), F.col(name).alias("name")), "neighbor", "left")
    rows = F.sort_array(F.collect_list(F.struct("rank", F.col("neighbor").alias("id"), "name")))
    return named.groupBy(query_key).agg(F.to_json(F.transform(rows, lambda r: F.struct(r["id"].alias("id"), r["name"].alias("name")))).alias("recommendations"))


def codebook_histogram(df: DataFrame, centroids: DataFrame, *, key: str, item: str, vector: str, word: str) -> DataFrame:
    """Nearest centroid of every descriptor, counted per item in long form."""
    near = knn_join(df, centroids, 1, query_key=key, data_key=word, vector=vector)
    return near.join(df.select(key, item), key).groupBy(item, F.col("neighbor").alias(word)).agg(F.count("*").alias("n"))


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs; short ones, where the product loses digits, are measured one by one."""
    origin = b.mean(axis=0)
    x, y = a - origin, b - origin
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    squares = np.column_stack([x, xx, np.ones(len(x))]) @ np.column_stack([-2.0 * y, np.ones(len(y)), yy]).T
    i, j = _at(~(squares > (1e-4 * (xx + yy.max()))[:, None]))
    squares[i, j] = 0.0
    out = np.sqrt(squares, out=squares)
    out[i, j] = _measured(a, b, i, j, "euclidean")
    return out


def silhouette_euclidean(df: DataFrame, key: str, vector: str, label: str, block_rows: int | None = None) -> DataFrame:
    """Mean silhouette under plain Euclidean distance; -1 with fewer than two labels, 0 for a row alone in its cluster.

    The measure needs the distance of every pair of rows. Rows are packed into blocks, every block meets
    every block once in a grid, and a meeting gives one sum per row and cluster; sums are added up by
    Spark. Work grows with the square of the rows, as the measure does; memory does not: a task holds two
    blocks, of ``GROUP_BYTES`` each at most unless ``block_rows`` is given. ``silhouette`` is the linear
    alternative. Rows with a null label are left out.
    """
    ship_package(df.sparkSession)
    rows = durable(df.where(F.col(label).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("c"), as_vector(F.col(vector)).alias("vec")))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    blocks = max(1, -(-size["n"] // block_rows)) if block_rows else _grid(
        size["n"], size["dim"] or 1, CHUNK_ROWS, df.sparkSession.sparkContext.defaultParallelism)
    piece_rows = CHUNK_ROWS

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        parts = [pdf.iloc[at:at + piece_rows] for at in range(0, len(pdf), piece_rows)]
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "ids": [p["id"].to_numpy(np.int64).tobytes() for p in parts],
                             "c": [p["c"].to_numpy(np.int64).tobytes() for p in parts], "vecs": [_matrix(p["vec"]).tobytes() for p in parts]})

    # ids only tell rows apart: those without one stay together as they would in a group
    packed = durable(rows.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "id", F.coalesce("id", F.lit(-1 << 63))).groupBy("grp").applyInPandas(pack, "grp int, ids binary, c binary, vecs binary"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        known = _unpacked(pdf, 1, "c")
        names = np.unique(np.concatenate([c for _, _, c in known])) if known else np.empty(0, np.int64)
        out = [pd.DataFrame({"id": np.empty(0, np.int64), "own": np.empty(0, np.int64), "c": np.empty(0, np.int64), "s": np.empty(0)})]
        for ids, a, own in _unpacked(pdf, 0, "c"):
            total = np.zeros((len(ids), len(names)))
            for _, b, c in known:  # ascending labels
                start = np.flatnonzero(np.diff(c, prepend=c[0] - 1))
                place = np.searchsorted(names, c[start])
                for at in range(0, len(a), ROUGH_ROWS):
                    total[at:at + ROUGH_ROWS, place] += np.add.reduceat(_lengths(a[at:at + ROUGH_ROWS], b), start, axis=1)
            out.append(pd.DataFrame({"id": np.repeat(ids, len(names)), "own": np.repeat(own, len(names)),
                                     "c": np.tile(names, len(ids)), "s": total.ravel()}))
        return pd.concat(out)

    met = _meetings(packed, blocks, packed, blocks).groupBy("a", "b")
    per = met.applyInPandas(sums, "id long, own long, c long, s double").groupBy("id", "own", "c").agg(F.sum("s").alias("s"))
    sizes = rows.groupBy("c").agg(F.count("*").alias("n"))
    mean = F.col("s") / F.when(F.col("c") == F.col("own"), F.nullif(F.col("n") - 1, F.lit(0))).otherwise(F.col("n"))
    ends = per.join(sizes, "c").groupBy("id").agg(F.min(F.when(F.col("c") == F.col("own"), mean)).alias("a"), F.min(F.when(F.col("c") != F.col("own"), mean)).alias("b"))
    one = F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)))
    return ends.agg(F.when(F.max("b").isNull(), F.lit(-1.0)).otherwise(F.avg(one)).alias("silhouette"))


def silhouette(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, linear in the rows; -1 with fewer than two labels.

    The mean squared distance of a row to a cluster follows from the cluster's mean vector and
    mean squared norm, so no pair of rows is ever formed.
    """
    rows = df.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("c"), as_vector(F.col(vector)).alias("v"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, z: s + z)
    rows = rows.withColumn("vv", dot(F.col("v"), F.col("v")))
    parts = rows.select("c", "vv", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.avg("x").alias("m"))
    means = parts.groupBy("c").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))
    sizes = rows.groupBy("c").agg(F.count("*").alias("n"), F.avg("vv").alias("norm"))
    clusters = means.join(sizes, "c").agg(F.collect_list(F.struct("c", "n", "norm", "mean")).alias("l")).scalar()
    scored = rows.withColumn("clusters", clusters).withColumn("d", F.transform("clusters", lambda s: F.struct(
        s["c"].alias("c"), s["n"].alias("n"),
        (F.greatest(F.col("vv") - 2 * dot(F.col("v"), s["mean"]) + s["norm"], F.lit(0.0))).alias("d"))))
    own = F.get(F.filter("d", lambda s: s["c"] == F.col("c")), F.lit(0))
    other = F.array_min(F.transform(F.filter("d", lambda s: s["c"] != F.col("c")), lambda s: s["d"]))
    scored = scored.select(own.alias("own"), other.alias("b"))
    a = F.col("own.d") * F.col("own.n") / F.nullif(F.col("own.n") - 1, F.lit(0))
    s = F.when(F.col("own.n") <= 1, F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - a) / F.nullif(F.greatest(a, F.col("b")), F.lit(0.0)), F.lit(0.0)))
    return scored.agg(F.when(F.max("b").isNull(), F.lit(-1.0)).otherwise(F.avg(s)).alias("silhouette"))
