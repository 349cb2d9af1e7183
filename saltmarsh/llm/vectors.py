"""Embedding near-duplicates by dual traversal of cover trees.

Unit vectors with cosine c are at distance sqrt(2 - 2c), so the threshold is a radius. Equal vectors are
one item. Items are dealt to the cells of a bounded sample of centres; the centres are halved again and again
along their widest axis, and neighbours in that order make up chunks of a bounded size. Each chunk gets a cover
tree, built once: nested levels of balls with halving radii, every ball with its true covering radius. Two
trees are walked together, level by level: a pair of balls further apart than the threshold and both
covering radii is dropped, a pair that lies within it whole is linked whole, and only what remains
descends; at the points the cosine itself decides, in double precision. Where so many pairs of balls remain
that looking at them one by one costs more than the product of the two blocks, the product decides the rest
at once. Chunks are put in groups; pairs of groups whose covering balls rule each other out are dropped
before anything is sent, the others meet in a grid, so a chunk is sent once per group it may meet and not
once per chunk. Independent vectors in many dimensions are all about equally far apart: there no ball but
the smallest is ever dropped, and the work is that of all pairs, in blocks.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attach, components, ship, stored

COSINE = 0.9
#: vectors that become the centres of cells, at most (a bounded sample; every vector is dealt to a cell)
CENTRES = 1024
CHUNK = 2048
#: a pair looked at by itself costs about as much as so many in a product of blocks
ALONE = 8
GROUP = 4
RADII = [1.0, 0.5, 0.25]
_EDGE = 1e-9


def _rows(column) -> np.ndarray:
    """Vectors of an Arrow list column, one per row, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


@dataclass
class Level:
    centre: np.ndarray  # row of each ball's centre
    radius: np.ndarray  # true covering radius
    first: np.ndarray  # balls (or points) of the next level are contiguous: start of each ball's
    count: np.ndarray


class CoverTree:
    """Nested balls over unit vectors; ``order`` puts the points of every ball next to each other."""

    def __init__(self, x: np.ndarray, radii: list[float] = RADII):
        n = len(x)
        spans = [np.arange(n)]  # lists of points; each level splits them
        levels: list[list[tuple[int, float, int]]] = []
        for r in radii:
            level, split = [], []
            for k, points in enumerate(spans):
                left = points
                while len(left):
                    d = distances(x[left[:1]], x[left])[0]
                    inside = d <= r
                    inside[0] = True
                    level.append((left[0], float(d[inside].max()), k))
                    split.append(left[inside])
                    left = left[~inside]
            levels.append(level)
            spans = split
        self.order = np.concatenate(spans) if n else np.empty(0, int)
        self.x = x[self.order]
        place = np.empty(n, int)
        place[self.order] = np.arange(n)
        self.levels = []
        for i, level in enumerate(levels):
            sizes = np.array([len(s) for s in spans]) if i + 1 == len(levels) else np.bincount([b for _, _, b in levels[i + 1]], minlength=len(level))
            self.levels.append(Level(place[np.array([c for c, _, _ in level], int)], np.array([r for _, r, _ in level]),
                                     np.cumsum(sizes) - sizes, sizes))
        # points below each ball, as ranges of ``order``
        self.points = [(lv.first, lv.first + lv.count) for lv in self.levels]
        for i in range(len(self.levels) - 2, -1, -1):
            lv, (a, b) = self.levels[i], self.points[i + 1]
            self.points[i] = (a[lv.first], b[lv.first + lv.count - 1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def dual(a: CoverTree, b: CoverTree, cosine: float = COSINE):
    """Yield (points of a, points of b, whole): pairs of point index arrays, aligned if not ``whole``, where
    ``whole`` means that all of the first are linked with all of the second. For a tree with itself every
    unordered pair comes once, and (points, points, True) stands for all pairs inside."""
    limit, same = math.sqrt(2 - 2 * cosine), a is b
    if not len(a.x) or not len(b.x):
        return
    top_a, top_b = a.levels[0], b.levels[0]
    found = []
    for s in range(0, len(top_a.centre), 1024):
        rows = np.arange(s, min(s + 1024, len(top_a.centre)))
        d = distances(a.x[top_a.centre[rows]], b.x[top_b.centre])
        near = d <= limit + top_a.radius[rows][:, None] + top_b.radius[None] + _EDGE
        if same:
            near &= rows[:, None] <= np.arange(len(top_b.centre))[None]
        i, j = np.nonzero(near)
        found.append((rows[i], j))
    pairs = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    done = None  # pairs of points linked as whole balls

    def product():
        for t in range(0, len(a.x), 1024):
            hit = a.x[t:t + 1024] @ b.x.T >= cosine
            if done is not None:
                hit &= ~done[t:t + 1024]
            p, q = np.nonzero(hit)
            p += t
            if same:
                p, q = p[p < q], q[p < q]
            if len(p):
                yield p, q, False

    size = max(1, (1 << 22) // max(1, a.x.shape[1]))
    for depth in range(len(a.levels)):
        la, lb = a.levels[depth], b.levels[depth]
        (fa, ta), (fb, tb) = a.points[depth], b.points[depth]
        keep = [np.empty((2, 0), int)]
        for s in range(0, len(pairs[0]), size):
            i, j = pairs[0][s:s + size], pairs[1][s:s + size]
            d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", a.x[la.centre[i]], b.x[lb.centre[j]])))
            reach = la.radius[i] + lb.radius[j]
            near = d <= limit + reach + _EDGE
            whole = d + reach <= limit - _EDGE
            if same:
                whole = np.where(i == j, 2 * la.radius[i] <= limit - _EDGE, whole)
                alone = (i == j) & (ta[i] - fa[i] == 1)
                near, whole = near & ~alone, whole & ~alone
            for u, v in zip(i[whole], j[whole]):
                if done is None:
                    done = np.zeros((len(a.x), len(b.x)), bool)
                done[fa[u]:ta[u], fb[v]:tb[v]] = True
                yield np.arange(fa[u], ta[u]), np.arange(fb[v], tb[v]), True
            keep.append(np.stack([i[near & ~whole], j[near & ~whole]]))
        i, j = np.concatenate(keep, 1)
        below = la.count[i] * lb.count[j]
        if below.sum() * ALONE > len(a.x) * len(b.x):
            yield from product()
            return
        at = np.repeat(np.arange(len(i)), below)
        step = np.arange(len(at)) - np.repeat(np.cumsum(below) - below, below)
        p, q = la.first[i][at] + step // lb.count[j][at], lb.first[j][at] + step % lb.count[j][at]
        last = depth + 1 == len(a.levels)
        if same:
            once = np.where((i == j)[at], p < q if last else p <= q, True)
            p, q = p[once], q[once]
        pairs = p, q
    for s in range(0, len(pairs[0]), size):
        p, q = pairs[0][s:s + size], pairs[1][s:s + size]
        hit = np.einsum("ij,ij->i", a.x[p], b.x[q]) >= cosine
        if hit.any():
            yield p[hit], q[hit], False


class Tally:
    """Links per item, and enough edges to connect what is linked."""

    def __init__(self):
        self.items: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.edges: list[np.ndarray] = []
        self.held = 0

    def pairs(self, ia, wa, ib, wb, whole: bool, inside: bool) -> None:
        """``inside``: all pairs within one list. Weights are the numbers of equal vectors of an item."""
        if inside:
            self._count(ia, wa.sum() - wa)
            self._edges(np.repeat(ia[:1], len(ia) - 1), ia[1:])
        elif whole:
            self._count(ia, np.full(len(ia), wb.sum()))
            self._count(ib, np.full(len(ib), wa.sum()))
            self._edges(np.repeat(ia[:1], len(ib)), ib)
            self._edges(np.repeat(ib[:1], len(ia)), ia)
        else:
            self._count(ia, wb)
            self._count(ib, wa)
            self._edges(ia, ib)

    def _count(self, items, n) -> None:
        self.items.append(items)
        self.counts.append(n)
        self.held += len(items)
        if self.held > 1 << 21:
            self.squeeze()

    def _edges(self, a, b) -> None:
        self.edges.append(np.stack([a, b]))

    def squeeze(self) -> None:
        """One count per item; edges of each connected part replaced by a star."""
        if self.items:
            items, where = np.unique(np.concatenate(self.items), return_inverse=True)
            counts = np.zeros(len(items), np.int64)
            np.add.at(counts, where, np.concatenate(self.counts))
            self.items, self.counts = [items], [counts]
        if self.edges:
            e = np.concatenate(self.edges, 1)
            nodes, where = np.unique(e, return_inverse=True)
            a, b = where.reshape(e.shape)
            label = np.arange(len(nodes))
            while True:
                low = np.minimum(label[a], label[b])
                new = label.copy()
                np.minimum.at(new, label[a], low)
                np.minimum.at(new, label[b], low)
                new = new[new]
                if (new == label).all():
                    break
                label = new
            member = np.flatnonzero(label != np.arange(len(nodes)))
            self.edges = [np.stack([nodes[label[member]], nodes[member]])]
        self.held = sum(map(len, self.items))


def halved(points: np.ndarray) -> list[int]:
    """The points in an order that keeps neighbours together: halves along the widest axis, and so on."""
    out, waiting = [], [np.arange(len(points))]
    while waiting:
        some = waiting.pop()
        if len(some) < 3:
            out.extend(some.tolist())
            continue
        x = points[some] - points[some].mean(0)
        some = some[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
        waiting += [some[len(some) // 2:], some[:len(some) // 2]]
    return out


def _deal(centres: np.ndarray):
    """Nearest centre of each vector."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell = np.argmax(unit(_rows(batch.column("embedding"))) @ centres.T, 1)
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(cell.astype(np.int32))], ["k", "cell"])
    return run


def _pack(pdf):
    """One chunk as one row: its cover tree, with item numbers and weights in the tree's order, and its covering ball."""
    import pandas as pd

    x = unit(np.array(pdf["embedding"].tolist(), np.float64))
    tree = CoverTree(x)
    items, weights = pdf["k"].to_numpy()[tree.order], pdf["size"].to_numpy()[tree.order]
    centre = x.mean(0)
    radius = float(np.sqrt(((x - centre) ** 2).sum(1)).max())
    original = np.array(pdf["embedding"].tolist(), np.float64)[tree.order]
    small = original.astype(np.float32)
    vectors = small if (small == original).all() else original
    body = pickle.dumps((items, weights, vectors, tree.levels, tree.points, centre, radius))
    return pd.DataFrame([{"chunk": int(pdf["chunk"].iloc[0]), "body": body, "centre": centre.tolist(), "radius": radius}])


def _unpack(body: bytes):
    items, weights, vectors, levels, points, centre, radius = pickle.loads(body)
    tree = CoverTree.__new__(CoverTree)
    tree.x, tree.levels, tree.points = unit(vectors.astype(np.float64)), levels, points
    return items, weights, tree, centre, radius


def _meet(cosine: float):
    def run(pdf):
        import pandas as pd

        limit, tally = math.sqrt(2 - 2 * cosine), Tally()
        one, two = int(pdf["one"].iloc[0]), int(pdf["two"].iloc[0])
        chunks = {c: _unpack(b) for c, b in zip(pdf["chunk"], pdf["body"])}
        groups = dict(zip(pdf["chunk"], pdf["grp"]))
        for c in sorted(chunks):
            for d in sorted(chunks):
                if c > d or {groups[c], groups[d]} != {one, two}:
                    continue
                (ka, wa, ta, ca, ra), (kb, wb, tb, cb, rb) = chunks[c], chunks[d]
                if c != d and math.sqrt(((ca - cb) ** 2).sum()) > limit + ra + rb + _EDGE:
                    continue
                for p, q, whole in dual(ta, tb, cosine):
                    tally.pairs(ka[p], wa[p], kb[q], wb[q], whole, whole and c == d and p[0] == q[0])
        tally.squeeze()
        rows = [pd.DataFrame({"k": i, "other": -1, "n": n}) for i, n in zip(tally.items, tally.counts)]
        rows += [pd.DataFrame({"k": e[0], "other": e[1], "n": 0}) for e in tally.edges]
        return pd.concat(rows) if rows else pd.DataFrame({"k": [], "other": [], "n": []}, dtype="int64")
    return run


def near_groups(chunks: DataFrame, n_groups: int, limit: float) -> DataFrame:
    """(grp, one, two) per group and pair it may meet: covering balls of both no further apart than ``limit``.

    A group's ball is around the mean of its chunks' centres. Only balls are compared here, no vectors.
    """
    middle = chunks.select("grp", F.posexplode("centre").alias("i", "x")).groupBy("grp", "i").agg(F.avg("x").alias("x"))
    middle = middle.groupBy("grp").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("middle"))
    gap = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, z: s + z))
    balls = stored(chunks.join(middle, "grp").groupBy("grp", "middle").agg(
        F.max(gap(F.col("middle"), F.col("centre")) + F.col("radius")).alias("reach")), "group-balls")
    other = balls.select(F.col("grp").alias("two"), F.col("middle").alias("middle2"), F.col("reach").alias("reach2"))
    pairs = balls.select(F.col("grp").alias("one"), "middle", "reach", F.explode(F.sequence(F.col("grp"), F.lit(n_groups - 1))).alias("two"))
    near = pairs.join(other, "two").where(
        (F.col("one") == F.col("two")) | (gap(F.col("middle"), F.col("middle2")) <= limit + F.col("reach") + F.col("reach2") + _EDGE))
    return near.select(F.explode(F.array_distinct(F.array("one", "two"))).alias("grp"), "one", "two")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, centres: int = CENTRES, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine is at least ``cosine``. Null, empty and zero vectors, vectors with
    a null or non-finite component and rows with a null vec_id link with nothing. A shorter vector counts
    as padded with zeros. Rows that repeat a vec_id count one by one as vectors. A row without links is its
    own component; with a null vec_id its component is null and it is kept.
    """
    spark = vectors.sparkSession
    ship(spark)
    e = F.transform(vectors["embedding"], lambda v: v.cast("double"))
    sound = vectors["vec_id"].isNotNull() & F.coalesce(
        F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), F.when(sound, e).alias("embedding"))
    rows = rows.withColumn("key", F.sha2(F.array_join(F.transform("embedding", lambda v: v.cast("string")), ","), 256))
    good = rows.where("embedding is not null")
    length = good.agg(F.max(F.size("embedding"))).first()[0] or 0
    padded = F.concat("embedding", F.array_repeat(F.lit(0.0), F.lit(length) - F.size("embedding")))
    items = good.groupBy("key").agg(F.min("vec_id").alias("cid"), F.count("*").alias("size"), F.first("embedding").alias("embedding"))
    items = stored(items.select("key", "cid", "size", padded.alias("embedding"), F.monotonically_increasing_id().alias("k")), "items")

    some = items.orderBy(F.xxhash64("key"), "key").limit(centres).select("embedding").collect()  # ``centres`` vectors at most
    middle = unit(np.array([r[0] for r in some], np.float64)) if some else np.zeros((1, max(1, length)))
    dealt = stored(items.select("k", "embedding").mapInArrow(_deal(middle), "k long, cell int"), "cells")
    cells = {r["cell"]: r["n"] for r in dealt.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row per centre
    # neighbouring cells share a chunk until it is full; a cell of more than a chunk is cut by hash
    plan, room, total = [], 0, 0
    for cell in (c for c in halved(middle) if c in cells):
        parts = math.ceil(cells[cell] / chunk)
        if parts > 1 or cells[cell] > room:
            total, room = total + parts, chunk - cells[cell] if parts == 1 else 0
        else:
            room -= cells[cell]
        plan.append((cell, total - parts, parts))
    dealt = dealt.join(F.broadcast(spark.createDataFrame(plan, "cell int, first int, parts int")), "cell")  # one row per centre
    number = (F.col("first") + F.pmod(F.xxhash64("k"), F.col("parts"))).cast("int")
    chunked = items.select("k", "size", "embedding").join(dealt, "k").select("k", "size", "embedding", number.alias("chunk"))
    packed = stored(chunked.groupBy("chunk").applyInPandas(_pack, "chunk int, body binary, centre array<double>, radius double"), "chunks")

    n_groups = max(1, math.ceil(total / group))
    grouped = packed.select("chunk", "body", (F.col("chunk") / group).cast("int").alias("grp"), "centre", "radius")
    sent = grouped.select("grp", "chunk", "body").join(near_groups(grouped, n_groups, math.sqrt(2 - 2 * cosine)), "grp")
    met = stored(sent.groupBy("one", "two").applyInPandas(_meet(cosine), "k long, other long, n long"), "vector-links")
    links = met.where("other < 0").groupBy("k").agg(F.sum("n").alias("links"))
    labels = stored(components(met.where("other >= 0").select(F.col("k").alias("a"), F.col("other").alias("b"))), "vector-components")

    known = items.select("key", "cid", "size", "k").join(links, "k", "left").join(labels, F.col("k") == F.col("node"), "left")
    known = known.withColumn("component", F.coalesce("component", "k"))
    least = known.groupBy("component").agg(F.min("cid").alias("component_id"), F.count("*").alias("size"))
    known = attach(known.withColumnRenamed("size", "copies"), stored(least, "vector-least"), "component", "size", spread="k")
    final = stored(known.select("key", F.col("copies").alias("size"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-classes")
    out = attach(rows.select("vec_id", F.when(F.col("embedding").isNotNull(), F.col("key")).alias("key")), final, "key", "size", spread="vec_id")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
