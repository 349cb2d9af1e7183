"""Exponential averages and time-ordered splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .ordering import PART, POS, attach_groups, group_row_index, join_groups, lay_out, nearest_mark, row_index, with_index
from .relational import md5_key
from .stats import one_row

BLOCK = 256  # rows per block, and maps composed at once
STRETCH = 300.0  # exp(STRETCH) is far from overflow
APART = 4096  # more stretches than the decay of one block can make


def _fold(maps: Column, k: int) -> Column:
    """Composition of an ordered list of maps ``y -> A*y + B``."""
    return F.aggregate(
        maps, F.struct(F.lit(1.0).alias("A"), F.lit(0.0).alias("B")),
        lambda acc, s: F.struct((acc["A"] * s[f"A{k}"]).alias("A"), (s[f"A{k}"] * acc["B"] + s[f"B{k}"]).alias("B")))


def _prefixes(segments: DataFrame, group: list[str], order: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Per group of segments: the map of everything before each one, and the map of the whole group."""
    cols = [F.col(c) for c in order] + [F.col(f"{m}{k}") for k in range(n) for m in "AB"]
    lists = segments.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("l"))
    whole = lists.select(*group, *[c for k in range(n) for c in (
        _fold(F.col("l"), k)["A"].alias(f"A{k}"), _fold(F.col("l"), k)["B"].alias(f"B{k}"))])
    each = lists.select(*group, "l", F.posexplode("l").alias("i", "s"))
    before = F.slice("l", F.lit(1), F.col("i"))
    each = each.select(*group, *[F.col(f"s.{c}").alias(c) for c in order],
                       *[c for k in range(n) for c in (
                           _fold(before, k)["A"].alias(f"pA{k}"), _fold(before, k)["B"].alias(f"pB{k}"))])
    return each, whole


def _with_gap(laid: DataFrame, by: list[str], value: str) -> DataFrame:
    """``_gap``: rows without a value between a row and the last value of its group; null if there is none before it."""
    rows = with_index(laid, "_i").withColumn("_own", F.when(F.col(value).isNotNull(), F.struct(*by, "_i")))
    parts = rows.groupBy(PART).agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), F.col(POS))).alias("_end"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(PART, F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(parts), PART).withColumn("_prev", F.coalesce(F.last("_own", ignorenulls=True).over(inside), "_carry"))
    same = F.col("_prev").isNotNull()
    for key in by:
        same = same & F.col(f"_prev.{key}").eqNullSafe(F.col(key))
    return rows.withColumn("_gap", F.when(same, F.col("_i") - F.col("_prev._i") - 1)).drop("_own", "_prev", "_carry", "_i")


def ema(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, spans: Sequence[int],
    names: Sequence[str], block: int = BLOCK,
) -> DataFrame:
    """Recursive averages ``y0 = x0``, ``y_t = (1-a) y_{t-1} + a x_t`` with ``a = 2/(span+1)``.

    Every row is kept. A row without a value repeats the average so far (null before the first value), and
    ages it: after g such rows the old average weighs ``(1-a)^(g+1)`` against ``a``, divided by their sum.

    Each row is an affine map of the value carried in. Maps are composed per block of a global sort, blocks
    level by level, and the carried value is applied at the end; one very long series is spread over many
    tasks. Where the decay inside a block passes ``exp(-STRETCH)``, or a row forgets all before it, a new
    stretch starts.
    """
    if any(s < 1 for s in spans):
        raise ValueError("spans must be at least 1")
    decay = [1 - 2.0 / (s + 1) for s in spans]
    n, by = len(spans), list(by)
    laid = _with_gap(lay_out(df, [*by, *order]), by, value)
    top = laid.agg(F.max(POS).alias("p")).first()["p"] or 0
    # Python numbers: block sizes of the levels below one sort partition
    sizes = [block]
    while sizes[-1] <= top:
        sizes.append(sizes[-1] * BLOCK)
    levels = [f"_b{i}" for i in range(len(sizes))]
    rows = laid.select("*", *[F.floor(F.col(POS) / s).alias(lv) for lv, s in zip(levels, sizes)])
    has, first = F.col(value).isNotNull(), F.col("_gap").isNull()
    for k, d in enumerate(decay):
        old = F.pow(F.lit(d), F.col("_gap") + 1)
        rows = rows.withColumn(f"_mul{k}", F.when(~has, F.lit(1.0)).when(first, F.lit(0.0)).otherwise(old / (old + (1 - d))))
        rows = rows.withColumn(f"_add{k}", F.when(~has, F.lit(0.0)).when(first, F.col(value)).otherwise(F.col(value) * (1 - d) / (old + (1 - d))))
    logs = [F.when(F.col(f"_mul{k}") == 0, 0.0).otherwise(F.log(F.greatest(F.col(f"_mul{k}"), F.lit(1e-300)))) for k in range(n)]
    forgets = F.lit(False)
    for k in range(n):
        forgets = forgets | (F.col(f"_mul{k}") == 0)
    whole = Window.partitionBy(*by, PART, *reversed(levels)).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(c).over(whole).alias(f"_log{k}") for k, c in enumerate(logs)],
                       (F.floor(F.sum(F.least(*logs) if n > 1 else logs[0]).over(whole) / -STRETCH) + F.count_if(forgets).over(whole) * APART).alias("_stretch"))
    seg = [*by, PART, *reversed(levels), "_stretch"]
    inside = Window.partitionBy(*seg).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    for k in range(n):  # relative to the first row of the stretch, whose own map may forget everything
        rows = rows.withColumn(f"_decayed{k}", F.exp(F.col(f"_log{k}") - F.first(f"_log{k}").over(inside)))
        rows = rows.withColumn(f"_head{k}", F.first(f"_mul{k}").over(inside))
        rows = rows.withColumn(f"_s{k}", F.sum(F.col(f"_add{k}") / F.col(f"_decayed{k}")).over(inside))
    segments = durable(rows.groupBy(*seg).agg(*[F.max_by(c, POS).alias(name) for k in range(n) for c, name in (
        (F.col(f"_decayed{k}") * F.col(f"_head{k}"), f"A{k}"), (F.col(f"_decayed{k}") * F.col(f"_s{k}"), f"B{k}"))]))

    # up: compose blocks into larger blocks; down: hand the carried-in map back to the small ones
    steps, current, keys = [], segments, seg
    for _ in levels:
        each, current = _prefixes(current, keys[:-1], [keys[-1]], n)
        steps.append(each)
        keys = keys[:-1]
    carried, _ = _prefixes(current, by, [PART] + keys[len(by) + 1:], n)
    for each in reversed(steps):
        up = carried.select(*[c for c in carried.columns if not c.startswith("p")],
                            *[F.col(f"p{m}{k}").alias(f"q{m}{k}") for k in range(n) for m in "AB"])
        on = [c for c in up.columns if not c.startswith("q")]
        joined = join_groups(each, up, on)
        carried = joined.select(*[c for c in each.columns if not c.startswith("p")], *[
            c for k in range(n) for c in (
                (F.col(f"qA{k}") * F.col(f"pA{k}")).alias(f"pA{k}"),
                (F.col(f"pA{k}") * F.col(f"qB{k}") + F.col(f"pB{k}")).alias(f"pB{k}"))])
    # nothing is carried into a group, so only the constant of the map counts
    carried = carried.select(*seg, *[F.col(f"pB{k}").alias(f"_in{k}") for k in range(n)])
    out = join_groups(rows, carried, seg)
    return out.select(*df.columns, *[
        F.when(has | F.col("_gap").isNotNull(), F.col(f"_decayed{k}") * (F.col(f"_head{k}") * F.col(f"_in{k}") + F.col(f"_s{k}"))).alias(names[k])
        for k in range(n)])


def macd(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
         fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """MACD line, its signal line and their difference."""
    both = ema(df, by, order, value, [fast, slow], ["ema_fast", "ema_slow"])
    line = both.withColumn("macd", F.col("ema_fast") - F.col("ema_slow")).drop("ema_fast", "ema_slow")
    out = ema(line, by, order, "macd", [signal], ["macd_signal"])
    return out.withColumn("macd_diff", F.col("macd") - F.col("macd_signal"))


# --- splits --------------------------------------------------------------------------------

def _group_table(df: DataFrame, group: str) -> DataFrame:
    """Distinct groups with their 0-based position ``__g`` and the number of groups ``__n``."""
    groups = df.select(group).distinct()
    total = groups.agg(F.count("*").alias("n")).scalar()
    return row_index(groups, [group], "__g").withColumn("__n", total.cast("long"))


def _enough(groups: DataFrame, n_splits: int) -> None:
    first = groups.select("__n").first()
    found = first["__n"] if first else 0
    if found < n_splits + 1:
        raise ValueError(f"{n_splits} folds need at least {n_splits + 1} groups, not {found}")


def _roles(groups: DataFrame, group: str, n_folds: int, ranges) -> DataFrame:
    """One row per (group, fold, role) from ``ranges(fold) -> [(role, start, end)]`` on group positions."""
    g = F.col("__g")
    hits = [F.when((g >= lo) & (g < hi), F.struct(F.lit(f).alias("fold"), F.lit(role).alias("role")))
            for f in range(n_folds) for role, lo, hi in ranges(f)]
    return groups.select(group, F.explode(F.array_compact(F.array(*hits))).alias("h")).select(
        group, "h.fold", "h.role")


def _drop_head(split: DataFrame, order: Sequence[str], heads: dict[str, int]) -> DataFrame:
    """Drop the first rows of some roles in every fold; only those few rows are ranked."""
    if not any(heads.values()):
        return split
    w = Window.partitionBy("fold", "role").orderBy(*order)
    ranked = split.where(F.col("role").isin(list(heads))).select("fold", "role", *order).withColumn(
        "_r", F.row_number().over(w)).where(F.col("_r") <= max(heads.values()))
    limit = F.coalesce(*[F.when(F.col("role") == r, F.lit(h)) for r, h in heads.items()])
    gone = ranked.where(F.col("_r") <= limit).drop("_r")
    # at most (folds x roles x head) rows
    return split.join(F.broadcast(gone), ["fold", "role", *order], "left_anti")


def purged_group_split(
    df: DataFrame, group: str, order: Sequence[str], n_splits: int = 5, group_gap: int = 1,
    max_train_groups: int | None = None, max_test_groups: int | None = None, drop_head_rows: int | None = None,
) -> DataFrame:
    """Rows with ``fold`` and ``role``: test blocks of consecutive groups, a training block that ends
    ``group_gap`` groups before, and the first ``drop_head_rows`` rows of each test block left out.
    Fewer groups than folds and one more are refused."""
    groups = _group_table(df, group)
    _enough(groups, n_splits)
    n = F.col("__n")
    size = F.least(F.floor(n / (n_splits + 1)), F.lit(max_test_groups)) if max_test_groups else F.floor(n / (n_splits + 1))

    def ranges(f):
        start = n - n_splits * size + f * size
        first = F.greatest(F.lit(0), start - group_gap - max_train_groups) if max_train_groups else F.lit(0)
        return [("train", first, start - group_gap), ("test", start, start + size)]

    split = attach_groups(df, _roles(groups, group, n_splits, ranges), [group])
    return _drop_head(split, order, {"test": group_gap if drop_head_rows is None else drop_head_rows})


def purged_stacking_split(
    df: DataFrame, group: str, order: Sequence[str], n_splits: int, val_gap: int, test_gap: int,
    max_train_groups: int, max_val_groups: int, max_test_groups: int,
) -> DataFrame:
    """Three blocks per fold (train, val, test) with a gap before the second and the third."""
    groups = _group_table(df, group)
    _enough(groups, n_splits)
    n = F.col("__n")
    size = F.least(F.floor(n / (n_splits + 1)), F.lit(max_test_groups))

    def ranges(f):
        test = n - n_splits * size + f * size
        val = F.greatest(F.lit(max_train_groups + val_gap), test - test_gap - max_val_groups)
        train = F.greatest(F.lit(0), val - val_gap - max_train_groups)
        return [("train", train, val - val_gap), ("val", val, test - test_gap), ("test", test, test + size)]

    split = attach_groups(df, _roles(groups, group, n_splits, ranges), [group])
    return _drop_head(split, order, {"val": val_gap, "test": test_gap})


def aligned_fold_table(df: DataFrame, group: Column, order: Sequence[str], n_folds: int = 5,
                       train: float = 0.70, test: float = 0.30, train1: float = 0.20) -> DataFrame:
    """Row with its 0-based position, ``fold`` and ``part`` (train1, train2, test), cut at group starts.

    Fold starts are the group starts nearest to equal row shares; inside a fold the test block
    starts near ``train`` of its rows and the second training block near ``train1`` of the rest.
    The very last row only marks the end of the last range and is not part of it.
    """
    rows = row_index(df.withColumn("_g", group), order, "idx")
    starts = durable(rows.groupBy("_g").agg(F.min("idx").alias("start")).select("start"))
    n = rows.agg(F.count("*").alias("n")).scalar()
    spark = df.sparkSession
    per = F.floor(F.floor(n / n_folds) * F.lit(train)) + F.floor(F.floor(n / n_folds) * F.lit(test))
    targets = spark.range(n_folds).select(F.col("id").cast("int").alias("fold"), (F.col("id") * per).alias("t"))
    fold_start = nearest_mark(targets, "t", starts, "start", "a").select("fold", "a")
    w = Window.orderBy("fold")  # one row per fold
    folds = fold_start.withColumn("z", F.coalesce(F.lead("a").over(w), n - 1))
    tests = nearest_mark(folds.withColumn("t", F.floor((F.col("z") - F.col("a")) * F.lit(train) + F.col("a"))),
                         "t", starts, "start", "c").select("fold", "a", "z", "c")
    cuts = nearest_mark(tests.withColumn("t", F.floor((F.col("c") - F.col("a")) * F.lit(train1) + F.col("a"))),
                        "t", starts, "start", "b").select("fold", "a", "b", "c", "z")
    table = cuts.agg(F.sort_array(F.collect_list(F.struct("fold", "a", "b", "c", "z"))).alias("l")).scalar()
    i = F.col("idx")
    hit = F.get(F.filter("_folds", lambda s: (s["a"] <= i) & (i < s["z"])), F.lit(0))
    out = rows.withColumn("_folds", table).withColumn("_h", hit).where(F.col("_h").isNotNull())
    part = F.when(i < F.col("_h.b"), "train1").when(i < F.col("_h.c"), "train2").otherwise("test")
    return out.select(*df.columns, "idx", F.col("_h.fold").alias("fold"), part.alias("part"))


def expanding_time_split(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """``fold`` and ``role`` of ordered rows: block ``f`` of ``n // (k+1)`` rows is tested on all rows before."""
    n = df.agg(F.count("*").alias("n")).scalar()
    rows = row_index(df, order, "idx").withColumn("_n", n)
    size = F.floor(F.col("_n") / (k + 1))
    first = F.col("_n") - k * size
    hits = []
    for f in range(k):
        lo = first + f * size
        role = F.when(F.col("idx") < lo, "train").when(F.col("idx") < lo + size, "test")
        hits.append(F.when(role.isNotNull(), F.struct(F.lit(f).alias("fold"), role.alias("role"))))
    return rows.select(*df.columns, "idx", F.explode(F.array_compact(F.array(*hits))).alias("h")).select(
        *df.columns, "idx", "h.fold", "h.role")


def minibatches(df: DataFrame, order: Sequence[str], step: int) -> DataFrame:
    """Consecutive blocks of ``step`` ordered rows; the remainder is the last block."""
    return row_index(df, order, "idx").withColumn("batch", F.floor(F.col("idx") / step))


def learning_curve(df: DataFrame, order: Sequence[str], step: int, value: str) -> DataFrame:
    """Per mini-batch: its rows, and mean and RMSE of the mean predictor over all rows so far."""
    per = minibatches(df, order, step).groupBy("batch").agg(
        F.count("*").alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    laid = lay_out(per, ["batch"])
    parts = laid.groupBy(PART).agg(*[F.sum(c).alias(c) for c in "nsq"])
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(PART, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"p{c}") for c in "nsq"])
    w = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    out = laid.join(F.broadcast(parts), PART).select(
        "batch", "n", *[(F.sum(c).over(w) + F.col(f"p{c}")).alias(f"c{c}") for c in "nsq"])
    mean = F.col("cs") / F.col("cn")
    return out.select("batch", "n", F.col("cn").alias("n_prefix"), mean.alias("prefix_mean"),
                      F.sqrt(F.greatest(F.col("cq") / F.col("cn") - mean * mean, F.lit(0.0))).alias("prefix_rmse"))


def stratified_split(df: DataFrame, key: str, strata: Sequence[str], share: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly ``floor(share * n)`` pseudo-random rows of every stratum."""
    ranked = group_row_index(df.withColumn("_h", md5_key(key, seed)), list(strata), ["_h", key], "_r")
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_n"))
    out = join_groups(ranked, sizes, strata)
    return out.withColumn("is_test", (F.col("_r") + 1 <= F.col("_n") * F.lit(share)).cast("int")).drop(
        "_h", "_r", "_n")


def kfold_split(df: DataFrame, key: str, strata: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Adds ``fold``: rows of every stratum dealt out to ``k`` folds in pseudo-random order."""
    ranked = group_row_index(df.withColumn("_h", md5_key(key, seed)), list(strata), ["_h", key], "_r")
    return ranked.withColumn("fold", (F.col("_r") % k).cast("int")).drop("_h", "_r")
