"""Mixing sources to target weights by Pfair scheduling; DataFrame functions only.

Every source is cut into blocks of ``block_docs`` documents. With integer weights w that add up to W,
block i (from 0) of a source may not start before slot floor(i W / w) and must be placed before slot
ceil((i + 1) W / w). Each slot takes, among the blocks released, the one with the earliest deadline
(smallest source name on a tie). Such windows can always be met, so at every slot a source is less than
one block away from its share. The schedule repeats after W slots: only one period, W rows at most, is
computed, and slots of later periods follow by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import PART, POS, with_index
from .shared import stored

BLOCK_DOCS = 16
PERIOD = 1000
#: name of all sources too small for a slot of their own
POOL = "rest"
EXPONENT = 0.9


def source_name(source: Column) -> Column:
    """A null source is a source of its own, apart from every text."""
    return F.when(source.isNull(), "null").otherwise(F.concat(F.lit("="), source.cast("string")))


def period(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """Rows (name, weight, k, slot): the k-th block of each source within one period."""
    names = sorted(n for n, w in weights.items() if w > 0)
    share = [int(weights[n]) for n in names]
    total = sum(share)
    if not names:
        return spark.createDataFrame([], "name string, weight long, k long, slot long")
    w = F.array(*[F.lit(v).cast("long") for v in share])
    sources = F.array(*[F.lit(i) for i in range(len(names))])

    def place(state, t):
        def choice(s):
            done, weight = F.get(state["done"], s), F.get(w, s)
            ready = (done < weight) & (F.floor(done * total / weight) <= t)
            return F.when(ready, F.struct(F.ceil((done + 1) * total / weight).alias("deadline"), s.alias("source")))
        pick = F.array_min(F.transform(sources, choice))["source"]
        return F.struct(F.transform(state["done"], lambda d, i: F.when(i == pick, d + 1).otherwise(d)).alias("done"),
                        F.concat(state["order"], F.array(pick)).alias("order"))

    start = F.struct(F.transform(sources, lambda s: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, place, lambda s: s["order"])
    rows = spark.range(1).select(F.posexplode(order).alias("slot", "i"))
    k = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("i"))
    return rows.select(name.alias("name"), F.get(w, F.col("i")).alias("weight"), k.cast("long").alias("k"), F.col("slot").cast("long").alias("slot"))


def temperature_weights(docs: DataFrame, exponent: float = EXPONENT, total: int = PERIOD) -> dict[str, int]:
    """Integer weights in proportion to (rows of a source) ** exponent, by largest remainders.

    They add up to ``total``, so at most ``total`` sources, and as many rows on the driver, get one of their
    own. Sources below one slot in ``total`` are pooled: ``POOL`` has the weight of their rows together, 1 at least.
    """
    counts = docs.groupBy(source_name(docs["source"]).alias("name")).agg(F.count("*").alias("n"))
    power = lambda n: F.pow(F.col(n).cast("double"), F.lit(exponent))
    counts = stored(counts.select("name", "n", power("n").alias("p")), "source-counts")
    all_of = counts.agg(F.sum("p")).first()[0]
    if all_of is None:
        return {}
    small = F.col("p") * total / F.lit(all_of) < 1
    pool = counts.where(small).agg(F.sum("n").alias("n")).where("n is not null").select(F.lit(POOL).alias("name"), power("n").alias("p"))
    shares = stored(counts.where(~small).select("name", "p").unionAll(pool), "source-shares")
    quota = F.col("p") * total / F.lit(shares.agg(F.sum("p")).first()[0])
    shares = shares.select("name", F.floor(quota).alias("w"), (quota - F.floor(quota)).alias("rest"))
    left = total - (shares.agg(F.sum("w")).first()[0] or 0)
    more = shares.orderBy(F.desc("rest"), "name").limit(int(left)).select("name", F.lit(1).alias("more"))
    w = F.col("w") + F.coalesce("more", F.lit(0))
    rows = shares.join(F.broadcast(more), "name", "left").select("name", F.when(F.col("name") == POOL, F.greatest(w, F.lit(1))).otherwise(w).alias("w"))
    return {r["name"]: r["w"] for r in rows.where("w > 0").collect()}


def pooled_name(source: Column, weights: dict[str, int]) -> Column:
    """The name a row is scheduled under: that of its source, or ``POOL`` for a source without a weight if there is a pool."""
    name = source_name(source)
    return F.when(name.isin([n for n, w in weights.items() if w > 0]), name).otherwise(POOL) if POOL in weights else name


def schedule(docs: DataFrame, weights: dict[str, int], block_docs: int = BLOCK_DOCS, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: doc_id, name, block, place (in the block), slot, in_mix.

    ``weights`` maps ``source_name`` values to integers. Inside a source documents stand in the order of
    an MD5 of seed and doc_id, then doc_id. The mix ends at the first slot whose source has no block left;
    up to there the weights hold to less than one block. Rows behind it keep their slot with in_mix false;
    rows of sources without a weight have null block, place and slot, unless ``POOL`` has a weight: then they
    are scheduled together under that name, and the mix does not end when the pool has run out. Null doc_ids
    come first in their source.
    """
    spark = docs.sparkSession
    plan = stored(period(spark, weights), "period")
    total = sum(w for w in weights.values() if w > 0)
    share = plan.select("name", "weight").distinct()
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    rows = docs.select(docs["doc_id"].alias("doc_id"), pooled_name(docs["source"], weights).alias("name"))
    rows = rows.join(F.broadcast(share), "name", "left")
    placed = rows.where("weight is not null").orderBy("name", order, "doc_id")
    placed = stored(placed.withColumn("__mid", F.monotonically_increasing_id()), "mix-order")
    laid = placed.withColumn(PART, F.shiftright("__mid", 33)).withColumn(POS, F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("__mid")
    indexed = with_index(laid, "i").drop(PART, POS)
    # one row per weighted source: at most as many as the period has slots
    ranges = stored(indexed.groupBy("name").agg(F.min("i").alias("first"), F.count("*").alias("n")), "source-ranges")

    def slot_of(block, weight):
        """Index inside the period, and slots of the periods before."""
        return F.pmod(block, weight), F.floor(block / weight) * total

    ends = ranges.join(share, "name", "right").select(
        "name", "weight", F.expr(f"(coalesce(n, 0) + {block_docs - 1}) div {block_docs}").alias("missing"))
    k, before = slot_of(F.col("missing"), F.col("weight"))
    ends = ends.select("name", k.alias("k"), before.alias("before")).join(plan, ["name", "k"])
    if len(weights) > 1:
        ends = ends.where(F.col("name") != POOL)
    horizon = ends.agg(F.min(F.col("before") + F.col("slot"))).first()[0] or 0

    at = indexed.join(F.broadcast(ranges.drop("n")), "name").select(
        "doc_id", "name", "weight", F.expr(f"(i - first) div {block_docs}").alias("block"), F.pmod(F.col("i") - F.col("first"), F.lit(block_docs)).alias("place"))
    k, before = slot_of(F.col("block"), F.col("weight"))
    # the period has as many rows as the weights add up to, whatever the data
    out = at.withColumn("k", k).withColumn("before", before).join(F.broadcast(plan.drop("weight")), ["name", "k"]).select(
        "doc_id", "name", "block", "place", (F.col("before") + F.col("slot")).alias("slot"))
    out = out.withColumn("in_mix", F.col("slot") < horizon)
    none = F.lit(None).cast("long")
    return out.unionByName(rows.where("weight is null").select(
        "doc_id", "name", none.alias("block"), none.alias("place"), none.alias("slot"), F.lit(False).alias("in_mix")))


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of ``docs`` that are in the mix, in the order of their slots; columns unchanged.

    Without ``weights`` they follow ``temperature_weights``; the mix ends where the first source of a weight of
    its own runs out, and the rows behind it are left out. Rows that share source and doc_id share the
    earliest of their places. An empty table stays empty.
    """
    weights = temperature_weights(docs) if weights is None else weights
    slots = schedule(docs, weights, block_docs).where("in_mix").groupBy("doc_id", "name").agg(
        F.min(F.struct("slot", "place")).alias("__at")).select(F.col("doc_id").alias("__doc"), F.col("name").alias("__name"), "__at")
    slots = stored(slots, "mix-slots")
    same = docs["doc_id"].eqNullSafe(F.col("__doc")) & (pooled_name(docs["source"], weights) == F.col("__name"))
    return docs.join(slots, same).orderBy("__at.slot", "__at.place", "doc_id").select(*[docs[c] for c in docs.columns])
