"""Sort, limit, sampling, splits, set operations."""

from pyspark.sql import functions as F

from ..functions.numbers import cut_edges, tidy
from ..operators import relational as rel
from ..operators import timeseries as ts
from ..operators import windows as win
from ..operators.aggregate import equal_width_bin
from ..operators.stats import quantile_values
from ..session import durable
from ..sources import table
from .registry import query, rnd


@query("top_k", f"SELECT o_orderkey, {rnd('o_totalprice', 2)} AS o_totalprice FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, sf):
    top = rel.top_k(table(spark, sf, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)
    return top.select("o_orderkey", tidy("o_totalprice", 2).alias("o_totalprice"))


@query("top_value_flag", """
WITH best AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY sum(l_extendedprice * l_quantity) DESC, l_partkey LIMIT 20)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey IN (SELECT l_partkey FROM best) AS INTEGER) AS is_top FROM lineitem""")
def top_value_flag(spark, sf):
    lines = table(spark, sf, "lineitem")
    flagged = win.top_value_flag(lines, "l_partkey", F.col("l_extendedprice") * F.col("l_quantity"), 20, "is_top")
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "is_top")


METRICS_SQL = """WITH m AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_orders, round(sum(o_totalprice), 2) AS revenue, round(avg(o_totalprice), 4) AS mean_price,
  max(o_totalprice) AS max_price, min(o_totalprice) AS min_price FROM orders GROUP BY 1)"""
METRICS = ["n_orders", "revenue", "mean_price", "max_price", "min_price"]


def customer_metrics(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").cast("double").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"),
        F.round(F.avg("o_totalprice"), 4).alias("mean_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"))


@query("best_row_per_metric", METRICS_SQL + " UNION ALL ".join(
    f" SELECT '{m}' AS metric, arg_max(o_custkey, ({m}, -o_custkey)) AS o_custkey, {rnd(f'max({m})', 3)} AS value FROM m" for m in METRICS))
def best_row_per_metric(spark, sf):
    return win.best_row_per_metric(customer_metrics(spark, sf), "o_custkey", METRICS).withColumn("value", tidy("value", 3))


@query("sample_rows", """
SELECT doc_id, lang FROM documents ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def sample_rows(spark, sf):
    return rel.sample_rows(table(spark, sf, "documents"), "doc_id", 100).select("doc_id", "lang")


BIN50 = """CAST(least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / 50)), 1), 50) AS INTEGER)"""


@query("split_stratified", f"""
WITH b AS (SELECT o_orderkey, {BIN50} AS bin FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)),
r AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS i, count(*) OVER (PARTITION BY bin) AS n FROM b)
SELECT o_orderkey, bin, CAST(i <= n * 0.1::DOUBLE AS INTEGER) AS is_test FROM r""")
def split_stratified(spark, sf):
    orders = table(spark, sf, "orders")
    binned = orders.select("o_orderkey", equal_width_bin(orders, "o_totalprice", 50).alias("bin"))
    return ts.stratified_split(binned, "o_orderkey", ["bin"], 0.1).select("o_orderkey", "bin", "is_test")


@query("split_stratified_deciles", """
WITH q AS (SELECT quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM orders),
b AS (SELECT o_orderkey, CAST(1 + len(list_filter(e, lambda x: o_totalprice > x)) AS INTEGER) AS bin FROM orders, q),
r AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS i, count(*) OVER (PARTITION BY bin) AS n FROM b)
SELECT o_orderkey, bin, CAST(i <= n * 0.1::DOUBLE AS INTEGER) AS is_test FROM r""")
def split_stratified_deciles(spark, sf):
    orders = table(spark, sf, "orders")
    edges = quantile_values(orders, "o_totalprice", [i / 10 for i in range(11)])
    binned = orders.select("o_orderkey", cut_edges(F.col("o_totalprice"), edges).alias("bin"))
    return ts.stratified_split(binned, "o_orderkey", ["bin"], 0.1).select("o_orderkey", "bin", "is_test")


@query("split_kfold", """
SELECT o_orderkey, o_orderpriority, CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def split_kfold(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return ts.kfold_split(orders, "o_orderkey", ["o_orderpriority"], 5).select("o_orderkey", "o_orderpriority", "fold")


@query("split_random", """
SELECT o_orderkey, CAST(CAST('0x' || substr(md5('42-' || CAST(o_orderkey AS VARCHAR)), 1, 7) AS BIGINT) < CAST(floor(268435456 * 0.1::DOUBLE) AS BIGINT) AS INTEGER) AS is_test FROM orders""")
def split_random(spark, sf):
    return rel.split_random(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1)


@query("split_holdouts", "SELECT o_orderkey, " + ", ".join(
    f"CAST(CAST('0x' || substr(md5('{seed}-' || CAST(o_orderkey AS VARCHAR)), 1, 7) AS BIGINT) < CAST(floor(268435456 * 0.2::DOUBLE) AS BIGINT) AS INTEGER) AS holdout_{seed}"
    for seed in (1, 2, 3)) + " FROM orders")
def split_holdouts(spark, sf):
    """Three repeated hold-outs of 20 percent, one column per seed."""
    out = table(spark, sf, "orders").select("o_orderkey")
    for seed in (1, 2, 3):
        out = rel.split_random(out, "o_orderkey", 0.2, seed).withColumnRenamed("is_test", f"holdout_{seed}")
    return out


@query("union_all", f"""
SELECT c_custkey AS id, c_name AS name, {rnd('c_acctbal', 2)} AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, {rnd('s_acctbal', 2)}, NULL FROM supplier""")
def union_all(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            tidy("c_acctbal", 2).alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), tidy("s_acctbal", 2).alias("balance"))
    return rel.union_all([c, s])


@query("distinct_rows", "SELECT lang, n_chars, md5(text) AS digest FROM (SELECT DISTINCT text, lang, n_chars FROM documents)")
def distinct_rows(spark, sf):
    rows = table(spark, sf, "documents").select("text", "lang", "n_chars").dropDuplicates()
    return rows.select("lang", "n_chars", F.md5("text").alias("digest"))


@query("except_rows", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey").subtract(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")))


@query("intersect_rows", METRICS_SQL + " INTERSECT ".join(
    f" SELECT o_custkey FROM m WHERE {m} > (SELECT quantile_cont({m}, 0.8) FROM m)" for m in METRICS))
def intersect_rows(spark, sf):
    """Customers above the 80 % quantile of every metric; one filter instead of a chain of intersections."""
    m = durable(customer_metrics(spark, sf))  # read once per quantile pass
    out = m
    for name in METRICS:
        (cut,) = quantile_values(m, name, [0.8])
        out = out.where(F.col(name) > cut)
    return out.select("o_custkey")


@query("union_dedup_first", """
WITH a AS (SELECT o_custkey, 1 AS source FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT o_custkey, 2 FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_custkey, 3 FROM orders WHERE o_orderpriority = '1-URGENT') SELECT o_custkey, min(source) AS source FROM a GROUP BY 1""")
def union_dedup_first(spark, sf):
    """Union of three key lists; each key keeps the first list it occurs in."""
    orders = table(spark, sf, "orders")
    conditions = ["o_totalprice > 400000", "o_orderstatus = 'P'", "o_orderpriority = '1-URGENT'"]
    lists = [orders.where(c).select("o_custkey", F.lit(i).alias("source")) for i, c in enumerate(conditions, 1)]
    return rel.union_all(lists).groupBy("o_custkey").agg(F.min("source").alias("source"))
