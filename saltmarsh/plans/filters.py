"""Projections, filters, predicates."""

from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio, three_way, tidy
from ..operators import relational as rel
from ..operators.stats import completeness
from ..sources import table
from .registry import query, rnd


@query("select_columns", f"SELECT l_orderkey, l_linenumber, {rnd('l_quantity', 2)} AS l_quantity FROM lineitem")
def select_columns(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tidy("l_quantity", 2).alias("l_quantity"))


@query("select_by_prefix", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def select_by_prefix(spark, sf):
    return rel.select_by_prefix(table(spark, sf, "orders").drop("o_orderdate"), ["o_order"])


@query("drop_by_prefix", f"SELECT o_custkey, {rnd('o_totalprice', 2)} AS o_totalprice FROM orders")
def drop_by_prefix(spark, sf):
    return rel.drop_by_prefix(table(spark, sf, "orders"), ["o_order"]).withColumn("o_totalprice", tidy("o_totalprice", 2))


@query("select_by_type", """
SELECT 'c_custkey' AS column_name, 'quantitative' AS kind, 100.0::DOUBLE * count(c_custkey) / count(*) AS percent_complete FROM customer
UNION ALL SELECT 'c_name', 'qualitative', 100.0::DOUBLE * count(c_name) / count(*) FROM customer
UNION ALL SELECT 'c_nationkey', 'quantitative', 100.0::DOUBLE * count(c_nationkey) / count(*) FROM customer
UNION ALL SELECT 'c_acctbal', 'quantitative', 100.0::DOUBLE * count(c_acctbal) / count(*) FROM customer
UNION ALL SELECT 'c_mktsegment', 'qualitative', 100.0::DOUBLE * count(c_mktsegment) / count(*) FROM customer""")
def select_by_type(spark, sf):
    customer = table(spark, sf, "customer")
    quantitative = rel.columns_by_kind(customer)["quantitative"]
    kind = F.when(F.col("column_name").isin(quantitative), "quantitative").otherwise("qualitative")
    return completeness(customer).select("column_name", kind.alias("kind"), "percent_complete")


@query("drop_sparse_columns", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def drop_sparse_columns(spark, sf):
    """``top_price`` is filled for well under one percent of the orders and goes."""
    orders = table(spark, sf, "orders")
    sparse = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                           F.when(F.col("o_totalprice") > 499000, F.col("o_totalprice")).alias("top_price"))
    return rel.drop_sparse_columns(sparse, minimum=0.01)


@query("filter_contains", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(?i)(?:license|copyright|all rights)')")
def filter_contains(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.where(rel.contains_any("text", ["license", "copyright", "all rights"])).select("doc_id", "lang")


@query("filter_expr", f"""
SELECT l_orderkey, l_partkey, l_linenumber, {rnd('l_quantity', 2)} AS l_quantity FROM lineitem
WHERE (l_quantity > 45 AND l_discount BETWEEN 0.03 AND 0.07) OR (l_returnflag = 'R' AND l_tax >= 0.08)""")
def filter_expr(spark, sf):
    return table(spark, sf, "lineitem").where(
        "(l_quantity > 45 AND l_discount BETWEEN 0.03D AND 0.07D) OR (l_returnflag = 'R' AND l_tax >= 0.08D)").select(
        "l_orderkey", "l_partkey", "l_linenumber", tidy("l_quantity", 2).alias("l_quantity"))


@query("filter_startswith", "SELECT o_orderkey, o_orderpriority FROM orders WHERE starts_with(o_orderpriority, '1-')")
def filter_startswith(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderpriority").startswith("1-")).select("o_orderkey", "o_orderpriority")


@query("filter_alpha_code", r"""
SELECT code, count(*) AS n FROM (SELECT p_type AS code FROM part UNION ALL SELECT p_brand FROM part
  UNION ALL SELECT CAST(p_size AS VARCHAR) FROM part) WHERE regexp_full_match(code, '[\p{L}]+') GROUP BY code""")
def filter_alpha_code(spark, sf):
    part = table(spark, sf, "part")
    codes = part.select(F.explode(F.array("p_type", "p_brand", F.col("p_size").cast("string"))).alias("code"))
    return codes.where(F.col("code").rlike(r"^\p{L}+$")).groupBy("code").agg(F.count("*").alias("n"))


@query("filter_isin", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def filter_isin(spark, sf):
    return table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R")).select(
        "l_orderkey", "l_linenumber", "l_returnflag")


@query("not_isin", "SELECT p_partkey, p_type FROM part WHERE p_type NOT IN ('PROMO', 'ECONOMY')")
def not_isin(spark, sf):
    return table(spark, sf, "part").where(~F.col("p_type").isin("PROMO", "ECONOMY")).select("p_partkey", "p_type")


@query("filter_outliers_quantile", f"""
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice', 2)} AS l_extendedprice FROM lineitem, q
WHERE l_extendedprice BETWEEN lo AND hi""")
def filter_outliers_quantile(spark, sf):
    return rel.within_quantiles(table(spark, sf, "lineitem"), "l_extendedprice").select(
        "l_orderkey", "l_linenumber", tidy("l_extendedprice", 2).alias("l_extendedprice"))


@query("filter_outliers_zscore", f"""
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
SELECT event_id, {rnd('value', 2)} AS value FROM events, s WHERE abs((value - m) / d) <= 4""")
def filter_outliers_zscore(spark, sf):
    return rel.without_zscore_outliers(table(spark, sf, "events"), ["value"]).select(
        "event_id", tidy("value", 2).alias("value"))


@query("drop_null_rows", "SELECT d.doc_id, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)")
def drop_null_rows(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select("doc_id", "quality", "toxic").na.drop(subset=["quality", "toxic"])


@query("cast_columns", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size FROM part")
def cast_columns(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    return rel.cast_columns(part, {"p_partkey": "string", "p_size": "double"})


@query("patch_cell", "SELECT p_partkey, CASE WHEN p_partkey = 7 THEN 'Brand#0' ELSE p_brand END AS p_brand FROM part")
def patch_cell(spark, sf):
    return rel.patch_cell(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey", 7, "p_brand", "Brand#0")


@query("strip_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def strip_strings(spark, sf):
    pad = lambda c: F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c)
    return rel.strip_strings(table(spark, sf, "customer").select("c_custkey", pad("c_name"), pad("c_mktsegment")))


@query("derived_column", f"""
SELECT l_orderkey, l_linenumber, {rnd('l_quantity * l_extendedprice', 4)} AS total,
       CAST(l_discount > 0.05 AS INTEGER) AS is_discounted FROM lineitem""")
def derived_column(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", tidy(F.col("l_quantity") * F.col("l_extendedprice"), 4).alias("total"),
        (F.col("l_discount") > 0.05).cast("int").alias("is_discounted"))


@query("interaction_features", f"""
SELECT l_orderkey, l_linenumber, {rnd('l_quantity * l_extendedprice', 4)} AS quantity_x_price,
       {rnd('l_quantity * l_discount', 4)} AS quantity_x_discount, {rnd('l_quantity * l_tax', 4)} AS quantity_x_tax,
       {rnd('l_quantity + l_discount + l_tax', 4)} AS feature_sum,
       {rnd('l_discount / (l_tax + CAST(1e-5 AS DOUBLE))', 4)} AS discount_tax_ratio FROM lineitem""")
def interaction_features(spark, sf):
    q = F.col("l_quantity")
    others = {"price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[tidy(q * F.col(c), 4).alias(f"quantity_x_{n}") for n, c in others.items()],
        tidy(q + F.col("l_discount") + F.col("l_tax"), 4).alias("feature_sum"),
        tidy(safe_ratio(F.col("l_discount"), F.col("l_tax")), 4).alias("discount_tax_ratio"))


@query("threshold_flag", """
SELECT event_id, CAST(p >= 0.3 AS INTEGER) AS flag, CASE WHEN p < 0.5 THEN 0 WHEN p > 0.6 THEN 1 ELSE -1 END AS code
FROM (SELECT event_id, value / 100.0::DOUBLE AS p FROM events)""")
def threshold_flag(spark, sf):
    p = F.col("value") / 100.0
    return table(spark, sf, "events").select("event_id", (p >= 0.3).cast("int").alias("flag"), three_way(p, 0.6).alias("code"))
