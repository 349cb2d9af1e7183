"""Sources and sinks."""

from pyspark.sql import functions as F

from ..functions.numbers import tidy
from ..operators import models
from ..session import scratch_path
from ..sources import (read_columnar, read_delimited, read_delimited_parts, reconcile_counts, table, use_all_slots,
                       write_and_read)
from .registry import query, rnd


@query("scan_csv_typed", f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, {rnd('o_totalprice', 2)} AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def scan_csv_typed(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-tsv")
    orders.write.option("sep", "\t").option("header", True).csv(path)
    back = read_delimited(spark, path, orders.schema, sep="\t", as_string=["o_custkey"])
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", tidy("o_totalprice", 2).alias("o_totalprice"),
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("scan_csv_glob", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_csv_glob(spark, sf):
    """Good files plus one file of broken lines (a key that is no number, columns missing)."""
    customer = table(spark, sf, "customer")
    path = scratch_path(spark, "customer-csv")
    use_all_slots(customer).write.option("header", True).csv(path)
    customer.select(F.concat(F.lit("broken"), F.col("c_custkey"), F.lit(",only two"))).write.mode("append").text(path)
    return read_delimited_parts(spark, path, customer.schema, ["c_custkey", "c_name", "c_mktsegment"])


@query("scan_columnar", f"""
SELECT l_orderkey, CAST(l_linenumber AS TINYINT) AS l_linenumber,
       {rnd('CAST(l_extendedprice AS REAL)', 3)} AS price, {rnd('CAST(l_discount AS REAL)', 4)} AS discount FROM lineitem""")
def scan_columnar(spark, sf):
    narrow = read_columnar(spark, f"{sf}/lineitem.parquet", {
        "l_orderkey": "long", "l_linenumber": "byte", "l_extendedprice": "float", "l_discount": "float"})
    return narrow.select("l_orderkey", "l_linenumber", tidy("l_extendedprice", 3).alias("price"),
                         tidy("l_discount", 4).alias("discount"))


@query("sink_table", f"SELECT c_custkey, c_name, c_nationkey, {rnd('c_acctbal', 2)} AS c_acctbal, c_mktsegment FROM customer")
def sink_table(spark, sf):
    stored = write_and_read(table(spark, sf, "customer"), scratch_path(spark, "customer"))
    return stored.withColumn("c_acctbal", tidy("c_acctbal", 2))


@query("row_count_reconcile", "SELECT count(*) + count(*) FILTER (WHERE s_suppkey % 10 = 0) AS n_expected, count(*) AS n_loaded FROM supplier")
def row_count_reconcile(spark, sf):
    """Every tenth supplier is written once more with a key that is no number: those lines are lost in the load."""
    supplier = table(spark, sf, "supplier")
    path = scratch_path(spark, "supplier-csv")
    supplier.write.option("header", True).csv(path)
    broken = supplier.where("s_suppkey % 10 = 0").withColumn("s_suppkey", F.concat(F.lit("no. "), "s_suppkey"))
    broken.write.mode("append").option("header", True).csv(path)
    return reconcile_counts(spark, path, supplier.schema).select("n_expected", "n_loaded")


@query("model_save_load")
def model_save_load(spark, sf):
    """The stored pipeline scores the table exactly as the fitted one would."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler
    data = models.as_features(table(spark, sf, "embeddings"), "embedding")
    fitted = models.fit_pipeline(data, [
        StandardScaler(inputCol="features", outputCol="scaled"),
        KMeans(k=8, seed=models.SEED, featuresCol="scaled", predictionCol="cluster")])
    loaded = models.save_and_load(fitted, scratch_path(spark, "pipeline"))
    return loaded.transform(data).select("vec_id", "cluster")


