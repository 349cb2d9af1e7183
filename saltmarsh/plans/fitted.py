"""Fitted on some rows, applied to others: every query learns from one part of a table and transforms the rest."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ..functions.numbers import tidy
from ..operators import fitted
from ..session import scratch_path
from ..sources import table, use_all_slots
from .aggregations import ROLLED, tidy_rolled
from .registry import query, rnd


def saved(spark, model):
    """The model after a round trip through the shared folder."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def fit_apply(spark, stages, train, rest):
    return saved(spark, Pipeline(stages=stages).fit(train)).transform(rest)


@query("one_hot_fitted", """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def one_hot_fitted(spark, sf):
    """Categories learned from the orders before 2000."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    out = fit_apply(spark, [fitted.OneHot(["o_orderstatus"])], orders.where("o_orderdate < timestamp '2000-01-01'"),
                    orders.where("o_orderdate >= timestamp '2000-01-01'"))
    return out.drop("o_orderdate")


@query("rank_encode_fitted", """
WITH m AS (SELECT p_brand, row_number() OVER (ORDER BY avg(p_retailprice), p_brand) - 1 AS r FROM part WHERE p_size <= 25 GROUP BY 1)
SELECT p_partkey, r AS p_brand FROM part LEFT JOIN m USING (p_brand) WHERE p_size > 25""")
def rank_encode_fitted(spark, sf):
    """Brands ranked by the mean price of the small parts."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    return fit_apply(spark, [fitted.MeanRank(["p_brand"], "p_retailprice")], part.where("p_size <= 25"), part.where("p_size > 25")).select("p_partkey", "p_brand")


@query("rare_to_other_fitted", """
WITH c AS (SELECT p_name, count(*) AS n FROM part WHERE p_size <= 25 GROUP BY 1), k AS (SELECT p_name, sum(n) OVER (ORDER BY n DESC, p_name ROWS UNBOUNDED PRECEDING)
  / CAST((SELECT sum(n) FROM c) AS DOUBLE) * 100 AS cum FROM c)
SELECT p_partkey, CASE WHEN cum < 80 THEN p_name ELSE 'OTHERS' END AS p_name FROM part LEFT JOIN k USING (p_name) WHERE p_size > 25""")
def rare_to_other_fitted(spark, sf):
    """Names that make up less than 80 percent of the small parts stay."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    return fit_apply(spark, [fitted.RareToOther(["p_name"], 80.0)], part.where("p_size <= 25"), part.where("p_size > 25")).select("p_partkey", "p_name")


@query("bag_of_words_fitted", r"""
WITH t AS (SELECT doc_id, source, word, count(*) AS n FROM (SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents) GROUP BY 1, 2, 3),
v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS position FROM t WHERE source = 'src0' GROUP BY 1
  HAVING count(*) >= (SELECT count(*) FROM documents WHERE source = 'src0') * 0.02::DOUBLE)
SELECT doc_id, word, position, n FROM t JOIN v USING (word) WHERE source <> 'src0'""")
def bag_of_words_fitted(spark, sf):
    """The vocabulary of one source counted in the texts of all others."""
    docs = use_all_slots(table(spark, sf, "documents").select("doc_id", "source", "text"))
    model = saved(spark, Pipeline(stages=[fitted.BagOfWords("text", "doc_id", 0.02)]).fit(docs.where("source = 'src0'")))
    return model.stages[0].long(docs.where("source <> 'src0'"), "doc_id")


@query("label_index_inverse", """
WITH l AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM events WHERE ts < TIMESTAMP '2024-01-15'))
SELECT event_id, code, event_type AS label, CAST(NULL AS VARCHAR) AS unknown FROM events LEFT JOIN l USING (event_type) WHERE ts >= TIMESTAMP '2024-01-15'""")
def label_index_inverse(spark, sf):
    """Codes learned from the first half of the month, and back to the labels; a code never given has none."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    model = saved(spark, Pipeline(stages=[fitted.LabelIndex("event_type")]).fit(events.where("ts < timestamp '2024-01-15'")))
    coded = model.transform(events.where("ts >= timestamp '2024-01-15'")).drop("event_type")
    back = model.stages[0].inverse(coded, "code", "label").withColumn("far", F.col("code") + 1000)
    return model.stages[0].inverse(back, "far", "unknown").select("event_id", "code", "label", "unknown")


@query("fill_scale_fitted", f"""
WITH g AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS p FROM lineitem),
s AS (SELECT avg(p) AS a, min(l_quantity) AS lo, max(l_quantity) AS hi, min(p) AS plo, max(p) AS phi FROM g WHERE l_shipdate < TIMESTAMP '2000-01-01')
SELECT l_orderkey, l_linenumber, {rnd('(l_quantity - lo) / (hi - lo)')} AS l_quantity, {rnd('(coalesce(p, a) - plo) / (phi - plo)')} AS l_extendedprice
FROM g, s WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def fill_scale_fitted(spark, sf):
    """Means and ranges of the lines shipped before 2000, in a stored pipeline, fill and scale the later ones."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", F.when(
        F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("l_extendedprice"))
    columns = ["l_quantity", "l_extendedprice"]
    out = fit_apply(spark, [fitted.Fill(columns), fitted.Scale(columns, "minmax")], lines.where("l_shipdate < timestamp '2000-01-01'"),
                    lines.where("l_shipdate >= timestamp '2000-01-01'"))
    return out.select("l_orderkey", "l_linenumber", *[tidy(c, 6).alias(c) for c in columns])


SEGMENT_SQL = """WITH lines AS (SELECT o_custkey, o_orderdate, o_orderstatus = 'P' AS bad, l_partkey, l_quantity, l_extendedprice, l_returnflag
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
best AS (SELECT l_partkey FROM lines WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,4))) DESC, l_partkey LIMIT 20),
cust AS (SELECT t.late, o_custkey, CAST(max(CAST(bad AS INTEGER)) AS INTEGER) AS has_ever_cancelled,
  CAST(max(CAST(l_partkey IN (SELECT l_partkey FROM best) AS INTEGER)) AS INTEGER) AS bought_top_product,
  greatest((epoch((SELECT max(o_orderdate) FROM lines WHERE o_orderdate < TIMESTAMP '2000-01-01')) - epoch(min(o_orderdate) FILTER (NOT bad))) / (86400 * 30.436875::DOUBLE), 1.0::DOUBLE) AS months_active,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) FILTER (NOT bad) AS DOUBLE) AS amount, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) FILTER (NOT bad) AS DOUBLE) AS quantity,
  CAST(max(CAST(l_returnflag = 'R' AND NOT bad AS INTEGER)) AS INTEGER) AS had_return
  FROM lines JOIN (VALUES (true), (false)) t(late) ON t.late OR o_orderdate < TIMESTAMP '2000-01-01' WHERE l_partkey NOT IN (1, 2, 3) GROUP BY 1, 2 HAVING count(*) FILTER (NOT bad) > 0),
rolled AS (SELECT late, o_custkey, has_ever_cancelled, bought_top_product, had_return, months_active, amount / months_active AS price_per_month,
  quantity / months_active AS quantity_per_month FROM cust),
q AS (SELECT quantile_cont(months_active, [0.25, 0.5, 0.75]) AS qr, quantile_cont(quantity_per_month, [0.25, 0.5, 0.75]) AS qf,
  quantile_cont(price_per_month, [0.25, 0.5, 0.75]) AS qm FROM rolled WHERE NOT late),
scored AS (SELECT *, r + f + m AS rfm_score FROM (SELECT rolled.*,
  CASE WHEN months_active <= qr[1] THEN 1 WHEN months_active <= qr[2] THEN 2 WHEN months_active <= qr[3] THEN 3 ELSE 4 END AS r,
  CASE WHEN quantity_per_month <= qf[1] THEN 4 WHEN quantity_per_month <= qf[2] THEN 3 WHEN quantity_per_month <= qf[3] THEN 2 ELSE 1 END AS f,
  CASE WHEN price_per_month <= qm[1] THEN 4 WHEN price_per_month <= qm[2] THEN 3 WHEN price_per_month <= qm[3] THEN 2 ELSE 1 END AS m
  FROM rolled, q WHERE late))"""


def invoice_lines(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("l_orderkey", "o_orderkey")


def stored_lines(spark, sf):
    """The invoice lines joined once and stored by column; fitting and scoring read them several times."""
    path = scratch_path(spark, "invoice-lines")
    invoice_lines(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def segmentation_stages():
    return [fitted.CustomerRollup(customer="o_custkey", when="o_orderdate", amount="l_extendedprice", quantity="l_quantity", product="l_partkey",
                                  cancelled="o_orderstatus = 'P'", generic="l_partkey in (1, 2, 3)", presence={"had_return": "l_returnflag = 'R'"}),
            fitted.Rfm()]


@query("rfm_fitted", SEGMENT_SQL + f" SELECT {ROLLED}, r, f, m, rfm_score FROM scored")
def rfm_fitted(spark, sf):
    """Last date, best products and quartiles of the years before 2000 score the customers of all years."""
    lines = stored_lines(spark, sf)
    return tidy_rolled(fit_apply(spark, segmentation_stages(), lines.where("o_orderdate < timestamp '2000-01-01'"), lines))


@query("segmentation_pipeline")
def segmentation_pipeline(spark, sf):
    """From invoice lines to a cluster per customer: roll-up, RFM, min-max scale, k-means, in one stored pipeline."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    columns = ["months_active", "price_per_month", "quantity_per_month", "rfm_score"]
    stages = [*segmentation_stages(), fitted.Scale(columns, "minmax"), VectorAssembler(inputCols=columns, outputCol="features"),
              KMeans(k=5, seed=42, featuresCol="features", predictionCol="segment")]
    lines = stored_lines(spark, sf)
    return fit_apply(spark, stages, lines.where("o_orderdate < timestamp '2000-01-01'"), lines).select("o_custkey", "segment")
