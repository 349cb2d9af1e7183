"""Aggregations, profiles, customer roll-up."""

from pyspark.sql import functions as F

from ..functions.numbers import cut_fixed, tidy
from ..operators import aggregate as agg
from ..operators import stats
from ..operators.windows import top_value_flag
from ..sources import table
from .registry import query, rnd


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf):
    return agg.value_counts(table(spark, sf, "events"), "event_type")


@query("group_agg", f"""
SELECT l_returnflag, {rnd('avg(l_extendedprice)', 4)} AS mean_price, {rnd('sum(l_quantity)', 2)} AS sum_qty,
       {rnd('stddev_samp(l_extendedprice)', 4)} AS std_price, {rnd('min(l_extendedprice)', 2)} AS min_price,
       first_part FROM lineitem JOIN (SELECT l_returnflag, arg_min(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS first_part
       FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY l_returnflag, first_part""")
def group_agg(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        tidy(F.avg("l_extendedprice"), 4).alias("mean_price"), tidy(F.sum("l_quantity"), 2).alias("sum_qty"),
        tidy(F.stddev_samp("l_extendedprice"), 4).alias("std_price"), tidy(F.min("l_extendedprice"), 2).alias("min_price"),
        F.min_by("l_partkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")).alias("first_part"))


@query("group_agg_multi_top", f"""
SELECT l_suppkey, l_returnflag, {rnd('avg(l_extendedprice)', 4)} AS mean_price FROM lineitem
GROUP BY 1, 2 ORDER BY avg(l_extendedprice) DESC, 1, 2 LIMIT 10""")
def group_agg_multi_top(spark, sf):
    means = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.avg("l_extendedprice").alias("m"))
    return means.orderBy(F.desc("m"), "l_suppkey", "l_returnflag").limit(10).select(
        "l_suppkey", "l_returnflag", tidy("m", 4).alias("mean_price"))


@query("nested_agg", f"""
SELECT {rnd('avg(s)', 4)} AS mean_all, {rnd('avg(f)', 4)} AS mean_final FROM (
  SELECT o_custkey, sum(o_totalprice) AS s, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)""")
def nested_agg(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("s"), F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("f"))
    return per.agg(tidy(F.avg("s"), 4).alias("mean_all"), tidy(F.avg("f"), 4).alias("mean_final"))


@query("std_of_group_means", f"""
SELECT {rnd('stddev_samp(m)', 4)} AS std_of_means FROM (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY 1)""")
def std_of_group_means(spark, sf):
    means = table(spark, sf, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m"))
    return means.agg(tidy(F.stddev_samp("m"), 4).alias("std_of_means"))


@query("count_distinct", """
SELECT count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem""")
def count_distinct(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.countDistinct("l_orderkey").alias("n_orders"), F.countDistinct("l_partkey").alias("n_parts"),
        F.countDistinct("l_suppkey").alias("n_suppliers"))


PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_skew", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, {rnd(f'avg({c})', 5)} AS mean, {rnd(f'stddev_samp({c})', 5)} AS std,
  {rnd(f'min({c})', 5)} AS min, {rnd(f'quantile_cont({c}, 0.25)', 5)} AS q1, {rnd(f'quantile_cont({c}, 0.5)', 5)} AS median,
  {rnd(f'quantile_cont({c}, 0.75)', 5)} AS q3, {rnd(f'max({c})', 5)} AS max, {rnd(f'skewness({c})', 5)} AS skew FROM lineitem""" for c in PROFILED))
def describe_skew(spark, sf):
    d = stats.describe(table(spark, sf, "lineitem"), PROFILED)
    return d.select("column", "n", *[tidy(c, 5).alias(c) for c in ("mean", "std", "min", "q1", "median", "q3", "max", "skew")])


NULLS_SQL = """WITH t AS (SELECT d.doc_id, d.lang, l.quality, l.toxic, CASE WHEN l.toxic = 1 THEN l.quality END AS toxic_quality
FROM documents d LEFT JOIN labels l USING (doc_id))"""


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.withColumn("toxic_quality", F.when(F.col("toxic") == 1, F.col("quality")))


@query("completeness", NULLS_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, {rnd(f'count({c}) * 100.0 / count(*)', 5)} AS percent_complete FROM t""" for c in
                                                     ("doc_id", "lang", "quality", "toxic", "toxic_quality")))
def completeness(spark, sf):
    return stats.completeness(labelled(spark, sf)).withColumn("percent_complete", tidy("percent_complete", 5))


@query("missing_over_threshold", NULLS_SQL + """, s AS (SELECT 'quality' AS c, avg(CAST(quality IS NULL AS DOUBLE)) AS m FROM t
UNION ALL SELECT 'toxic', avg(CAST(toxic IS NULL AS DOUBLE)) FROM t UNION ALL SELECT 'toxic_quality', avg(CAST(toxic_quality IS NULL AS DOUBLE)) FROM t
UNION ALL SELECT 'doc_id', 0 UNION ALL SELECT 'lang', 0)
SELECT round(avg(CAST(m > 0.7 AS DOUBLE)) * 100, 2) AS percent_columns, string_agg(c, ',' ORDER BY c) FILTER (m > 0.7) AS columns FROM s""")
def missing_over_threshold(spark, sf):
    c = stats.completeness(labelled(spark, sf))
    sparse = F.col("percent_complete") < 30
    names = F.sort_array(F.collect_list(F.when(sparse, F.col("column_name"))))  # one entry per column
    return c.agg(F.round(F.avg(sparse.cast("double")) * 100, 2).alias("percent_columns"),
                 F.array_join(names, ",").alias("columns"))


@query("compare_nulls", NULLS_SQL + """
SELECT round(avg(CAST(quality IS NOT NULL AND toxic_quality IS NULL AS DOUBLE)) * 100, 5) AS only_a,
       round(avg(CAST(quality IS NULL AND toxic_quality IS NOT NULL AS DOUBLE)) * 100, 5) AS only_b,
       round(avg(CAST(quality IS NOT NULL AND toxic_quality IS NOT NULL AS DOUBLE)) * 100, 5) AS both FROM t""")
def compare_nulls(spark, sf):
    return agg.compare_nulls(labelled(spark, sf), "quality", "toxic_quality")


def bin_sql(bins):
    return f"""b AS (SELECT o_orderkey, o_totalprice, CAST(least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / {bins})), 1), {bins}) AS INTEGER) AS bin
FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders))"""


@query("freq_table_binned", f"""
WITH {bin_sql(50)}, c AS (SELECT k.bin, count(b.bin) AS n FROM (SELECT CAST(unnest(range(1, 51)) AS INTEGER) AS bin) k LEFT JOIN b USING (bin) GROUP BY 1)
SELECT bin, n, {rnd('n / CAST((SELECT count(*) FROM orders) AS DOUBLE)')} AS freq,
  {rnd('sum(n) OVER (ORDER BY bin) / CAST((SELECT count(*) FROM orders) AS DOUBLE)')} AS cum_freq FROM c""")
def freq_table_binned(spark, sf):
    t = agg.frequency_table(table(spark, sf, "orders"), "o_totalprice", 50)
    return t.select("bin", "n", tidy("freq", 6).alias("freq"), tidy("cum_freq", 6).alias("cum_freq"))


@query("histogram_custom", """
SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN value > 0 AND value <= 10 THEN 1 WHEN value > 10 AND value <= 25 THEN 2
  WHEN value > 25 AND value <= 50 THEN 3 WHEN value > 50 AND value <= 100 THEN 4 WHEN value > 100 AND value <= 200 THEN 5 END AS bucket
  FROM events) WHERE bucket IS NOT NULL GROUP BY 1""")
def histogram_custom(spark, sf):
    return stats.histogram(table(spark, sf, "events"), cut_fixed(F.col("value"), [0, 10, 25, 50, 100, 200], [1, 2, 3, 4, 5]))


@query("group_by_time_bucket", """
SELECT event_type, CAST(d // 7 AS INTEGER) AS bucket, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT event_type, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS d, count(*) AS n FROM events GROUP BY 1, 2)
GROUP BY 1, 2""")
def group_by_time_bucket(spark, sf):
    """Counts per type and day, then summed in bins of seven days from the first day."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    first = events.agg(F.min("day").alias("d")).scalar()
    daily = events.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return daily.groupBy("event_type", F.floor(F.datediff("day", first) / 7).cast("int").alias("bucket")).agg(F.sum("n").alias("n"))


@query("crosstab_margins", """
SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'All' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def crosstab_margins(spark, sf):
    return agg.crosstab_with_margins(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("chi2_contributions", f"""
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT o_orderstatus, sum(n) AS rt FROM c GROUP BY 1), k AS (SELECT o_orderpriority, sum(n) AS ct FROM c GROUP BY 1),
g AS (SELECT o_orderstatus, o_orderpriority, coalesce(n, 0) AS obs, CAST(rt AS DOUBLE) * ct / (SELECT sum(n) FROM c) AS expected
  FROM r CROSS JOIN k LEFT JOIN c USING (o_orderstatus, o_orderpriority))
SELECT o_orderstatus, o_orderpriority, obs, {rnd('expected')} AS expected,
  {rnd('pow(obs - expected, 2) / expected / sum(pow(obs - expected, 2) / expected) OVER ()')} AS share FROM g""")
def chi2_contributions(spark, sf):
    t = agg.chi2_contributions(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    return t.select("o_orderstatus", "o_orderpriority", "obs", tidy("expected", 6).alias("expected"), tidy("share", 6).alias("share"))


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_pearson", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})')} AS r FROM lineitem"
    for i, a in enumerate(CORR) for b in CORR[i + 1:]))
def corr_pearson(spark, sf):
    return stats.correlation_pairs(table(spark, sf, "lineitem"), CORR).withColumn("r", tidy("r", 6))


@query("corr_spearman", f"""
WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0 AS b FROM part)
SELECT {rnd('corr(a, b)')} AS rho FROM r""")
def corr_spearman(spark, sf):
    return stats.spearman(table(spark, sf, "part"), "p_size", "p_retailprice").select(tidy("rho", 6).alias("rho"))


PROBS = [0.01, 0.25, 0.5, 0.8, 0.99]


@query("quantiles_exact", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, {rnd(f'quantile_cont(l_extendedprice, {p})', 4)} AS q FROM lineitem" for p in PROBS))
def quantiles_exact(spark, sf):
    q = stats.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", PROBS)
    pairs = F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in PROBS]).alias("p"), F.col("q")))
    return q.select(pairs.alias("x")).select("x.p", tidy("x.q", 4).alias("q"))


@query("boxplot_stats", f"""
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT o_orderpriority, {rnd('any_value(q1)', 4)} AS q1, {rnd('any_value(median)', 4)} AS median, {rnd('any_value(q3)', 4)} AS q3, {rnd('any_value(q3 - q1)', 4)} AS iqr,
  {rnd('min(o_totalprice) FILTER (o_totalprice >= q1 - 1.5 * (q3 - q1))', 2)} AS whisker_low,
  {rnd('max(o_totalprice) FILTER (o_totalprice <= q3 + 1.5 * (q3 - q1))', 2)} AS whisker_high
FROM orders JOIN q USING (o_orderpriority) GROUP BY 1""")
def boxplot_stats(spark, sf):
    b = agg.boxplot_stats(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return b.select("o_orderpriority", *[tidy(c, 4).alias(c) for c in ("q1", "median", "q3", "iqr")],
                    *[tidy(c, 2).alias(c) for c in ("whisker_low", "whisker_high")])


@query("mode_per_key", """
SELECT p_brand, p_type AS mode, n FROM (SELECT p_brand, p_type, count(*) AS n,
  row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS r FROM part GROUP BY 1, 2) WHERE r = 1""")
def mode_per_key(spark, sf):
    return agg.mode_per_key(table(spark, sf, "part"), "p_brand", "p_type")


@query("inconsistent_keys", """
SELECT p_name, count(DISTINCT p_brand) AS n_values FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""")
def inconsistent_keys(spark, sf):
    return agg.inconsistent_keys(table(spark, sf, "part"), "p_name", "p_brand")


@query("gini", f"""
WITH c AS (SELECT o_custkey, round(sum(o_totalprice), 2) + 1e-7::DOUBLE AS x FROM orders GROUP BY 1),
r AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM c)
SELECT {rnd('sum((2 * i - n - 1) * x) / (any_value(n) * sum(x))')} AS gini FROM r""")
def gini(spark, sf):
    revenue = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("x"))
    return stats.gini(revenue, "x").select(tidy("gini", 6).alias("gini"))


@query("gini_entropy_by_group", f"""
WITH r AS (SELECT l_returnflag, l_extendedprice AS p, l_extendedprice + 1e-7::DOUBLE AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS i,
  count(*) OVER (PARTITION BY l_returnflag) AS n, sum(l_extendedprice) OVER (PARTITION BY l_returnflag) AS t FROM lineitem),
g AS (SELECT l_returnflag, sum((2 * i - n - 1) * x) / (any_value(n) * sum(x)) AS gini, sum(-p / t * ln(p / t)) AS entropy FROM r GROUP BY 1)
SELECT l_returnflag, {rnd('gini')} AS gini, {rnd('entropy')} AS entropy FROM g
UNION ALL SELECT 'mean', {rnd('avg(gini)')}, {rnd('avg(entropy)')} FROM g""")
def gini_entropy_by_group(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    by = ["l_returnflag"]
    both = stats.gini(lines, "l_extendedprice", by).join(stats.entropy(lines, "l_extendedprice", by), by)
    mean = both.agg(F.lit("mean").alias("l_returnflag"), F.avg("gini").alias("gini"), F.avg("entropy").alias("entropy"))
    return both.unionByName(mean).select("l_returnflag", tidy("gini", 6).alias("gini"), tidy("entropy", 6).alias("entropy"))


@query("share_of_total", f"SELECT {rnd('avg(CAST(o_totalprice > 250000 AS DOUBLE)) * 100')} AS percent FROM orders")
def share_of_total(spark, sf):
    return table(spark, sf, "orders").agg(tidy(F.avg((F.col("o_totalprice") > 250000).cast("double")) * 100, 6).alias("percent"))


ROLLUP_SQL = """WITH lines AS (SELECT o_custkey, o_orderdate, o_orderstatus = 'P' AS bad, l_partkey, l_quantity, l_extendedprice, l_returnflag
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
best AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY sum(l_extendedprice) DESC, l_partkey LIMIT 20),
agg AS (SELECT o_custkey, CAST(max(CAST(bad AS INTEGER)) AS INTEGER) AS has_ever_cancelled,
  CAST(max(CAST(l_partkey IN (SELECT l_partkey FROM best) AS INTEGER)) AS INTEGER) AS bought_top_product,
  greatest((epoch((SELECT max(o_orderdate) FROM lines)) - epoch(min(o_orderdate) FILTER (NOT bad))) / (86400 * 30.436875::DOUBLE), 1.0::DOUBLE) AS months_active,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) FILTER (NOT bad) AS DOUBLE) AS amount, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) FILTER (NOT bad) AS DOUBLE) AS quantity,
  CAST(max(CAST(l_returnflag = 'R' AND NOT bad AS INTEGER)) AS INTEGER) AS had_return
  FROM lines WHERE l_partkey NOT IN (1, 2, 3) GROUP BY 1 HAVING count(*) FILTER (NOT bad) > 0),
rolled AS (SELECT o_custkey, has_ever_cancelled, bought_top_product, had_return, months_active, amount / months_active AS price_per_month,
  quantity / months_active AS quantity_per_month FROM agg),
q AS (SELECT quantile_cont(months_active, [0.25, 0.5, 0.75]) AS qr, quantile_cont(quantity_per_month, [0.25, 0.5, 0.75]) AS qf,
  quantile_cont(price_per_month, [0.25, 0.5, 0.75]) AS qm FROM rolled),
scored AS (SELECT *, r + f + m AS rfm_score FROM (SELECT rolled.*,
  CASE WHEN months_active <= qr[1] THEN 1 WHEN months_active <= qr[2] THEN 2 WHEN months_active <= qr[3] THEN 3 ELSE 4 END AS r,
  CASE WHEN quantity_per_month <= qf[1] THEN 4 WHEN quantity_per_month <= qf[2] THEN 3 WHEN quantity_per_month <= qf[3] THEN 2 ELSE 1 END AS f,
  CASE WHEN price_per_month <= qm[1] THEN 4 WHEN price_per_month <= qm[2] THEN 3 WHEN price_per_month <= qm[3] THEN 2 ELSE 1 END AS m
  FROM rolled, q))"""


def rolled_customers(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    lines = top_value_flag(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"),
                           "l_partkey", F.col("l_extendedprice"), 20, "is_top")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return agg.customer_rollup(
        joined, customer="o_custkey", when="o_orderdate", amount="l_extendedprice", quantity="l_quantity",
        cancelled=F.col("o_orderstatus") == "P", top_product=F.col("is_top") == 1,
        generic_product=F.col("l_partkey").isin(1, 2, 3), presence={"had_return": F.col("l_returnflag") == "R"})


def tidy_rolled(df):
    for c in ("months_active", "price_per_month", "quantity_per_month"):
        df = df.withColumn(c, tidy(c, 8))
    return df


ROLLED = f"""o_custkey, has_ever_cancelled, bought_top_product, had_return, {rnd('months_active', 8)} AS months_active,
{rnd('price_per_month', 8)} AS price_per_month, {rnd('quantity_per_month', 8)} AS quantity_per_month"""


@query("customer_rollup", ROLLUP_SQL + f" SELECT {ROLLED} FROM rolled")
def customer_rollup(spark, sf):
    return tidy_rolled(rolled_customers(spark, sf))


@query("rfm_score", ROLLUP_SQL + f" SELECT {ROLLED}, r, f, m, rfm_score FROM scored")
def rfm_score(spark, sf):
    return tidy_rolled(agg.rfm_score(rolled_customers(spark, sf)))


@query("customer_value_report", ROLLUP_SQL + f""", v AS (SELECT o_custkey, rfm_score, {rnd('price_per_month', 4)} AS price FROM scored),
c AS (SELECT *, sum(price) OVER (ORDER BY price DESC, o_custkey) AS cum, sum(price) OVER () AS t FROM v)
SELECT o_custkey, rfm_score, price, {rnd('cum / t', 5)} AS cum_share, CAST(cum < t * 0.8::DOUBLE AS INTEGER) AS in_core FROM c""")
def customer_value_report(spark, sf):
    """RFM score of every customer with the cumulative share of monthly revenue."""
    from ..operators.windows import cumulative_share
    scored = agg.rfm_score(rolled_customers(spark, sf)).select("o_custkey", "rfm_score", tidy("price_per_month", 4).alias("price"))
    share = cumulative_share(scored, "o_custkey", "price").drop("price", "cum")
    return scored.join(share, "o_custkey").select("o_custkey", "rfm_score", "price", tidy("cum_share", 5).alias("cum_share"), "in_core")


@query("utility_score", f"""
WITH m AS (SELECT event_type, avg(value) AS a FROM events GROUP BY 1),
d AS (SELECT CAST(ts AS DATE) AS day, sum(CASE WHEN event_type = 'purchase' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END * (value - a)
  * CAST(CAST(props->>'$.k' AS INTEGER) >= 40 AND value > 40 AS INTEGER)) AS p FROM events JOIN m USING (event_type) GROUP BY 1),
s AS (SELECT count(*) AS d, sum(p) AS p, sum(p * p) AS pp FROM d), t AS (SELECT d, p, CASE WHEN pp = 0 THEN 0 ELSE p / sqrt(pp) * sqrt(250.0::DOUBLE / d) END AS t FROM s)
SELECT d, {rnd('p', 4)} AS p, {rnd('t', 6)} AS t, {rnd('least(greatest(t, 0), 6) * p', 4)} AS u FROM t""")
def utility_score(spark, sf):
    events = table(spark, sf, "events")
    means = events.groupBy("event_type").agg(F.avg("value").alias("a"))
    rows = events.join(means, "event_type")
    action = ((F.get_json_object("props", "$.k").cast("int") >= 40) & (F.col("value") > 40)).cast("int")
    u = agg.utility_score(rows, F.to_date("ts"), F.when(F.col("event_type") == "purchase", 2.0).otherwise(1.0), F.col("value") - F.col("a"), action)
    return u.select("d", tidy("p", 4).alias("p"), tidy("t", 6).alias("t"), tidy("u", 4).alias("u"))


@query("duplicates_report", """
SELECT doc_id, lang, source FROM documents WHERE text IN (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def duplicates_report(spark, sf):
    return agg.repeated_rows(table(spark, sf, "documents"), ["text"]).select("doc_id", "lang", "source")
