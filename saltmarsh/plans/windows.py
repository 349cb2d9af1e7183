"""Windows, time series, splits."""

from pyspark.sql import functions as F

from ..functions.numbers import tidy
from ..operators import timeseries as ts
from ..operators import windows as win
from ..sources import table
from .registry import query, rnd


@query("window_count", """
SELECT event_id, count(*) OVER (PARTITION BY user_id) AS n_user, count(*) OVER (PARTITION BY user_id, date_trunc('hour', ts)) AS n_user_hour
FROM events""")
def window_count(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("hour"))
    counted = win.attach_counts(events, {"n_user": ["user_id"], "n_user_hour": ["user_id", "hour"]})
    return counted.select("event_id", "n_user", "n_user_hour")


@query("cumulative_share_pareto", f"""
WITH r AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1),
c AS (SELECT *, sum(revenue) OVER (ORDER BY revenue DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS cum, sum(revenue) OVER () AS t FROM r)
SELECT o_custkey, {rnd('revenue', 2)} AS revenue, {rnd('cum', 2)} AS cum, {rnd('cum / t')} AS cum_share, CAST(cum < t * 0.8::DOUBLE AS INTEGER) AS in_core FROM c""")
def cumulative_share_pareto(spark, sf):
    revenue = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    out = win.cumulative_share(revenue, "o_custkey", "revenue")
    return out.select("o_custkey", tidy("revenue", 2).alias("revenue"), tidy("cum", 2).alias("cum"), tidy("cum_share", 6).alias("cum_share"), "in_core")


@query("lag_fill", """
SELECT event_id, CAST(lag(CAST(value > 50 AS INTEGER), 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS previous_flag FROM events""")
def lag_fill(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", (F.col("value") > 50).cast("int").alias("flag"))
    return win.previous_flag(events, ["user_id"], ["ts", "event_id"], "flag", "previous_flag").select("event_id", "previous_flag")


EMA_SQL = """WITH RECURSIVE o AS MATERIALIZED (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, i, event_id, value AS e12, value AS e26{s0} FROM o WHERE i = 1
UNION ALL SELECT o.user_id, o.i, o.event_id, r.e12 * (11.0::DOUBLE / 13) + o.value * (2.0::DOUBLE / 13), r.e26 * (25.0::DOUBLE / 27) + o.value * (2.0::DOUBLE / 27){s1}
FROM r JOIN o ON o.user_id = r.user_id AND o.i = r.i + 1)"""
MACD_NEXT = ("((r.e12 * (11.0::DOUBLE / 13) + o.value * (2.0::DOUBLE / 13)) - (r.e26 * (25.0::DOUBLE / 27) + o.value * (2.0::DOUBLE / 27)))")


@query("ema", EMA_SQL.format(s0="", s1="") + f" SELECT event_id, {rnd('e12')} AS ema_12, {rnd('e26')} AS ema_26 FROM r")
def ema(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = ts.ema(events, ["user_id"], ["ts", "event_id"], "value", [12, 26], ["ema_12", "ema_26"])
    return out.select("event_id", tidy("ema_12", 6).alias("ema_12"), tidy("ema_26", 6).alias("ema_26"))


@query("ema_with_gaps", f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT event_id, user_id, CASE WHEN event_id % 7 > 1 THEN value END AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, i, event_id, x AS e, 1.0::DOUBLE AS w FROM o WHERE i = 1
UNION ALL SELECT o.user_id, o.i, o.event_id,
CASE WHEN o.x IS NULL THEN r.e WHEN r.e IS NULL THEN o.x ELSE (r.w * (11.0::DOUBLE / 13) * r.e + (2.0::DOUBLE / 13) * o.x) / (r.w * (11.0::DOUBLE / 13) + 2.0::DOUBLE / 13) END,
CASE WHEN o.x IS NULL THEN r.w * (11.0::DOUBLE / 13) ELSE 1.0::DOUBLE END
FROM r JOIN o ON o.user_id = r.user_id AND o.i = r.i + 1)
SELECT event_id, {rnd('e')} AS ema_12 FROM r""")
def ema_with_gaps(spark, sf):
    """Rows without a value stay, repeat the average so far and age it."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 7 > 1, F.col("value")).alias("x"))
    return ts.ema(events, ["user_id"], ["ts", "event_id"], "x", [12], ["ema_12"]).select("event_id", tidy("ema_12", 6).alias("ema_12"))


@query("macd", EMA_SQL.format(s0=", 0.0::DOUBLE AS sig", s1=f", r.sig * 0.8::DOUBLE + {MACD_NEXT} * 0.2::DOUBLE") + f"""
SELECT event_id, {rnd('e12 - e26')} AS macd, {rnd('sig')} AS macd_signal, {rnd('e12 - e26 - sig')} AS macd_diff FROM r""")
def macd(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = ts.macd(events, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", *[tidy(c, 6).alias(c) for c in ("macd", "macd_signal", "macd_diff")])


@query("top_n_per_group", f"""
SELECT o_custkey, o_orderkey, {rnd('o_totalprice', 2)} AS o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3""")
def top_n_per_group(spark, sf):
    top = win.top_n_per_group(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    return top.select("o_custkey", "o_orderkey", tidy("o_totalprice", 2).alias("o_totalprice"), "rank")


@query("value_at_rank", """
WITH w AS (SELECT count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS n FROM events), r AS (SELECT n, row_number() OVER (ORDER BY n DESC) - 1 AS i FROM w)
SELECT n FROM r WHERE i = (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) FROM events)""")
def value_at_rank(spark, sf):
    events = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    return win.value_at_rank(win.attach_counts(events, {"n": ["user_id", "day"]}), "n", 0.8)


@query("rank_encode", """
WITH m AS (SELECT p_brand, row_number() OVER (ORDER BY round(avg(p_retailprice), 6), p_brand) - 1 AS brand_rank FROM part GROUP BY 1)
SELECT p_partkey, p_brand, brand_rank FROM part JOIN m USING (p_brand)""")
def rank_encode(spark, sf):
    return win.rank_encode(table(spark, sf, "part"), "p_brand", "p_retailprice", "brand_rank").select("p_partkey", "p_brand", "brand_rank")


GROUPS_SQL = """WITH g AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS g, count(*) OVER () AS n FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)),
x AS (SELECT event_id, ts, g, n FROM events JOIN g ON CAST(ts AS DATE) = d), f AS (SELECT CAST(unnest(range({folds})) AS INTEGER) AS fold)"""


def days(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"))


@query("purged_group_split", GROUPS_SQL.format(folds=4) + """, r AS (SELECT f.fold, x.*, least(n // 5, 5) AS sz, n - 4 * least(n // 5, 5) + fold * least(n // 5, 5) AS st FROM x, f),
s AS (SELECT fold, 'train' AS role, event_id, ts FROM r WHERE g >= greatest(0, st - 2 - 12) AND g < st - 2
UNION ALL SELECT fold, 'test', event_id, ts FROM r WHERE g >= st AND g < st + sz)
SELECT fold, role, event_id FROM (SELECT *, row_number() OVER (PARTITION BY fold, role ORDER BY ts, event_id) AS i FROM s) WHERE role = 'train' OR i > 2""")
def purged_group_split(spark, sf):
    return ts.purged_group_split(days(spark, sf), "day", ["ts", "event_id"], n_splits=4, group_gap=2,
                                 max_train_groups=12, max_test_groups=5).select("fold", "role", "event_id")


STACK_SQL = GROUPS_SQL.format(folds=3) + """, a AS (SELECT f.fold, x.*, least(n // 4, 6) AS sz, n - 3 * least(n // 4, 6) + fold * least(n // 4, 6) AS st FROM x, f),
b AS (SELECT *, greatest(8 + 1, st - 2 - 6) AS va FROM a), r AS (SELECT *, greatest(0, va - 1 - 8) AS tr FROM b),
s AS (SELECT fold, 'train' AS role, event_id, ts FROM r WHERE g >= tr AND g < va - 1 UNION ALL SELECT fold, 'val', event_id, ts FROM r WHERE g >= va AND g < st - 2
UNION ALL SELECT fold, 'test', event_id, ts FROM r WHERE g >= st AND g < st + sz)
SELECT fold, role, event_id FROM (SELECT *, row_number() OVER (PARTITION BY fold, role ORDER BY ts, event_id) AS i FROM s)
WHERE role = 'train' OR (role = 'val' AND i > 1) OR (role = 'test' AND i > 2)"""


def stacking_split(df):
    return ts.purged_stacking_split(df, "day", ["ts", "event_id"], n_splits=3, val_gap=1, test_gap=2,
                                    max_train_groups=8, max_val_groups=6, max_test_groups=6)


@query("purged_stacking_split", STACK_SQL)
def purged_stacking_split(spark, sf):
    return stacking_split(days(spark, sf)).select("fold", "role", "event_id")


def near(x):
    return f"(SELECT start FROM starts ORDER BY abs(start - ({x})), start LIMIT 1)"


ALIGNED_SQL = f"""WITH i AS (SELECT event_id, CAST(ts AS DATE) AS d, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx, count(*) OVER () AS n FROM events),
starts AS (SELECT min(idx) AS start FROM i GROUP BY d), k AS (SELECT any_value(n) AS n, CAST(floor((any_value(n) // 5) * 0.7::DOUBLE) + floor((any_value(n) // 5) * 0.3::DOUBLE) AS BIGINT) AS per FROM i),
f AS (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold), a AS (SELECT fold, n, {near('fold * per')} AS a FROM f, k),
z AS (SELECT *, coalesce(lead(a) OVER (ORDER BY fold), n - 1) AS z FROM a),
c AS (SELECT *, {near('floor((z.z - z.a) * 0.7::DOUBLE + z.a)')} AS c FROM z), b AS (SELECT *, {near('floor((c.c - c.a) * 0.2::DOUBLE + c.a)')} AS b FROM c)"""


@query("fold_table_date_aligned", ALIGNED_SQL + """
SELECT event_id, fold, CASE WHEN idx < b THEN 'train1' WHEN idx < c THEN 'train2' ELSE 'test' END AS part FROM i JOIN b ON idx >= a AND idx < z""")
def fold_table_date_aligned(spark, sf):
    return ts.aligned_fold_table(table(spark, sf, "events").select("event_id", "ts"), F.to_date("ts"), ["ts", "event_id"]).select(
        "event_id", "fold", "part")


@query("expanding_time_split", """
WITH i AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx, count(*) OVER () AS n FROM events),
r AS (SELECT fold, event_id, idx, n - 5 * (n // 6) + fold * (n // 6) AS lo, n // 6 AS sz FROM i, (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold))
SELECT fold, CASE WHEN idx < lo THEN 'train' ELSE 'test' END AS role, event_id FROM r WHERE idx < lo + sz""")
def expanding_time_split(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return ts.expanding_time_split(events, ["ts", "event_id"], 5).select("fold", "role", "event_id")


@query("minibatch_ranges", f"""
WITH i AS (SELECT value, (row_number() OVER (ORDER BY ts, event_id) - 1) // 300 AS batch FROM events),
p AS (SELECT batch, count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM i GROUP BY 1),
c AS (SELECT batch, n, CAST(sum(n) OVER w AS BIGINT) AS cn, sum(s) OVER w AS cs, sum(q) OVER w AS cq FROM p WINDOW w AS (ORDER BY batch))
SELECT batch, n, cn AS n_prefix, {rnd('cs / cn')} AS prefix_mean, {rnd('sqrt(cq / cn - (cs / cn) * (cs / cn))')} AS prefix_rmse FROM c""")
def minibatch_ranges(spark, sf):
    curve = ts.learning_curve(table(spark, sf, "events").select("event_id", "ts", "value"), ["ts", "event_id"], 300, "value")
    return curve.select("batch", "n", "n_prefix", tidy("prefix_mean", 6).alias("prefix_mean"), tidy("prefix_rmse", 6).alias("prefix_rmse"))
