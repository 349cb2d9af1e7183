"""Evaluation metrics, neighbour predictions, stream scoring."""

from pyspark.sql import functions as F

from ..functions.numbers import sigmoid, three_way, tidy
from ..operators import knn
from ..operators import metrics as met
from ..operators.linear import weighted_line
from ..operators.ordering import attach_groups
from ..session import scratch_path
from ..sources import table
from ..streaming.scoring import stream_score as score_stream
from .joins import E_SQL, EUCLIDEAN, NN_SQL, neighbors
from .registry import query, rnd

RESIDUAL_SQL = """WITH m AS (SELECT l_returnflag, avg(l_extendedprice) AS p FROM lineitem GROUP BY 1),
e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y, p, abs(l_extendedprice - p) AS a FROM lineitem JOIN m USING (l_returnflag))"""


def predicted(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    return met.with_group_mean(lines, "l_returnflag", "l_extendedprice")


@query("rmse_mae", RESIDUAL_SQL + f" SELECT {rnd('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse, {rnd('avg(a)', 4)} AS mae FROM e")
def rmse_mae(spark, sf):
    return met.rmse_mae(predicted(spark, sf), "l_extendedprice", "prediction").select(tidy("rmse", 4).alias("rmse"), tidy("mae", 4).alias("mae"))


@query("residual_weights", RESIDUAL_SQL + f"""
SELECT l_orderkey, l_linenumber, l_partkey, {rnd('((SELECT max(a) FROM e) - a) / (SELECT max(a) FROM e)')} AS weight FROM e WHERE ((SELECT max(a) FROM e) - a) / (SELECT max(a) FROM e) > 0.5""")
def residual_weights(spark, sf):
    w = met.residual_weights(predicted(spark, sf), "l_extendedprice", "prediction", 0.5)
    return w.select("l_orderkey", "l_linenumber", "l_partkey", tidy("weight", 6).alias("weight"))


@query("residual_refit", RESIDUAL_SQL + f""", w AS (SELECT y, l_partkey, l_quantity AS x, ((SELECT max(a) FROM e) - a) / (SELECT max(a) FROM e) AS w
  FROM e JOIN lineitem USING (l_orderkey, l_linenumber, l_partkey) WHERE ((SELECT max(a) FROM e) - a) / (SELECT max(a) FROM e) > 0.5),
s AS (SELECT count(*) AS n, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w),
f AS (SELECT n, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope, sw, sx, sy FROM s)
SELECT n, {rnd('slope', 4)} AS slope, {rnd('(sy - slope * sx) / sw', 3)} AS intercept FROM f""")
def residual_refit(spark, sf):
    """A line fitted anew to the rows with small residuals, weighted by how small they are."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    kept = met.residual_weights(predicted(spark, sf), "l_extendedprice", "prediction", 0.5)
    fit = weighted_line(kept.join(table(spark, sf, "lineitem").select(*keys, "l_quantity"), keys), "l_quantity", "l_extendedprice", "weight")
    return fit.select("n", tidy("slope", 4).alias("slope"), tidy("intercept", 3).alias("intercept"))


CUT_SQL = RESIDUAL_SQL + ", q AS (SELECT quantile_cont(a, 0.8) AS c FROM e)"


@query("error_percent_threshold", CUT_SQL + f" SELECT {rnd('100 * avg(CAST(a < 15000 AS DOUBLE))', 5)} AS percent_below FROM e, q WHERE a <= c")
def error_percent_threshold(spark, sf):
    return met.error_cut(predicted(spark, sf), "l_extendedprice", "prediction", 0.8, 15000).select(tidy("percent_below", 5).alias("percent_below"))


@query("error_best_mean", CUT_SQL + f" SELECT {rnd('avg(a)', 4)} AS best_mean FROM e, q WHERE a <= c")
def error_best_mean(spark, sf):
    return met.error_cut(predicted(spark, sf), "l_extendedprice", "prediction", 0.8, 15000).select(tidy("best_mean", 4).alias("best_mean"))


@query("error_worst_mean", CUT_SQL + f" SELECT {rnd('avg(a)', 4)} AS worst_mean FROM e, q WHERE a > c")
def error_worst_mean(spark, sf):
    return met.error_cut(predicted(spark, sf), "l_extendedprice", "prediction", 0.8, 15000).select(tidy("worst_mean", 4).alias("worst_mean"))


RULES_SQL = r"""WITH t AS (SELECT doc_id, quality, toxic, CAST(n_chars > 200 AS INTEGER) AS quality_rule, CAST(regexp_matches(text, '(?i)password|license|th') AS INTEGER) AS toxic_rule FROM documents JOIN labels USING (doc_id)),
c AS (SELECT 'quality' AS label, count(*) FILTER (quality = 1 AND quality_rule = 1) AS tp, count(*) FILTER (quality = 0 AND quality_rule = 1) AS fp, count(*) FILTER (quality = 1 AND quality_rule = 0) AS fn FROM t
UNION ALL SELECT 'toxic', count(*) FILTER (toxic = 1 AND toxic_rule = 1), count(*) FILTER (toxic = 0 AND toxic_rule = 1), count(*) FILTER (toxic = 1 AND toxic_rule = 0) FROM t),
s AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS r, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f FROM c)"""


@query("multilabel_scores", RULES_SQL + f"""
SELECT {rnd('sum(tp) / CAST(sum(tp + fp) AS DOUBLE)')} AS micro_precision, {rnd('sum(tp) / CAST(sum(tp + fn) AS DOUBLE)')} AS micro_recall, {rnd('2 * sum(tp) / CAST(sum(2 * tp + fp + fn) AS DOUBLE)')} AS micro_f1,
  {rnd('avg(p)')} AS macro_precision, {rnd('avg(r)')} AS macro_recall, {rnd('avg(f)')} AS macro_f1,
  {rnd('(SELECT avg(CAST(quality = quality_rule AND toxic = toxic_rule AS DOUBLE)) FROM t)')} AS subset_accuracy FROM s""")
def multilabel_scores(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "quality", "toxic", (F.col("n_chars") > 200).cast("int").alias("quality_rule"),
        F.col("text").rlike("(?i)password|license|th").cast("int").alias("toxic_rule"))
    scores = met.micro_macro(met.label_counts(docs, [("quality", "quality_rule"), ("toxic", "toxic_rule")]))
    exact = (F.col("quality") == F.col("quality_rule")) & (F.col("toxic") == F.col("toxic_rule"))
    accuracy = docs.agg(F.avg(exact.cast("double")).alias("a")).scalar()
    return scores.select(*[tidy(c, 6).alias(c) for c in scores.columns], tidy(accuracy, 6).alias("subset_accuracy"))


PRED_SQL = NN_SQL + """, p AS (SELECT vec_id, label AS actual, neighbor_label AS predicted FROM nn WHERE rank = 2),
c AS (SELECT l.label, count(*) FILTER (actual = l.label AND predicted = l.label) AS tp, count(*) FILTER (actual <> l.label AND predicted = l.label) AS fp,
  count(*) FILTER (actual = l.label AND predicted <> l.label) AS fn FROM (SELECT DISTINCT label FROM e) l, p GROUP BY 1)"""


def nearest_other(spark, sf):
    """Label of the closest other vector as the prediction."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("actual"))
    second = neighbors(spark, sf, 2).where("rank = 2").select("vec_id", "neighbor")
    labels = e.select(F.col("vec_id").alias("neighbor"), F.col("actual").alias("predicted"))
    return e.join(second, "vec_id").join(labels, "neighbor").select("vec_id", "actual", "predicted")


@query("classification_report", PRED_SQL + f"""
SELECT label, {rnd('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END')} AS precision, {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END')} AS recall,
  {rnd('CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END')} AS f1, tp + fn AS support FROM c""")
def classification_report(spark, sf):
    r = met.with_scores(met.class_counts(nearest_other(spark, sf), "actual", "predicted"))
    return r.select("label", *[tidy(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("support_vs_precision", PRED_SQL + f"""
SELECT c.label, n_train, {rnd('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END')} AS precision FROM c JOIN (SELECT label, count(*) AS n_train FROM embeddings GROUP BY 1) t ON t.label = c.label""")
def support_vs_precision(spark, sf):
    counts = table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n_train"))
    scores = met.with_scores(met.class_counts(nearest_other(spark, sf), "actual", "predicted"))
    return scores.join(counts, "label").select("label", "n_train", tidy("precision", 6).alias("precision"))


@query("never_predicted_labels", """
WITH t AS (SELECT vec_id, label AS actual, CASE WHEN embedding[1] > 0 THEN label % 7 ELSE label % 5 END AS predicted FROM embeddings),
bad AS (SELECT actual AS label, count(*) AS support FROM t WHERE actual NOT IN (SELECT predicted FROM t) GROUP BY 1)
SELECT vec_id, actual, support FROM t JOIN bad ON bad.label = t.actual""")
def never_predicted_labels(spark, sf):
    """Rows of the labels that a weak rule never predicts."""
    e = table(spark, sf, "embeddings")
    rule = F.when(F.get("embedding", F.lit(0)) > 0, F.col("label") % 7).otherwise(F.col("label") % 5)
    rows = e.select("vec_id", F.col("label").alias("actual"), rule.alias("predicted"))
    bad = met.never_predicted(met.class_counts(rows, "actual", "predicted"))
    return rows.join(bad.withColumnRenamed("label", "actual"), "actual").select("vec_id", "actual", "support")


SWEEP = [0.1, 0.3, 0.5, 0.503, 0.7]


@query("threshold_sweep", f"""
WITH t AS (SELECT CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value / 100.0::DOUBLE AS p FROM events),
c AS (SELECT k AS threshold, count(*) FILTER (p >= k AND y = 1) AS tp, count(*) FILTER (p >= k AND y = 0) AS fp, count(*) FILTER (p < k AND y = 1) AS fn FROM t, (SELECT CAST(unnest({SWEEP}) AS DOUBLE) AS k) GROUP BY 1)
SELECT threshold, tp, fp, fn, {rnd('tp / CAST(tp + fp AS DOUBLE)')} AS precision, {rnd('tp / CAST(tp + fn AS DOUBLE)')} AS recall, {rnd('2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)')} AS f1 FROM c""")
def threshold_sweep(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").isin("purchase", "signup").cast("int").alias("y"), (F.col("value") / 100.0).alias("p"))
    s = met.threshold_sweep(events, "y", "p", SWEEP)
    return s.select("threshold", "tp", "fp", "fn", *[tidy(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("confusion_matrix", PRED_SQL + f"""
SELECT actual, predicted, count(*) AS n, {rnd('count(*) / CAST(sum(count(*)) OVER (PARTITION BY actual) AS DOUBLE)')} AS share, CASE WHEN actual = predicted THEN 0 ELSE count(*) END AS n_wrong FROM p GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return met.confusion(nearest_other(spark, sf), "actual", "predicted").withColumn("share", tidy("share", 6))


@query("misclassified_pairs", PRED_SQL + " SELECT actual, predicted, count(*) AS n FROM p WHERE actual <> predicted GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 50")
def misclassified_pairs(spark, sf):
    return met.misclassified(nearest_other(spark, sf), "actual", "predicted", 50)


def scored_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").isin("purchase", "signup").cast("int").alias("y"), F.least(F.col("value") / 100.0, F.lit(1.0)).alias("p"))


SCORED_SQL = "WITH t AS (SELECT CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, least(value / 100.0::DOUBLE, 1.0::DOUBLE) AS p FROM events)"


@query("roc_auc", SCORED_SQL + f""", r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM t)
SELECT {rnd('(sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0))')} AS auc FROM r""")
def roc_auc(spark, sf):
    return met.roc_auc(scored_events(spark, sf), "y", "p").select(tidy("auc", 6).alias("auc"))


@query("brier", SCORED_SQL + f" SELECT {rnd('avg((p - y) * (p - y))')} AS brier FROM t")
def brier(spark, sf):
    return met.brier(scored_events(spark, sf), "y", "p").select(tidy("brier", 6).alias("brier"))


@query("silhouette", E_SQL + f"""d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(pow({EUCLIDEAN}, 2)) AS s, count(*) AS n FROM e a, e b GROUP BY 1, 2, 3),
x AS (SELECT vec_id, max(s / (n - 1)) FILTER (own = other) AS a, min(s / n) FILTER (own <> other) AS b FROM d GROUP BY 1)
SELECT {rnd('avg((b - a) / greatest(a, b))')} AS silhouette FROM x""")
def silhouette(spark, sf):
    return knn.silhouette(table(spark, sf, "embeddings"), "vec_id", "embedding", "label").select(tidy("silhouette", 6).alias("silhouette"))


@query("knn_multilabel", NN_SQL + f"""
SELECT vec_id, {rnd('avg(CAST(neighbor_label < 3 AS DOUBLE))')} AS p_low, {rnd('avg(CAST(neighbor_label % 2 = 0 AS DOUBLE))')} AS p_even FROM nn WHERE rank <= 10 GROUP BY 1""")
def knn_multilabel(spark, sf):
    """Tag probability: mean of the 0/1 tags over ten neighbours."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("neighbor"), (F.col("label") < 3).cast("double").alias("low"),
                                              (F.col("label") % 2 == 0).cast("double").alias("even"))
    near = neighbors(spark, sf, 10).join(e, "neighbor")
    return near.groupBy("vec_id").agg(tidy(F.avg("low"), 6).alias("p_low"), tidy(F.avg("even"), 6).alias("p_even"))


@query("knn_regress", NN_SQL + f" SELECT vec_id, {rnd('avg(neighbor_label)')} AS prediction FROM nn WHERE rank BETWEEN 2 AND 6 GROUP BY 1")
def knn_regress(spark, sf):
    e = table(spark, sf, "embeddings")
    return knn.neighbor_mean(neighbors(spark, sf, 6), e, "vec_id", "vec_id", "label", skip_first=True).withColumn("prediction", tidy("prediction", 6))


@query("codebook_histogram", f"""
WITH m AS (SELECT label AS word, i, avg(v) AS v FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(64)) AS i FROM embeddings) GROUP BY 1, 2),
b AS (SELECT word, list(v ORDER BY i) AS v FROM m GROUP BY 1), a AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT a.vec_id, a.label, b.word, row_number() OVER (PARTITION BY a.vec_id ORDER BY {EUCLIDEAN}, b.word) AS r FROM a, b)
SELECT label, CAST(word AS BIGINT) AS word, count(*) AS n FROM n WHERE r = 1 GROUP BY 1, 2""")
def codebook_histogram(spark, sf):
    """Vectors quantised to the per-label mean vectors, counted per label."""
    e = table(spark, sf, "embeddings").withColumn("v", knn.as_vector(F.col("embedding")))
    means = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centroids = means.groupBy(F.col("label").cast("long").alias("word")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))
    return knn.codebook_histogram(e, centroids, key="vec_id", item="label", vector="v", word="word")


@query("baseline_mean", f"""
SELECT {rnd('sqrt(var_pop(o_totalprice))', 4)} AS rmse, {rnd('avg(abs(o_totalprice - (SELECT avg(o_totalprice) FROM orders)))', 4)} AS mae FROM orders""")
def baseline_mean(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice")
    mean = orders.agg(F.avg("o_totalprice").alias("m")).scalar()
    return met.rmse_mae(orders.withColumn("p", mean), "o_totalprice", "p").select(tidy("rmse", 4).alias("rmse"), tidy("mae", 4).alias("mae"))


@query("stream_score", f"""
SELECT event_id, {rnd('1 / (1 + exp(-(value / 50 - 1)))')} AS p, CASE WHEN 1 / (1 + exp(-(value / 50 - 1))) < 0.5 THEN 0 WHEN 1 / (1 + exp(-(value / 50 - 1))) > 0.7 THEN 1 ELSE -1 END AS action FROM events""")
def stream_score(spark, sf):
    """The events arrive as files in time order; each record gets one action."""
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    folder = scratch_path(spark, "event-stream")
    events.orderBy("ts", "event_id").write.parquet(folder)

    def score(df):
        p = sigmoid(F.col("value") / 50 - 1)
        return df.select("event_id", tidy(p, 6).alias("p"), three_way(p, 0.7).alias("action"))

    return score_stream(spark, folder, events.schema, score)


@query("threshold_utility", f"""
WITH m AS (SELECT event_type, avg(value) AS a FROM events GROUP BY 1),
e AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_type = 'purchase' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END * (value - a) AS g, value / 100.0::DOUBLE AS p FROM events JOIN m USING (event_type)),
k AS (SELECT CAST(unnest({SWEEP}) AS DOUBLE) AS threshold),
d AS (SELECT threshold, day, sum(CASE WHEN p >= threshold THEN g ELSE 0 END) AS s, count(*) FILTER (p >= threshold) AS n FROM e, k GROUP BY 1, 2),
s AS (SELECT threshold, sum(n) AS actions, sum(s) AS p, sum(s * s) AS pp, count(*) AS d FROM d GROUP BY 1),
t AS (SELECT *, CASE WHEN pp = 0 THEN 0 ELSE p / sqrt(pp) * sqrt(250.0::DOUBLE / d) END AS t FROM s)
SELECT threshold, CAST(actions AS BIGINT) AS actions, {rnd('p', 4)} AS p, {rnd('t')} AS t, {rnd('least(greatest(t, 0), 6) * p', 4)} AS u FROM t""")
def threshold_utility(spark, sf):
    """Utility of acting at each threshold of the score."""
    events = table(spark, sf, "events")
    rows = attach_groups(events, events.groupBy("event_type").agg(F.avg("value").alias("a")), ["event_type"])
    u = met.utility_sweep(rows, F.to_date("ts"), F.when(F.col("event_type") == "purchase", 2.0).otherwise(1.0), F.col("value") - F.col("a"),
                          F.col("value") / 100.0, SWEEP)
    return u.select("threshold", "actions", tidy("p", 4).alias("p"), tidy("t", 6).alias("t"), tidy("u", 4).alias("u"))


@query("silhouette_euclidean")
def silhouette_euclidean(spark, sf):
    """Mean silhouette of the embeddings' labels under plain Euclidean distance."""
    s = knn.silhouette_euclidean(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return s.select(tidy("silhouette", 6).alias("silhouette"))
