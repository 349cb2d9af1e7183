"""Models on ``pyspark.ml``. Values depend on initialisation, so most are checked by invariants."""

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbers import tidy
from ..operators import bayes, encode, linear, metrics, models, relational, search
from ..operators import timeseries as ts
from ..sources import table, use_all_slots
from .registry import query, rnd
from .scalars import STOP_WORDS
from .windows import ALIGNED_SQL, stacking_split


def vectors(spark, sf):
    return models.as_features(table(spark, sf, "embeddings"), "embedding")


def event_features(spark, sf):
    """Numeric features of an event and a 0/1 target."""
    coded = encode.label_index(table(spark, sf, "events"), "event_type", "type_code")
    return coded.select("event_id", "ts", F.to_date("ts").alias("day"), F.hour("ts").cast("double").alias("hour"),
                        F.col("type_code").cast("double").alias("type_code"), (F.col("user_id") % 10).cast("double").alias("user_group"),
                        F.get_json_object("props", "$.k").cast("double").alias("k"), (F.col("value") > 35).cast("double").alias("y"))


FEATURES = ["hour", "type_code", "user_group", "k"]


@query("pca_project", f"""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp,
  corr(l_quantity, l_extendedprice) AS r FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, (l_quantity - mq) / sq AS a, (l_extendedprice - mp) / sp AS b, r FROM lineitem, s)
SELECT l_orderkey, l_linenumber, {rnd('CASE WHEN r >= 0 THEN a + b ELSE a - b END / sqrt(2)')} AS pc1, {rnd('CASE WHEN r >= 0 THEN a - b ELSE a + b END / sqrt(2)')} AS pc2,
  {rnd('(1 + abs(r)) / 2')} AS ratio1, {rnd('(1 - abs(r)) / 2')} AS ratio2 FROM z""")
def pca_project(spark, sf):
    """Two standardised columns: the components are their sum and difference, the shares follow from the correlation."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    projected, parts = linear.pca_project(lines, ["l_quantity", "l_extendedprice"], 2)
    ratio = [r["ratio"] for r in parts.orderBy("component").collect()]  # two rows
    return projected.select("l_orderkey", "l_linenumber", tidy("pc1", 6).alias("pc1"), tidy("pc2", 6).alias("pc2"),
                            tidy(F.lit(ratio[0]), 6).alias("ratio1"), tidy(F.lit(ratio[1]), 6).alias("ratio2"))


@query("pca_vectors")
def pca_vectors(spark, sf):
    """Every embedding on its first five principal components."""
    wide, names = linear.spread(table(spark, sf, "embeddings"), "embedding", 64)
    return linear.pca_project(wide, names, 5)[0].select("vec_id", *[f"pc{i}" for i in range(1, 6)])


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return models.kmeans_sweep(vectors(spark, sf), [2, 4, 6, 8])


@query("argmax_row", f"""
WITH t AS (SELECT CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value / 100.0::DOUBLE AS p FROM events),
c AS (SELECT k AS threshold, count(*) FILTER (p >= k AND y = 1) AS tp, count(*) FILTER (p >= k AND y = 0) AS fp, count(*) FILTER (p < k AND y = 1) AS fn
  FROM t, (SELECT unnest(range(1, 10)) / 10.0::DOUBLE AS k) GROUP BY 1)
SELECT threshold, tp, fp, fn, {rnd('2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)')} AS f1 FROM c ORDER BY f1 DESC, threshold LIMIT 1""")
def argmax_row(spark, sf):
    """The threshold with the best F1."""
    events = table(spark, sf, "events").select(F.col("event_type").isin("purchase", "signup").cast("int").alias("y"), (F.col("value") / 100.0).alias("p"))
    scores = metrics.threshold_sweep(events, "y", "p", [i / 10 for i in range(1, 10)])
    return relational.argmax_row(scores.select("threshold", "tp", "fp", "fn", tidy("f1", 6).alias("f1")), "f1", "threshold")


@query("cluster_assign_profile")
def cluster_assign_profile(spark, sf):
    return models.cluster_profile(models.cluster_assign(vectors(spark, sf), 8), "label")


def doc_words(spark, sf):
    words = text.words(F.col("text"))
    return use_all_slots(table(spark, sf, "documents")).select("doc_id", F.filter(words, lambda w: ~w.isin(STOP_WORDS)).alias("words"))


@query("lda_topics")
def lda_topics(spark, sf):
    return models.lda_topics(doc_words(spark, sf), "words", topics=50, vocabulary=2000, max_iter=20)


@query("doc_vectors")
def doc_vectors(spark, sf):
    """The mean word vector of every document."""
    docs = use_all_slots(table(spark, sf, "documents")).select("doc_id", text.words(F.col("text")).alias("words"))
    return models.doc_vectors(docs, "words", STOP_WORDS, size=16).select("doc_id", models.vector_to_array("vector").alias("vector"))


@query("linear_regression", f"""
SELECT {rnd('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope, {rnd('regr_intercept(l_extendedprice, l_quantity)', 3)} AS intercept, {rnd('regr_r2(l_extendedprice, l_quantity)')} AS r2 FROM lineitem""")
def linear_regression(spark, sf):
    fit = models.univariate_ols(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return fit.select(tidy("slope", 4).alias("slope"), tidy("intercept", 3).alias("intercept"), tidy("r2", 6).alias("r2"))


@query("linear_regression_multiple")
def linear_regression_multiple(spark, sf):
    return models.linear_fit(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@query("linear_regression_elastic")
def linear_regression_elastic(spark, sf):
    return models.linear_fit(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", reg=1.0, elastic=0.5)


@query("tree_regression")
def tree_regression(spark, sf):
    return models.tree_importance(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", trees=50)


@query("tree_regression_boosted")
def tree_regression_boosted(spark, sf):
    return models.tree_importance(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", kind="boosted", trees=20, depth=3)


@query("boosted_classifier")
def boosted_classifier(spark, sf):
    """The test rows of every fold, scored by a model of that fold's training block."""
    split = ts.purged_group_split(event_features(spark, sf), "day", ["ts", "event_id"], n_splits=3, group_gap=1)
    parts = [models.boosted_probability(split.where(f"fold = {f} and role = 'train'"), split.where(f"fold = {f} and role = 'test'"), FEATURES, "y")
             for f in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("event_id", "fold", "y", "p")


@query("fold_predictor")
def fold_predictor(spark, sf):
    folds = ts.aligned_fold_table(event_features(spark, sf), F.col("day"), ["ts", "event_id"])
    labelled = folds.withColumn("fold", F.col("fold").cast("double"))
    return models.fold_probabilities(labelled, FEATURES, "fold", 5).select("event_id", "fold", *[f"fold_p{i}" for i in range(5)])


@query("tree_explain")
def tree_explain(spark, sf):
    return models.explain_clusters(models.cluster_assign(vectors(spark, sf), 5))


def event_folds(spark, sf):
    return ts.aligned_fold_table(event_features(spark, sf), F.col("day"), ["ts", "event_id"]).select("event_id", "day", *FEATURES, "y", "fold")


@query("out_of_fold", ALIGNED_SQL + """, e AS (SELECT i.event_id, type_code, fold, CAST(value > 35 AS DOUBLE) AS y FROM i JOIN b ON idx >= a AND idx < z
  JOIN events USING (event_id) JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS type_code FROM (SELECT DISTINCT event_type FROM events)) USING (event_type)),
cell AS (SELECT fold, type_code, sum(y) AS s, count(*) AS n FROM e GROUP BY 1, 2),
rest AS (SELECT f.fold, c.type_code, sum(c.s) / sum(c.n) AS p FROM (SELECT DISTINCT fold FROM e) f JOIN cell c ON c.fold <> f.fold GROUP BY 1, 2)
""" + f"SELECT event_id, fold, y, {rnd('p')} AS p_type FROM e JOIN rest USING (fold, type_code)")
def out_of_fold(spark, sf):
    """The rate of the row's event type in the other folds."""
    wide = search.out_of_fold(event_folds(spark, sf), {"p_type": search.group_rate_base("type_code", "y")}, "fold", 5)
    return wide.select("event_id", "fold", "y", tidy("p_type", 6).alias("p_type"))


@query("logistic_stack")
def logistic_stack(spark, sf):
    """A logistic model per fold on the out-of-fold probabilities of three base models."""
    bases = {"p_logistic": search.ml_base(LogisticRegression(regParam=0.01), FEATURES, "y"),
             "p_forest": search.ml_base(RandomForestClassifier(numTrees=20, maxDepth=5, seed=models.SEED), FEATURES, "y"),
             "p_type": search.group_rate_base("type_code", "y")}
    wide = search.out_of_fold(event_folds(spark, sf), bases, "fold", 5)
    return search.stacked_logistic(wide, list(bases), "y", "fold", 5)


@query("meta_stacking")
def meta_stacking(spark, sf):
    """The test rows of every fold."""
    split = stacking_split(event_features(spark, sf))
    parts = [models.meta_stack(split, FEATURES, "y", fold=f, trees=10) for f in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("event_id", "fold", "y", "p_base", "p_meta")


BAYES_SQL = r"""
WITH t AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents) GROUP BY 1, 2),
tags AS (SELECT doc_id, 'quality' AS label FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'lang ' || lang FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL),
c AS (SELECT count(DISTINCT doc_id) AS c FROM labels),
tot AS MATERIALIZED (SELECT word, sum(n) AS n FROM t WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1),
pos AS MATERIALIZED (SELECT label, word, sum(n) AS n FROM t JOIN tags USING (doc_id) GROUP BY 1, 2),
v AS (SELECT count(*) AS v, sum(n) AS n FROM tot),
lab AS (SELECT label, r, coalesce(w, 0) AS w FROM (SELECT label, count(*) AS r FROM tags GROUP BY 1) LEFT JOIN (SELECT label, sum(n) AS w FROM pos GROUP BY 1) USING (label)),
model AS MATERIALIZED (SELECT lab.label, tot.word, ln((coalesce(pos.n, 0) + 0.01::DOUBLE) / (w + 0.01::DOUBLE * v)) - ln((tot.n - coalesce(pos.n, 0) + 0.01::DOUBLE) / ((v.n - w) + 0.01::DOUBLE * v)) AS g
  FROM tot CROSS JOIN lab CROSS JOIN v LEFT JOIN pos ON pos.label = lab.label AND pos.word = tot.word),
sums AS (SELECT doc_id, label, sum(t.n * g) AS s FROM t JOIN model USING (word) GROUP BY 1, 2),
odds AS (SELECT doc_id, lab.label, greatest(-500, least(500, coalesce(s, 0) + ln(r / CAST(c - r AS DOUBLE)))) AS o
  FROM documents CROSS JOIN lab CROSS JOIN c LEFT JOIN sums USING (doc_id, label))
"""


@query("multilabel_fit", BAYES_SQL + f" SELECT doc_id, label, {rnd('1 / (1 + exp(-o))')} AS p FROM odds")
def multilabel_fit(spark, sf):
    """Quality, toxicity and language as tags of the labelled documents, fitted on all their words; scores for every document."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    words = encode.document_terms(use_all_slots(docs.select("doc_id", "text")), "doc_id", text.words(F.col("text"), r"[\p{L}\p{N}_]{2,}"))
    known = labels.join(docs.select("doc_id", "lang"), "doc_id", "left")
    tag = F.explode(F.array(F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic"), F.concat(F.lit("lang "), "lang")))
    scores = bayes.score_multilabel(words, docs, bayes.fit_multilabel(words, known.select("doc_id", tag.alias("label")), "doc_id"), "doc_id")
    return scores.select("doc_id", "label", tidy("p", 6).alias("p"))


def holed_lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    gap = lambda c, cond: F.when(cond, None).otherwise(F.col(c)).alias(c)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", gap("l_extendedprice", F.col("l_returnflag") == "R"),
                        gap("l_tax", F.col("l_linestatus") == "O"))


@query("impute_chained")
def impute_chained(spark, sf):
    """Price and tax with holes; up to ten rounds of regression on the other columns."""
    return linear.impute_chained(holed_lines(spark, sf), ["l_quantity", "l_extendedprice", "l_tax"], rounds=10)


@query("impute_regression", f"""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem WHERE l_returnflag <> 'R')
SELECT l_orderkey, l_linenumber, l_quantity, {rnd("CASE WHEN l_returnflag = 'R' THEN s * l_quantity + i ELSE l_extendedprice END", 3)} AS l_extendedprice FROM lineitem, f""")
def impute_regression(spark, sf):
    """One column with holes: its fills lie on the regression line."""
    filled = linear.impute_chained(holed_lines(spark, sf).drop("l_tax"), ["l_quantity", "l_extendedprice"])
    return filled.select("l_orderkey", "l_linenumber", "l_quantity", tidy("l_extendedprice", 3).alias("l_extendedprice"))


@query("grid_search_cv")
def grid_search_cv(spark, sf):
    """Regularisation searched over purged time folds, scored by utility and by micro precision."""
    rows = event_features(spark, sf).join(table(spark, sf, "events").select("event_id", (F.col("value") - 35).alias("resp")), "event_id")
    split = ts.purged_group_split(rows.withColumn("weight", F.lit(1.0)), "day", ["ts", "event_id"], n_splits=3, group_gap=1)
    lr = LogisticRegression(labelCol="y", maxIter=50)
    grid = [{lr.regParam: r, lr.elasticNetParam: e} for r in (0.0, 0.1) for e in (0.0, 1.0)]
    return search.purged_search(split, FEATURES, lr, grid, {
        "utility": search.UtilityEvaluator(), "micro_precision": search.MicroPrecisionEvaluator(["y"], ["prediction"])})


@query("baseline_random", f"""
WITH e AS (SELECT event_id, CAST(value > 35 AS INTEGER) AS y FROM events)
SELECT event_id, y, CAST(CAST('0x' || substr(md5('42-' || event_id), 1, 7) AS BIGINT) / 268435456.0::DOUBLE < (SELECT avg(CAST(y AS DOUBLE)) FROM e) AS INTEGER) AS action FROM e""")
def baseline_random(spark, sf):
    events = table(spark, sf, "events").select("event_id", (F.col("value") > 35).cast("int").alias("y"))
    return models.baseline_random(events, "event_id", "y")


@query("predictions_rule", f"SELECT event_id, {rnd('1 / (1 + exp(-(0.5::DOUBLE + 0.01::DOUBLE * value - 0.02::DOUBLE * hour(ts))))')} AS p FROM events")
def predictions_rule(spark, sf):
    """Logistic probability from given coefficients, written out as an expression."""
    from ..functions.numbers import sigmoid
    score = 0.5 + 0.01 * F.col("value") - 0.02 * F.hour("ts")
    return table(spark, sf, "events").select("event_id", tidy(sigmoid(score), 6).alias("p"))


