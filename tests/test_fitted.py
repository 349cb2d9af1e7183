"""Fit and apply, and the models built on product sums, folds and word counts, against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from saltmarsh.operators import aggregate, bayes, fitted, linear, metrics, models, ordering, search, timeseries, windows
from saltmarsh.operators.scale import boxcox_transform
from saltmarsh.plans import QUERIES
from saltmarsh.session import scratch_path


def round_trip(spark, model):
    path = scratch_path(spark, "test-model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def fit(spark, stage, train):
    return round_trip(spark, Pipeline(stages=[stage]).fit(train))


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 9.0), (None, "x", 4.0), ("a", "z", 3.0)], "c string, d string, t double")


def test_one_hot_knows_the_categories_of_the_fit(spark, train):
    rest = spark.createDataFrame([(1, "b", "x"), (2, "new", None), (3, None, "y")], "i int, c string, d string")
    got = fit(spark, fitted.OneHot(["c", "d"]), train).transform(rest).orderBy("i")
    assert got.columns == ["i", "c_a", "c_b", "d_x", "d_y", "d_z"]
    assert [tuple(r) for r in got.collect()] == [(1, 0, 1, 1, 0, 0), (2, 0, 0, 0, 0, 0), (3, 0, 0, 0, 1, 0)]
    with pytest.raises(ValueError):
        fitted.OneHot(["d"], max_categories=2).fit(train)


def test_rank_rare_and_labels_of_unseen_values(spark, train):
    rest = spark.createDataFrame([(1, "a", "x"), (2, "b", "z"), (3, "new", "y"), (4, None, None)], "i int, c string, d string")
    ranks = fit(spark, fitted.MeanRank(["c", "d"], "t"), train).transform(rest).orderBy("i")
    assert [(r.c, r.d) for r in ranks.collect()] == [(0, 2), (1, 1), (None, 0), (None, None)]
    # each column has its own list: 80 percent of five rows is less than four rows
    rare = fit(spark, fitted.RareToOther(["c", "d"], 79.0), train).transform(rest).orderBy("i")
    assert [(r.c, r.d) for r in rare.collect()] == [("a", "x"), ("OTHERS", "OTHERS"), ("OTHERS", "OTHERS"), (None, None)]
    model = fit(spark, fitted.LabelIndex("d"), train)
    coded = model.transform(rest).orderBy("i")
    assert [r.code for r in coded.collect()] == [0, 2, 1, None]
    back = model.stages[0].inverse(coded, "code", "label").orderBy("i")
    assert [r.label for r in back.collect()] == ["x", "z", "y", None]


def test_fill_scale_and_power_use_the_fitted_numbers(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, None, None), (4, 9.0, 5.0)], "i int, x double, k double")
    rest = spark.createDataFrame([(1, None, None), (2, 17.0, 6.0)], "i int, x double, k double")
    for how, x in (("mean", 4.0), ("median", 2.0)):
        got = fit(spark, fitted.Fill(["x", "k"], how), df).transform(rest).orderBy("i").collect()
        assert [(r.x, r.k) for r in got] == [(x, 5.0), (17.0, 6.0)]
    got = fit(spark, fitted.Scale(["x", "k"], "minmax"), df).transform(rest).orderBy("i").collect()
    assert [(r.x, r.k) for r in got] == [(None, None), (2.0, 1.0)]
    got = fit(spark, fitted.Scale(["x"], "standard"), df).transform(rest).where("i = 2").first()
    assert got.x == pytest.approx((17 - 4) / np.std([1, 2, 9]))
    empty = spark.createDataFrame([], df.schema)
    assert fit(spark, fitted.Fill(["x"]), empty).transform(rest).where("i = 1").first().x is None
    grid = [-1.0, 0.0, 0.5, 1.0]
    known = df.where("x is not null")
    power = fit(spark, fitted.BoxCox(["x"], grid), known)
    want = {r.i: r.y for r in boxcox_transform(known, "x", grid, "y").collect()}
    assert {r.i: pytest.approx(r.x) for r in power.transform(known).collect()} == want
    assert power.transform(spark.createDataFrame([(1, -50.0, 0.0)], df.schema)).first().x is None


def test_bag_of_words_keeps_rows_and_knows_only_fitted_words(spark):
    df = spark.createDataFrame([(1, "Salt marsh, salt!"), (2, "marsh hay"), (3, None), (4, "")], "k int, t string")
    rest = spark.createDataFrame([(7, "salt and marsh salt"), (8, "unknown"), (9, None)], "k int, t string")
    model = fit(spark, fitted.BagOfWords("t", "k", 0.25), df)
    assert [(r.word, r.df, r.position) for r in model.stages[0].tables["vocabulary"].orderBy("position").collect()] == [("hay", 1, 0), ("marsh", 2, 1), ("salt", 1, 2)]
    got = {r.k: [tuple(x) for x in r.bow] for r in model.transform(rest).collect()}
    assert got == {7: [(1, 1), (2, 2)], 8: [], 9: []}


def test_segments_follow_from_the_fitted_years(spark, sf):
    out = QUERIES["segmentation_pipeline"](spark, sf)
    assert {r["segment"] for r in out.select("segment").distinct().collect()} <= set(range(5))


def test_groups_are_attached_without_moving_the_rows(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("hot")).alias("g"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = windows.attach_counts(df, {"n": ["g"]})
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
        assert {(r.g, r.n) for r in out.collect()} == {(None, 667), ("hot", 1333)}
        assert ordering.SMALL_GROUPS >= 1000
        ordering.SMALL_GROUPS, kept = 1, ordering.SMALL_GROUPS
        try:
            assert {(r.g, r.n) for r in windows.attach_counts(df, {"n": ["g"]}).collect()} == {(None, 667), ("hot", 1333)}
        finally:
            ordering.SMALL_GROUPS = kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_components_are_those_of_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) + 1e4
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(400, None)]
    wide, names = linear.spread(spark.createDataFrame(rows, "i int, v array<double>").repartition(3), "v", 6)
    out, parts = linear.pca_project(wide, names, 3)
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T, bias=True))
    for k, r in enumerate(parts.orderBy("component").collect()):
        w = vectors[:, -1 - k]
        w = w * np.sign(w[np.abs(w).argmax()])
        assert r.ratio == pytest.approx(values[-1 - k] / values.sum()) and np.allclose(r.loadings, w, atol=1e-7)
        got = [r[f"pc{k + 1}"] for r in out.orderBy("i").collect()]
        assert got[400] is None and np.allclose(got[:400], z @ w, atol=1e-6)
    assert linear.pca_project(wide.limit(0), names, 2)[1].first().ratio is None


def test_twenty_columns_with_holes_are_filled(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(500, 3))
    x = base @ rng.normal(size=(3, 20)) + 0.01 * rng.normal(size=(500, 20))
    holes = rng.random(x.shape) < 0.1
    names = [f"c{i}" for i in range(20)]
    rows = [(i, *[None if h else float(v) for v, h in zip(r, hr)]) for i, (r, hr) in enumerate(zip(x, holes))]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} double" for c in names)).repartition(2)
    out = linear.impute_chained(df, names, rounds=2).orderBy("i").collect()
    got = np.array([[r[c] for c in names] for r in out])
    assert (got[~holes] == x[~holes]).all() and np.sqrt(np.mean((got[holes] - x[holes]) ** 2)) < 0.3 * x.std()


def test_bayes_for_all_labels_equals_one_model_per_label(spark):
    rng = random.Random(6)
    words = [(k, w, n) for k in range(60) for w, n in {f"w{rng.randrange(12)}": rng.randrange(1, 4) for _ in range(rng.randrange(6))}.items()]
    tags = [(k, t) for k in range(40) for t in {rng.choice(["p", "q", "r", None]) for _ in range(2)}]
    w, t = spark.createDataFrame(words, "k int, word string, n long"), spark.createDataFrame(tags, "k int, label string")
    got = {(r.k, r.label): r.p for r in bayes.score_multilabel(w, spark.range(60).select(F.col("id").cast("int").alias("k")), bayes.fit_multilabel(w, t, "k"), "k").collect()}
    vocabulary = sorted({x for k, x, _ in words if k < 40})
    assert len(got) == 180
    for label in "pqr":
        own = {k for k, x in tags if x == label}
        count = {side: {x: 0.01 for x in vocabulary} for side in (True, False)}
        for k, x, n in words:
            if k < 40:
                count[k in own][x] += n
        for k in range(60):
            odds = math.log(len(own) / (40 - len(own)))
            for kk, x, n in words:
                if kk == k and x in vocabulary:
                    odds += n * (math.log(count[True][x] / sum(count[True].values())) - math.log(count[False][x] / sum(count[False].values())))
            assert got[k, label] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-9)


def test_no_row_is_scored_by_a_model_that_saw_it(spark):
    df = spark.range(300).select("id", (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 2).cast("double").alias("x"),
                                 (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") % 2 == 1, 7).otherwise(2)).cast("double").alias("y"))
    def seen(train, rows, name):
        mine = train.select(F.col("id").alias("__id"), F.lit(1.0).alias("__seen"))
        return rows.join(mine, F.col("id") == F.col("__id"), "left").select(*rows.columns, F.coalesce("__seen", F.lit(0.0)).alias(name))
    wide = search.out_of_fold(df, {"p_seen": seen, "p_rate": search.group_rate_base("x", "y")}, "fold", 5)
    assert wide.count() == 300 and wide.agg(F.max("p_seen").alias("m")).first().m == 0.0
    # one 0/1 feature: the coefficient is the difference of the log odds of the other folds
    table = {r["fold"]: r for r in search.stacked_logistic(df, ["x"], "y", "fold", 5).collect()}
    for f in range(5):
        rate = {x: r for x, r in df.where(f"fold != {f}").groupBy("x").agg(F.avg("y")).collect()}
        odds = {x: math.log(p / (1 - p)) for x, p in rate.items()}
        assert table[f]["x"] == pytest.approx(odds[1.0] - odds[0.0], abs=1e-3) and table[f]["intercept"] == pytest.approx(odds[0.0], abs=1e-3)
    assert table[-1]["x"] == pytest.approx(np.mean([table[f]["x"] for f in range(5)]))


def test_search_scores_the_folds_of_the_purged_split(spark):
    df = spark.range(480).select("id", (F.col("id") / 40).cast("int").alias("day"), F.rand(3).alias("x")).withColumn(
        "y", (F.col("x") + F.rand(4) > 1).cast("double")).withColumn("weight", F.lit(1.0)).withColumn("resp", F.col("y") - 0.4)
    split = timeseries.purged_group_split(df, "day", ["id"], n_splits=3, group_gap=1).cache()
    lr = LogisticRegression(labelCol="y", maxIter=30)
    grid = [{lr.regParam: 0.0}, {lr.regParam: 5.0}]
    scorers = {"utility": search.UtilityEvaluator(), "precision": search.MicroPrecisionEvaluator(["y"], ["prediction"])}
    got = {(r.params["regParam"], r.scorer): r for r in search.purged_search(split, ["x"], lr, grid, scorers).collect()}
    assert set(got) == {(0.0, "utility"), (0.0, "precision"), (5.0, "utility"), (5.0, "precision")}
    for f in range(3):
        part = lambda role: search.assembled(split.where(f"fold = {f} and role = '{role}'"), ["x"])  # noqa: B023,E731
        rows = lr.fit(part("train")).transform(part("test")).collect()
        said = [r for r in rows if r.prediction == 1]
        assert got[0.0, "precision"].fold_scores[f] == pytest.approx(sum(r.y for r in said) / len(said))
        days = {}
        for r in rows:
            days[r.day] = days.get(r.day, 0.0) + (r.resp if r.probability[1] >= 0.5 else 0.0)
        p, pp = sum(days.values()), sum(v * v for v in days.values())
        u = min(max(p / math.sqrt(pp) * math.sqrt(250 / len(days)), 0), 6) * p if pp else 0.0
        assert got[0.0, "utility"].fold_scores[f] == pytest.approx(u)
    r = got[0.0, "utility"]
    assert r.mean_score == pytest.approx(np.mean(r.fold_scores)) and r.std_score == pytest.approx(np.std(r.fold_scores))


def test_utility_of_all_thresholds_in_one_pass(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("d"), (F.col("id") % 11 - 4).cast("double").alias("r"), (F.col("id") % 10 / 10).alias("p"), F.lit(2.0).alias("w"))
    got = {r.threshold: r for r in metrics.utility_sweep(df, F.col("d"), F.col("w"), F.col("r"), F.col("p"), [0.0, 0.55, 2.0]).collect()}
    for t in got:
        one = aggregate.utility_score(df, F.col("d"), F.col("w"), F.col("r"), (F.col("p") >= t).cast("int")).first()
        assert (got[t].p, got[t].t, got[t].u) == (pytest.approx(one.p), pytest.approx(one.t), pytest.approx(one.u))
    assert got[2.0].actions == 0 and got[2.0].u == 0.0


def test_weighted_line(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1.0), (1.0, 3.0, 1.0), (1.0, 5.0, 3.0), (None, 9.0, 1.0)], "x double, y double, w double")
    r = linear.weighted_line(df, "x", "y", "w").first()
    assert (r.n, r.slope, r.intercept) == (3, pytest.approx(3.5), pytest.approx(1.0))
    assert linear.weighted_line(df.where("x = 1"), "x", "y", "w").first().slope is None


def test_document_vectors_of_all_documents(spark):
    rng = random.Random(8)
    rows = [(i, [f"{'ab'[i % 2]}{rng.randrange(6)}" for _ in range(20)]) for i in range(300)] + [(300, []), (301, ["the"])]
    df = spark.createDataFrame(rows, "doc_id int, words array<string>")
    out = {r.doc_id: r.vector.toArray() for r in models.doc_vectors(df, "words", ["the"], size=4, min_count=1, max_iter=20, partitions=2).collect()}
    assert len(out) == 302 and not out[300].any() and not out[301].any()
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert np.mean([cos(out[i], out[i + 2]) for i in range(200)]) > np.mean([cos(out[i], out[i + 1]) for i in range(200)])


def test_document_vectors_take_the_words_from_the_texts_once(spark, sf):
    from saltmarsh.plans import QUERIES
    assert "regexp_extract_all" not in QUERIES["doc_vectors"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


def test_random_baseline_has_the_share_of_the_data(spark):
    df = spark.range(4000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    assert models.baseline_random(df, "id", "y").agg(F.avg("action").alias("a")).first().a == pytest.approx(0.1, abs=0.02)
    assert models.baseline_random(df.where("y = 0"), "id", "y").agg(F.sum("action").alias("a")).first().a == 0


def test_invoice_lines_are_joined_once(spark, sf):
    """Fitting and scoring read the stored lines; none of them joins orders and lines again."""
    from saltmarsh.plans.fitted import invoice_lines, stored_lines
    lines = stored_lines(spark, sf)
    assert "Join" not in lines._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, lines.collect()), key=repr) == sorted(map(tuple, invoice_lines(spark, sf).collect()), key=repr)
