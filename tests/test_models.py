"""Invariants of the model queries and of the stream."""

import random

import pytest
from pyspark.sql import functions as F

from saltmarsh.plans import ORACLES, QUERIES
from saltmarsh.plans.models import FEATURES, event_features
from saltmarsh.operators import models

MODEL_QUERIES = sorted(set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_runs_and_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_probabilities_are_probabilities(spark, sf):
    p = QUERIES["boosted_classifier"](spark, sf).agg(F.min("p").alias("a"), F.max("p").alias("b")).first()
    assert 0 <= p["a"] <= p["b"] <= 1
    sums = QUERIES["fold_predictor"](spark, sf).select(sum(F.col(f"fold_p{i}") for i in range(5)).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_pca_explains_at_most_everything(spark, sf):
    row = QUERIES["pca_project"](spark, sf).first()
    assert 0 < row["ratio2"] <= row["ratio1"] < 1 and row["ratio1"] + row["ratio2"] == pytest.approx(1, abs=1e-5)


def test_saved_pipeline_scores_alike(spark, sf):
    out = QUERIES["model_save_load"](spark, sf)
    assert out.agg(F.max("cluster").alias("c")).first()["c"] < 8


def test_linear_fit_matches_closed_form(spark, sf):
    events = event_features(spark, sf)
    fit = {r["feature"]: r["coefficient"] for r in models.linear_fit(events, ["k"], "y").collect()}
    ols = models.univariate_ols(events, "k", "y").first()
    assert fit["k"] == pytest.approx(ols["slope"], abs=1e-9)
    assert fit["intercept"] == pytest.approx(ols["intercept"], abs=1e-9)
    assert FEATURES


def test_boosted_trees_on_binned_means_are_those_on_all_rows(spark):
    from pyspark.ml.regression import GBTRegressor

    rng = random.Random(3)
    rows = [(float(rng.randrange(50)), rng.random(), float(rng.randrange(3))) for _ in range(3000)]
    df = spark.createDataFrame([(a, b, c, a * b + c + rng.random()) for a, b, c in rows], "a double, b double, c double, y double").repartition(3)
    cells = models.binned_means(df, ["a", "b", "c"], "y")
    assert cells.agg({"weight": "sum"}).first()[0] == 3000 and cells.count() <= 32 * 32 * 3
    model = GBTRegressor(labelCol="y", maxIter=5, maxDepth=3, seed=models.SEED).fit(models.assemble(df, ["a", "b", "c"]))
    got = {r.feature: r.importance for r in models.tree_importance(df, ["a", "b", "c"], "y", "boosted", trees=5, depth=3).collect()}
    assert all(abs(got[c] - v) < 1e-9 for c, v in zip("abc", model.featureImportances.toArray()))


def test_forest_on_drawn_means_is_like_one_on_rows(spark):
    rng = random.Random(5)
    rows = [(float(rng.randrange(50)), rng.random(), float(rng.randrange(3))) for _ in range(6000)]
    df = spark.createDataFrame([(a, b, c, 2 * a + 30 * b + 5 * c + rng.random()) for a, b, c in rows], "a double, b double, c double, y double").repartition(3)
    columns = ["a", "b", "c"]
    cells = models.durable(models.drawn_means(df, columns, "y", 8))
    per_tree = {r.tree: r for r in cells.groupBy("tree").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("y")).alias("t"), F.count("*").alias("cells")).collect()}
    assert sorted(per_tree) == list(range(8)) and len({r.n for r in per_tree.values()}) > 1
    mean = df.agg(F.avg("y")).first()[0]
    for r in per_tree.values():
        assert r.n == pytest.approx(6000, abs=400) and r.t / r.n == pytest.approx(mean, rel=0.05) and r.cells <= 32 * 32 * 3
    one = cells.where("tree = 0").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()
    other = cells.where("tree = 1").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()
    assert one != other

    def importance(**by):
        return {r.feature: r.importance for r in models.tree_importance(df, columns, "y", trees=20, **by).collect()}

    on_rows, on_means = importance(), importance(by_row=0)
    assert sum(on_means.values()) == pytest.approx(1) and all(on_means[c] == pytest.approx(on_rows[c], abs=0.08) for c in columns)
    assert importance(by_row=0) == on_means


def test_few_labels_are_added_up_in_columns_as_in_rows(spark, monkeypatch):
    from saltmarsh.operators import bayes

    rng = random.Random(4)
    words = spark.createDataFrame([(d, w, rng.randrange(1, 4)) for d in range(30) for w in rng.sample("abcdefgh", 3)] + [(None, "a", 2), (2, None, 1)],
                                  "doc long, word string, n long")
    tags = spark.createDataFrame([(d, t) for d in range(20) for t in ("odd" if d % 2 else "even", "all", None if d % 3 else "third")], "doc long, label string")
    rows = spark.createDataFrame([(d,) for d in [*range(32), 5, None]], "doc long")
    model = bayes.fit_multilabel(words, tags, "doc")
    score = lambda: sorted((str(r.doc), r.label, None if r.p is None else round(r.p, 9)) for r in bayes.score_multilabel(words, rows, model, "doc").collect())
    plan = bayes.score_multilabel(words, rows, model, "doc")._jdf.queryExecution().optimizedPlan().toString()
    by_columns = score()
    assert plan.count("Generate") == 1 and len(by_columns) == 34 * 4
    monkeypatch.setattr(bayes, "WIDE", 0)
    assert score() == by_columns
