"""Models built on ``pyspark.ml``: projections, clustering, regression, classification, stacking."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import CountVectorizer, StopWordsRemover, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable, ship_package
from .relational import md5_key

SEED = 42


def as_features(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    """Array column to an ml vector, on the JVM."""
    return df.withColumn(name, array_to_vector(F.transform(column, lambda v: v.cast("double"))))


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def kmeans_sweep(df: DataFrame, ks: Sequence[int], features: str = "features", max_iter: int = 20) -> DataFrame:
    """Silhouette (squared Euclidean) and cost per number of clusters."""
    cached = durable(df.select(features))
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol="cluster")
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=SEED, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(cached)
        rows.append((k, float(evaluator.evaluate(model.transform(cached))), float(model.summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double")


def cluster_assign(df: DataFrame, k: int, features: str = "features", max_iter: int = 20) -> DataFrame:
    model = KMeans(k=k, seed=SEED, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df)
    return model.transform(df)


def cluster_profile(assigned: DataFrame, target: str) -> DataFrame:
    """Size and target mean per cluster."""
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.avg(target).alias("target_mean"))


def lda_topics(df: DataFrame, words: str, topics: int, vocabulary: int, max_iter: int, top: int = 10) -> DataFrame:
    """Top words per topic in long form."""
    vec = CountVectorizer(inputCol=words, outputCol="counts", vocabSize=vocabulary).fit(df)
    model = LDA(k=topics, seed=SEED, maxIter=max_iter, featuresCol="counts", optimizer="online").fit(vec.transform(df))
    vocab = F.array(*[F.lit(w) for w in vec.vocabulary])
    return model.describeTopics(top).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t")).select(
        "topic", "rank", F.get(vocab, F.col("t.termIndices")).alias("word"), F.col("t.termWeights").alias("weight"))


def doc_vectors(df: DataFrame, words: str, stop_words: Sequence[str], size: int = 32, max_iter: int = 1,
                min_count: int = 5, partitions: int = 8, order: str = "doc_id") -> DataFrame:
    """Mean word vectors per document, stop words removed.

    Trained on a fixed number of ``partitions``, filled and sorted by ``order``, so training does not follow
    the size of the cluster or the layout of the table; words of equal frequency may start from each
    other's random vector. A document without known words has a zero vector.
    """
    clean = StopWordsRemover(inputCol=words, outputCol="_clean", stopWords=list(stop_words)).transform(df)
    data = durable(clean.repartition(partitions, order).sortWithinPartitions(order))
    model = Word2Vec(vectorSize=size, minCount=min_count, maxIter=max_iter, seed=SEED, numPartitions=partitions,
                     inputCol="_clean", outputCol="vector").fit(data)
    return model.transform(data).drop("_clean")  # stored: the words are not taken from the texts again


def linear_fit(df: DataFrame, columns: Sequence[str], y: str, reg: float = 0.0, elastic: float = 0.0) -> DataFrame:
    """Coefficient, p-value (plain OLS only) and share of absolute coefficients per feature."""
    model = LinearRegression(featuresCol="features", labelCol=y, solver="normal" if elastic == 0 else "auto",
                             regParam=reg, elasticNetParam=elastic).fit(assemble(df, columns))
    coefs = [float(c) for c in model.coefficients]
    p_values = [float(p) for p in model.summary.pValues] if reg == 0 else [None] * (len(coefs) + 1)
    total = sum(abs(c) for c in coefs) or 1.0
    rows = [(c, v, p_values[i], abs(v) / total) for i, (c, v) in enumerate(zip(columns, coefs))]
    rows.append(("intercept", float(model.intercept), p_values[-1], 0.0))
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, p_value double, importance double")


def univariate_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 as built-in aggregates."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


#: intervals that a tree tells apart in a feature, and rows from which their borders are taken, both as in ``pyspark.ml``
BINS, BORDER_ROWS = 32, 10_000
#: rows up to which a forest takes them one by one, and trees of a larger one that are fitted at the same time
BY_ROW, FITS_AT_ONCE = 100_000, 8


def _borders(values: Sequence[float], expected: float) -> list[float]:
    """Between the distinct values, or so that about as many of ``values`` lie in each of ``BINS`` intervals.

    As in ``pyspark.ml``, rows that are missing to the number ``expected`` count as zeros.
    """
    found = Counter(v for v in values if v)
    zeros = expected - sum(found.values())
    counts = sorted((found | {0.0: zeros} if zeros > 1e-6 else found).items())
    middle = [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(middle) < BINS:
        return middle
    out, seen, step = [], 0.0, expected / BINS
    target = step
    for (_, n), (_, following), border in zip(counts, counts[1:], middle):
        seen += n
        if abs(seen - target) < abs(seen + following - target):
            out.append(border)
            target += step
    return out


def _drawn(rows: DataFrame, share: float) -> DataFrame:
    """The rows that the trees of ``pyspark.ml`` take their borders from under ``SEED``."""
    spark = rows.sparkSession
    seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(SEED).nextInt()
    return DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.toJavaRDD().sample(False, share, seed), rows._jdf.schema()), spark)


def _binned(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """The ``columns`` as numbers of intervals, from 0, and ``y``, all of them doubles. Null and NaN are errors."""
    number = lambda c: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.raise_error(F.lit(f"{c} has nulls"))).otherwise(F.col(c).cast("double"))
    rows = df.select(*[number(c).alias(c) for c in columns], number(y).alias(y))
    n_rows = df.count()
    share = BORDER_ROWS / max(1, n_rows)
    some = (_drawn(rows, share) if share < 1 else rows).select(*columns).collect()
    binned = lambda c, i: F.size(F.filter(F.array(*map(F.lit, _borders([r[i] for r in some], min(n_rows, BORDER_ROWS)))).cast("array<double>"), lambda b: b < F.col(c)))
    return rows.select(*[binned(c, i).cast("double").alias(c) for i, c in enumerate(columns)], y)


def binned_means(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """The ``columns`` as numbers of intervals, with the mean of ``y`` and the number of rows of each combination that occurs.

    A tree sees no more of a row than its intervals, and the spread of ``y`` inside a combination adds as much to
    a node as to its two children, so a regression tree on these weighted means is the tree on all rows. There are
    at most ``BINS`` to the power of the columns of them, however many rows. Null and NaN are errors.
    """
    return _binned(df, columns, y).groupBy(*columns).agg(F.avg(y).alias(y), F.count("*").cast("double").alias("weight"))


def _draws(trees: int, n_columns: int, rows_at_once: int = 1 << 20):
    """Sums over the rows that each tree draws, per combination of intervals and up to ``rows_at_once`` rows of a partition."""
    sides = (BINS + 1,) * n_columns

    def sums(cell, y, rng):
        cells, at = np.unique(cell, return_inverse=True)
        names = [pa.array(c.astype(np.float64)) for c in np.unravel_index(cells, sides)]
        for tree in range(trees):
            times = rng.poisson(1.0, len(y)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), tree, np.int32)), *names, pa.array(np.bincount(at, times, len(cells))),
                                              pa.array(np.bincount(at, times * y, len(cells)))], names=["tree", *(f"c{i}" for i in range(n_columns)), "weight", "total"])

    def run(batches):
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        held, n = [], 0
        for batch in batches:
            *bins, y = (batch.column(i).to_numpy() for i in range(batch.num_columns))
            held.append((np.ravel_multi_index([b.astype(np.int64) for b in bins], sides), y))
            n += len(y)
            if n >= rows_at_once:
                yield from sums(*map(np.concatenate, zip(*held)), rng)
                held, n = [], 0
        if n:
            yield from sums(*map(np.concatenate, zip(*held)), rng)
    return run


def drawn_means(df: DataFrame, columns: Sequence[str], y: str, trees: int) -> DataFrame:
    """``binned_means`` of the rows that each ``tree`` of a forest draws, with the times they are drawn as weights.

    Each tree takes each row a Poisson number of times, 1 on average, as in ``pyspark.ml``. All trees draw in one
    pass, and what is kept does not grow with the rows.
    """
    ship_package(df.sparkSession)
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(["tree int", *(f"{c} double" for c in names), "weight double", "total double"])
    sums = _binned(df, columns, y).mapInArrow(_draws(trees, len(columns)), schema).groupBy("tree", *names).agg(
        F.sum("weight").alias("weight"), F.sum("total").alias("total")).where("weight > 0")
    return sums.select("tree", *[F.col(n).alias(c) for n, c in zip(names, columns)], (F.col("total") / F.col("weight")).alias(y), "weight")


def _forest_importance(df: DataFrame, columns: Sequence[str], y: str, trees: int, depth: int) -> np.ndarray:
    """Importances of a forest whose trees are fitted one by one to their ``drawn_means``, each tree counting the same."""
    cells = durable(drawn_means(df, columns, y, trees))

    def fit(tree):
        one = RandomForestRegressor(labelCol=y, weightCol="weight", numTrees=1, maxDepth=depth, bootstrap=False, seed=SEED + tree,
                                    featureSubsetStrategy="onethird" if trees > 1 else "all")
        return one.fit(assemble(cells.where(F.col("tree") == tree), columns)).featureImportances.toArray()

    with ThreadPool(FITS_AT_ONCE) as pool:
        total = np.sum(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(trees)), axis=0)
    return total / (total.sum() or 1.0)


def tree_importance(df: DataFrame, columns: Sequence[str], y: str, kind: str = "forest", trees: int = 20, depth: int = 5,
                    by_row: int = BY_ROW) -> DataFrame:
    """Feature importance and its cumulative sum for a tree ensemble regressor.

    Boosted trees use every row in every round; they are fitted to ``binned_means``, which gives the same
    trees. The trees of a forest each draw rows: of up to ``by_row`` rows one by one, of more rows in one pass
    for all trees, which are then fitted to their ``drawn_means``.
    """
    if kind == "forest" and df.limit(by_row + 1).count() <= by_row:
        importance = RandomForestRegressor(labelCol=y, numTrees=trees, maxDepth=depth, seed=SEED).fit(assemble(df, columns)).featureImportances.toArray()
    elif kind == "forest":
        importance = _forest_importance(df, columns, y, trees, depth)
    else:
        cells = durable(binned_means(df, columns, y))
        model = GBTRegressor(labelCol=y, weightCol="weight", maxIter=trees, maxDepth=depth, seed=SEED).fit(assemble(cells, columns))
        importance = model.featureImportances.toArray()
    ranked = sorted(zip(columns, importance), key=lambda r: (-r[1], r[0]))
    rows, total = [], 0.0
    for name, value in ranked:
        total += float(value)
        rows.append((name, float(value), total))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, cumulative double")


def probability(model, data: DataFrame, name: str, index: int = 1) -> DataFrame:
    return model.transform(data).withColumn(name, F.get(vector_to_array("probability"), F.lit(index))).drop(
        "rawPrediction", "probability", "prediction")


def boosted_probability(train: DataFrame, test: DataFrame, columns: Sequence[str], y: str, trees: int = 10,
                        depth: int = 4, name: str = "p") -> DataFrame:
    """Test rows with the probability of a gradient-boosted classifier."""
    model = GBTClassifier(labelCol=y, maxIter=trees, maxDepth=depth, stepSize=0.1, seed=SEED).fit(assemble(train, columns))
    return probability(model, assemble(test, columns), name).drop("features")


def fold_probabilities(df: DataFrame, columns: Sequence[str], fold: str, n_folds: int, trees: int = 10) -> DataFrame:
    """Probability that a row belongs to each fold, as features ``fold_p0 ..``."""
    data = assemble(df, columns)
    model = RandomForestClassifier(labelCol=fold, numTrees=trees, maxDepth=5, seed=SEED).fit(data)
    p = vector_to_array("probability")
    return model.transform(data).select(*df.columns, *[F.get(p, F.lit(i)).alias(f"fold_p{i}") for i in range(n_folds)])


def explain_clusters(assigned: DataFrame, features: str = "features", depth: int = 4) -> DataFrame:
    """Importance of each vector component in a decision tree fitted on the cluster ids."""
    model = DecisionTreeClassifier(featuresCol=features, labelCol="cluster", maxDepth=depth, seed=SEED).fit(assigned)
    rows = [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return assigned.sparkSession.createDataFrame(rows, "component int, importance double")


def meta_stack(split: DataFrame, columns: Sequence[str], y: str, fold: int, trees: int = 5) -> DataFrame:
    """Base model on train; its probability is a feature of the meta model fitted on val; scored on test."""
    one = durable(assemble(split.where(F.col("fold") == fold), columns))
    role = lambda r: one.where(F.col("role") == r)
    base = GBTClassifier(labelCol=y, maxIter=trees, maxDepth=3, seed=SEED).fit(role("train"))
    val, test = (probability(base, role(r), "p_base").drop("features") for r in ("val", "test"))
    meta = LogisticRegression(labelCol=y, maxIter=20).fit(assemble(val, [*columns, "p_base"]))
    return probability(meta, assemble(test, [*columns, "p_base"]), "p_meta").drop("features")


def fit_pipeline(df: DataFrame, stages) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)


def baseline_random(df: DataFrame, key: str, y: str, name: str = "action", seed: int = SEED) -> DataFrame:
    """A random 0/1 action that is as frequent as class 1 is in the data, repeatable per row key on any cluster."""
    share = df.agg(F.avg(F.col(y).cast("double")).alias("p")).scalar()
    draw = F.conv(F.substring(md5_key(key, seed), 1, 7), 16, 10).cast("double") / float(16**7)
    return df.withColumn(name, (draw < share).cast("int"))
