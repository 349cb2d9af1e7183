"""Search over purged time folds with scorers of one's own, and stacking on out-of-fold probabilities."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .aggregate import utility_score


class UtilityEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Trading utility of acting where the probability reaches ``threshold``; 0 without rows.

    Needs the columns ``day``, ``weight`` and ``resp`` (names are parameters) beside ``probability``.
    """

    dayCol = Param(Params._dummy(), "dayCol", "column of the day", typeConverter=TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "column of the weight", typeConverter=TypeConverters.toString)
    respCol = Param(Params._dummy(), "respCol", "column of the return", typeConverter=TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "smallest probability that acts", typeConverter=TypeConverters.toFloat)

    def __init__(self, dayCol: str = "day", weightCol: str = "weight", respCol: str = "resp", threshold: float = 0.5):
        super().__init__()
        self._set(dayCol=dayCol, weightCol=weightCol, respCol=respCol, threshold=threshold)

    def _evaluate(self, dataset: DataFrame) -> float:
        act = (F.get(vector_to_array("probability"), F.lit(1)) >= self.getOrDefault(self.threshold)).cast("int")
        day, weight, resp = (F.col(self.getOrDefault(p)) for p in (self.dayCol, self.weightCol, self.respCol))
        return float(utility_score(dataset, day, weight, resp, act).first()["u"] or 0.0)


class MicroPrecisionEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Share of true positives among all positive predictions, over all 0/1 label columns; 0 without predictions.

    ``labelCols`` and ``predictionCols`` are lists of equal length.
    """

    labelCols = Param(Params._dummy(), "labelCols", "0/1 label columns", typeConverter=TypeConverters.toListString)
    predictionCols = Param(Params._dummy(), "predictionCols", "0/1 prediction columns", typeConverter=TypeConverters.toListString)

    def __init__(self, labelCols: Sequence[str] = ("label",), predictionCols: Sequence[str] = ("prediction",)):
        super().__init__()
        self._set(labelCols=list(labelCols), predictionCols=list(predictionCols))

    def _evaluate(self, dataset: DataFrame) -> float:
        pairs = list(zip(self.getOrDefault(self.labelCols), self.getOrDefault(self.predictionCols)))
        hit = sum(F.count_if((F.col(y) == 1) & (F.col(p) == 1)) for y, p in pairs)
        said = sum(F.count_if(F.col(p) == 1) for _, p in pairs)
        return float(dataset.agg((hit / F.nullif(said, F.lit(0))).alias("s")).first()["s"] or 0.0)


def assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error").transform(df)


def purged_search(split: DataFrame, columns: Sequence[str], estimator: Estimator, grid: Sequence[Mapping], scorers: Mapping[str, Evaluator]) -> DataFrame:
    """One row per parameter set and scorer: parameters, mean and deviation over the folds, and the score of every fold.

    ``split`` has ``fold`` and ``role`` (train, test), as the purged splits give them: a fold is trained on
    its own training block and scored on its test block, so no row near a test block takes part. The folds
    overlap, which a ``CrossValidator`` can't do. ``grid`` is a list of {parameter: value}. The rows are
    stored once with their features; each (fold, parameter set) is one fit.
    """
    rows = durable(assembled(split, columns))
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())  # few by construction
    scores: dict[tuple[int, str], list[float]] = {}
    for f in folds:
        train, test = (rows.where((F.col("fold") == f) & (F.col("role") == r)) for r in ("train", "test"))
        for i, model in estimator.fitMultiple(train, [dict(g) for g in grid]):
            predicted = model.transform(test)
            for name, scorer in scorers.items():
                scores.setdefault((i, name), []).append((f, scorer.evaluate(predicted)))
    out = []
    for (i, name), found in sorted(scores.items()):
        values = [s for _, s in sorted(found)]
        mean = sum(values) / len(values)
        deviation = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
        out.append(({p.name: float(v) for p, v in grid[i].items()}, name, mean, deviation, values))
    return split.sparkSession.createDataFrame(out, "params map<string,double>, scorer string, mean_score double, std_score double, fold_scores array<double>")


Base = Callable[[DataFrame, DataFrame, str], DataFrame]


def ml_base(estimator: Estimator, columns: Sequence[str], y: str) -> Base:
    """A base model from a ``pyspark.ml`` classifier: fitted on the first table, its probability of class 1 on the second."""
    def score(train: DataFrame, rows: DataFrame, name: str) -> DataFrame:
        model = estimator.copy({estimator.labelCol: y}).fit(assembled(train, columns))
        p = F.get(vector_to_array("probability"), F.lit(1))
        return model.transform(assembled(rows, columns)).select(*rows.columns, p.alias(name))
    return score


def group_rate_base(column: str, y: str) -> Base:
    """A base model that says the training rate of ``y`` in the row's group, and the overall rate for new groups."""
    def score(train: DataFrame, rows: DataFrame, name: str) -> DataFrame:
        from .ordering import attach_groups
        rate = train.groupBy(column).agg(F.avg(y).alias("__rate"))
        overall = train.agg(F.avg(y).alias("r")).scalar()
        return attach_groups(rows, rate, [column], "left").select(*rows.columns, F.coalesce("__rate", overall).alias(name))
    return score


def out_of_fold(rows: DataFrame, bases: Mapping[str, Base], fold: str, n_folds: int) -> DataFrame:
    """``rows`` with one probability per base model, each from a model fitted on the other folds only.

    A row's probabilities come from models that never saw its fold. The tables of the folds are stored and
    put together; every row of a fold from 0 to ``n_folds`` - 1 comes out once.
    """
    rows = durable(rows)
    parts = []
    for f in range(n_folds):
        train, left = rows.where(F.col(fold) != f), rows.where(F.col(fold) == f)
        for name, base in bases.items():
            left = base(train, left, name)
        parts.append(durable(left))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stacked_logistic(wide: DataFrame, columns: Sequence[str], y: str, fold: str, n_folds: int, max_iter: int = 100) -> DataFrame:
    """Per fold a logistic model on the base probabilities of the other folds: (fold, coefficients..., intercept, auc-free accuracy).

    ``accuracy`` is the share of rows of the left-out fold that the model tells right. A last row with
    fold -1 holds the averages.
    """
    data = durable(assembled(wide, columns).select("features", F.col(y).cast("double").alias("label"), F.col(fold).alias("fold")))
    rows = []
    for f in range(n_folds):
        model = LogisticRegression(maxIter=max_iter, tol=1e-9).fit(data.where(F.col("fold") != f))
        right = model.transform(data.where(F.col("fold") == f)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).first()["a"]
        rows.append((f, *[float(c) for c in model.coefficients], float(model.intercept), right))
    width = len(columns) + 2
    mean = [sum(v for v in (r[i + 1] for r in rows) if v is not None) / max(1, sum(r[i + 1] is not None for r in rows)) for i in range(width)]
    schema = ", ".join(["fold int", *[f"{c} double" for c in columns], "intercept double", "accuracy double"])
    return wide.sparkSession.createDataFrame([*rows, (-1, *mean)], schema)
