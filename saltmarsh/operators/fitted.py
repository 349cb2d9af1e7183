"""Fit on one table, apply to another: ``pyspark.ml`` estimators whose models are small tables.

Every model keeps its fitted state as named DataFrames and its settings as JSON, so it takes part in a
``Pipeline``, is saved and loaded with it, and can be read as plain Parquet by anyone else. Fitting writes
the state to the shared folder: it is computed once, and later joins know its size. Values that were not
seen in fitting have a stated result in every class; no class needs a list of values typed in.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbers import boxcox
from ..session import scratch_path
from .aggregate import customer_rollup, quartile_code
from .encode import frequent_categories
from .ordering import attach_groups, running_total
from .scale import boxcox_lambda
from .stats import quantiles
from .windows import rank_table


class _Settings(Params):
    settings = Param(Params._dummy(), "settings", "the settings as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, **settings):
        super().__init__()
        self._set(settings=json.dumps(settings))

    def setting(self, name: str):
        return json.loads(self.getOrDefault(self.settings))[name]


class _Writer(MLWriter):
    def __init__(self, model: TableModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"tables": sorted(self.model.tables)})
        for name, df in self.model.tables.items():
            df.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.tables = {name: spark.read.parquet(f"{path}/tables/{name}") for name in metadata["tables"]}
        return model


class TableModel(_Settings, Model, MLWritable, MLReadable):
    """A fitted transformation: settings and named tables."""

    tables: dict[str, DataFrame] = {}

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df)

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


class TableEstimator(_Settings, Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """``learn`` gives the tables of the model; they are stored once."""

    model_class: type[TableModel] = TableModel

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> TableModel:
        model = self.model_class()
        model._set(settings=self.getOrDefault(self.settings))
        model.tables = {}
        for name, learned in self.learn(df).items():
            path = scratch_path(df.sparkSession, f"fitted-{name}")
            learned.write.parquet(path)
            model.tables[name] = df.sparkSession.read.schema(learned.schema).parquet(path)
        return model


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _look_up(df: DataFrame, known: DataFrame, column: str, value: str, name: str) -> DataFrame:
    """``df`` with the ``value`` of ``known`` (columns column, category, value) for the category of ``column``; null if unseen."""
    mine = known.where(F.col("column") == column).select(F.col("category").alias("__category"), F.col(value).alias("__value"))
    keyed = df.withColumn("__category", F.col(column).cast("string"))
    return attach_groups(keyed, mine, ["__category"], "left").withColumn(name, F.col("__value")).drop("__category", "__value")


class OneHotModel(TableModel):
    def names(self) -> list[tuple[str, str]]:
        """(column, category) in output order; fitting refused more than ``max_categories``."""
        rows = self.tables["categories"].collect()
        order = {c: i for i, c in enumerate(self.setting("columns"))}
        return sorted(((r["column"], r["category"]) for r in rows), key=lambda r: (order[r[0]], r[1]))

    def apply(self, df: DataFrame) -> DataFrame:
        bits = [F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for c, v in self.names()]
        return df.select(*[c for c in df.columns if c not in self.setting("columns")], *bits)


class OneHot(TableEstimator):
    """Each of ``columns`` replaced by a 0/1 column per category seen in fitting, named column_category.

    An unseen category and a null are 0 in all of them. More categories than ``max_categories`` in one
    column raise ValueError, as each becomes a column.
    """

    model_class = OneHotModel

    def __init__(self, columns: Sequence[str] = (), max_categories: int = 1000):
        super().__init__(columns=list(columns), max_categories=max_categories)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        found = _union([df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")).where("category is not null").distinct()
                        for c in self.setting("columns")])
        many = found.groupBy("column").count().where(F.col("count") > self.setting("max_categories")).first()
        if many:
            raise ValueError(f"{many['column']} has {many['count']} categories; raise max_categories or group the rare ones first")
        return {"categories": found}


class MeanRankModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.setting("columns"):
            out = _look_up(out, self.tables["ranks"], c, "rank", "__rank").withColumn(c, F.col("__rank")).drop("__rank")
        return out.select(*df.columns)


class MeanRank(TableEstimator):
    """Each category replaced by its 0-based rank by mean ``target`` in fitting, the name breaking ties; unseen ones and nulls are null."""

    model_class = MeanRankModel

    def __init__(self, columns: Sequence[str] = (), target: str = ""):
        super().__init__(columns=list(columns), target=target)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"ranks": _union([rank_table(df.select(F.col(c).cast("string").alias("category"), F.col(self.setting("target")).alias("__target")),
                                            "category", "__target").select(F.lit(c).alias("column"), "category", "rank")
                                 for c in self.setting("columns")])}


class RareToOtherModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.setting("columns"):
            out = _look_up(out, self.tables["frequent"], c, "kept", "__kept").withColumn(
                c, F.when(F.col(c).isNull() | F.col("__kept").isNotNull(), F.col(c)).otherwise(self.setting("other"))).drop("__kept")
        return out.select(*df.columns)


class RareToOther(TableEstimator):
    """Categories beyond the most frequent ones that make up less than ``percent`` of the fitted rows become ``other``.

    Every column has its own list. A category unseen in fitting is rare; null stays null.
    """

    model_class = RareToOtherModel

    def __init__(self, columns: Sequence[str] = (), percent: float = 80.0, other: str = "OTHERS"):
        super().__init__(columns=list(columns), percent=percent, other=other)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"frequent": _union([frequent_categories(df.select(F.col(c).cast("string").alias("category")), "category", self.setting("percent"))
                                    .select(F.lit(c).alias("column"), "category", F.lit(True).alias("kept")) for c in self.setting("columns")])}


class LabelIndexModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        return _look_up(df, self.tables["labels"], self.setting("column"), "code", self.setting("name"))

    def inverse(self, df: DataFrame, code: str, name: str) -> DataFrame:
        """``df`` with the label of each code; null for codes that were never given out."""
        back = self.tables["labels"].select(F.col("code").alias("__code"), F.col("category").alias("__label"))
        keyed = df.withColumn("__code", F.col(code).cast("long"))
        return attach_groups(keyed, back, ["__code"], "left").withColumn(name, F.col("__label")).drop("__code", "__label")


class LabelIndex(TableEstimator):
    """A two-way dictionary between the labels of ``column`` in sorted order and dense codes from 0; unseen labels have no code."""

    model_class = LabelIndexModel

    def __init__(self, column: str = "", name: str = "code"):
        super().__init__(column=column, name=name)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        labels = df.select(F.col(self.setting("column")).cast("string").alias("category")).where("category is not null").distinct()
        coded = running_total(labels, ["category"], F.lit(1), "__n")
        return {"labels": coded.select(F.lit(self.setting("column")).alias("column"), "category", (F.col("__n") - 1).cast("long").alias("code"))}


class BagOfWordsModel(TableModel):
    def long(self, df: DataFrame, key: str) -> DataFrame:
        """(key, word, position, n): counts of the vocabulary's words, long; rows without any are absent."""
        rows = df.select(F.col(key), F.explode(_words(self.setting("column"))).alias("word"))
        # counted per row first: a word that a third of the texts use moves once per row
        counts = rows.groupBy(key, "word").agg(F.count("*").alias("n"))
        return attach_groups(counts, self.tables["vocabulary"].select("word", "position"), ["word"], "inner").select(key, "word", "position", "n")

    def apply(self, df: DataFrame) -> DataFrame:
        key = self.setting("key")
        lists = self.long(df, key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", "n"))).alias("__bow"))
        lists = lists.withColumnRenamed(key, "__key")
        none = F.array().cast("array<struct<position:bigint,n:bigint>>")
        return df.join(lists, F.col(key) == F.col("__key"), "left").select(*df.columns, F.coalesce("__bow", none).alias(self.setting("name")))


def _words(column: str):
    return text.words(F.coalesce(F.col(column), F.lit("")), r"[\p{L}\p{N}_]{2,}")


class BagOfWords(TableEstimator):
    """Vocabulary of the words in at least a share ``min_df`` of the fitted texts; positions follow the words' order.

    Applied, a row gets the list ``name`` of (position, n), empty without known words; ``long`` gives one
    row per (key, word). Words unseen in fitting are left out. ``key`` must be unique.
    """

    model_class = BagOfWordsModel

    def __init__(self, column: str = "", key: str = "", min_df: float = 0.001, name: str = "bow"):
        super().__init__(column=column, key=key, min_df=min_df, name=name)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        n = df.agg(F.count("*").alias("n")).scalar()
        seen = df.select(F.explode(F.array_distinct(_words(self.setting("column")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
        kept = seen.where(F.col("df") >= n * F.lit(float(self.setting("min_df"))))
        return {"vocabulary": running_total(kept, ["word"], F.lit(1), "__n").select("word", "df", (F.col("__n") - 1).cast("long").alias("position"))}


class FillModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        values = {r["column"]: r["value"] for r in self.tables["values"].collect()}  # one row per column
        return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns])


class Fill(TableEstimator):
    """Nulls replaced by the fitted ``mean`` or ``median``; a column without values in fitting keeps its nulls."""

    model_class = FillModel

    def __init__(self, columns: Sequence[str] = (), how: str = "mean"):
        if how not in ("mean", "median"):
            raise ValueError("how is mean or median")
        super().__init__(columns=list(columns), how=how)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        if self.setting("how") == "mean":
            row = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.avg(c).alias("value")) for c in self.setting("columns")]).alias("l"))
            return {"values": row.select(F.explode("l").alias("v")).select("v.*")}
        return {"values": _union([quantiles(df, c, [0.5]).select(F.lit(c).alias("column"), F.get("q", F.lit(0)).alias("value"))
                                  for c in self.setting("columns")])}


class BoxCoxModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        state = {r["column"]: r for r in self.tables["powers"].collect()}  # one row per column
        new = {}
        for c, r in state.items():
            x = F.col(c) + F.lit(r["shift"])
            new[c] = F.when(x > 0, boxcox(x, F.lit(r["lam"])))
        return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


class BoxCox(TableEstimator):
    """Power transform with the shift and the exponent of greatest likelihood on a grid, as fitted.

    The shift is |smallest value| + 1. A value that is not positive after the fitted shift gives null.
    """

    model_class = BoxCoxModel

    def __init__(self, columns: Sequence[str] = (), grid: Sequence[float] = tuple(x / 10 for x in range(-20, 21))):
        super().__init__(columns=list(columns), grid=[float(x) for x in grid])

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        found = []
        for c in self.setting("columns"):
            shift = df.agg((F.abs(F.min(c)) + 1).alias("s")).scalar()
            likely = boxcox_lambda(df.select((F.col(c) + shift).alias("__x")), "__x", self.setting("grid"))
            best = likely.agg(F.max_by("lam", F.struct("llf", -F.col("lam"))).alias("lam"))
            found.append(best.select(F.lit(c).alias("column"), shift.cast("double").alias("shift"), "lam"))
        return {"powers": _union(found)}


class ScaleModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        state = {r["column"]: r for r in self.tables["scales"].collect()}  # one row per column
        return df.select(*[((F.col(c) - F.lit(state[c]["start"])) / F.lit(state[c]["width"])).alias(c) if c in state else F.col(c) for c in df.columns])


class Scale(TableEstimator):
    """``standard`` (mean, population deviation) or ``minmax`` scaling; a column that was constant in fitting is only shifted."""

    model_class = ScaleModel

    def __init__(self, columns: Sequence[str] = (), how: str = "standard"):
        if how not in ("standard", "minmax"):
            raise ValueError("how is standard or minmax")
        super().__init__(columns=list(columns), how=how)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        ends = (lambda c: (F.avg(c), F.stddev_pop(c))) if self.setting("how") == "standard" else (lambda c: (F.min(c), F.max(c) - F.min(c)))
        rows = []
        for c in self.setting("columns"):
            start, width = (x.cast("double") for x in ends(c))
            rows.append(F.struct(F.lit(c).alias("column"), start.alias("start"), F.coalesce(F.nullif(width, F.lit(0.0)), F.lit(1.0)).alias("width")))
        return {"scales": df.agg(F.array(*rows).alias("l")).select(F.explode("l").alias("s")).select("s.*")}


class CustomerRollupModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        s = self.setting
        last = self.tables["dates"].agg(F.max("last").alias("m")).scalar()
        best = F.broadcast(self.tables["products"].select(F.col("product").alias("__product"), F.lit(True).alias("__top")))  # ``top`` rows at most
        lines = df.join(best, F.col(s("product")).cast("string") == F.col("__product"), "left")
        return customer_rollup(
            lines, customer=s("customer"), when=s("when"), amount=s("amount"), quantity=s("quantity"), cancelled=F.expr(s("cancelled")),
            top_product=F.col("__top").isNotNull(), generic_product=F.expr(s("generic")), last=last,
            presence={n: F.expr(e) for n, e in s("presence").items()})


class CustomerRollup(TableEstimator):
    """One row per customer; the last order date and the ``top`` products by value are those of the fitted lines.

    Conditions are SQL text, so that they are saved with the model. See ``aggregate.customer_rollup``.
    """

    model_class = CustomerRollupModel

    def __init__(self, customer: str = "", when: str = "", amount: str = "", quantity: str = "", product: str = "",
                 cancelled: str = "false", generic: str = "false", presence: dict[str, str] | None = None, top: int = 20):
        super().__init__(customer=customer, when=when, amount=amount, quantity=quantity, product=product, cancelled=cancelled,
                         generic=generic, presence=presence or {}, top=top)

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        s = self.setting
        value = df.where(F.col(s("product")).isNotNull()).groupBy(F.col(s("product")).alias("__p")).agg(
            F.sum(F.col(s("amount")).cast("decimal(18,4)")).alias("value"))
        best = value.orderBy(F.desc("value"), F.asc("__p")).limit(s("top")).select(F.col("__p").cast("string").alias("product"))
        return {"dates": df.agg(F.max(s("when")).alias("last")), "products": best}


class RfmModel(TableModel):
    def apply(self, df: DataFrame) -> DataFrame:
        q = {r["column"]: [F.lit(x) for x in r["q"]] for r in self.tables["quartiles"].collect()}  # three rows
        out = df
        for name, column, codes in RFM_CODES:
            out = out.withColumn(name, quartile_code(F.col(column), q[column], codes))
        return out.withColumn("rfm_score", F.col("r") + F.col("f") + F.col("m"))


#: fixed values: output column, measure, codes from the lowest to the highest quartile
RFM_CODES = [("r", "months_active", (1, 2, 3, 4)), ("f", "quantity_per_month", (4, 3, 2, 1)), ("m", "price_per_month", (4, 3, 2, 1))]


class Rfm(TableEstimator):
    """Recency, frequency and money codes by the quartiles of the fitted customers, and their sum."""

    model_class = RfmModel

    def learn(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"quartiles": _union([quantiles(df, c, [0.25, 0.5, 0.75]).select(F.lit(c).alias("column"), "q") for _, c, _ in RFM_CODES])}
