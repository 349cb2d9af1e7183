"""A training corpus from ``documents``, in five stages; each one calls one operator of ``saltmarsh.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's documents. All stages but the last return the columns of documents, so their decisions
show in the rows and texts that go on: quality drops rejected rows, line dedup shortens texts (n_chars
follows) and keeps every row, near-dedup leaves the smallest doc_id of each group, mixing leaves the rows
up to the end of the mix, and the last stage encodes and decodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.lines import without_repeated_lines
from saltmarsh.llm.mixing import mixed
from saltmarsh.llm.near_dup import one_of_each
from saltmarsh.llm.quality import good_documents
from saltmarsh.llm.shared import stored
from saltmarsh.llm.tokens import encode_documents
from saltmarsh.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that importance resampling towards the good labels keeps.

    A null or empty text weighs nothing for or against; rows that tie with the last one kept stay, and rows
    that repeat a doc_id share their noise. Without a good or without a bad label all rows stay.
    """
    return good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without lines that three documents or more have; a null text becomes empty.

    The document with the largest doc_id keeps the line. Rows that repeat a doc_id are one document; rows
    without a doc_id lose nothing.
    """
    cut = without_repeated_lines(docs)
    new = {"text": F.col("__kept")} | ({"n_chars": F.length("__kept").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cut.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Texts without words are linked with nothing and stay, as do rows without a doc_id. Rows that repeat a
    doc_id are one document and stay or go together.
    """
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows up to the end of the mix, interleaved by source.

    Weights follow the sizes of the sources, a null source being one of its own; sources below one slot in a
    thousand are pooled and stay in. The mix ends where the first source of a weight of its own runs out.
    """
    return mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per row; a null or empty text has no ids."""
    return encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("bpe", bpe)]

#: the quality and near-duplicate stages can't be said in SQL; tests/llm/test_pipeline.py holds run() against plain versions of all stages
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
