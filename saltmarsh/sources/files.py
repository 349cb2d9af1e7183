"""Readers and writers for delimited and columnar files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", encoding: str = "UTF-8",
                   as_string: Sequence[str] = ()) -> DataFrame:
    """A delimited file with header and given types; some columns may be forced to text."""
    fields = [T.StructField(f.name, T.StringType() if f.name in as_string else f.dataType) for f in schema]
    return (spark.read.schema(T.StructType(fields)).option("sep", sep).option("header", True)
            .option("encoding", encoding).option("enforceSchema", False).csv(path))


def read_delimited_parts(spark: SparkSession, folder: str, schema: T.StructType, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Every delimited file of a folder as one table; malformed lines are skipped, a column subset is kept.

    Column pruning in the CSV parser would hide malformed lines, so it is switched off for this read.
    """
    return (spark.read.schema(schema).option("sep", sep).option("header", True).option("mode", "DROPMALFORMED")
            .option("columnPruning", False).csv(folder).select(*columns))


def read_columnar(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """Parquet with narrowed types and only the named columns."""
    return spark.read.parquet(path).select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def write_and_read(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write for the next stage and hand back the stored table."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
        return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
    writer.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def peek_line(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Line ``n`` (0-based) of one text file."""
    return spark.read.text(path).offset(n).limit(1)


def reconcile_counts(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Lines in the files against rows loaded without the malformed ones; each file has one header line."""
    lines = spark.read.text(path)
    raw = lines.select(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n_lines"), F.countDistinct("f").alias("n_headers"))
    # counted over a hash of all columns: a plain count would be pruned to no column and parse none of them
    mark = F.xxhash64(*schema.names)
    loaded = read_delimited_parts(spark, path, schema, schema.names, sep).agg((F.count_if(mark >= 0) + F.count_if(mark < 0)).alias("n"))
    return raw.select("n_lines", (F.col("n_lines") - F.col("n_headers")).alias("n_expected"),
                      loaded.select("n").scalar().alias("n_loaded"))
