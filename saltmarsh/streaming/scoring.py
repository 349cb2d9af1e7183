"""Time-ordered records scored as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path


def stream_score(spark: SparkSession, path: str, schema: T.StructType, score: Callable[[DataFrame], DataFrame],
                 name: str = "scores", max_files: int = 100) -> DataFrame:
    """Consume the files that arrive under ``path`` batch by batch, emit one scored row per record.

    The stateless projection runs on every micro-batch; the file sink and its log make each row
    appear exactly once even if the query is restarted. Returns the written table.
    """
    target = scratch_path(spark, name)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
    query = (score(stream).writeStream.format("parquet").option("path", f"{target}/rows")
             .option("checkpointLocation", f"{target}/log").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{target}/rows")
