"""Streaming entry points.

The reference has no streaming operator (SURVEY 2.10). The calendar
aggregates are plain ``DataFrame -> DataFrame`` functions, so they run
unchanged on a streaming frame; this module only wires a file stream to
them. State is the per-month partial count, kept by Spark's state store
(checkpointed under the shared checkpoint folder, so a restarted query
resumes where it stopped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loomstat.operators.calendar import count_by_month
from loomstat.session import scratch_path


def file_stream(spark: SparkSession, directory: str, schema: StructType,
                fmt: str = "parquet", max_files: int = 1) -> DataFrame:
    """New files of ``directory`` as a stream (explicit schema, no inference)."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files).load(directory))


def monthly_count_stream(stream: DataFrame, ts: str):
    """A1 on a stream: running count per ``MM-yyyy`` month (complete mode)."""
    return count_by_month(stream, ts)


def start(df: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None):
    """Start a query into the in-process memory table ``name``."""
    spark = df.sparkSession
    return (df.writeStream.outputMode(mode).format("memory").queryName(name)
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
            .start())
