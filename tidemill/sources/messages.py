"""Event-stream readers (A1): one input per stream, read as one DataFrame.

Streaming: ``read_streams`` builds one ``readStream`` per stream folder with a
per-trigger file cap (the consumer's bounded batch), tags each with its
stream name and unions them. A new query (new checkpoint) starts at the
beginning of every stream, like a new consumer group. The batch twin uses
``spark.read`` on the same folders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

MESSAGE_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("arrival_seq", LongType()),
    StructField("event_type", StringType()),
    StructField("client_id", StringType()),
    StructField("event_ts", TimestampNTZType()),
    StructField("data", StringType()),
])


def union_streams(per_stream: Mapping[str, DataFrame]) -> DataFrame:
    """Tag each input with its stream name and union them by column name."""
    out = None
    for name, df in per_stream.items():
        tagged = df.withColumn("stream", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no streams given")
    return out


def read_streams(spark: SparkSession, paths: Mapping[str, str], max_files_per_trigger: int = 10,
                 schema: StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Streaming read of several Parquet stream folders as one stream."""
    return union_streams({
        name: spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
        for name, path in paths.items()
    })


def read_batches(spark: SparkSession, paths: Mapping[str, str], schema: StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Batch twin of ``read_streams``."""
    return union_streams({name: spark.read.schema(schema).parquet(path) for name, path in paths.items()})
