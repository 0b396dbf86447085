"""Running a streaming query to completion over the data that is there (tests, catch-up jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.sources.tables import table_path


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A driver table read as a file stream (schema taken from the batch read)."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    # A file source watches a folder or a glob; the brace glob names exactly this table's file(s).
    glob = f"{sf_dir.rstrip('/')}/{{{name}}}.parquet"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(glob)


def run_available(writer, checkpoint: str) -> None:
    """Start with ``availableNow`` (process everything there, then stop) and wait."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
