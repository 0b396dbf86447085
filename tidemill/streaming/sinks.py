"""Tables that micro-batches write, safe against retried batches and new checkpoints.

A batch's rows lie under ``query=<id>/batch=<n>``. The query id is the one Spark keeps in the checkpoint:
a restarted query has the same id and a repeated batch replaces its own rows; a new checkpoint has a new
id and touches nothing that is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query whose ``foreachBatch`` function is running."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("called outside foreachBatch: no streaming query id")
    return found


def write_batch(rows: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Put ``rows`` in place of what batch ``batch_id`` of ``query`` wrote before."""
    (rows.withColumn("query", F.lit(query)).withColumn("batch", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows with ``query`` and ``batch``; None where nothing is written yet."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def each_batch(path: str, of: Callable[[DataFrame], DataFrame]):
    """``foreachBatch`` function that writes ``of(batch)`` under ``path``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(of(batch), path, query_id(batch), batch_id)
    return sink
