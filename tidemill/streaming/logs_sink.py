"""Log rows as a stream (A4, K4): micro-batches appended to a month-partitioned table.

The reference flushes every 100 rows or 5 seconds; here the trigger interval
is the time bound and the source's ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``
bounds a batch. A failed batch is retried by the engine from the checkpoint,
so no row is lost or written twice by the file sink's commit protocol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.operators.partitions import with_month


def log_sink(logs: DataFrame, path: str, interval: str | None = "5 seconds"):
    """Writer for a streaming log DataFrame; call ``.option("checkpointLocation", ...).start()``."""
    w = (with_month(logs).writeStream.format("parquet").outputMode("append")
                        .partitionBy("month").option("path", path))
    return w.trigger(processingTime=interval) if interval else w
