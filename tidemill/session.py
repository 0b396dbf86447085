"""Session helpers.

Cluster settings win: nothing here overrides a value the cluster already
set, except the few SQL settings every job in this package relies on.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on; applied with ``setdefault`` semantics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial (map-side) aggregation stays on for skewed keys.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemill", driver_memory: str | None = None) -> SparkSession:
    """Create or reuse a session; used by tests, bench and the CLI entry points.

    ``driver_memory`` only takes effect when this call starts the JVM (local mode).
    """
    builder = SparkSession.builder.appName(app_name)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset on a local master (tests) a scratch folder is created.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tidemill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def checkpointed(df):
    """``df.checkpoint()`` into the shared folder (made known to the context first)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: With it Spark removes a query's shuffle files when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession):
    """What is written inside leaves no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df, name: str):
    """``df`` written once as a compressed table in the shared folder and reread: smaller than a checkpoint."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_end(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_buckets(run, spark: SparkSession, name: str, buckets: int, keys: list[str], order: str):
    """One table in the shared folder, in buckets of ``keys`` sorted by ``order``, written in runs.

    ``run(k, so_far)`` gives the rows of run ``k`` (0, 1, ...) or None at the end; ``so_far`` is the table until then.
    Reread the table is dealt by ``keys``: grouping by these needs no exchange. The catalog holds its name only
    while it is written.
    """
    unique = f"{name}-{uuid.uuid4().hex}"
    table, path = unique.replace("-", "_"), scratch_path(spark, unique)
    so_far, k = None, 0
    try:
        while (df := run(k, so_far)) is not None:
            with shuffles_end(spark):
                (df.write.mode("append").option("compression", "zstd").option("path", path)
                   .bucketBy(buckets, *keys).sortBy(order).saveAsTable(table))
            spark.catalog.refreshTable(table)
            so_far, k = spark.table(table), k + 1
        return so_far
    finally:
        spark.sql(f"drop table if exists {table}")


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Shuffle partitions for ``rows``, so that a task's share stays the same however many there are."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
