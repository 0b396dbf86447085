"""Month-partitioned tables: partition values, writes, calendar coverage, retention.

Spark needs no pre-created partitions; what remains of the reference's
partition functions is their decision logic, computed from the data.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import MONTH_NAME_FORMAT, month_key
from tidemill.session import scratch_path

PARTITION_PREFIX = "logs_"


def with_month(df: DataFrame, ts_col: str = "ts", name: str = "month") -> DataFrame:
    """Add the month partition value (first day of the month) of ``ts_col``."""
    return df.withColumn(name, month_key(F.col(ts_col)))


def write_monthly(df: DataFrame, path: str, ts_col: str = "ts", cluster_by: tuple[str, ...] = (),
                  unit: tuple[str, ...] = ()) -> None:
    """Write partitioned by month; a rerun replaces only the (unit, month) pairs it writes (A5).

    ``partitionOverwriteMode=dynamic`` is set on the writer, so rewriting one
    period leaves the other months alone. Inside a rewritten month, rows of
    units (say, clients) that ``df`` does not hold for that month are carried
    over: they are copied to the shared folder first, as a table cannot be
    read while its files are replaced. Without ``unit`` whole months go. Rows are range-partitioned by
    (month, cluster keys, time) and sorted that way inside each month, so a
    hot month or a hot client-month is split over several tasks by time, files
    stay few and large, and Parquet min/max statistics prune reads of one
    client (the partition count grows with months, not with clients x months).
    """
    out = with_month(df, ts_col)
    if unit:
        out = out.unionByName(_carried_over(out, path, unit))
    order = ["month", *cluster_by, ts_col]
    (out.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("month").parquet(path))


def _carried_over(out: DataFrame, path: str, unit: tuple[str, ...]) -> DataFrame:
    """Rows stored at ``path`` in months of ``out`` whose unit ``out`` does not replace."""
    spark = out.sparkSession
    try:
        old = spark.read.parquet(path).select(out.columns)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return out.limit(0)
    kept = (old.join(out.select("month").distinct(), "month", "left_semi")
               .join(out.select(*unit, "month").distinct(), [*unit, "month"], "left_anti").select(out.columns))
    copy = scratch_path(spark, f"carried-{uuid.uuid4().hex}")
    kept.write.parquet(copy)
    return spark.read.schema(kept.schema).parquet(copy)


def partition_counts(df: DataFrame, keys: tuple[str, ...] = (), ts_col: str = "ts") -> DataFrame:
    """Rows per (keys, month): what each partition of ``write_monthly`` holds."""
    return with_month(df, ts_col).groupBy(*keys, "month").agg(F.count(F.lit(1)).alias("rows"))


def partition_name(month: Column) -> Column:
    return F.concat(F.lit(PARTITION_PREFIX), F.date_format(month, MONTH_NAME_FORMAT))


def month_calendar(df: DataFrame, as_of: Column, months_ahead: int = 3, ts_col: str = "ts") -> DataFrame:
    """Months from that of ``as_of`` to ``months_ahead`` later (inclusive), with the rows each
    holds; months without rows are the ones the reference would pre-create (P2).

    The per-month counts are one row per month (bounded by the calendar), so
    the calendar join is a broadcast.
    """
    counts = partition_counts(df, ts_col=ts_col)
    lo = month_key(as_of)
    cal = (df.sparkSession.range(1)
             .select(F.explode(F.sequence(lo, F.add_months(lo, months_ahead), F.expr("interval 1 month"))).alias("month")))
    return (cal.join(F.broadcast(counts), "month", "left")
               .select(partition_name(F.col("month")).alias("partition"), F.col("month").alias("start"),
                       F.add_months(F.col("month"), 1).alias("end"),
                       F.coalesce(F.col("rows"), F.lit(0)).alias("rows")))


def retention_plan(df: DataFrame, as_of: Column, retention_days: int = 90, ts_col: str = "ts") -> DataFrame:
    """Partitions to drop: month start before ``as_of - retention_days``.

    As in the reference the test is on the month's *start*, so a dropped
    partition can still hold rows newer than the cutoff; they are counted.
    """
    cutoff = F.to_date(as_of - F.make_dt_interval(days=F.lit(retention_days)))
    m = with_month(df, ts_col)
    return (m.groupBy("month")
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.to_date(F.col(ts_col)) >= cutoff).alias("rows_after_cutoff"))
             .select(partition_name(F.col("month")).alias("partition"), "month", "rows",
                     (F.col("month") < cutoff).alias("drop"),
                     F.when(F.col("month") < cutoff, F.col("rows_after_cutoff")).otherwise(F.lit(0))
                      .alias("rows_lost_early")))
