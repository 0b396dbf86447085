"""The stored log table: 19 columns, a typed context, month partitions.

Files lie under ``data/month=<first day>``. Every read by time goes through ``time_range``, so months outside
the asked range are pruned from the partition values. Row counts per month come from the files' footers
(an aggregate pushed into the scan), not from rows. Retention writes a manifest that names the dropped months;
reads leave these out from then on, and their files may be removed at any time later.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.time import month_key, time_range
from tidemill.operators.logs import normalise_logs

# The columns of the log table.
LOG_COLUMNS = ["ts", "service_name", "instance_id", "node_name", "environment", "level", "category", "trace_id", "span_id",
               "request_id", "function_name", "file_path", "line_number", "message", "error_message", "stack_trace", "context",
               "duration_ms", "ingestion_time"]


def typed_context(ctx: Column) -> Column:
    """A map of texts as a variant object: numbers, booleans and nested JSON keep their type, other text is a string."""
    typed = F.transform_values(ctx, lambda _, v: F.coalesce(F.try_parse_json(v), v.cast("variant")))
    return F.to_variant_object(typed)


def log_records(calls: DataFrame) -> DataFrame:
    """Logger calls as rows of the table: normalised, with a typed context (null if empty)."""
    rows = normalise_logs(calls)
    return rows.select(*[typed_context(F.col(c)).alias(c) if c == "context" else c for c in LOG_COLUMNS],
                       *[c for c in rows.columns if c == "event_id"])


class LogTable:
    """A month-partitioned log table in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, records: DataFrame) -> None:
        """Adds rows; a hot month is written by several tasks, split by time."""
        out = records.withColumn("month", month_key(F.col("ts")))
        (out.repartitionByRange(F.col("month"), F.col("ts"))
            .write.mode("append").partitionBy("month").parquet(f"{self.path}/data"))

    def dropped(self) -> list[dt.date]:
        """Months that retention has dropped (one entry a month)."""
        schema = "month date, n_rows long, dropped_at timestamp_ntz"
        try:
            manifest = self.spark.read.schema(schema).parquet(f"{self.path}/dropped")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["month"] for r in manifest.select("month").distinct().collect())

    def read(self, lo: Column | None = None, hi: Column | None = None) -> DataFrame:
        """Rows with ``lo <= ts < hi`` (either may be open) of the months that are kept, with ``month``."""
        rows = self.spark.read.parquet(f"{self.path}/data")
        gone = self.dropped()
        if gone:
            rows = rows.filter(~F.col("month").isin(gone))
        return time_range(rows, "ts", lo, hi, "month")

    def month_counts(self) -> dict[dt.date, int]:
        """Rows of every kept month, from partition values and file footers; no row is read."""
        return {r["month"]: r["n"] for r in self.month_counts_frame().collect()}

    def month_counts_frame(self) -> DataFrame:
        own = self.spark.newSession()
        own.conf.set("spark.sql.sources.useV1SourceList", "")
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        rows = own.read.parquet(f"{self.path}/data")
        gone = self.dropped()
        if gone:
            rows = rows.filter(~F.col("month").isin(gone))
        return rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"))

    def calendar(self, ahead_of: dt.date, months_ahead: int = 3) -> DataFrame:
        """Every month from the oldest kept one to ``months_ahead`` after ``ahead_of``, with its rows (gaps: 0)."""
        counts = self.month_counts()
        first, last = min([*counts, ahead_of.replace(day=1)]), _plus(ahead_of, months_ahead)
        months = []
        while first <= max([last, *counts]):
            months.append(first)
            first = _plus(first, 1)
        return self.spark.createDataFrame([(f"logs_{m:%Y_%m}", m, _plus(m, 1), counts.get(m, 0)) for m in months],
                                          "partition string, start date, end date, rows long")

    def retention(self, as_of: dt.datetime, days: int) -> DataFrame:
        """Which kept months go (they begin before the day ``days`` before ``as_of``) and how many of their rows are
        newer than that day. Only the month that holds that day has such rows; it alone is scanned."""
        cut = (as_of - dt.timedelta(days=days)).date()
        counts = self.month_counts()
        straddled = cut.replace(day=1)
        early = self.read(F.lit(cut).cast("timestamp_ntz"), F.lit(_plus(cut, 1)).cast("timestamp_ntz")).count() if straddled in counts and straddled < cut else 0
        rows = [(f"logs_{m:%Y_%m}", m, n, m < cut, early if m == straddled and m < cut else 0) for m, n in sorted(counts.items())]
        return self.spark.createDataFrame(rows, "partition string, month date, rows long, drop boolean, rows_lost_early long")

    def apply_retention(self, as_of: dt.datetime, days: int) -> list[dt.date]:
        """Drops what ``retention`` names, by one append to the manifest; repeating it drops nothing more."""
        plan = self.retention(as_of, days).filter("drop")
        out = plan.select("month", F.col("rows").alias("n_rows"), F.lit(as_of).cast("timestamp_ntz").alias("dropped_at"))
        gone = sorted(r["month"] for r in out.select("month").collect())
        if gone:
            out.coalesce(1).write.mode("append").parquet(f"{self.path}/dropped")
        return gone


def _plus(day: dt.date, months: int) -> dt.date:
    """The first day of the month ``months`` after that of ``day``."""
    at = day.year * 12 + day.month - 1 + months
    return dt.date(at // 12, at % 12 + 1, 1)


def logs_for_request(rows: DataFrame, request_id: str) -> DataFrame:
    """All rows of one request."""
    return rows.filter(F.col("request_id") == request_id)


def logs_with_context(rows: DataFrame, path: str, value: Column, kind: str) -> DataFrame:
    """Rows whose typed context holds ``value`` of type ``kind`` at ``path``."""
    return rows.filter(F.try_variant_get("context", path, kind) == value)
