"""Structured-log jobs: statistics (D1), severity/trace/recent filters, last errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numeric import round_half_up_ratio
from tidemill.functions.text import source_path

# The log levels that keep a stack trace / count as severe.
SEVERE_LEVELS = ("error", "fatal", "panic")
# The event categories.
CATEGORIES = ("feature_engineering", "bom_explosion", "database", "messenger", "pipeline", "starrocks", "cache", "security")
# Columns that log rows keep as given, where a call has them.
CARRIED = ("event_id", "instance_id", "node_name", "span_id", "request_id", "function_name", "line_number", "error_message", "ingestion_time")


def log_stats(logs: DataFrame, as_of: Column, hours_back: int = 24) -> DataFrame:
    """Count and 2-decimal mean duration per service x environment x level, by count desc.

    ``timestamp >= as_of - hours_back`` (no upper bound, as in the reference).
    One hash aggregation with map-side partial counts, so a hot service does
    not concentrate rows before the shuffle.
    """
    lo = as_of - F.make_dt_interval(hours=F.lit(hours_back))
    d = F.col("duration_ms")
    return (logs.filter(F.col("ts") >= lo)
                .groupBy(F.col("service_name").alias("service"), "environment", "level")
                .agg(F.count(F.lit(1)).alias("count"),
                     F.sum(d.cast("long")).alias("_sum"),
                     F.count(d).alias("_n"))
                .select("service", "environment", "level", "count",
                        round_half_up_ratio(F.col("_sum"), F.col("_n"), 2).alias("avg_duration_ms"))
                .orderBy(F.col("count").desc()))


def normalise_logs(raw: DataFrame) -> DataFrame:
    """Log rows as stored.

    ``raw`` carries ``base_context`` and ``call_fields`` (``map<string,string>``),
    ``file_path`` and ``stack_trace`` next to the fixed columns.

    * context = base fields overlaid by call fields (call wins; null maps are
      empty); ``_category`` moves out and, if it comes with the call and is a
      known one, replaces the category; ``duration_ms`` moves out and is
      cast to int; an empty context is null;
    * the source path keeps the part from the first ``src`` folder on, else
      the file name;
    * a stack trace is kept only for severe levels.
    """
    nothing = F.create_map().cast("map<string,string>")
    base, call = F.coalesce("base_context", nothing), F.coalesce("call_fields", nothing)
    category = F.when(call["_category"].isin(*CATEGORIES), call["_category"])
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(call), k)), call)
    ctx = F.map_filter(merged, lambda k, v: ~k.isin("_category", "duration_ms"))
    return raw.select(
        "ts", "service_name", "environment", "level",
        F.coalesce(category, F.col("category")).alias("category"),
        "trace_id", "message",
        F.when(F.size(ctx) > 0, ctx).alias("context"),
        merged["duration_ms"].try_cast("double").try_cast("int").alias("duration_ms"),
        source_path(F.col("file_path")).alias("file_path"),
        F.when(F.col("level").isin(*SEVERE_LEVELS), F.col("stack_trace")).alias("stack_trace"),
        *[c for c in raw.columns if c in CARRIED],
    )


def context_text(ctx: Column) -> Column:
    """A context map as sorted ``k=v`` pairs joined by ``;`` (stable text for reports)."""
    pairs = F.transform(F.map_entries(ctx), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return F.array_join(F.array_sort(pairs), ";")


def severe_logs(logs: DataFrame) -> DataFrame:
    """error/fatal/panic rows, newest first."""
    return logs.filter(F.col("level").isin(*SEVERE_LEVELS)).orderBy(F.col("ts").desc(), F.col("event_id").desc())


def logs_for_trace(logs: DataFrame, trace_id: str) -> DataFrame:
    """All rows of one trace."""
    return logs.filter(F.col("trace_id") == trace_id)


def logs_for_context(logs: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose JSON context has ``key = value``."""
    return logs.filter(F.from_json("context", "map<string,string>")[key] == value)


def recent_logs(logs: DataFrame, category: str, as_of: Column, minutes: int) -> DataFrame:
    """Rows of a category newer than ``as_of - minutes``, newest first."""
    lo = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return (logs.filter((F.col("category") == category) & (F.col("ts") > lo))
                .orderBy(F.col("ts").desc(), F.col("event_id").desc()))


def last_errors(logs: DataFrame, category: str, n: int = 20) -> DataFrame:
    """The newest ``n`` error rows of a category (F1): a top-k, planned as TakeOrderedAndProject."""
    return (logs.filter((F.col("category") == category) & (F.col("level") == "error"))
                .orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(n))
