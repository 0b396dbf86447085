"""Input views derived from the driver tables (schemas in FIXTURES.md).

Each function returns a DataFrame built with the DataFrame API; the
equivalent DuckDB text lives in ``tidemill.plans.views`` for the oracles.
Everything is a narrow projection of one scan except ``sales`` (one
aggregation), ``weather``/``holidays`` (a distinct over days) and
``bom_explosion_status`` (one aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.tables import read_table


def _uuid_of(col: Column) -> Column:
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(col.cast("string"), 12, "0"))


def raw_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Message envelopes from ``events``: bad JSON, empty payloads, unknown types, no client id,
    and failures (payload not an object, unusable or missing id, client id that is no UUID).

    ``events`` may be given instead (e.g. a streaming read of the same table).
    """
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    ev = ev.select("event_id", "ts", "user_id", "event_type")
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    uuid = _uuid_of(uid)
    signup = F.concat(
        F.lit('{"id":"'), uuid,
        F.lit('","name":"client '), uid.cast("string"),
        F.lit('","organization_id":"'), (uid % 7).cast("string"),
        F.lit('","status":"'), F.when(eid % 5 == 0, "suspended").otherwise("active"),
        F.lit('","features_enabled":{"feature_engineering":true,"bom_explosion":'),
        F.when(eid % 2 == 0, "true").otherwise("false"),
        F.lit('},"config_confirmed":'), F.when(eid % 3 == 0, "false").otherwise("true"),
        F.lit(',"created_at":"2024-01-'), F.lpad((1 + eid % 28).cast("string"), 2, "0"),
        F.lit('T00:00:00Z"}'),
    )
    other = F.concat(
        F.lit('{"table_name":"c'), (uid % 7).cast("string"),
        F.lit('_sales","record_count":'), (eid % 90).cast("string"), F.lit("}"),
    )
    return ev.select(
        eid.cast("string").alias("event_id"),
        eid.alias("arrival_seq"),
        F.col("ts").alias("event_ts"),
        F.when(etype == "signup", "clients-updates")
         .when(etype == "purchase", "sales-updates")
         .otherwise("other-updates").alias("stream"),
        F.when(etype == "signup", "clients_updated")
         .when(etype == "purchase", "sales_updated")
         .when(etype == "click", "stock_updated")
         .when(etype == "view", "bom_updated")
         .otherwise("mystery").alias("event_type"),
        F.when(eid % 40 == 7, F.lit(None).cast("string")).when(eid % 40 == 9, "not-a-uuid").otherwise(uuid).alias("client_id"),
        F.when(eid % 50 == 0, "not json")
         .when(eid % 50 == 1, "{}")
         .when(eid % 50 == 2, "[1]")
         .when(eid % 50 == 3, '{"id":"nope","name":"x","organization_id":"1"}')
         .when(eid % 50 == 4, '{"name":"x","organization_id":"1"}')
         .when(etype == "signup", signup)
         .otherwise(other).alias("data"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client table with integer ids and every boolean spelling in ``features_enabled``."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                   "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    feats = (F.when(key % 7 == 0, '{"forecast":true}')
              .when(key % 7 == 1, '{"forecast":false}')
              .when(key % 7 == 2, '{"forecast":"yes"}')
              .when(key % 7 == 3, '{"forecast":"on"}')
              .when(key % 7 == 4, '{"forecast":"abc"}')
              .when(key % 7 == 5, '{"forecast":null}')
              .otherwise("{}"))
    return c.select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("organization_id"),
        F.when(seg == "HOUSEHOLD", "suspended").when(seg == "MACHINERY", "archived")
         .otherwise("active").alias("status"),
        (F.col("c_acctbal") > 2000).alias("config_confirmed"),
        F.when(key % 3 == 0, "prefixed_tables").when(key % 3 == 1, "dedicated_db")
         .otherwise("shared").alias("tenant_mode"),
        feats.alias("features_enabled"),
    )


def logs(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Structured log rows from ``events`` (or from a given, possibly streaming, ``events``)."""
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    ev = ev.select("ts", "user_id", "event_id", "event_type", "props", "value")
    eid, etype = F.col("event_id"), F.col("event_type")
    return ev.select(
        F.col("ts"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 3).cast("string")).alias("service_name"),
        F.when(eid % 3 == 0, "dev").when(eid % 3 == 1, "stage").otherwise("prod").alias("environment"),
        F.when(etype == "error", "error").when(etype == "click", "info")
         .when(etype == "view", "debug").when(etype == "signup", "warn")
         .otherwise("fatal").alias("level"),
        F.when(eid % 4 == 0, "messenger").when(eid % 4 == 1, "database")
         .when(eid % 4 == 2, "starrocks").alias("category"),
        F.concat(F.lit("trace-"), (eid % 100).cast("string")).alias("trace_id"),
        F.concat(F.lit("message "), eid.cast("string")).alias("message"),
        F.col("props").alias("context"),
        F.when(eid % 10 == 0, F.lit(None).cast("int"))
         .otherwise(F.floor("value").cast("int")).alias("duration_ms"),
        eid,
    )


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold quantities (client_id, product_id, ds, qty), a row per order line."""
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity")
    return li.select(F.col("l_suppkey").alias("client_id"), F.col("l_partkey").alias("product_id"),
                     F.to_date("l_shipdate").alias("ds"), F.col("l_quantity").alias("qty"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quantity per (client_id, product_id, ds); one aggregation with map-side combine."""
    return sale_lines(spark, sf_dir).groupBy("client_id", "product_id", "ds").agg(F.sum("qty").alias("qty"))


def bom(spark: SparkSession, sf_dir: str, with_cycle: bool = False) -> DataFrame:
    """Acyclic BOM edges from ``part``; ``with_cycle`` adds the edge 0 -> 5."""
    p = read_table(spark, sf_dir, "part", "p_partkey").filter(F.col("p_partkey") >= 1)
    key = F.col("p_partkey")
    site = F.concat(F.lit("site-"), (key % 5).cast("string"))
    by3 = F.floor(key / 3).cast("bigint")
    by7 = F.floor(key / 7).cast("bigint")
    first = p.select(key.alias("parent"), by3.alias("component"),
                     ((1 + key % 4) * 0.25).alias("qty"), site.alias("produced_at"))
    second = (p.filter(by7 != by3)
               .select(key.alias("parent"), by7.alias("component"),
                       ((1 + key % 3) * 0.5).alias("qty"), site.alias("produced_at")))
    edges = first.unionByName(second)
    if with_cycle:
        spark_ = p.sparkSession
        extra = spark_.createDataFrame([(0, 5, 1.0, "site-0")], "parent bigint, component bigint, qty double, produced_at string")
        edges = edges.unionByName(extra)
    return edges


def feature_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only config history, some parameters invalid."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("client_id"),
        F.when(k % 3 == 0, "ema").when(k % 3 == 1, "lags").otherwise("seasonality").alias("feature_type"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
        (30 + k % 400).cast("int").alias("window_days"),
        (k % 10).cast("int").alias("min_samples"),
        F.when(k % 4 == 0, "decay").when(k % 4 == 1, "fill_zero").when(k % 4 == 2, "drop")
         .otherwise("bogus").alias("nan_strategy"),
    )


def bom_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only BOM parameters per client, some with a depth that is missing or out of range."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("client_id"),
        F.when(k % 29 == 0, F.lit(None).cast("int")).otherwise((k % 13).cast("int")).alias("max_levels"),
        (k % 2 == 0).alias("include_produced_at"),
        (k % 3 != 0).alias("cycle_detection"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
        F.col("o_orderdate").alias("created_at"),
    )


def bom_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients of BOM runs: every supplier, and as many that sell nothing."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey")
    return s.select(F.explode(F.array(F.col("s_suppkey"), -1 - F.col("s_suppkey"))).alias("client_id"))


def bom_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of ``bom`` before a change: some missing, some with another quantity, one more."""
    edges = bom(spark, sf_dir)
    key = F.col("parent")
    gone = (key % 97 == 5) & (F.col("component") % 2 == 0)
    extra = edges.filter(key % 89 == 3).select("parent", (key - 1).alias("component"), F.lit(2.0).alias("qty"), "produced_at")
    return (edges.filter(~gone).withColumn("qty", F.when(key % 101 == 7, F.col("qty") * 2).otherwise(F.col("qty")))
                 .unionByName(extra))


def config_alpha() -> Column:
    """Smoothing factor of a config row: 0 to 1, missing for some, out of range for a few."""
    k = F.col("id")
    return F.when(k % 13 == 0, F.lit(None).cast("double")).when(k % 17 == 0, F.lit(1.5)).otherwise((k % 11) / 10.0)


def bom_explosion_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    return (o.filter(F.col("o_custkey") % 3 != 0)
             .groupBy(F.col("o_custkey").alias("client_id"))
             .agg(F.max("o_orderdate").alias("last_processed_at"),
                  F.count(F.lit(1)).alias("records_processed")))


def client_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", "s_suppkey")
    return s.select(
        F.col("s_suppkey").alias("client_id"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("date"))
         .otherwise(F.lit("2000-01-01").cast("date")).alias("last_processed_at"),
    )


def tenant_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "value", "event_id")
    return ev.select(
        (F.col("user_id") % 10).alias("tenant_id"),
        F.to_date("ts").alias("day"),
        F.col("value").alias("latency_ms"),
        (F.col("event_id") * 10).alias("bytes"),
    )


def promos(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey").filter(F.col("p_partkey") % 5 == 0)
    off = (F.col("p_partkey") % 365).cast("int")
    start = F.lit("1998-01-01").cast("date")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.date_add(start, off).alias("start_ds"),
        F.date_add(start, off + 13).alias("end_ds"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sales day (bounded by the calendar, not by data volume)."""
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate")
    d = F.col("l_shipdate")
    return li.select(
        F.to_date(d).alias("ds"),
        (5 + F.dayofmonth(d) % 20).alias("temperature"),
        (F.month(d) % 4).alias("precipitation"),
        (1 + F.dayofmonth(d) % 9).alias("wind"),
    ).distinct()


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate")
    d = F.col("l_shipdate")
    cond = ((F.month(d) == 1) & (F.dayofmonth(d) <= 7)) | ((F.month(d) == 5) & F.dayofmonth(d).isin(1, 9))
    return li.filter(cond).select(F.to_date(d).alias("ds")).distinct()


def log_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logger calls behind the ``logs`` rows: base fields, call fields, caller file, stack trace.

    Call fields come from the row's JSON context plus ``duration_ms`` and, for
    every seventh event, a ``_category`` override; the base fields share the
    key ``k`` with the call fields so the overlay is visible.
    """
    lg = logs(spark, sf_dir)
    eid = F.col("event_id")
    empty = F.create_map().cast("map<string,string>")
    call = F.map_concat(
        F.coalesce(F.from_json("context", "map<string,string>"), empty),
        F.when(F.col("duration_ms").isNotNull(),
               F.create_map(F.lit("duration_ms"), F.col("duration_ms").cast("string"))).otherwise(empty),
        F.when(eid % 7 == 0, F.create_map(F.lit("_category"), F.lit("security"))).otherwise(empty),
    )
    return lg.select(
        "ts", "service_name", "environment", "level", "category", "trace_id", "message", "event_id",
        F.create_map(F.lit("service"), F.col("service_name"), F.lit("k"), F.lit("base")).alias("base_context"),
        call.alias("call_fields"),
        F.when(eid % 3 == 0, "/app/src/handlers/event_handler.py")
         .when(eid % 3 == 1, "/usr/lib/python3/site.py").otherwise("main.py").alias("file_path"),
        F.concat(F.lit("Traceback "), eid.cast("string")).alias("stack_trace"),
    )


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``log_calls`` with the other columns of the log table, spread over three months and a gap."""
    calls, eid = log_calls(spark, sf_dir), F.col("event_id")
    back = F.when(eid % 5 == 0, 92).when(eid % 5 == 1, 61).otherwise(0)
    return calls.select(
        *[c for c in calls.columns if c != "ts"],
        (F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(days=back)).alias("ts"),
        F.concat(F.lit("i-"), (eid % 6).cast("string")).alias("instance_id"),
        F.when(eid % 4 != 0, F.concat(F.lit("node-"), (eid % 4).cast("string"))).alias("node_name"),
        F.lpad(F.lower(F.hex(eid)), 16, "0").alias("span_id"),
        F.when(eid % 3 != 0, F.concat(F.lit("req-"), (eid % 50).cast("string"))).alias("request_id"),
        F.concat(F.lit("run_"), (eid % 8).cast("string")).alias("function_name"),
        (1 + eid % 300).cast("int").alias("line_number"),
        F.when(F.col("level") == "error", F.concat(F.lit("failed "), eid.cast("string"))).alias("error_message"),
        (F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(2))).alias("ingestion_time"),
    )
