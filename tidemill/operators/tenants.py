"""Multi-tenant routing, tenant split, upgrade signals, and parameterised SQL."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Tenant modes and the data types stored per tenant; the shared database is a parameter.
SHARED_DATABASE = "shared"
DATA_TYPES = ("features", "bom", "timeseries")
TENANT_MODES = ("prefixed_tables", "dedicated_db", "shared")
# Documented upgrade triggers.
VOLUME_90D_BYTES = 300 * 10**9
INGRESS_DAY_BYTES = 2 * 10**12
P95_FACTOR = 2.0
P95_DAYS_IN_A_ROW = 3
COMPUTE_SHARE = 0.25


def run_sql(spark: SparkSession, query: str, args: Mapping[str, object] | None = None,
            **tables: DataFrame) -> DataFrame:
    """Parameterised analytic SQL (A2): ``:name`` markers bound from ``args``; ``{t}`` in the
    text refers to a DataFrame passed as keyword ``t``. The result stays a DataFrame:
    ``fetch_one`` is ``.limit(1)``, ``execute`` is ``.count()``."""
    return spark.sql(query, args=dict(args or {}), **tables)


def tenant_routes(clients: DataFrame, data_types: tuple[str, ...] = DATA_TYPES,
                  shared_database: str = SHARED_DATABASE) -> DataFrame:
    """(tenant_mode, organization_id, data_type) -> database, table and row filter.

    Unknown or missing modes use the default ``prefixed_tables``. The data-type
    list is a literal array exploded per client (a generator, not a join).
    """
    mode = F.when(F.col("tenant_mode").isin(*TENANT_MODES), F.col("tenant_mode")).otherwise("prefixed_tables")
    org = F.col("organization_id")
    dt = F.col("data_type")
    rows = clients.select("id", "organization_id", mode.alias("tenant_mode"),
                          F.explode(F.array(*[F.lit(d) for d in data_types])).alias("data_type"))
    return rows.select(
        "id", "organization_id", "tenant_mode", "data_type",
        F.when(F.col("tenant_mode") == "dedicated_db", F.concat(F.lit("client_"), org))
         .otherwise(F.lit(shared_database)).alias("database"),
        F.when(F.col("tenant_mode") == "prefixed_tables", F.concat(F.lit("c"), org, F.lit("_"), dt))
         .otherwise(dt).alias("table"),
        F.when(F.col("tenant_mode") == "shared", F.concat(F.lit("tenant_id = "), org)).alias("row_filter"),
    )


def split_tenant(shared: DataFrame, tenant_id, path: str, ts_col: str = "day") -> DataFrame:
    """Copy one tenant out of a shared table into its own month-partitioned table
    and reconcile row counts per month (source vs written)."""
    part = (shared.filter(F.col("tenant_id") == F.lit(tenant_id)).drop("tenant_id")
                  .withColumn("month", F.trunc(F.col(ts_col), "month")))
    part.repartitionByRange("month", ts_col).write.mode("overwrite").partitionBy("month").parquet(path)
    spark = shared.sparkSession
    written = (spark.read.schema(part.schema).parquet(path)
                    .groupBy("month").agg(F.count(F.lit(1)).alias("written_rows")))
    source = part.groupBy("month").agg(F.count(F.lit(1)).alias("source_rows"))
    return (source.join(written, "month", "full")
                  .select(F.lit(tenant_id).alias("tenant_id"), "month",
                          F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                          F.coalesce("written_rows", F.lit(0)).alias("written_rows"))
                  .withColumn("match", F.col("source_rows") == F.col("written_rows")))


def scratch_dir(spark: SparkSession, name: str) -> str:
    from tidemill.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def volume_signals(usage: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Bytes over the last ``days`` and the largest day per tenant, with both flags."""
    lo = F.date_sub(F.to_date(as_of), days)
    per_day = (usage.filter(F.col("day") > lo)
                    .groupBy("tenant_id", "day").agg(F.sum("bytes").alias("day_bytes")))
    return (per_day.groupBy("tenant_id")
                   .agg(F.sum("day_bytes").alias("bytes_90d"), F.max("day_bytes").alias("max_day_bytes"))
                   .withColumn("volume_flag", F.col("bytes_90d") > VOLUME_90D_BYTES)
                   .withColumn("ingress_flag", F.col("max_day_bytes") > INGRESS_DAY_BYTES))


def _rank(q: float) -> Column:
    return F.lit(q) * (F.col("total") - 1)


def _holds(q: float) -> Column:
    """The row's ``n`` items after the first ``before`` of ``total`` include a rank that quantile ``q`` needs."""
    inside = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
    return inside(F.floor(_rank(q))) | inside(F.ceil(_rank(q)))


def _held(counts: DataFrame, by: list[str], q: float) -> DataFrame:
    """The cells of ``counts`` (by, cell, n) with the middle ranks of each group, and the rows before them."""
    group = Window.partitionBy(*by)
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("before", F.sum("n").over(upto) - F.col("n")).withColumn("total", F.sum("n").over(group))
                  .filter(_holds(q)).select(*by, "cell", "before", "total"))


def _quantile(values: DataFrame, by: list[str], q: float) -> DataFrame:
    """Quantile of each group from its held cells' ``values`` (by, cell, before, total, latency_ms, n)."""
    inside = (Window.partitionBy(*by, "cell").orderBy("latency_ms")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = values.withColumn("before", F.col("before") + F.sum("n").over(inside) - F.col("n"))
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("latency_ms")))
    low, high = at(F.floor(_rank(q))), at(F.ceil(_rank(q)))
    return ranked.groupBy(*by).agg(low.alias("_low"), high.alias("_high"), F.max(_rank(q)).alias("_rank")).select(
        *by, (F.col("_low") + (F.col("_rank") - F.floor("_rank")) * (F.col("_high") - F.col("_low"))).alias("value"))


def latency_levels(usage: DataFrame, q: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(tenant_id, day, p95) and (day, cluster_median), both exact, without a tenant-day or day in one buffer.

    One table counts rows per (tenant, day, whole millisecond). Cumulative counts name the cells with
    the ranks that the tenant's quantile or the day's median needs, and a second pass counts the single
    values of those cells only. Rows without a latency take no part.
    """
    rows = (usage.filter(F.col("latency_ms").isNotNull())
                 .select("tenant_id", "day", "latency_ms", F.floor("latency_ms").alias("cell")))
    counts = rows.groupBy("tenant_id", "day", "cell").agg(F.count(F.lit(1)).alias("n"))
    of_tenant = _held(counts, ["tenant_id", "day"], q)
    of_day = _held(counts.groupBy("day", "cell").agg(F.sum("n").alias("n")), ["day"], 0.5)      # at most two rows a day
    wanted = (counts.join(of_tenant.select("tenant_id", "day", "cell", F.struct("before", "total").alias("tenant")), ["tenant_id", "day", "cell"], "left")
                    .join(F.broadcast(of_day.select("day", "cell", F.struct("before", "total").alias("whole"))), ["day", "cell"], "left")
                    .filter("tenant is not null or whole is not null").select("tenant_id", "day", "cell", "tenant", "whole"))
    values = (rows.join(wanted, ["tenant_id", "day", "cell"])
                  .groupBy("tenant_id", "day", "cell", "tenant", "whole", "latency_ms").agg(F.count(F.lit(1)).alias("n")))
    mine = values.filter("tenant is not null").select("tenant_id", "day", "cell", "tenant.*", "latency_ms", "n")
    whole = (values.filter("whole is not null").groupBy("day", "cell", "whole", "latency_ms").agg(F.sum("n").alias("n"))
                   .select("day", "cell", "whole.*", "latency_ms", "n"))
    return (_quantile(mine, ["tenant_id", "day"], q).withColumnRenamed("value", "p95"),
            _quantile(whole, ["day"], 0.5).withColumnRenamed("value", "cluster_median"))


def p95_breaches(usage: DataFrame, factor: float = P95_FACTOR, days_in_a_row: int = P95_DAYS_IN_A_ROW) -> DataFrame:
    """Runs of at least ``days_in_a_row`` consecutive days on which a tenant's p95 latency
    exceeds ``factor`` x the cluster median of that day (D7).

    Both levels come from counted cells (``latency_levels``). The medians are one row
    per day and are broadcast. Consecutive days are grouped by ``day - row_number``.
    """
    p95, med = latency_levels(usage)
    bad = (p95.join(F.broadcast(med), "day")
              .filter(F.col("p95") > F.lit(factor) * F.col("cluster_median")))
    w = Window.partitionBy("tenant_id").orderBy("day")
    runs = bad.withColumn("_grp", F.date_sub(F.col("day"), F.row_number().over(w)))
    return (runs.groupBy("tenant_id", "_grp")
                .agg(F.min("day").alias("start_day"), F.max("day").alias("end_day"),
                     F.count(F.lit(1)).alias("days"))
                .filter(F.col("days") >= days_in_a_row).drop("_grp"))


def compute_share(usage: DataFrame, threshold: float = COMPUTE_SHARE) -> DataFrame:
    """Each tenant's share of total work (bytes), flagged above ``threshold``.

    The window without partitioning runs over the per-tenant aggregate (one
    row per tenant), never over raw rows.
    """
    per = usage.groupBy("tenant_id").agg(F.sum("bytes").alias("bytes"))
    total = F.sum("bytes").over(Window.partitionBy())
    return (per.withColumn("share", F.round(F.col("bytes") / total, 6))
               .withColumn("share_flag", F.col("share") > threshold))
