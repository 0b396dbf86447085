"""Client table: rows from full-state events, the idempotent fold, lookups and gates.

The fold (D2) is ``groupBy(id)`` with ``max_by``/``min_by`` on the arrival
order: partial aggregates, so replays and hot ids are combined map-side and
the result is the same however often an event is delivered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import json as J
from tidemill.functions.barrier import computed_once
from tidemill.functions.text import bool_text, canonical_uuid
from tidemill.functions.time import parse_iso_timestamp
from tidemill.operators.messages import CLIENTS_EVENT

# Text columns of the clients table: (key, default, max length, nullable).
TEXT_FIELDS = (
    ("name", "", 255, False),
    ("organization_id", "", 255, False),
    ("contact_email", None, 255, True),
    ("contact_phone", None, 50, True),
    ("status", "active", 50, False),
    ("config_confirmed_by", None, 255, True),
    ("source", None, 255, True),
)
TS_FIELDS = ("created_at", "updated_at", "config_confirmed_at")

CLIENT_COLUMNS = [
    "id", "name", "organization_id", "contact_email", "contact_phone", "status",
    "features_enabled", "config_confirmed", "config_confirmed_by", "config_confirmed_at",
    "source", "created_at", "updated_at", "synced_at",
]


def _first(*reasons: Column) -> Column:
    return F.coalesce(*reasons)


def _present(key: str) -> Column:
    return F.col(f"t_{key}").isNotNull()


def _truthy(key: str) -> Column:
    """Python truthiness of a decoded value from its type and text columns."""
    t, v = F.col(f"t_{key}"), F.col(f"s_{key}")
    return (F.when(t.isNull() | (t == "VOID"), F.lit(False))
             .when(t == "BOOLEAN", v == "true")
             .when(t == "STRING", F.length(v) > 0)
             .when(t.isin("OBJECT", "ARRAY"), ~F.to_json(F.col("p")[key]).isin("{}", "[]"))
             .otherwise(v.try_cast("double") != 0))


def client_fields(p: Column, as_of: Column) -> tuple[dict[str, Column], Column]:
    """Typed client columns and the first error, from ``normalise_messages`` output.

    Reads the per-key ``t_<key>`` / ``s_<key>`` columns (and ``p`` for the
    feature map). Errors are checked in the consumer's order: timestamps, id,
    feature map, then the table's constraints (NOT NULL, lengths, boolean input).
    """
    out: dict[str, Column] = {}
    ts_err, db_err = [], []
    for key in TS_FIELDS:
        t = F.col(f"t_{key}")
        truthy = _truthy(key)
        out[key] = F.when(truthy & (t == "STRING"), parse_iso_timestamp(F.col(f"s_{key}")))
        ts_err.append(F.when(truthy & (t != "STRING"), F.lit(f"{key}_not_text")))
    for key in ("created_at", "updated_at"):
        out[key] = F.coalesce(out[key], as_of)
    cid = F.col("_id_uuid")
    id_err = (F.when(~_present("id"), "missing_id")
               .when((F.col("t_id") != "STRING") | cid.isNull(), "invalid_id"))
    out["id"] = F.when(F.col("t_id") == "STRING", cid)
    fe_t = F.col("t_features_enabled")
    fe_err = F.when(_present("features_enabled") & (fe_t != "OBJECT"), "features_enabled_not_object")
    out["features_enabled"] = F.when(_present("features_enabled"), J.as_map(p["features_enabled"])) \
                               .otherwise(F.create_map().cast(J.MAP_SCHEMA))
    for key, default, limit, nullable in TEXT_FIELDS:
        t = F.col(f"t_{key}")
        value = F.when(~_present(key), F.lit(default).cast("string")).otherwise(F.col(f"s_{key}"))
        out[key] = value
        db_err.append(F.when(t.isin("OBJECT", "ARRAY"), F.lit(f"{key}_not_text")))
        if not nullable:
            db_err.append(F.when(t == "VOID", F.lit(f"{key}_null")))
        db_err.append(F.when(F.length(value) > limit, F.lit(f"{key}_too_long")))
    ct, cs = F.col("t_config_confirmed"), F.col("s_config_confirmed")
    cc_val = (F.when(ct.isNull(), F.lit(False))
               .when(ct == "BOOLEAN", cs == "true")
               .when(ct == "STRING", bool_text(cs)))
    out["config_confirmed"] = cc_val
    db_err.append(F.when(ct == "VOID", F.lit("config_confirmed_null")))
    db_err.append(F.when(ct.isNotNull() & (ct != "VOID") & cc_val.isNull(), F.lit("config_confirmed_not_boolean")))
    out["synced_at"] = as_of
    return out, _first(*ts_err, id_err, fe_err, *db_err)


def enabled_list(features: Column) -> Column:
    """Names of truthy entries, sorted."""
    return F.array_sort(F.map_keys(F.map_filter(features, lambda k, v: J.truthy(v))))


def client_rows(norm: DataFrame, as_of: Column) -> DataFrame:
    """One typed client row per ``clients_updated`` message with a non-empty object payload."""
    fields, err = client_fields(F.col("p"), as_of)
    # The payload tests come after the decode: below it, the optimizer would decode the text once more for them.
    rows = computed_once(norm.filter(F.col("event_type") == CLIENTS_EVENT), ["event_id", "arrival_seq"],
                         [*[fields[c].alias(c) for c in CLIENT_COLUMNS], err.alias("error"),
                          (F.col("payload_truthy") & (F.col("payload_kind") == "object")).alias("_has_client")])
    return rows.filter("_has_client").drop("_has_client")


def clients_upsert(rows: DataFrame, with_seq: bool = False) -> DataFrame:
    """Fold full-state rows by id: the last arrival wins, ``created_at`` stays from the first.

    Only rows without error take part (a failed message never reached the
    table). They are selected inside the aggregation (``max_by``/``min_by``
    skip rows whose ordering value is null), not by a filter on the derived
    error column, which the optimizer would push below the decode and
    evaluate twice. ``features_enabled`` is kept as compact JSON text. With ``with_seq`` the arrivals of
    the first and the last row are kept too, which orders rows of separate folds.
    """
    last_fields = [c for c in CLIENT_COLUMNS if c not in ("id", "created_at")]
    ok_seq = F.when(F.col("error").isNull(), F.col("arrival_seq"))
    r = rows.withColumn("features_enabled", F.to_json("features_enabled"))
    folded = (r.groupBy("id")
               .agg(F.max_by(F.struct(*last_fields), ok_seq).alias("l"),
                    F.min_by(F.col("created_at"), ok_seq).alias("created_at"),
                    F.count(ok_seq).alias("n_events"),
                    *([F.min(ok_seq).alias("first_seq"), F.max(ok_seq).alias("last_seq")] if with_seq else []))
               .filter(F.col("n_events") > 0))
    return folded.select("id", *[F.col(f"l.{c}").alias(c) for c in last_fields], "created_at", "n_events",
                         *(["first_seq", "last_seq"] if with_seq else []))


def enabled_features(rows: DataFrame) -> DataFrame:
    """Enabled-feature list, its size and a single-feature test per client row."""
    ok = rows.filter(F.col("error").isNull())
    feats = enabled_list(F.col("features_enabled"))
    fe = F.col("features_enabled")["bom_explosion"]
    return ok.select("event_id", "id", feats.alias("enabled_features"),
                     F.size(feats).alias("features_count"),
                     F.coalesce(J.truthy(fe), F.lit(False)).alias("bom_explosion_enabled"))


def client_by_id(clients: DataFrame, client_id) -> DataFrame:
    """Point lookup (A3); on Parquet the equality reaches the scan as a pushed filter."""
    return clients.filter(F.col("id") == F.lit(client_id))


def active_clients(clients: DataFrame) -> DataFrame:
    """Active clients ordered by name, id as tie-break."""
    return clients.filter(F.col("status") == "active").orderBy("name", "id")


def feature_flag(features_json: Column, feature: str) -> Column:
    """``(features_enabled->>feature)::boolean`` with PostgreSQL's boolean input (T4)."""
    return bool_text(F.from_json(features_json, "map<string,string>")[feature])


def clients_with_feature(clients: DataFrame, feature: str) -> DataFrame:
    """Active clients whose JSON flag for ``feature`` reads as true, by name.

    Text the database would reject as a boolean is treated as not enabled
    (the database fails the whole query instead; recorded deviation).
    """
    return (clients.filter((F.col("status") == "active")
                           & F.coalesce(feature_flag(F.col("features_enabled"), feature), F.lit(False)))
                   .orderBy("name", "id"))


def sales_enriched(notifications: DataFrame, clients: DataFrame) -> DataFrame:
    """Each sales notification with client name/status; no match -> unknown / not_found.

    The client table is one row per client; the join is left to AQE, which
    turns it into a broadcast only when the built side is measured small.
    """
    c = clients.select(F.col("id").alias("_cid"), F.col("name").alias("_name"), F.col("status").alias("_status"))
    key = canonical_uuid(F.col("client_id"))
    return (notifications.join(c, key == F.col("_cid"), "left")
                         .select("event_id", "client_id", "table_name", "record_count",
                                 F.coalesce("_name", F.lit("unknown")).alias("client_name"),
                                 F.coalesce("_status", F.lit("not_found")).alias("client_status")))


def bom_status_report(clients: DataFrame, status: DataFrame) -> DataFrame:
    """Active clients with their BOM run status, newest first, never-run first."""
    s = status.withColumnRenamed("client_id", "_cid")
    return (clients.filter(F.col("status") == "active")
                   .join(s, F.col("id") == F.col("_cid"), "left")
                   .select("id", "name", "organization_id", "last_processed_at", "records_processed")
                   .orderBy(F.col("last_processed_at").desc_nulls_first(), "id"))


def eligible_clients(clients: DataFrame) -> DataFrame:
    return clients.filter((F.col("status") == "active") & F.coalesce(F.col("config_confirmed"), F.lit(False)))


def gate_eligible(rows: DataFrame, clients: DataFrame, key: str = "client_id") -> DataFrame:
    """Rows of clients that are active and confirmed (C3): a left semi join."""
    ok = eligible_clients(clients).select(F.col("id").alias(key))
    return rows.join(ok, key, "left_semi")


def gate_blocked(rows: DataFrame, clients: DataFrame, key: str = "client_id") -> DataFrame:
    """Clients whose rows are held back, with the reason and the number of rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    c = clients.select(F.col("id").alias(key), "status", "config_confirmed")
    eligible = (F.col("status") == "active") & F.coalesce(F.col("config_confirmed"), F.lit(False))
    return (counts.join(c, key, "left")
                .filter(~F.coalesce(eligible, F.lit(False)))
                .select(key, "n_rows",
                        F.when(F.col("status").isNull(), "not_found")
                         .when(F.col("status") != "active", "inactive")
                         .otherwise("not_confirmed").alias("reason")))


def new_rows(rows: DataFrame, state: DataFrame, key: str = "client_id", ts: str = "ds") -> DataFrame:
    """Rows newer than the client's ``last_processed_at`` (C4); no state -> everything."""
    s = state.select(F.col(key), F.col("last_processed_at").alias("_last"))
    return (rows.join(s, key, "left")
                .filter(F.col(ts) > F.coalesce(F.col("_last"), F.lit("0001-01-01").cast("date")))
                .drop("_last"))


def advance_state(rows: DataFrame, state: DataFrame, key: str = "client_id", ts: str = "ds") -> DataFrame:
    """New ``last_processed_at``: the newest processed row, or the old value if none is new (C4).

    The facts become one row per client before the join.
    """
    never = F.lit("0001-01-01").cast("date")
    newest = rows.groupBy(key).agg(F.max(ts).alias("_new")).filter(F.col("_new") > never)
    ahead = F.col("_new") > F.coalesce(F.col("last_processed_at"), never)
    return (state.join(newest, key, "full")
                 .select(key, F.when(ahead, F.col("_new")).otherwise(F.col("last_processed_at")).alias("last_processed_at")))
