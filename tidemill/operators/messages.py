"""Message envelopes: decode, route, decide each message's outcome.

Outcome rules follow the consumer's behaviour message by message:
``processed`` and ``skipped`` and ``unknown`` are acknowledged, ``failed`` is
not (it stays pending, and goes to the dead-letter table). Everything is a
narrow projection, so it runs in one pass, per micro-batch or per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import json as J
from tidemill.functions.barrier import computed_once
from tidemill.functions.text import canonical_uuid, pg_uuid
from tidemill.functions.time import parse_iso_timestamp

# The two event types with a handler; all others are unknown.
CLIENTS_EVENT = "clients_updated"
SALES_EVENT = "sales_updated"

ENVELOPE = ["event_id", "arrival_seq", "stream", "event_type", "client_id", "event_ts"]

# Payload keys read by the handlers (client state and sales metadata).
PAYLOAD_KEYS = (
    "id", "name", "organization_id", "contact_email", "contact_phone", "status",
    "features_enabled", "config_confirmed", "config_confirmed_by", "config_confirmed_at",
    "source", "created_at", "updated_at", "table_name", "record_count",
)


def normalise_messages(raw: DataFrame, handled_only: bool = False) -> DataFrame:
    """Envelope fields as they are (missing -> null) plus the decoded payload (B1, B2).

    ``p`` holds the known payload keys as variants (absent -> null); invalid or
    missing text decodes to the empty object, so every ``p`` field is null.
    For each known key ``t_<key>`` is its JSON type (null if absent) and
    ``s_<key>`` its scalar text: every later rule reads these plain columns, so
    each value is decoded once per row however many rules look at it. With
    ``handled_only`` the payload of a message that no handler takes is not
    decoded: it counts as missing (its outcome does not depend on it).
    """
    cols = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in ENVELOPE]
    data = F.col("data")
    if handled_only:
        data = F.when(F.col("event_type").isin(CLIENTS_EVENT, SALES_EVENT), data).alias("data")
    base = raw.select(*cols, data)
    keys = J.payload_keys(F.col("data"))
    staged = base.select(*ENVELOPE, "data", keys.alias("_keys"),
                         J.payload_struct(F.col("data"), PAYLOAD_KEYS).alias("p"))
    kind = J.payload_kind(F.col("data"), F.col("_keys"))
    p = F.col("p")
    typed = staged.select(
        *ENVELOPE, kind.alias("payload_kind"),
        F.coalesce(F.size("_keys"), F.lit(0)).alias("payload_size"),
        J.payload_truthy(F.col("data"), kind, F.col("_keys")).alias("payload_truthy"),
        "p",
        *[J.vtype(p[k]).alias(f"t_{k}") for k in PAYLOAD_KEYS],
        *[J.vstring(p[k]).alias(f"s_{k}") for k in PAYLOAD_KEYS],
    )
    # ids parsed once per message: the payload id (consumer rules), the envelope client id (database rules)
    return typed.withColumn("_id_uuid", canonical_uuid(F.col("s_id"))) \
                .withColumn("_client_uuid", pg_uuid(F.col("client_id")))


def route_of(event_type: Column) -> Column:
    return (F.when(event_type == CLIENTS_EVENT, "clients")
             .when(event_type == SALES_EVENT, "sales")
             .otherwise("unknown"))


def sales_outcome(norm: DataFrame) -> tuple[Column, Column]:
    """(outcome, reason) for a sales notification."""
    kind = F.col("payload_kind")
    cid = F.col("client_id")
    reason = (F.when(F.coalesce(cid, F.lit("")) == "", "missing_client_id")
               .when(~kind.isin("object", "invalid", "missing"), "payload_not_object")
               .when(F.col("_client_uuid").isNull(), "invalid_client_id"))
    outcome = (F.when(reason == "missing_client_id", "skipped")
                .when(reason.isNotNull(), "failed")
                .otherwise("processed"))
    return outcome, reason


def message_outcomes(norm: DataFrame, client_error: Column) -> DataFrame:
    """One row per message: route, outcome and reason.

    ``client_error`` is the first error of the client row built from the
    payload (see ``clients.client_fields``); it is consulted for the clients
    route only. The two reasons are computed in a step of their own, below
    which no later filter is pushed, so each rule runs once per row.
    """
    _, s_reason = sales_outcome(norm)
    kind = F.col("payload_kind")
    c_reason = (F.when(~F.col("payload_truthy"), "empty_data")
                 .when(kind != "object", "payload_not_object")
                 .otherwise(client_error))
    staged = computed_once(norm, ["event_id", "arrival_seq", "stream", "event_type"],
                           [route_of(F.col("event_type")).alias("route"),
                            c_reason.alias("_c_reason"), s_reason.alias("_s_reason")])
    route, c, sr = F.col("route"), F.col("_c_reason"), F.col("_s_reason")
    c_out = F.when(c == "empty_data", "skipped").when(c.isNotNull(), "failed").otherwise("processed")
    s_out = F.when(sr == "missing_client_id", "skipped").when(sr.isNotNull(), "failed").otherwise("processed")
    return staged.select(
        "event_id", "arrival_seq", "stream", "event_type", "route",
        F.when(route == "clients", c_out).when(route == "sales", s_out).otherwise("unknown").alias("outcome"),
        F.when(route == "clients", c).when(route == "sales", sr).otherwise("unknown_event_type").alias("reason"),
    )


def route_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("route", "outcome").agg(F.count(F.lit(1)).alias("n"))


def sales_notifications(norm: DataFrame) -> DataFrame:
    """Processed sales notifications with their metadata and defaults.

    A default applies only when the key is absent; an explicit null stays null.
    ``table`` strips the tenant prefix ``c<org>_`` so both spellings agree.
    """
    s_out, _ = sales_outcome(norm)
    tname = F.when(F.col("t_table_name").isNull(), F.lit("unknown")).otherwise(F.col("s_table_name"))
    rcount = F.when(F.col("t_record_count").isNull(), F.lit("0")).otherwise(F.col("s_record_count"))
    upd = F.when(F.col("t_updated_at").isNotNull(), parse_iso_timestamp(F.col("s_updated_at"))) \
           .otherwise(F.col("event_ts"))
    return (norm.filter((F.col("event_type") == SALES_EVENT) & (s_out == "processed"))
                .select("event_id", "arrival_seq", "client_id",
                        tname.alias("table_name"),
                        F.regexp_replace(tname, r"^c\d+_", "").alias("table"),
                        rcount.alias("record_count"),
                        upd.alias("updated_at")))


def failed_messages(outcomes: DataFrame) -> DataFrame:
    """Dead-letter rows: failed messages with their error (K3)."""
    return (outcomes.filter(F.col("outcome") == "failed")
                    .select("event_id", "arrival_seq", "stream", "event_type", F.col("reason").alias("error")))


def pending_messages(delivered: DataFrame, acked: DataFrame) -> DataFrame:
    """Delivered but never acknowledged."""
    return delivered.join(acked.select("event_id").distinct(), "event_id", "left_anti")


def stream_length(messages: DataFrame) -> DataFrame:
    """Messages per stream (D3); partial counts are combined map-side."""
    return messages.groupBy("stream").agg(F.count(F.lit(1)).alias("length"))


def consumer_lag(messages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per stream: last id, last processed id, and how many messages lie beyond it.

    Both marks come from one pass over the outcomes; only the count reads the
    (undecoded) messages again. The marks are one row per stream (bounded by the
    number of streams), so joining them back is a broadcast; zero when nothing
    is behind.
    """
    marks = outcomes.groupBy("stream").agg(
        F.max("arrival_seq").alias("last_id"),
        F.max(F.when(F.col("outcome") != "failed", F.col("arrival_seq"))).alias("last_processed_id"))
    behind = (messages.select("stream", "arrival_seq")
                      .join(F.broadcast(marks), "stream")
                      .groupBy("stream", "last_id", "last_processed_id")
                      .agg(F.count_if(F.col("arrival_seq") > F.coalesce(F.col("last_processed_id"), F.lit(-1)))
                           .alias("lag")))
    return behind


def newest_per_stream(messages: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` messages of each stream (E5 retention, F2 with a filter).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most ``n`` rows per stream: a hot
    stream is cut down before it reaches a single task.
    """
    w = Window.partitionBy("stream").orderBy(F.col("arrival_seq").desc())
    return (messages.withColumn("_rn", F.row_number().over(w))
                    .filter(F.col("_rn") <= n).drop("_rn"))
