"""Edge cases of message handling; expected rows come from reading the consumer's code."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.operators import clients as CL
from tidemill.operators import messages as MS

AS_OF = dt.datetime(2024, 2, 1)
U1 = "00000000-0000-4000-8000-000000000001"
U2 = "00000000-0000-4000-8000-000000000002"

SCHEMA = "event_id string, arrival_seq long, stream string, event_type string, client_id string, event_ts timestamp_ntz, data string"


def msgs(spark, rows):
    ts = dt.datetime(2024, 1, 1)
    full = [(str(i), i, "s", et, cid, ts, data) for i, (et, cid, data) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def outcomes(spark, rows):
    norm = MS.normalise_messages(msgs(spark, rows))
    _, err = CL.client_fields(F.col("p"), F.lit(AS_OF).cast("timestamp_ntz"))
    out = MS.message_outcomes(norm, err).orderBy("arrival_seq").collect()
    return [(r.outcome, r.reason) for r in out]


def client(spark, rows):
    norm = MS.normalise_messages(msgs(spark, rows))
    return CL.client_rows(norm, F.lit(AS_OF).cast("timestamp_ntz")).orderBy("arrival_seq").collect()


C = "clients_updated"
S = "sales_updated"


def test_t1_payload_shapes_clients(spark):
    got = outcomes(spark, [
        (C, U1, "not json"), (C, U1, ""), (C, U1, "null"), (C, U1, "[]"), (C, U1, "[1]"),
        (C, U1, '"abc"'), (C, U1, "0"), (C, U1, None), (C, U1, "{}"),
    ])
    assert got == [
        ("skipped", "empty_data"), ("skipped", "empty_data"), ("skipped", "empty_data"), ("skipped", "empty_data"),
        ("failed", "payload_not_object"), ("failed", "payload_not_object"), ("skipped", "empty_data"),
        ("skipped", "empty_data"), ("skipped", "empty_data"),
    ]


def test_t1_payload_shapes_sales(spark):
    got = outcomes(spark, [
        (S, U1, "null"), (S, U1, "[]"), (S, U1, "not json"), (S, U1, "{}"), (S, U1, '"x"'),
    ])
    assert got == [("failed", "payload_not_object"), ("failed", "payload_not_object"),
                   ("processed", None), ("processed", None), ("failed", "payload_not_object")]


def test_b3_defaults_only_when_absent(spark):
    norm = MS.normalise_messages(msgs(spark, [
        (S, U1, "not json"), (S, U1, '{"table_name": null, "record_count": 5}'), (S, U1, '{"table_name": "c2_sales"}'),
    ]))
    rows = MS.sales_notifications(norm).orderBy("arrival_seq").collect()
    assert [(r.table_name, r.table, r.record_count) for r in rows] == [
        ("unknown", "unknown", "0"), (None, None, "5"), ("c2_sales", "sales", "0")]
    assert rows[0].updated_at == dt.datetime(2024, 1, 1)


def test_t2_duplicate_keys_keep_last(spark):
    got = outcomes(spark, [(C, U1, '{"id": "bad", "id": "%s", "name": "a"}' % U1),
                           (C, U1, '{"id": "%s", "id": "bad"}' % U1)])
    assert got == [("processed", None), ("failed", "invalid_id")]


def test_b8_uuid_is_lenient_like_the_consumer(spark):
    rows = client(spark, [(C, None, '{"id": "{%s}"}' % U1.upper()),
                          (C, None, '{"id": "urn:uuid:%s"}' % U1.replace("-", "")),
                          (C, None, '{"id": 12}'), (C, None, '{"name": "x"}'),
                          (C, None, '{"id": "}{%s}{"}' % U1), (C, None, '{"id": "%s{x}"}' % U1[:-1])])
    assert [(r.id, r.error) for r in rows] == [(U1, None), (U1, None), (None, "invalid_id"), (None, "missing_id"),
                                               (U1, None), (None, "invalid_id")]


def test_t3_timestamps(spark):
    rows = client(spark, [
        (C, None, '{"id": "%s", "created_at": "2024-01-05T10:00:00Z"}' % U1),
        (C, None, '{"id": "%s", "created_at": "14:00"}' % U1),
        (C, None, '{"id": "%s", "created_at": ""}' % U1),
        (C, None, '{"id": "%s", "created_at": 0}' % U1),
        (C, None, '{"id": "%s", "created_at": 5}' % U1),
        (C, None, '{"id": "%s", "updated_at": "2024-01-05T10:00:00+02:00"}' % U1),
    ])
    assert rows[0].created_at == dt.datetime(2024, 1, 5, 10)
    assert rows[1].created_at == AS_OF and rows[1].error is None
    assert rows[2].created_at == AS_OF and rows[3].created_at == AS_OF and rows[3].error is None
    assert rows[4].error == "created_at_not_text"
    assert rows[5].updated_at == dt.datetime(2024, 1, 5, 8)


def test_t4_python_truthiness_for_enabled_list(spark):
    norm = MS.normalise_messages(msgs(spark, [(C, None, '{"id": "%s", "features_enabled": {"a": "false", "b": false, "c": 0, "d": 1, "e": null, "f": "", "g": [1]}}' % U1)]))
    rows = CL.client_rows(norm, F.lit(AS_OF).cast("timestamp_ntz"))
    feats = rows.select(CL.enabled_list(F.col("features_enabled")).alias("f")).first().f
    assert feats == ["a", "d", "g"]


def test_t4_sql_boolean_text(spark):
    df = spark.createDataFrame(
        [(i, "n%d" % i, "active", '{"forecast": %s}' % v) for i, v in
         enumerate(['true', 'false', '"yes"', '"on"', '"abc"', 'null', '"t"', '"Of"', '"1"'])] + [(9, "n9", "active", "{}")],
        "id long, name string, status string, features_enabled string")
    got = [r.id for r in CL.clients_with_feature(df, "forecast").collect()]
    assert got == [0, 2, 3, 6, 8]


def test_t6_nulls_in_not_null_columns_fail(spark):
    got = outcomes(spark, [
        (C, None, '{"id": "%s", "features_enabled": null}' % U1),
        (C, None, '{"id": "%s", "features_enabled": [1]}' % U1),
        (C, None, '{"id": "%s", "name": null}' % U1),
        (C, None, '{"id": "%s", "status": null}' % U1),
        (C, None, '{"id": "%s", "config_confirmed": null}' % U1),
        (C, None, '{"id": "%s", "config_confirmed": "maybe"}' % U1),
        (C, None, '{"id": "%s", "contact_email": null, "config_confirmed": "yes"}' % U1),
    ])
    assert got == [("failed", "features_enabled_not_object"), ("failed", "features_enabled_not_object"),
                   ("failed", "name_null"), ("failed", "status_null"), ("failed", "config_confirmed_null"),
                   ("failed", "config_confirmed_not_boolean"), ("processed", None)]


def test_t7_lengths(spark):
    got = outcomes(spark, [
        (C, None, '{"id": "%s", "name": "%s"}' % (U1, "x" * 256)),
        (C, None, '{"id": "%s", "name": "%s"}' % (U1, "x" * 255)),
        (C, None, '{"id": "%s", "contact_phone": "%s"}' % (U1, "1" * 51)),
        (C, None, '{"id": "%s", "name": {"a": 1}}' % U1),
    ])
    assert got == [("failed", "name_too_long"), ("processed", None), ("failed", "contact_phone_too_long"),
                   ("failed", "name_not_text")]


def test_t8_arrival_order_wins_created_at_from_first(spark):
    rows = msgs(spark, [
        (C, None, '{"id": "%s", "name": "old", "created_at": "2024-01-03T00:00:00Z", "updated_at": "2024-01-09T00:00:00Z"}' % U1),
        (C, None, '{"id": "%s", "name": "new", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-02T00:00:00Z"}' % U1),
        (C, None, '{"id": "%s", "name": "broken", "status": null}' % U1),
        (C, None, '{"id": "%s", "name": "other"}' % U2),
    ])
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    folded = CL.clients_upsert(CL.client_rows(MS.normalise_messages(rows), as_of)).orderBy("id").collect()
    assert [(r.id, r.name, r.created_at, r.updated_at) for r in folded] == [
        (U1, "new", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 2)),
        (U2, "other", AS_OF, AS_OF)]


def test_fold_is_idempotent_under_replay(spark):
    rows = msgs(spark, [(C, None, '{"id": "%s", "name": "a%d"}' % (U1, i)) for i in range(5)])
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    once = CL.clients_upsert(CL.client_rows(MS.normalise_messages(rows), as_of)).drop("n_events").collect()
    twice = CL.clients_upsert(CL.client_rows(MS.normalise_messages(rows.unionByName(rows)), as_of)) \
              .drop("n_events").collect()
    assert once == twice


def test_t15_sales_client_id(spark):
    got = outcomes(spark, [(S, "not-a-uuid", "{}"), (S, "", "{}"), (S, None, "{}"),
                           (S, U1.upper(), "{}"), (S, "{%s}" % U1, "{}"), (S, U1.replace("-", ""), "{}")])
    assert got == [("failed", "invalid_client_id"), ("skipped", "missing_client_id"),
                   ("skipped", "missing_client_id"), ("processed", None), ("processed", None), ("processed", None)]


def test_unknown_types_are_acknowledged(spark):
    assert outcomes(spark, [("stock_updated", U1, "{}"), (None, U1, "{}")]) == [
        ("unknown", "unknown_event_type"), ("unknown", "unknown_event_type")]


def test_t5_null_last_processed_first(spark):
    clients = spark.createDataFrame([(1, "a", "0", "active"), (2, "b", "0", "active"), (3, "c", "0", "active")],
                                    "id long, name string, organization_id string, status string")
    status = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 5), (2, dt.datetime(2024, 2, 1), 7)],
                                   "client_id long, last_processed_at timestamp_ntz, records_processed long")
    got = [r.id for r in CL.bom_status_report(clients, status).collect()]
    assert got == [3, 2, 1]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = client(spark, [(C, None, '{"id": "%s", "created_at": "2024-01-05T10:00:00Z"}' % U1),
                              (C, None, '{"id": "%s", "created_at": "2024-01-05T10:00:00+02:00"}' % U1),
                              (C, None, '{"id": "%s", "created_at": "2024-01-05T10:00:00"}' % U1),
                              (C, None, '{"id": "%s", "created_at": "2024-01-05"}' % U1),
                              (C, None, '{"id": "%s", "created_at": "2024-01-05T10:00:00.5-01:30"}' % U1)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.created_at for r in rows] == [dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 8),
                                            dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5),
                                            dt.datetime(2024, 1, 5, 11, 30, 0, 500000)]


def test_iso_forms_of_the_consumer(spark):
    """Week and compact dates, any separator, compact times and decimal commas parse like
    Python's ``datetime.fromisoformat`` (3.12); a bare time does not."""
    from tidemill.functions.time import parse_iso_timestamp
    cases = {
        "2025-W01-1": dt.datetime(2024, 12, 30), "2025W011": dt.datetime(2024, 12, 30),
        "2020-W53-5": dt.datetime(2021, 1, 1), "2024-W52-7T10:00:00": dt.datetime(2024, 12, 29, 10),
        "20251122T140000": dt.datetime(2025, 11, 22, 14), "20251122": dt.datetime(2025, 11, 22),
        "2025-11-22x14:00:00": dt.datetime(2025, 11, 22, 14), "2025-11-22T1400Z": dt.datetime(2025, 11, 22, 14),
        "2025-11-22T14:00+05:30": dt.datetime(2025, 11, 22, 8, 30),
        "2025-11-22T14:00:00,25": dt.datetime(2025, 11, 22, 14, 0, 0, 250000), "14:00": None, "": None,
        "2025-11-22T14": dt.datetime(2025, 11, 22, 14), "2025-11-22T14Z": dt.datetime(2025, 11, 22, 14),
        "2025-11-22T14+01:00": dt.datetime(2025, 11, 22, 13),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.v for r in df.select("t", parse_iso_timestamp(F.col("t")).alias("v")).collect()}
    assert got == cases
