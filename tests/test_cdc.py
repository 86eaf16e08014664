import datetime as dt
import json
import random

from pyspark.sql import functions as F

from fareloom.functions.columns import app_status, full_name, number_or, text_or
from fareloom.operators import cdc, payments, quality, tables
from fareloom.schemas import APP_STATUS, WIDE_PHOTO_COLUMNS
from fareloom.sources.marketplace import Marketplace

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2026, 1, 20, 9)


def dimensions(m):
    return cdc.Dimensions(m.users, m.profiles, m.drivers, m.vehicles)


def test_status_map_and_its_default(spark):
    names = [*APP_STATUS, "draft", None]
    df = spark.createDataFrame([(n,) for n in names], "status string")
    got = {r.status: r.a for r in df.select("status", app_status().alias("a")).collect()}
    assert {k: got[k] for k in APP_STATUS} == APP_STATUS
    assert got["draft"] == got[None] == "pending"


def test_absent_zero_and_empty(spark):
    df = spark.sql("SELECT * FROM VALUES (0, ''), (3, '0'), (NULL, NULL) AS t(n, s)")
    got = [(r.a, r.b) for r in df.select(number_or("n", 1).alias("a"), text_or("s", "x").alias("b")).collect()]
    assert got == [(1, "x"), (3, "0"), (1, "x")]


def test_names_ignore_a_missing_part(spark):
    df = spark.sql("SELECT * FROM VALUES ('A', 'B'), ('A', NULL), (NULL, 'B'), (NULL, NULL) AS t(f, l)")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == ["A B", "A", "B", None]


def test_payload_keeps_null_fields_and_both_lookups_agree(spark):
    m = Marketplace(spark, SF)
    some = m.changes.filter(F.col("driver_id").isNull() | F.col("customer_id").isin("C1", "C2", "C9"))
    a = {r.id: r.payload for r in cdc.booking_events(some, dimensions(m)).collect()}
    b = {r.id: r.payload for r in cdc.booking_events(some, dimensions(m), limit=-1).collect()}
    assert a == b and a
    assert {len(json.loads(p)) for p in a.values()} == {49}
    assert any(json.loads(p)["driverId"] is None for p in a.values())


def test_projection_does_not_depend_on_order_and_drops_deleted(spark):
    rows = [
        ("e1", "booking", "b1", "created", '{"status": "pending_payment", "createdAt": "2026-01-20T09:00:00"}', T0),
        ("e2", "booking", "b1", "updated", '{"status": "matched", "passengerCount": 0, "depositPaid": true}', T0 + dt.timedelta(minutes=1)),
        ("e3", "booking", "b2", "created", '{"status": "completed"}', T0),
        ("e4", "booking", "b2", "deleted", None, T0 + dt.timedelta(minutes=2)),
        ("e5", "booking", "b3", "deleted", None, T0),
        ("e6", "booking", "b3", "updated", '{"status": "?", "startDate": "2026-02-01", "startTime": "08:30:00", "luggageCount": 2}', T0 + dt.timedelta(minutes=2)),
        ("e7", "other", "b4", "created", "{}", T0),
    ]
    schema = "id string, aggregate_type string, aggregate_id string, event_type string, payload string, created_at timestamp_ntz"
    seen = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        docs = cdc.project_bookings(spark.createDataFrame(rows, schema)).collect()
        seen.append({d.id: (d.status, d.passengerCount, d.luggageCount, d.depositPaid, d.bookingTime) for d in docs})
    assert seen[0] == seen[1] == {
        "b1": ("awaitingDriver", 1, None, True, None),
        "b3": ("pending", 1, 2, False, dt.datetime(2026, 2, 1, 8, 30)),
    }
    gone = cdc.projection_tombstones(spark.createDataFrame(rows, schema)).collect()
    assert [(r.aggregate_id, r.event_id) for r in gone] == [("b2", "e4")]


def test_delivery_rounds_end_in_dead_letters(spark):
    log = spark.createDataFrame([(i, "booking") for i in "abc"] + [("u", "weather")], "id string, aggregate_type string")
    log = log.withColumn("aggregate_id", F.lit("b")).withColumn("event_type", F.lit("updated"))
    state = spark.createDataFrame(
        [("a", 0, None, None), ("b", 2, None, "x"), ("c", 1, T0, None)],
        "event_id string, attempts int, delivered_at timestamp_ntz, last_error string",
    )
    assert {r.id for r in cdc.pending_events(log, state).collect()} == {"a", "b", "u"}
    attempts = spark.createDataFrame(
        [("a", True), ("a", False), ("b", False), ("b", False), ("u", True), ("u", True)], "event_id string, ok boolean"
    )
    outcomes = cdc.delivery_outcome(attempts)
    assert {r.event_id: r.outcome for r in outcomes.collect()} == {"a": "partial", "b": "retry", "u": "success"}
    after = cdc.next_delivery_state(state, outcomes, T0)
    got = {r.event_id: (r.attempts, r.delivered_at is not None) for r in after.collect()}
    assert got == {"a": (0, True), "b": (3, False), "c": (1, True), "u": (0, True)}
    assert {(r.id, r.reason) for r in cdc.dead_letters(log, after).collect()} == {("b", "retries_exhausted"), ("u", "unknown_type")}


def test_retention_keeps_undelivered_and_the_boundary(spark):
    df = spark.createDataFrame([(1, None), (2, T0 - dt.timedelta(days=7)), (3, T0 - dt.timedelta(days=7, seconds=1))], "id int, at timestamp_ntz")
    assert {r.id for r in cdc.retain(df, "at", T0).collect()} == {1, 2}
    assert {r.id for r in cdc.retain(df, "at", T0, keep_null=False).collect()} == {2}
    assert tuple(cdc.retention_counts(df, "at", T0).first()) == (3, 1)


# --- tables -----------------------------------------------------------------------------


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, phone string")
    source = spark.createDataFrame([(2, "B", None), (3, "C", "z")], "id int, name string, phone string")
    once = tables.upsert(target, source, "id", ["name"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "z")]
    assert sorted(tables.upsert(once, source, "id", ["name"]).collect()) == sorted(once.collect())
    assert sorted(map(tuple, tables.insert_missing(target, source, "id").collect())) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "z")]


def test_patches_keep_what_they_do_not_give(spark):
    base = spark.createDataFrame([("a", "matched", None, True), ("b", "matched", T0, None)], "id string, status string, completed_at timestamp_ntz, deposit_paid boolean")
    patch = spark.createDataFrame([("b", "completed", None, True)], "id string, status string, completed_at timestamp_ntz, deposit_paid boolean")
    got = {r.id: (r.status, r.completed_at, r.deposit_paid, r.is_patched) for r in tables.apply_status_patches(base, patch).collect()}
    assert got == {"a": ("matched", None, True, False), "b": ("completed", T0, True, True)}


def test_json_set_keeps_other_fields(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "currency": "USD", "n": null}',)], "value string")
    out = json.loads(tables.settings_set(df, "value", {"currency": '"TWD"', "depositRate": "0.25"}).first().value)
    assert out == {"a": {"b": [1, 2]}, "currency": "TWD", "depositRate": 0.25, "n": None}


def test_policies(spark):
    rows = spark.createDataFrame([(1, "u", "pending"), (2, "u", "approved"), (3, "v", "pending")], "id int, owner string, status string")
    owner = spark.createDataFrame([("u", "driver")], "id string, role string")
    admin = spark.createDataFrame([("u", "driver"), ("z", "admin")], "id string, role string")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(tables.visible_rows(rows, "owner", owner)) == [1, 2]
    assert ids(tables.visible_rows(rows, "owner", owner, "update", limit=-1)) == [1]
    assert ids(tables.visible_rows(rows, "owner", admin)) == [1, 2, 3]


# --- payments ---------------------------------------------------------------------------


def test_payment_flow(spark):
    """Confirm completes, the webhook after it is a no-op, bad input is rejected."""
    pays = spark.createDataFrame(
        [("t1", "b1", "deposit", "pending"), ("t2", "b2", "balance", "failed"), ("t3", "b3", "tip", "refunded"), ("t4", "b4", "balance", "pending")],
        "transaction_id string, booking_id string, type string, status string",
    ).withColumn("expires_at", F.lit(T0 + dt.timedelta(minutes=30)).cast("timestamp_ntz")).withColumn("confirmed_at", F.lit(None).cast("timestamp_ntz"))
    minutes = lambda n: T0 + dt.timedelta(minutes=n)
    asks = spark.createDataFrame(
        [("r1", "t1", minutes(5)), ("r2", "t1", minutes(6)), ("r3", "t2", T0), ("r4", "t3", T0), ("r5", "nope", T0), ("r6", "t4", minutes(31))],
        "request_id string, transaction_id string, requested_at timestamp_ntz",
    )
    for limit in (1 << 40, -1):
        got = {r.request_id: r.outcome for r in payments.payment_confirm_outcome(asks, pays, limit=limit).collect()}
        assert got == {"r1": "completed", "r2": "already_completed", "r3": "not_allowed", "r4": "not_allowed", "r5": "missing", "r6": "expired"}
    loose = payments.payment_confirm_outcome(asks, pays, ("pending", "processing", "refunded")).filter("request_id = 'r4'").first()
    assert loose.outcome == "completed"
    hooks = spark.createDataFrame(
        [("w1", "t1", "completed", minutes(1)), ("w2", "t1", "completed", minutes(2)), ("w3", "t1", "failed", minutes(3)),
         ("w4", "t1", "completed", minutes(4)), ("w5", "nope", "completed", T0), ("w6", "t2", "invalid-status", T0), ("w7", "t2", "failed", T0)],
        "webhook_id string, transaction_id string, status string, sent_at timestamp_ntz",
    ).withColumns({"external_transaction_id": F.lit("e"), "amount": F.lit(1500).cast("decimal(10,2)"), "currency": F.lit("TWD")})
    got = {r.webhook_id: r.outcome for r in payments.webhook_outcomes(hooks, pays).collect()}
    assert got == {"w1": "applied", "w2": "no_op", "w3": "applied", "w4": "applied", "w5": "rejected", "w7": "no_op"}
    state = {r.transaction_id: (r.status, r.confirmed_at) for r in payments.payment_latest_status(hooks, pays).collect()}
    assert state["t1"] == ("completed", minutes(4)) and state["t4"] == ("pending", None)


def test_bad_intent_lists_every_broken_rule(spark):
    df = spark.sql("SELECT '' AS booking_id, NULL AS customer_id, -100.0 AS amount, 'TWD' AS currency, 'gift' AS payment_type")
    assert payments.validate_intents(df).first().errors == ["booking_id", "customer_id", "amount", "payment_type"]


# --- quality ----------------------------------------------------------------------------


def test_compliance_folds_legacy_types(spark):
    have = ["id_card", "license", "vehicle_registration", "insurance", "police_clearance", "no_accident_record"]
    docs = [("d", t, "approved", T0, t) for t in have] + [("d", "license", "rejected", T0 + dt.timedelta(1), "later"), ("e", "selfie_photo", "pending", T0, "s")]
    documents = spark.createDataFrame(docs, "driver_id string, type string, status string, uploaded_at timestamp_ntz, url string")
    drivers = spark.createDataFrame([("d", False), ("e", True)], "user_id string, instant boolean")
    got = {r.user_id: r for r in quality.document_compliance(drivers, documents, F.col("instant")).collect()}
    assert got["d"].is_compliant and not got["e"].is_compliant
    assert got["e"].unapproved == "selfie_photo" and "taxi_permit" in got["e"].missing


def test_wide_and_long_are_inverse(spark):
    wide = Marketplace(spark, SF).driver_photos_wide
    long = quality.wide_to_long(wide, "driver_id", WIDE_PHOTO_COLUMNS, "photo_type")
    back = quality.long_to_wide(long, "driver_id", WIDE_PHOTO_COLUMNS, "photo_type")
    assert sorted(back.select(wide.columns).collect()) == sorted(wide.collect())


def test_null_regions_count_as_duplicates(spark):
    df = spark.createDataFrame([("TW", None), ("TW", None), ("TW", "n")], "country string, region string")
    assert [(r.key, r.n_rows) for r in quality.duplicate_keys("x", df, ["country", "region"]).collect()] == [("TW|(null)", 2)]
