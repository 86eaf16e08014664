"""Stateful streams: any order of the same rows, replays, late rows and broken batches give the batch result."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fareloom.operators import cdc, commission, reports
from fareloom.sources import sinks
from fareloom.sources.marketplace import Marketplace
from fareloom.streaming import commissions, delivery, event_log, expiry, history, jobs, rollup

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2026, 1, 1)


def files(spark, parts, schema, path):
    """A stream of one micro-batch for each list of rows, in that order."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- edges ------------------------------------------------------------------------------


def edges_by_hand(history_of):
    found, before = {}, None
    for i, v in enumerate(sorted(history_of)):
        if history_of[v] == "completed" and before != "completed":
            found[v] = (before, i == 0)
        before = history_of[v]
    return found


@pytest.mark.parametrize("seed", range(20))
def test_differences_add_up_in_any_order(seed):
    chance = random.Random(seed)
    whole = {v: (chance.choice(["completed", "matched", None]), T0, None) for v in chance.sample(range(1, 40), chance.randrange(1, 10))}
    order, known, held = list(whole), {}, {}
    chance.shuffle(order)
    while order:
        now = known | {v: whole[v] for v in [order.pop() for _ in range(min(len(order), chance.randrange(1, 4)))]}
        for row in history.EdgeChanges().differences("B", known, now):
            held.pop(row.version, None)
            if row.is_edge:
                held[row.version] = (row.previous_status, row.is_insert)
        known = now
    assert held == edges_by_hand({v: s for v, (s, _, _) in whole.items()})


def test_edges_of_gaps_replays_and_late_versions(spark, folder):
    schema = "id string, version int, status string, changed_at timestamp_ntz"

    def row(i, v, s):
        return (i, v, s, T0 + dt.timedelta(hours=v))

    parts = [
        [row("a", 9, "completed"), row("b", 1, "pending"), row("c", 2, "completed")],
        [row("a", 5, "completed"), row("b", 7, "completed"), row("c", 2, "completed")],
        [row("a", 1, "pending"), row("b", 4, "matched"), row("c", 1, "completed")],
        [row("a", 7, "matched"), row("b", 4, "matched"), row("c", 9, "completed")],
    ]
    stream = files(spark, parts, schema, f"{folder}/in")
    jobs.append_changes(history.edge_changes(stream), f"{folder}/out", f"{folder}/cp").awaitTermination()
    columns = ("booking_id", "version", "previous_status", "is_insert", "changed_at")
    log = spark.createDataFrame(sorted({r for part in parts for r in part}), schema)
    assert rows_of(history.current_edges(spark, f"{folder}/out"), *columns) == rows_of(commission.completion_edges(log), *columns)
    taken_back = sinks.read_batches(spark, f"{folder}/out").filter("not is_edge")
    assert rows_of(taken_back, "booking_id", "version") == [("a", 9), ("c", 2)]  # they were edges for a while


# --- delivery ---------------------------------------------------------------------------


def test_delivery_equals_the_rounds_folded(spark, folder):
    m = Marketplace(spark, SF)
    log, answers = m.outbox.select("id", "aggregate_type", "aggregate_id", "event_type"), m.delivery_answers
    stream = jobs.arrivals(delivery.delivery_inputs(log, answers), f"{folder}/in", 4)
    delivery.write_delivery(delivery.delivery_changes(stream), f"{folder}/out", f"{folder}/cp").awaitTermination()

    state = spark.createDataFrame([], "event_id string, attempts int, delivered_at timestamp_ntz, last_error string")
    for number in range(1, 5):
        due = cdc.pending_events(log, state).select(F.col("id").alias("event_id"))
        outcomes = cdc.delivery_outcome(answers.filter(F.col("round") == number)).join(due, "event_id", "left_semi")
        state = cdc.next_delivery_state(state, outcomes, f"2024-01-29 00:0{number}:00")
        state.write.parquet(f"{folder}/round{number}")
        state = spark.read.parquet(f"{folder}/round{number}")
    columns = ("event_id", "attempts", "delivered_at", "last_error")
    assert rows_of(delivery.delivery_state(spark, f"{folder}/out"), *columns) == rows_of(state, *columns)
    dead = cdc.dead_letters(log, state).select(F.col("id").alias("event_id"), "reason")
    assert rows_of(delivery.parked_events(spark, f"{folder}/out"), "event_id", "reason") == rows_of(dead, "event_id", "reason")


def test_failed_events_fall_due_again_until_parked(spark, folder):
    schema = "event_id string, aggregate_type string, round int, target string, ok boolean, at timestamp_ntz"

    def tried(number, ok):
        return [("a", None, number, t, ok, T0) for t in ("x", "y")]

    idle = [("q", None, 1, "x", True, T0)]
    parts = [[("a", "booking", None, None, None, None), ("z", "other", None, None, None, None)]]
    parts += [tried(1, False), idle, tried(2, False)[:1], idle, tried(3, False), idle, tried(4, False), tried(2, True)]
    changes = delivery.delivery_changes(files(spark, parts, schema, f"{folder}/in"), wait_seconds=0)
    delivery.write_delivery(changes, f"{folder}/out", f"{folder}/cp").awaitTermination()
    due = sinks.read_batches(spark, f"{folder}/out/due")
    assert rows_of(due, "batch", "event_id", "attempts") == [(0, "a", 0), (2, "a", 1), (4, "a", 2)]  # not a fourth time, and z never
    parked = sinks.read_batches(spark, f"{folder}/out/parked")
    assert rows_of(parked.filter("event_id = 'a'"), "batch", "reason") == [(5, "retries_exhausted"), (8, None)]
    assert rows_of(delivery.parked_events(spark, f"{folder}/out"), "event_id", "reason") == [("z", "unknown_type")]
    assert rows_of(delivery.delivery_state(spark, f"{folder}/out"), "event_id", "attempts", "delivered_at") == [("a", 1, T0), ("q", 0, T0)]  # round two's second answer came late


# --- event log --------------------------------------------------------------------------


def events(spark):
    def booking(i, n, kind, status):
        return (f"{i}{n}", "booking", i, kind, f'{{"status": "{status}", "totalAmount": {n}.5, "createdAt": "2026-01-01T00:00:00"}}', T0 + dt.timedelta(hours=n))

    def chat(i, n, kind, text):
        return (f"{i}-{n}", "chat_message", i, kind, f'{{"id": "{i}", "bookingId": "B1", "messageText": "{text}", "createdAt": "2026-01-01T00:00:0{n}"}}', T0 + dt.timedelta(hours=n))

    rows = [booking("B1", n, "updated", s) for n, s in ((1, "matched"), (2, "completed"), (3, "cancelled"))]
    rows += [booking("B2", 1, "created", "matched"), booking("B2", 2, "deleted", "x"), booking("B3", 2, "deleted", "x"), booking("B3", 4, "created", "matched")]
    rows += [chat("m1", 1, "created", "one"), chat("m1", 2, "updated", "two"), chat("m2", 3, "created", "three"), chat("m2", 4, "deleted", "")]
    rows += [("u1", "other", "B1", "created", "not json", T0), ("u2", None, "B1", "created", None, T0)]
    return spark.createDataFrame(rows, event_log.EVENT)


def held(spark, path):
    return {
        **{name: rows_of(event_log.documents(spark, path, name), "id", "status", "estimatedFare") for name in sinks.COLLECTIONS},
        "messages": rows_of(event_log.messages(spark, path), "booking_id", "message_id", "message_text"),
        "rooms": rows_of(event_log.rooms(spark, path), "booking_id", "lastMessage"),
        "parked": rows_of(event_log.parked(spark, path), "id", "reason"),
    }


def test_event_log_in_any_order_and_twice(spark, folder):
    log = events(spark).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    stream = jobs.arrivals(log, f"{folder}/in", 4).drop("n")
    event_log.write_event_log(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = held(spark, f"{folder}/out")
    fare = lambda x: pytest.importorskip("decimal").Decimal(x)
    assert got["bookings"] == got["orders_rt"] == [("B1", "cancelled", fare("3.50")), ("B3", "awaitingDriver", fare("4.50"))]
    assert got["messages"] == [("B1", "m1", "two")]
    assert got["rooms"] == [("B1", "three")]
    assert got["parked"] == [("u1", "unknown_type"), ("u2", "unknown_type")]


def test_a_half_written_batch_is_finished_not_doubled(spark, folder, monkeypatch):
    log, whole, broken = events(spark), f"{folder}/whole", f"{folder}/broken"
    event_log.write_events(log, whole, 0)
    for sink in event_log.SINKS:  # break off before each sink in turn
        def fail(rows, make=event_log.SINKS[sink][1]):
            raise RuntimeError("lost")

        path = f"{broken}/{sink}"
        with monkeypatch.context() as patch, pytest.raises(Exception, match="lost|PATH_NOT_FOUND"):
            patch.setitem(event_log.SINKS, sink, (event_log.SINKS[sink][0], fail))
            if sink == sinks.COLLECTIONS[1]:
                patch.setattr(event_log, "write_batch", lambda rows, p, n, w=event_log.write_batch: fail(rows) if "/bookings/rows" in p else w(rows, p, n))
            event_log.write_events(log, path, 0)
        before = {n: spark.read.parquet(f"{path}/{n}/rows").inputFiles() for n in event_log.SINKS if sinks.is_finished(spark, f"{path}/{n}", 0)}
        event_log.write_events(log, path, 0)
        event_log.write_events(log, path, 0)  # the same batch once more
        assert held(spark, path) == held(spark, whole)
        assert before == {n: spark.read.parquet(f"{path}/{n}/rows").inputFiles() for n in before}


# --- rollup -----------------------------------------------------------------------------


def test_rollup_takes_back_what_changes_or_goes(spark, folder):
    chance = random.Random(4)
    schema = "id string, version int, op string, status string, completed_at timestamp_ntz, driver_id string, driver_earning decimal(10,2), platform_fee decimal(10,2), total_amount decimal(10,2)"
    money = lambda: chance.choice([None, dt_decimal(chance.randrange(1, 90))])
    log = [
        (f"B{b}", v, "delete" if chance.random() < 0.1 else "write", chance.choice(["completed", "completed", "matched"]),
         chance.choice([None, T0 + dt.timedelta(hours=chance.randrange(72))]), chance.choice([None, "D1", "D2", "D3"]), money(), money(), dt_decimal(chance.randrange(90)))
        for b in range(40) for v in chance.sample(range(1, 9), chance.randrange(1, 6))
    ]
    chance.shuffle(log)
    log += chance.sample(log, 30)  # replays
    parts = [list(x) for x in itertools.batched(log, -(-len(log) // 4))]
    shares = rollup.share_changes(files(spark, parts, schema, f"{folder}/in"))
    rollup.write_rollup(shares, f"{folder}/out", f"{folder}/cp").awaitTermination()
    newest = {}
    for r in log:
        newest[r[0]] = max(newest.get(r[0], r), r, key=lambda x: x[1])
    live = spark.createDataFrame([r for r in newest.values() if r[2] == "write"], schema)
    first, last = T0.date(), (T0 + dt.timedelta(days=9)).date()
    drivers = spark.createDataFrame([("D1",), ("D2",), ("D3",), ("D4",)], "driver_id string")
    rollup.compact(spark, f"{folder}/out", f"{folder}/compacted")
    for path in ("out", "compacted"):
        days = rollup.rollup(spark, f"{folder}/{path}", first, last)
        for got, want in (
            (rollup.driver_earnings(days, drivers), reports.driver_earnings(live, drivers, first, last)),
            (rollup.platform_earnings(days), reports.platform_earnings(live, first, last)),
            (rollup.daily_summary(days), reports.daily_earnings_summary(live, first, last)),
        ):
            assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def dt_decimal(n):
    from decimal import Decimal

    return Decimal(n).quantize(Decimal("0.01"))


# --- commissions ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def market(spark):
    return Marketplace(spark, SF)


def test_corrected_accruals_leave_the_totals_right(spark, market, folder):
    """The highest versions come first: most accruals are corrected by what follows."""
    m = market
    accrued = m.usage.filter(F.col("commission_status") == "completed").select("booking_id")
    terms = commissions.Terms(m.referrals, m.influencers, m.rules, m.settings, m.driver_referrals, m.driver_affiliates, accrued)
    log = m.changes.select("id", "version", "status", "changed_at", *commissions.COLUMNS)
    for version in (4, 3, 2, 1):
        log.filter(F.col("version") == version).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    commissions.write_commissions(stream, terms, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = commissions.ledger(spark, f"{folder}/out")
    columns = ["booking_id", "beneficiary_id", "amount", "accrued_at"]
    want = commission.affiliate_commission(m.changes, m.referrals, m.influencers, accrued)
    assert rows_of(got.filter("scheme = 'affiliate'"), *columns) == rows_of(want, *columns)
    assert sinks.read_batches(spark, f"{folder}/out/accruals").filter("corrects").count() > 100
    sums = got.groupBy("scheme", "beneficiary_id").agg(F.sum("amount").alias("total_earnings"), F.count(F.lit(1)).alias("n_commissions"))
    names = ["scheme", "beneficiary_id", "total_earnings", "n_commissions"]
    assert rows_of(commissions.totals(spark, f"{folder}/out"), *names) == rows_of(sums, *names)


# --- replays and expiry -----------------------------------------------------------------


def test_no_first_arrival_is_dropped_however_old(spark, folder):
    parts = [[("a", T0)], [("b", T0 - dt.timedelta(days=4000)), ("a", T0)], [("b", T0), ("c", T0 - dt.timedelta(days=9000))]]
    stream = files(spark, parts, "id string, created_at timestamp_ntz", f"{folder}/in")
    jobs.append_to(jobs.dedup_stream(stream, "id"), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/out"), "id") == [("a",), ("b",), ("c",)]


def test_expiry_is_taken_back_by_a_status_that_comes_late(spark, folder):
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    schema = "transaction_id string, booking_id string, created_at timestamp_ntz, status string, status_at timestamp_ntz"

    def state(i, age, status, minutes):
        made = now - dt.timedelta(minutes=age)
        return (i, "B" + i, made, status, made + dt.timedelta(minutes=minutes))

    parts = [
        [state("old", 90, "pending", 0), state("new", 1, "pending", 0), state("done", 90, "completed", 9)],
        [state("done", 90, "pending", 0), state("late", 90, "processing", 3)],
        [state("late", 90, "completed", 5), state("old", 90, "pending", 0)],
    ]
    changes = expiry.expiry_changes(files(spark, parts, schema, f"{folder}/in"))
    jobs.append_changes(changes, f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert rows_of(expiry.expired_now(spark, f"{folder}/out"), "transaction_id", "old_status") == [("old", "pending")]
    told = sinks.read_batches(spark, f"{folder}/out")
    assert rows_of(told.filter("transaction_id = 'late'"), "batch", "is_expired") == [(1, True), (2, False)]
