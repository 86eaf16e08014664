"""Delivery state by buckets: few calls for many events, shared timers, answers that leave one by one."""

import datetime as dt
import json

from test_keyed_state import Clock, begun
from test_stream_state import files, rows_of

from fareloom.streaming import delivery

DAY = 24 * 3600 * 1000


def processor(ttl_days=30):
    p = delivery.DeliveryProcessor(3, 60_000, ttl_days, ("booking",))
    return p, begun(p)


def named(event, kind="booking"):
    return (7, event, json.dumps([kind, None, None, None, None]))


def answer(event, number, ok, at=5, target="x"):
    return (7, event, json.dumps([None, str(number), target, "true" if ok else "false", None if at is None else str(at)]))


def told(changes, *columns):
    return [tuple(x.get(c) for c in columns) for row in changes for x in json.loads(row.changes)]


class Expiry:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.at


def test_events_of_a_bucket_share_their_calls_and_their_timers():
    p, handle = processor()
    rows = [r for n in range(300) for r in (named(f"E{n}"), answer(f"E{n}", 1, False))]
    got = told(p.handleInputRows((7,), iter(rows), Clock(1000)), "kind", "attempts")
    assert handle.calls == ["get", "update"] and handle.timers == [61_001]
    assert got == [("state", 1)] * 300
    assert told(p.handleInputRows((7,), iter([answer("E1", 2, True)]), Clock(2000)), "event_id", "kind", "delivered_at") == [("E1", "state", 5)]
    due = told(p.handleExpiredTimer((7,), Clock(61_500), Expiry(61_001)), "event_id", "kind", "due_at")
    assert {x[0] for x in due} == {f"E{n}" for n in range(300)} - {"E1"} and {x[1:] for x in due} == {("due", 61_001_000)}
    assert not list(p.handleExpiredTimer((7,), Clock(61_600), Expiry(61_001)))
    assert not list(p.handleInputRows((7,), iter(rows[1::2]), Clock(62_000)))  # replays


def test_answers_leave_one_by_one():
    p, _ = processor(1)
    list(p.handleInputRows((7,), iter([answer("a", 1, False), answer("b", 1, True)]), Clock(0)))
    list(p.handleInputRows((7,), iter([answer("a", 2, False)]), Clock(DAY - 1)))
    assert told(p.handleInputRows((7,), iter([named("a")]), Clock(DAY)), "kind", "attempts") == []
    assert {k: set(answers) for k, (answers, _) in p.load().items()} == {"a": {(2, "x")}}


def test_times_and_missing_values_pass_unchanged(spark, folder):
    schema = "event_id string, aggregate_type string, round int, target string, ok boolean, at timestamp_ntz"
    at = [dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(2026, 3, 29, 2, 30, 0, 123_456), dt.datetime(1, 1, 1)]
    rows = [(f"e{n}", None, 1, "x", True, t) for n, t in enumerate(at)]
    rows += [(None, "booking", None, None, None, None), (None, None, 1, "x", True, at[0]), ("f", "a \"quoted\"\n type", None, None, None, None)]
    changes = delivery.delivery_changes(files(spark, [rows], schema, f"{folder}/in"))
    delivery.write_delivery(changes, f"{folder}/out", f"{folder}/cp").awaitTermination()
    state = delivery.delivery_state(spark, f"{folder}/out")
    assert rows_of(state, "event_id", "delivered_at") == sorted([*((f"e{n}", t) for n, t in enumerate(at)), (None, at[0])], key=repr)
    assert rows_of(delivery.parked_events(spark, f"{folder}/out"), "event_id", "reason") == [("f", "unknown_type")]
    assert dict(state.dtypes) == {"event_id": "string", "attempts": "int", "delivered_at": "timestamp_ntz", "last_error": "string"}
