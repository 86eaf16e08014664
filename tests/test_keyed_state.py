"""State by buckets: one read and one write for many keys, and entries that leave by the clock."""

import datetime as dt

from fareloom.streaming import expiry, history, rollup

T0 = dt.datetime(2026, 1, 1)


class Handle:
    """State in memory that counts its calls."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def getValueState(self, name, schema, ttl):  # noqa: N802
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


def begun(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def test_shares_of_a_bucket_take_one_read_and_one_write():
    p = rollup.ShareProcessor(400)
    handle = begun(p)
    got = list(p.handleInputRows((7,), ((7, f"B{n % 500}", n // 500, f"s{n % 3}") for n in range(1000)), Clock(0)))
    assert handle.calls == ["get", "update"]
    assert len(got) == 500 and {r.sign for r in got} == {1}
    moved = list(p.handleInputRows((7,), iter([(7, "B1", 2, None), (7, "B2", 0, "old"), (7, "B3", 5, "new")]), Clock(1)))
    assert [(r.sign, r.share) for r in moved] == [(-1, "s0"), (-1, "s2"), (1, "new")]
    assert handle.calls == ["get", "update"] * 2


def test_a_share_leaves_after_its_lifetime_though_its_bucket_lives_on():
    p = rollup.ShareProcessor(1)
    begun(p)
    day = 24 * 3600 * 1000
    list(p.handleInputRows((1,), iter([(1, "a", 5, "x"), (1, "b", 5, "x")]), Clock(0)))
    assert not list(p.handleInputRows((1,), iter([(1, "b", 4, "y")]), Clock(day - 1)))  # older than what is known
    list(p.handleInputRows((1,), iter([(1, "b", 6, "y")]), Clock(day - 1)))
    assert [(r.sign, r.share) for r in p.handleInputRows((1,), iter([(1, "a", 4, "z"), (1, "b", 4, "z")]), Clock(day + 1))] == [(1, "z")]
    assert set(p.load()) == {"a", "b"}


def test_histories_of_a_bucket_take_one_read_and_one_write():
    p = history.EdgeChanges()
    handle = begun(p)
    rows = [(3, f"B{n}", v, s, T0, None) for n in range(300) for v, s in ((2, "completed"), (1, "pending"))]
    edges = list(p.handleInputRows((3,), iter(rows), Clock(0)))
    assert handle.calls == ["get", "update"]
    assert {(r.booking_id, r.version, r.previous_status) for r in edges} == {(f"B{n}", 2, "pending") for n in range(300)}
    assert not list(p.handleInputRows((3,), iter(rows[:50]), Clock(1)))  # replays
    late = [(3, "B0", 0, "completed", T0, None), (3, "B1", 3, "matched", T0, None)]
    assert [(r.booking_id, r.version, r.is_insert) for r in p.handleInputRows((3,), iter(late), Clock(2))] == [("B0", 0, True)]


def test_versions_leave_one_by_one():
    p = history.EdgeChanges(ttl_days=1)
    begun(p)
    day = 24 * 3600 * 1000
    list(p.handleInputRows((3,), iter([(3, "a", 1, "completed", T0, None), (3, "b", 1, "matched", T0, None)]), Clock(0)))
    list(p.handleInputRows((3,), iter([(3, "a", 2, "matched", T0, None)]), Clock(day - 1)))
    last = list(p.handleInputRows((3,), iter([(3, "a", 3, "completed", T0, None)]), Clock(day)))
    assert [(r.version, r.previous_status) for r in last] == [(3, "matched")]
    assert {k: set(v) for k, v in p.load().items()} == {"a": {2, 3}}


def test_payments_of_a_bucket_share_their_calls_and_their_timers():
    p = expiry.ExpiryProcessor(30, ("pending", "processing"), 30)
    handle = begun(p)
    minute, start = 60_000, expiry._millis(T0)
    rows = [(5, f"T{n}", f"B{n}", T0, "pending", T0) for n in range(300)]
    assert not list(p.handleInputRows((5,), iter(rows), Clock(start)))
    assert handle.calls == ["get", "update"] and handle.timers == [start + 30 * minute]
    paid = [(5, "T1", "B1", T0, "completed", T0 + dt.timedelta(minutes=5))]
    assert not list(p.handleInputRows((5,), iter(paid), Clock(start + minute)))
    told = list(p.handleExpiredTimer((5,), Clock(start + 30 * minute), None))
    assert {r.transaction_id for r in told if r.is_expired} == {f"T{n}" for n in range(300)} - {"T1"} and len(told) == 299
    assert not list(p.handleExpiredTimer((5,), Clock(start + 31 * minute), None))
    late = [(5, "T2", "B2", T0, "completed", T0 + dt.timedelta(minutes=6)), (5, "T3", "B3", T0, "pending", T0)]
    back = list(p.handleInputRows((5,), iter(late), Clock(start + 40 * minute)))
    assert [(r.transaction_id, r.is_expired) for r in back] == [("T2", False)]
