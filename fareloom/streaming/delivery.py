"""Delivery state of the event log as a stream: attempts, retries at their time, parked events.

Keyed by event, in buckets (``keyed``), so Python is called per bucket and micro-batch. The state holds what
each target answered in each round, so answers may come in any order, more than once, and a round's targets in different micro-batches; the outcome is worked out over
all rounds each time, as ``cdc.next_delivery_state`` does round by round. Put out are changes:

- ``state``: attempts, time of delivery and last error of an event;
- ``parked``: with a reason, an event out of attempts or of a kind that nobody consumes; without, one that
  an answer which came late has taken back;
- ``due``: an event to be tried, at once when it comes, after a failed round when its waiting time is over.
  A timer on the processing-time clock, one for the events of a bucket that wait for the same time, puts it
  out, so an event is tried again without any new input; an answer that comes first calls it off.

State that has not been touched for ``ttl_days`` goes. ``write_delivery`` routes each kind to a folder.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.operators.cdc import CONSUMED
from fareloom.operators.joins import newest
from fareloom.schemas import MAX_RETRY
from fareloom.sources.sinks import read_batches, write_batch
from fareloom.streaming.keyed import BUCKETS, BucketProcessor, by_bucket
from fareloom.streaming.run import start

# ship the class itself with the query: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALL_FAILED = "all targets failed"
KINDS = ("state", "parked", "due")
#: A change as the processor packs it, with its times in microseconds; what is null is left out.
OUTPUT = "event_id string, kind string, attempts int, delivered_at bigint, last_error string, reason string, due_at bigint"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# whether an attempt succeeded, when (microseconds), and when that was written; by round and target
Answers = dict[tuple[int, str], tuple[bool, int | None, int]]
State = tuple[int, int | None, str | None]


def folded(answers: Answers, max_retry: int) -> State:
    """(attempts, delivered_at, last_error) after all rounds; rounds after the end are not counted."""
    rounds: dict[int, list[tuple[bool, int | None]]] = defaultdict(list)
    for (number, _), (ok, at, _) in answers.items():
        rounds[number].append((ok, at))
    attempts, error = 0, None
    for number in sorted(rounds):
        if any(ok for ok, _ in rounds[number]):
            return attempts, max((at for _, at in rounds[number] if at is not None), default=None), error
        attempts, error = attempts + 1, ALL_FAILED
        if attempts >= max_retry:
            break
    return attempts, None, error


class DeliveryProcessor(BucketProcessor):
    """Of each event its answers, and, once the log has named it, its type, when it is to be tried again (0 if
    it is not waiting) and the time of that entry."""

    def __init__(self, max_retry: int, wait_ms: int, ttl_days: int, consumed: tuple[str, ...]) -> None:
        super().__init__(ttl_days)
        self.max_retry, self.wait_ms, self.consumed = max_retry, wait_ms, consumed

    def _live(self, now: int) -> dict[str | None, tuple[Answers, tuple | None]]:
        """The bucket's events without what has outlived its time; each answer goes by itself."""
        found = {}
        for event_id, (answers, event) in self.load().items():
            if not all(self.lives(x, now) for x in answers.values()):
                answers = {k: x for k, x in answers.items() if self.lives(x, now)}
            event = event if event and self.lives(event, now) else None
            if answers or event:
                found[event_id] = (answers, event)
        return found

    def _reason(self, aggregate_type: str | None, is_known: bool, state: State) -> str | None:
        if is_known and aggregate_type not in self.consumed:
            return "unknown_type"
        return "retries_exhausted" if is_known and state[1] is None and state[0] >= self.max_retry else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        clock = timerValues.getCurrentProcessingTimeInMs()
        events = self._live(clock)
        came: dict[str | None, tuple[Answers, list]] = {}
        for _, event_id, packed in rows:
            aggregate_type, number, target, ok, at = json.loads(packed)
            if event_id not in came:
                came[event_id] = ({}, [])
            if target is None:
                came[event_id][1][:] = [aggregate_type]
            else:  # the same answer once more changes nothing
                answer = (None if number is None else int(number), sys.intern(target))
                came[event_id][0].setdefault(answer, (ok == "true", None if at is None else int(at), clock))
        waiting = {event[1] for _, event in events.values() if event}
        found, timers = [], set()
        for event_id, (answers, named) in came.items():
            before, event = events.get(event_id, ({}, None))
            was_known, is_known = event is not None, event is not None or bool(named)
            last_type, due_ms, _ = event or (None, 0, None)
            aggregate_type = named[0] if named else last_type
            now = {**answers, **before}
            old, new = folded(before, self.max_retry), folded(now, self.max_retry)
            if old != new or now and not before:
                found.append(self._row(event_id, "state", new))
            reason = self._reason(aggregate_type, is_known, new)
            if reason != self._reason(last_type, was_known, old):
                found.append(self._row(event_id, "parked", new, reason))
            if is_known:
                is_open = reason is None and new[1] is None
                waits = is_open and (not was_known or new != old)
                if waits or not is_open:
                    due_ms = 0
                if waits and new[0] == 0:
                    found.append(self._row(event_id, "due", new, None, clock))
                elif waits:
                    due_ms = clock + self.wait_ms * new[0] + 1
                    timers.add(due_ms)
            events[event_id] = (now, (aggregate_type, due_ms, clock) if is_known else None)
        self.store(events)
        for due_ms in timers - waiting:
            self.handle.registerTimer(due_ms)
        yield from self._packed(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now, expired = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        events, found = self._live(now), []
        for event_id, (answers, event) in events.items():
            if event and 0 < event[1] <= expired:  # a timer whose events have all been answered finds none
                events[event_id] = (answers, (event[0], 0, now))
                found.append(self._row(event_id, "due", folded(answers, self.max_retry), None, event[1]))
        if found:
            self.store(events)
        yield from self._packed(found)

    @staticmethod
    def _row(event_id: str | None, kind: str, state: State, reason: str | None = None, due_ms: int | None = None) -> dict:
        attempts, delivered_at, error = state
        row = {
            "event_id": event_id, "kind": kind, "attempts": attempts, "delivered_at": delivered_at, "last_error": error,
            "reason": reason, "due_at": None if due_ms is None else due_ms * 1000,
        }
        return {name: x for name, x in row.items() if x is not None}

    @staticmethod
    def _packed(found: list[dict]) -> Iterator[Row]:
        """The changes of a bucket as one value, for each row that Python takes or gives is dear."""
        if found:
            yield Row(changes=json.dumps(found))


def delivery_inputs(log: DataFrame, answers: DataFrame) -> DataFrame:
    """One stream of the log's events (id, aggregate_type) and of what targets answered (event_id,
    round, target, ok, at)."""
    events = log.select(F.col("id").alias("event_id"), "aggregate_type")
    tries = answers.select("event_id", F.col("round").cast("int").alias("round"), "target", "ok", F.col("at").cast("timestamp_ntz").alias("at"))
    return events.unionByName(tries, allowMissingColumns=True)


def _moment(micros: str) -> Column:
    """The time of some microseconds since 1970; a seconds' interval of decimals keeps them exactly."""
    seconds = (F.col(micros).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def delivery_changes(
    inputs: DataFrame, max_retry: int = MAX_RETRY, wait_seconds: float = 60, ttl_days: int = 30, buckets: int = BUCKETS
) -> DataFrame:
    """Changes of delivery state from ``delivery_inputs``; a failed event waits ``wait_seconds`` for
    each attempt it has had."""
    processor = DeliveryProcessor(max_retry, int(wait_seconds * 1000), ttl_days, CONSUMED)
    micros = F.expr(f"cast(cast(cast(at - {EPOCH} as interval second) as decimal(20,6)) * 1000000 as bigint)")
    packed = F.array("aggregate_type", F.col("round").cast("string"), "target", F.col("ok").cast("string"), micros.cast("string"))
    rows = inputs.select("event_id", F.to_json(packed).alias("packed"))
    changes = by_bucket(rows, "event_id", buckets).transformWithState(processor, "changes string", "append", "processingTime")
    found = changes.select(F.inline(F.from_json("changes", f"array<struct<{OUTPUT}>>")))
    return found.withColumns({name: _moment(name) for name in ("delivered_at", "due_at")})


def write_delivery(changes: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Route the changes to the folders ``state``, ``parked`` and ``due``; a batch runs once for all."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        # written once, for the processor must not run again for every folder
        write_batch(batch, f"{path}/changes", batch_id)
        written = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/changes/batch={batch_id}")
        for kind in KINDS:
            write_batch(written.filter(F.col("kind") == kind), f"{path}/{kind}", batch_id)

    return start(changes, sink, checkpoint, every=every, by_clock=True)


def delivery_state(spark: SparkSession, path: str) -> DataFrame:
    """(event_id, attempts, delivered_at, last_error) after all batches."""
    rows = read_batches(spark, f"{path}/state").select("event_id", "attempts", "delivered_at", "last_error", "batch")
    return newest(rows, "event_id", ["batch"]).drop("batch")


def parked_events(spark: SparkSession, path: str) -> DataFrame:
    """(event_id, reason) of the events that nobody will try again."""
    rows = read_batches(spark, f"{path}/parked").select("event_id", "reason", "batch")
    return newest(rows, "event_id", ["batch"]).filter(F.col("reason").isNotNull()).drop("batch")
