"""State per booking that gives the same result in whatever order its versions arrive.

``versions`` keeps the status of every version of a booking seen within ``ttl``, and of completed
versions the row they carry. When versions arrive, what follows from the whole history is worked out
before and after, and only the differences are put out: an edge that an earlier version turns into
none is taken back, a new predecessor replaces the old. A version that is there already changes
nothing, so replays put out nothing, and gaps need no waiting.

State that has not been touched for ``ttl_days`` goes by the clock, so it does not grow for good; a
booking's life is far shorter. One booking's versions of a micro-batch meet in one task. Histories are kept by
buckets of bookings (``keyed``), read once for each batch that touches the bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.joins import newest
from fareloom.sources.sinks import read_batches
from fareloom.streaming.keyed import BUCKETS, BucketProcessor, by_bucket

# ship the classes themselves with the query: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Version = tuple[str | None, object, str | None]


def edges_of(history: dict[int, Version]) -> dict[int, tuple[str | None, bool]]:
    """Of each version that completes the booking: the status before, and whether none was before."""
    found, before, first = {}, None, True
    for version in sorted(history):
        status = history[version][0]
        if status == "completed" and before != "completed":
            found[version] = (before, first)
        before, first = status, False
    return found


class HistoryProcessor(BucketProcessor):
    """Keeps the versions of each booking, each with its time; subclasses say what follows from them."""

    def __init__(self, ttl_days: int = 30) -> None:
        super().__init__(ttl_days)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        at = timerValues.getCurrentProcessingTimeInMs()
        kept = self.load()
        for booking, versions in list(kept.items()):
            kept[booking] = {v: x for v, x in versions.items() if self.lives(x, at)}
            if not kept[booking]:
                del kept[booking]
        came: dict[str | None, dict[int, Version]] = {}
        for _, booking, version, status, changed_at, row in rows:
            if version is not None and version not in kept.get(booking, ()) and version not in (new := came.setdefault(booking, {})):
                new[version] = (status, changed_at, row if status == "completed" else None)
        found = []
        for booking, new in came.items():
            if new:
                held = kept.setdefault(booking, {})
                known = {v: x[:-1] for v, x in held.items()}
                held.update({v: (*x, at) for v, x in new.items()})
                found += self.differences(booking, known, known | new)
        self.store(kept)
        yield from found

    def differences(self, booking_id: str, known: dict[int, Version], now: dict[int, Version]) -> Iterator[Row]:
        raise NotImplementedError


EDGE_CHANGES = "booking_id string, version bigint, previous_status string, is_insert boolean, changed_at timestamp_ntz, is_edge boolean"


class EdgeChanges(HistoryProcessor):
    """Edges that appear, change their predecessor, or turn out to be none."""

    def differences(self, booking_id: str, known: dict[int, Version], now: dict[int, Version]) -> Iterator[Row]:
        old, new = edges_of(known), edges_of(now)
        for version in sorted(old.keys() | new.keys()):
            if old.get(version) != new.get(version):
                before, is_insert = new.get(version, (None, None))
                yield Row(
                    booking_id=booking_id, version=version, previous_status=before, is_insert=is_insert,
                    changed_at=now[version][1], is_edge=version in new,
                )


ACCRUAL_CHANGES = "booking_id string, scheme string, version bigint, changed_at timestamp_ntz, row string, corrects boolean"


def accruals_of(history: dict[int, Version]) -> dict[str, int]:
    """The version that each scheme pays for: the first edge by update, and the first completion."""
    updates = [v for v, (_, is_insert) in edges_of(history).items() if not is_insert]
    completed = [v for v, x in history.items() if x[0] == "completed"]
    found = {"affiliate": min(updates)} if updates else {}
    return found | ({"driver_referral": min(completed)} if completed else {})


class AccrualChanges(HistoryProcessor):
    """What each scheme pays for, once per booking; a null version takes it back."""

    def differences(self, booking_id: str, known: dict[int, Version], now: dict[int, Version]) -> Iterator[Row]:
        old, new = accruals_of(known), accruals_of(now)
        for scheme in sorted(old.keys() | new.keys()):
            if old.get(scheme) != new.get(scheme):
                version = new.get(scheme)
                _, at, row = now[version] if version is not None else (None, None, None)
                yield Row(booking_id=booking_id, scheme=scheme, version=version, changed_at=at, row=row, corrects=scheme in old)


def _histories(
    changes: DataFrame, processor: HistoryProcessor, output: str, columns: tuple[str, ...] = (), buckets: int = BUCKETS
) -> DataFrame:
    """The processor over a stream of (id, version, status, changed_at); ``columns`` go along as JSON."""
    row = F.to_json(F.struct(*columns)) if columns else F.lit(None).cast("string")
    rows = changes.select("id", F.col("version").cast("bigint").alias("version"), "status", "changed_at", row.alias("row"))
    return by_bucket(rows, "id", buckets).transformWithState(processor, output, "append", "processingTime")


def edge_changes(changes: DataFrame, ttl_days: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """``commission.completion_edges`` on a stream with gaps, replays and versions in any order, as
    changes: the last row of each (booking, version) counts, and holds an edge if ``is_edge``."""
    return _histories(changes, EdgeChanges(ttl_days), EDGE_CHANGES, buckets=buckets)


def accrual_changes(changes: DataFrame, columns: tuple[str, ...], ttl_days: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """The change that each scheme pays for, with ``columns`` of the booking as JSON in ``row``."""
    return _histories(changes, AccrualChanges(ttl_days), ACCRUAL_CHANGES, columns, buckets)


def current_edges(spark: SparkSession, path: str) -> DataFrame:
    """The edges that hold after all batches written to ``path``."""
    rows = newest(read_batches(spark, path), ["booking_id", "version"], ["batch"])
    return rows.filter("is_edge").drop("is_edge", "batch")
