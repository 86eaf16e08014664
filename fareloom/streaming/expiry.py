"""Expiry of payments by the clock, with corrections when a status arrives late.

Keyed by payment, in buckets (``keyed``), the state holds its newest status. A timer on the processing-time
clock goes off when the payment's time is over; if it is still open then, it is put out as expired. A status
that arrives after that and shows that the payment had been settled takes the expiry back. So the result
depends on the clock alone, not on the order in which rows arrive, and no row is too late.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.joins import newest
from fareloom.schemas import CONFIRMABLE_STATUSES, PAYMENT_MINUTES
from fareloom.sources.sinks import read_batches
from fareloom.streaming.keyed import BUCKETS, BucketProcessor, by_bucket

# ship the class itself with the query: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "transaction_id string, booking_id string, old_status string, status string, is_expired boolean"


def _millis(moment: dt.datetime) -> int:
    return int(moment.replace(tzinfo=dt.UTC).timestamp() * 1000)


class ExpiryProcessor(BucketProcessor):
    """Of each payment: booking, creation, newest status and its time, the open status under which it was
    last put out as expired, and the time of the entry."""

    def __init__(self, minutes: int, open_statuses: tuple[str, ...], ttl_days: int) -> None:
        super().__init__(ttl_days)
        self.lifetime_ms, self.open_statuses = minutes * 60_000, open_statuses

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        payments = {k: x for k, x in self.load().items() if self.lives(x, now)}
        came: dict[str | None, tuple] = {}
        begun = set()
        for _, payment, booking_id, created_at, status, status_at in rows:
            if payment not in came:
                if payment not in payments:
                    begun.add(payment)
                came[payment] = payments.get(payment, (None,) * 6)[:5]
            known = came[payment]
            if known[3] is None or (status_at, status) > (known[3], known[2]):
                came[payment] = (booking_id, created_at, status, status_at, known[4])
        found, timers = [], set()
        for payment, entry in came.items():
            ends = _millis(entry[1]) + self.lifetime_ms
            if now >= ends:
                payments[payment] = (*self._tell(payment, entry, found), now)
            else:
                payments[payment] = (*entry, now)
                if payment in begun:
                    timers.add(ends)
        self.store(payments)
        for ends in timers - set(self.handle.listTimers() if timers else ()):
            self.handle.registerTimer(ends)
        yield from found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        payments = {k: x for k, x in self.load().items() if self.lives(x, now)}
        found: list[Row] = []
        for payment, (*entry, at) in payments.items():
            if at < _millis(entry[1]) + self.lifetime_ms <= now:  # over by now, and not looked at since
                payments[payment] = (*self._tell(payment, tuple(entry), found), now)
        self.store(payments)
        yield from found

    def _tell(self, payment: str | None, entry: tuple, found: list[Row]) -> tuple:
        """The time is over: what holds now goes to ``found``, if it is not what was told."""
        booking_id, _, status, _, told = entry
        holds = status if status in self.open_statuses else None
        if holds != told:
            found.append(
                Row(
                    transaction_id=payment, booking_id=booking_id, old_status=status,
                    status="expired" if holds else status, is_expired=holds is not None,
                )
            )
        return (*entry[:4], holds)


def expiry_changes(payments: DataFrame, minutes: int = PAYMENT_MINUTES, ttl_days: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """Expiries, and expiries taken back, from one row per state of a payment (transaction_id,
    booking_id, created_at, status, status_at)."""
    rows = payments.select("transaction_id", "booking_id", "created_at", "status", "status_at")
    processor = ExpiryProcessor(minutes, CONFIRMABLE_STATUSES, ttl_days)
    return by_bucket(rows, "transaction_id", buckets).transformWithState(processor, OUTPUT, "append", "processingTime")


def expired_now(spark: SparkSession, path: str) -> DataFrame:
    """The payments that are expired after all batches written to ``path``."""
    rows = newest(read_batches(spark, path), "transaction_id", ["batch"])
    return rows.filter("is_expired").select("transaction_id", "booking_id", "old_status", "status")
