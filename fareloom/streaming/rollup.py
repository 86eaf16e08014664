"""Earnings per day and driver, kept up to date from booking changes by signed sums.

State holds, for each booking, the newest version and what it adds to its day and driver. A newer version
takes that back and adds its own; a deleted booking, or one that is not completed any more, only takes
back. The changes of a micro-batch are summed to (day, driver) and written to a folder of its own; the
sums over all folders are the rollup. Orders are counted with their sign, so a driver without any orders
left on a day is no longer counted there, and distinct drivers stay exact.

An older version that arrives after a newer one changes nothing, so neither order nor replays matter, and
no row is ever too late. State that has not been touched for ``ttl_days`` goes. It is kept by buckets of bookings
(``keyed``), so Python is called per bucket and micro-batch.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions.columns import exact_mean, ratio
from fareloom.operators.reports import platform_row
from fareloom.schemas import TOTAL
from fareloom.sources.sinks import read_batches, write_batch
from fareloom.streaming.keyed import BUCKETS, BucketProcessor, by_bucket
from fareloom.streaming.run import start

# ship the class itself with the query: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a booking adds; without a date, nothing.
SHARE = {
    "date": "date", "driver_id": "string", "driver_earning": "decimal(10,2)", "platform_fee": "decimal(10,2)",
    "total_amount": "decimal(10,2)", "rate": "decimal(18,10)",
}
_SHARE = ", ".join(f"{name} {kind}" for name, kind in SHARE.items())
AMOUNTS = {"driver_earning": TOTAL, "platform_fee": TOTAL, "total_amount": TOTAL, "rate": "decimal(28,10)"}


class ShareProcessor(BucketProcessor):
    """Of each booking the newest version and its share, as JSON."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best: dict[str | None, tuple[int, str | None]] = {}
        for _, booking, version, share in rows:
            if version is not None and (booking not in best or best[booking][0] < version):
                best[booking] = (version, share)
        now = timerValues.getCurrentProcessingTimeInMs()
        last = {k: x for k, x in self.load().items() if self.lives(x, now)}
        signed = []
        for booking, (version, share) in best.items():
            known, old, _ = last.get(booking, (None, None, None))
            if known is not None and version <= known:
                continue
            last[booking] = (version, share, now)
            if old != share:
                signed += [(sign, x) for sign, x in ((-1, old), (1, share)) if x is not None]
        self.store(last)
        yield from (Row(sign=sign, share=x) for sign, x in signed)


def share_changes(changes: DataFrame, ttl_days: int = 400, buckets: int = BUCKETS) -> DataFrame:
    """(sign, date, driver_id, amounts) from booking changes with ``version`` and, if there are deletes, ``op``."""
    counts = (F.col("status") == "completed") & F.col("completed_at").isNotNull()
    if "op" in changes.columns:
        counts = counts & (F.col("op") != "delete")
    rate = ratio("platform_fee", "total_amount")
    columns = {"date": F.to_date("completed_at"), "rate": rate}
    share = F.to_json(F.struct(*(columns.get(n, F.col(n)).cast(kind).alias(n) for n, kind in SHARE.items())))
    rows = changes.select("id", F.col("version").cast("bigint").alias("version"), F.when(counts, share).alias("share"))
    signed = by_bucket(rows, "id", buckets).transformWithState(
        ShareProcessor(ttl_days), "sign int, share string", "append", "processingTime"
    )
    return signed.withColumn("share", F.from_json("share", _SHARE)).select("sign", "share.*")


def _signed(column: str) -> list[Column]:
    amount = F.sum(F.col("sign") * F.col(column)).cast(AMOUNTS[column])
    return [amount.alias(column), F.sum(F.when(F.col(column).isNotNull(), F.col("sign")).otherwise(0)).alias(f"n_{column}")]


def write_rollup(shares: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep each micro-batch's sums per (date, driver)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("date", "driver_id").agg(F.sum("sign").alias("orders"), *(c for n in AMOUNTS for c in _signed(n)))
        write_batch(sums, path, batch_id)

    return start(shares, sink, checkpoint, every=every, by_clock=True)


def rollup(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The sums per (date, driver) after all batches; an amount nobody has is NULL, not zero."""
    rows = read_batches(spark, path)
    if first:
        rows = rows.filter(F.col("date") >= F.lit(first))
    if last:
        rows = rows.filter(F.col("date") <= F.lit(last))
    sums = [F.sum("orders").alias("orders")]
    for name, kind in AMOUNTS.items():
        sums += [F.sum(name).cast(kind).alias(name), F.sum(f"n_{name}").alias(f"n_{name}")]
    rows = rows.groupBy("date", "driver_id").agg(*sums).filter("orders > 0")
    return rows.withColumns({n: F.when(F.col(f"n_{n}") > 0, F.col(n)) for n in AMOUNTS})


def compact(spark: SparkSession, path: str, to: str) -> None:
    """All batches so far as the first batch of a new path; the query goes on under its checkpoint
    with the next batch written there."""
    sums = [F.sum(c).cast(AMOUNTS.get(c, "bigint")).alias(c) for c in ("orders", *(x for n in AMOUNTS for x in (n, f"n_{n}")))]
    rows = read_batches(spark, path)
    write_batch(rows.groupBy("date", "driver_id").agg(*sums).filter("orders <> 0"), to, -1)


# --- the reports, from the rollup -------------------------------------------------------


def _sum(column: str) -> Column:
    return F.sum(column).cast(TOTAL)


def driver_earnings(days: DataFrame, drivers: DataFrame) -> DataFrame:
    """``reports.driver_earnings`` over the days of a rollup."""
    found = days.filter(F.col("driver_id").isNotNull()).groupBy("driver_id").agg(
        _sum("driver_earning").alias("total"), F.sum("orders").alias("orders"), F.sum("n_driver_earning").alias("paid")
    )
    zero = F.lit(0).cast(TOTAL)
    return drivers.select("driver_id").join(found, "driver_id", "left").select(
        "driver_id",
        F.coalesce("total", zero).alias("total_earnings"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce(exact_mean(F.col("total"), F.col("paid")), zero).alias("average_earnings"),
    )


def platform_earnings(days: DataFrame) -> DataFrame:
    """``reports.platform_earnings`` over the days of a rollup."""
    return platform_row(
        days.agg(
            _sum("platform_fee").alias("platform_fee"),
            _sum("total_amount").alias("revenue"),
            F.sum("orders").alias("orders"),
            F.sum("rate").alias("rates"),
            F.sum("n_rate").alias("rated"),
        )
    )


def daily_summary(days: DataFrame) -> DataFrame:
    """``reports.daily_earnings_summary`` over the days of a rollup."""
    return days.groupBy("date").agg(
        _sum("total_amount").alias("total_revenue"),
        _sum("driver_earning").alias("driver_earnings"),
        _sum("platform_fee").alias("platform_fee"),
        F.sum("orders").alias("orders"),
        F.count("driver_id").alias("drivers_count"),
    )
