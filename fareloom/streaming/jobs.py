"""Streaming queries over the booking change log, the event log and the payments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.operators.cdc import Dimensions, documents_of_changes
from fareloom.operators.joins import newest
from fareloom.operators.payments import split_valid
from fareloom.schemas import CONFIRMABLE_STATUSES, PAYMENT_MINUTES, TOTAL
from fareloom.sources.sinks import write_batch, write_dual
from fareloom.streaming.history import edge_changes
from fareloom.streaming.run import NO_LEFTOVERS, ROW_GROUP, few_folders, settings, start


def _event_time(column: str) -> Column:
    return F.col(column).cast("timestamp")


# --- completion edges -------------------------------------------------------------------

def completion_edges_stream(changes: DataFrame, horizon: str | None = None) -> DataFrame:
    """``completion_edges`` on a stream of (id, version, status, changed_at) without gaps in the versions.

    A completed version meets the version before it in a stream-stream join. The join key is
    (booking, version), so a booking with very many changes is spread over all tasks, and the
    order of arrival does not matter. With ``horizon``, successive versions are taken to be at
    most that far apart and older ones leave the state.
    """
    rows = changes.select(
        F.col("id").alias("booking_id"),
        F.col("version").cast("bigint").alias("version"),
        "status",
        _event_time("changed_at").alias("changed_at"),
    )
    if horizon:
        rows = rows.withWatermark("changed_at", horizon)
    completed = rows.filter(F.col("status") == "completed").drop("status")
    no_status = F.lit(None).cast("string")
    created = completed.filter(F.col("version") == 1).select(
        "booking_id", "version", no_status.alias("previous_status"), F.lit(True).alias("is_insert"), "changed_at"
    )
    before = rows.filter(F.col("status") != "completed").select(
        F.col("booking_id").alias("_id"),
        (F.col("version") + 1).alias("_version"),
        F.col("status").alias("previous_status"),
        F.col("changed_at").alias("_at"),
    )
    follows = (F.col("booking_id") == F.col("_id")) & (F.col("version") == F.col("_version"))
    if horizon:
        follows = follows & (F.col("changed_at") >= F.col("_at")) & (F.col("changed_at") <= F.col("_at") + F.expr(f"INTERVAL {horizon}"))
    updated = completed.filter(F.col("version") > 1).join(before, follows).select(
        "booking_id", "version", "previous_status", F.lit(False).alias("is_insert"), "changed_at"
    )
    return created.unionByName(updated)


def completion_edges_stateful(changes: DataFrame) -> DataFrame:
    """The same for a change log with gaps, replays and versions in any order, as changes of edges:
    see ``history.edge_changes``."""
    return edge_changes(changes)


# --- replays ----------------------------------------------------------------------------


SEEN = "_seen"


def dedup_stream(events: DataFrame, key: str, time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Each event once, however often it is delivered within ``delay``.

    Without ``time`` the delay is counted from an event's first arrival: the watermark follows the
    clock of the micro-batches, so no event is behind it, however old, and keys leave the state a
    delay after they came. With ``time`` it is counted in event time, and what is older than the
    watermark is dropped as late.
    """
    if time is not None:
        return events.withColumn(time, _event_time(time)).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    arrived = events.withColumn(SEEN, F.current_timestamp()).withWatermark(SEEN, delay)
    return arrived.dropDuplicatesWithinWatermark([key]).drop(SEEN)


# --- payment expiry ---------------------------------------------------------------------


def expiry_stream(payments: DataFrame, minutes: int = PAYMENT_MINUTES) -> DataFrame:
    """Open payments as the stream's clock passes their expiry.

    Input: one row per state of a payment (transaction_id, booking_id, created_at, status,
    status_at). The watermark trails the newest payment by the expiry time, so a payment's
    group closes, and its last status is known, exactly when it expires. State holds only
    the payments of the last ``minutes``.
    """
    states = payments.withColumn("created_at", _event_time("created_at")).withWatermark("created_at", f"{minutes} minutes")
    closed = states.groupBy("transaction_id", "booking_id", "created_at").agg(
        F.max_by("status", "status_at").alias("old_status")
    )
    return closed.filter(F.col("old_status").isin(*CONFIRMABLE_STATUSES)).select(
        "transaction_id", "booking_id", "old_status", F.lit("expired").alias("status"), "created_at"
    )


# --- running totals ---------------------------------------------------------------------


def daily_earnings_stream(bookings: DataFrame, delay: str = "7 days") -> DataFrame:
    """Running platform totals per completion day; a day is final ``delay`` after it ended."""
    done = bookings.filter((F.col("status") == "completed") & F.col("completed_at").isNotNull())
    day = F.window("completed_at", "1 day")
    return (
        done.withColumn("completed_at", _event_time("completed_at"))
        .withWatermark("completed_at", delay)
        .groupBy(day.alias("day"))
        .agg(
            F.sum("platform_fee").cast(TOTAL).alias("platform_fee"),
            F.sum("total_amount").cast(TOTAL).alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
        )
        .select(F.to_date("day.start").alias("date"), "platform_fee", "revenue", "orders")
    )


def write_running_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the changed totals of each micro-batch; ``sinks.latest_totals`` reads them."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return start(totals, sink, checkpoint, "update")


def ledger_totals_stream(ledger: DataFrame, delay: str = "7 days") -> DataFrame:
    """Running commission totals per scheme, beneficiary and day of accrual."""
    day = F.window("accrued_at", "1 day")
    return (
        ledger.withColumn("accrued_at", _event_time("accrued_at"))
        .withWatermark("accrued_at", delay)
        .groupBy(day.alias("day"), "scheme", "beneficiary_id")
        .agg(F.sum("amount").cast(TOTAL).alias("amount"), F.count(F.lit(1)).alias("n_commissions"))
        .select(F.to_date("day.start").alias("date"), "scheme", "beneficiary_id", "amount", "n_commissions")
    )


# --- ingest -----------------------------------------------------------------------------


def write_validated(
    rows: DataFrame, validate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Split incoming requests or webhooks into ``good`` and ``quarantine`` folders, per batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_valid(validate(batch))
        write_batch(good, f"{path}/good", batch_id)
        write_batch(bad, f"{path}/quarantine", batch_id)

    return start(rows, sink, checkpoint)


# --- projection -------------------------------------------------------------------------


def projection_batch(changes: DataFrame, dimensions: Dimensions) -> DataFrame:
    """The batch's newest document per booking, with deletions marked rather than dropped.

    Changes are reduced to the newest version per booking before they are enriched.
    """
    return documents_of_changes(newest(changes, "id", ["version"]), dimensions, keys_from=changes)


def write_projection(
    changes: DataFrame,
    dimensions: Dimensions,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Turn booking changes into documents and keep both collections current.

    Within a batch the newest version per booking wins, whatever the order of arrival;
    ``sinks.current`` applies the same order across batches.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, **NO_LEFTOVERS):
            write_dual(projection_batch(batch, dimensions), path, batch_id)

    return start(changes, sink, checkpoint)


# --- running ----------------------------------------------------------------------------


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a Parquet table, exactly once, until the input is used up."""
    return start(df, path, checkpoint)


def append_changes(changes: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write each micro-batch of changes from keyed state to a folder of its own, for readers that take
    the newest of each key."""
    return start(changes, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint, every=every, by_clock=True)


DEAL = "_deal"
# between the times of the files of two micro-batches
STEP_MS = 10_000


def arrivals(rows: DataFrame, path: str, batches: int = 3, by: Sequence[str] = (), shuffled: bool = True) -> DataFrame:
    """``rows`` written to files and read back as a stream of about ``batches`` micro-batches.

    Rows are dealt to the files by a hash of ``by`` (all columns, if none are named), so what belongs
    together arrives apart and out of order. Wide rows that many tasks make need not be ``shuffled`` for
    that: each task then writes a file for each micro-batch, and the stream takes the files in that order.
    """
    spark = rows.sparkSession
    hashed = F.xxhash64(*(by or rows.columns))
    if shuffled:
        files = max(2 * batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows.repartition(files, hashed).write.option("compression", "zstd").parquet(path)
        written, source = len(spark.read.schema(rows.schema).parquet(path).inputFiles()), path
    else:
        with settings(spark, **few_folders(batches)):
            dealt = rows.withColumn(DEAL, F.pmod(hashed, F.lit(batches)))
            dealt.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).partitionBy(DEAL).parquet(path)
        written, source = _in_order(spark, path), f"{path}/{DEAL}=*"
        if not written:  # one micro-batch, without rows
            spark.createDataFrame([], rows.schema).write.parquet(f"{path}/{DEAL}=0")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-written // batches))).parquet(source)


def _in_order(spark: SparkSession, path: str) -> int:
    """Give the files under ``path`` times in the order of their micro-batches, by which streams take files; how
    many there are. Where a storage keeps its own times, micro-batches are made up otherwise, of the same rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{DEAL}=*/*.parquet")))
    last = max((x.getModificationTime() for x in found), default=0)
    for x in found:
        deal = int(x.getPath().getParent().getName().split("=")[1])
        fs.setTimes(x.getPath(), last - last % 1000 + STEP_MS * deal - STEP_MS * len(found), -1)
    return len(found)
