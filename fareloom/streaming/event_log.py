"""The event log as a stream: bookings to two collections, chat messages, chat rooms, parked events.

A micro-batch is read once and written to an inbox, parted by kind; each sink then takes its part. A sink
marks the batch when it has written its folder, so a batch that is run again after a failure goes on
where it broke off: what is marked is left alone, what is not is written anew. Nothing is doubled, for a
sink's folder of a batch is overwritten as a whole, and readers take the newest event of each key over
all folders, by the event's own time and id. So it does not matter in which order events, deletions among
them, arrive, nor how often.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.operators.cdc import documents_of_events, messages_of_events, rooms_of_messages
from fareloom.operators.joins import newest
from fareloom.sources.sinks import COLLECTIONS, current, finish, is_finished, newest_in_files, read_batches, write_batch
from fareloom.streaming.run import NO_LEFTOVERS, ROW_GROUP, few_folders, settings, start

EVENT = "id string, aggregate_type string, aggregate_id string, event_type string, payload string, created_at timestamp_ntz"
MESSAGES, ROOMS, PARKED = "messages", "rooms", "parked"
ORDER = ["event_at", "event_id"]
KINDS = ("booking", "chat", "other")


def _documents(events: DataFrame) -> DataFrame:
    """Of events read from the inbox; their payloads are not moved."""
    return documents_of_events(events, lambda rows: newest_in_files(rows, "aggregate_id", ["created_at", "id"]))


def _newest_messages(events: DataFrame) -> DataFrame:
    return newest(messages_of_events(events), ["booking_id", "message_id"], ORDER)


def _newest_rooms(events: DataFrame) -> DataFrame:
    return newest(rooms_of_messages(messages_of_events(events)), "booking_id", ORDER)


def _parked(events: DataFrame) -> DataFrame:
    return events.select("id", "aggregate_type", "aggregate_id", "event_type", F.lit("unknown_type").alias("reason"))


# sink -> the kind of event it takes and what it makes of them
SINKS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    COLLECTIONS[0]: ("booking", _documents),
    COLLECTIONS[1]: ("booking", _documents),
    MESSAGES: ("chat", _newest_messages),
    ROOMS: ("chat", _newest_rooms),
    PARKED: ("other", _parked),
}


def write_events(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of events to all sinks that have not finished it yet."""
    spark = batch.sparkSession
    inbox = f"{path}/inbox/batch={batch_id}"
    if not is_finished(spark, f"{path}/inbox", batch_id):
        kind = F.when(F.col("aggregate_type") == "booking", "booking").when(F.col("aggregate_type") == "chat_message", "chat")
        kinds = batch.withColumn("kind", F.coalesce(kind, F.lit("other")))
        with settings(spark, **few_folders(len(KINDS))):
            writer = kinds.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", ROW_GROUP)
            writer.partitionBy("kind").parquet(inbox)
        finish(spark, f"{path}/inbox", batch_id)
    events = spark.read.schema(f"{EVENT}, kind string").parquet(inbox)
    for name, (kind, make) in SINKS.items():
        if not is_finished(spark, f"{path}/{name}", batch_id):
            if name == COLLECTIONS[1]:  # the same documents as in the first collection, read from there
                rows = spark.read.parquet(f"{path}/{COLLECTIONS[0]}/rows/batch={batch_id}")
            else:
                rows = make(events.filter(F.col("kind") == kind).drop("kind"))
            with settings(spark, **NO_LEFTOVERS):
                write_batch(rows, f"{path}/{name}/rows", batch_id)
            finish(spark, f"{path}/{name}", batch_id)


def write_event_log(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Consume a stream of events (``EVENT``)."""
    return start(events, lambda batch, batch_id: write_events(batch, path, batch_id), checkpoint, every=every)


# --- what the sinks hold ----------------------------------------------------------------


def documents(spark: SparkSession, path: str, collection: str = COLLECTIONS[0]) -> DataFrame:
    """The current documents of a collection; deleted bookings are gone."""
    return current(spark, f"{path}/{collection}/rows", "id", ORDER).drop("event_id")


def messages(spark: SparkSession, path: str) -> DataFrame:
    rows = current(spark, f"{path}/{MESSAGES}/rows", ["booking_id", "message_id"], ORDER)
    return rows.drop("booking", "event_at", "event_id")


def rooms(spark: SparkSession, path: str) -> DataFrame:
    """The current room of each booking; withdrawing a message does not touch it."""
    rows = newest(read_batches(spark, f"{path}/{ROOMS}/rows").drop("batch"), "booking_id", ORDER)
    return rows.drop("event_at", "event_id")


def parked(spark: SparkSession, path: str) -> DataFrame:
    """Events of a kind that nobody consumes, each once."""
    return read_batches(spark, f"{path}/{PARKED}/rows").drop("batch").dropDuplicates(["id"])
