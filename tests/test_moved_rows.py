"""Streams and collections move keys and places, not payloads and documents."""

import datetime as dt

from pyspark.sql import functions as F

from fareloom.operators import cdc, joins
from fareloom.operators.joins import newest
from fareloom.sources import sinks
from fareloom.sources.marketplace import Marketplace
from fareloom.streaming import event_log, jobs
from fareloom.streaming.run import NO_LEFTOVERS, few_folders, settings

T0 = dt.datetime(2026, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def moved(df):
    """The aggregates over rows that a plan moves."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "max_by" in x]


def test_newest_rows_are_taken_where_they_lie(spark, folder):
    for b, start in enumerate((0, 40_000, 3)):  # files of over 32,768 rows, and of few
        n = F.col("id")
        key = F.when(n % 997 > 0, F.concat(F.lit("k"), (n * 7919 % 5003).cast("string")))
        rows = spark.range(start, start + (7 if b == 2 else 40_000), 1, 1 + b % 2)
        rows.select(key.alias("key"), (n * 31 % 1009).alias("at"), (n + b * 1_000_000).alias("no"), F.lit("wide").alias("wide")).write.parquet(f"{folder}/batch={b}")
    held = sinks.read_batches(spark, folder).filter("at <> 5").drop("batch")
    got, want = sinks.newest_in_files(held, "key", ["at", "no"]), newest(held, "key", ["at", "no"])
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert moved(got) and not any("wide#" in x for x in moved(got)) and any("wide#" in x for x in moved(want))


def test_more_than_can_be_marked_is_moved(spark, folder, monkeypatch):
    spark.range(50).select((F.col("id") % 7).alias("key"), F.col("id").alias("at"), F.lit("wide").alias("wide")).write.parquet(f"{folder}/batch=0")
    held = sinks.read_batches(spark, folder)
    want = rows_of(sinks.newest_in_files(held, "key", ["at"]))
    monkeypatch.setattr(sinks, "MARKED_BYTES", 0)
    whole = sinks.newest_in_files(held, "key", ["at"])
    assert any("wide#" in x for x in moved(whole)) and rows_of(whole) == want and len(want) == 7


def test_documents_of_the_inbox_move_no_payload(spark, folder):
    rows = [(f"e{n}", "booking", f"B{n % 9}" if n % 4 else None, "deleted" if n % 13 == 0 else "updated", f'{{"status": "matched", "totalAmount": {n}}}', T0 + dt.timedelta(hours=n % 5)) for n in range(60)]
    spark.createDataFrame(rows + rows[:20], event_log.EVENT).write.parquet(folder + "/inbox")
    events = spark.read.schema(event_log.EVENT).parquet(folder + "/inbox")
    got, want = event_log.SINKS[sinks.COLLECTIONS[0]][1](events), cdc.documents_of_events(events)
    assert rows_of(got) == rows_of(want) and len(rows_of(got)) == 10
    assert moved(got) and not any("payload" in x for x in moved(got))


def test_rows_are_dealt_to_micro_batches_without_a_shuffle(spark, folder):
    rows = spark.range(0, 3000, 1, 5).select(F.concat(F.lit("e"), "id").alias("id"), (F.col("id") % 50).alias("booking"))
    stream = jobs.arrivals(rows, f"{folder}/in", by=["id"], shuffled=False)
    got = []
    jobs.start(stream, lambda batch, n: got.append({tuple(r) for r in batch.collect()}), f"{folder}/cp").awaitTermination()
    deal = {(r.id, r.booking): r.d for r in rows.withColumn("d", F.pmod(F.xxhash64("id"), F.lit(3))).collect()}
    assert [{deal[r] for r in part} for part in got] == [{0}, {1}, {2}]
    assert sum(map(len, got)) == 3000 and set().union(*got) == set(deal)
    assert all(len({b for _, b in part}) == 50 for part in got)  # the rows of a booking come apart


def test_a_stream_of_no_rows_has_a_micro_batch(spark, folder):
    stream = jobs.arrivals(spark.range(9).filter("id > 9"), f"{folder}/in", shuffled=False)
    got = []
    jobs.start(stream, lambda batch, n: got.append(batch.collect()), f"{folder}/cp").awaitTermination()
    assert got == [[]]


def test_rows_that_cannot_be_the_newest_are_left_out(spark, folder):
    n = F.col("id")
    rows = spark.range(20_000).select(
        F.when(n % 499 > 0, F.concat(F.lit("k"), (n % 500).cast("string"))).alias("key"),
        F.when(n % 7 > 0, n * 7919 % 1009).alias("at"), n.alias("no"), F.lit("wide").alias("w"),
    )
    rows.union(rows.filter("no % 3 = 0")).write.parquet(f"{folder}/rows")
    log = spark.read.parquet(f"{folder}/rows")
    few = joins.maybe_newest(log, "key", "at")
    assert few.columns == log.columns and few.count() < log.count() / 5
    assert rows_of(newest(few, "key", ["at", "no"])) == rows_of(newest(log, "key", ["at", "no"]))
    last = log.groupBy("key").agg(F.max("at").alias("last")).withColumnRenamed("key", "k")
    ties = log.join(last, F.expr("key <=> k and at <=> last"), "left_semi")
    assert not ties.exceptAll(few).count()  # of those with the greatest time none is missing


def test_tables_with_too_many_rows_to_mark_are_left_whole(spark, folder, monkeypatch):
    spark.range(9).select(F.lit(1).alias("key"), F.col("id").alias("at")).write.parquet(f"{folder}/rows")
    monkeypatch.setattr(joins, "SLOT_BYTES", 1)
    log = spark.read.parquet(f"{folder}/rows")
    monkeypatch.setattr(joins, "MOST_SLOT_BITS", 0)
    assert joins.maybe_newest(log, "key", "at").count() == 9


def test_superseded_changes_are_not_enriched(spark):
    m = Marketplace(spark, "/root/testdata/sf0.001")
    dims = cdc.Dimensions(m.users, m.profiles, m.drivers, m.vehicles)
    every, few = cdc.booking_events(m.changes, dims), cdc.booking_events(m.changes, dims, superseded=False)
    assert few.count() < every.count() * 0.6 and not few.exceptAll(every).count()
    documents = cdc.project_bookings(every)
    assert rows_of(cdc.project_bookings(few)) == rows_of(documents)
    by_hand = cdc.booking_document(cdc.latest_event(every).filter("event_type <> 'deleted'"))
    assert rows_of(documents) == rows_of(by_hand) and documents.columns == by_hand.columns
    assert moved(documents) and not any("payload" in x for x in moved(documents))


def test_collections_are_read_without_moving_documents(spark, folder):
    for batch, status in enumerate(("matched", "completed", "cancelled")):
        rows = [(f"B{n}", status, T0 + dt.timedelta(hours=(batch + n) % 3), batch, n % 10 == batch) for n in range(batch, 60, batch + 1)]
        documents = spark.createDataFrame(rows, "id string, status string, event_at timestamp_ntz, version int, is_deleted boolean")
        sinks.write_dual(documents, folder, batch)
    for name in sinks.COLLECTIONS:
        held = sinks.current(spark, f"{folder}/{name}", "id", ["event_at", "version"])
        want = newest(sinks.read_batches(spark, f"{folder}/{name}").drop("batch"), "id", ["event_at", "version"]).filter("not is_deleted")
        assert rows_of(held) == rows_of(want.drop("is_deleted"))
        assert moved(held) and not any("status#" in x for x in moved(held))


def test_a_write_leaves_no_shuffle_files(spark, folder):
    def kept():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    rows = spark.range(1000).groupBy((F.col("id") % 97).alias("k")).count()
    with settings(spark, **NO_LEFTOVERS):
        before = kept()
        rows.write.parquet(f"{folder}/tidy")
        assert kept() <= before
    assert spark.read.parquet(f"{folder}/tidy").count() == 97


def test_a_task_may_have_a_file_open_in_each_folder():
    # at the number it is given, Spark's writer begins to sort its rows
    assert few_folders(3)["spark__sql__maxConcurrentOutputFileWriters"] == "4"
