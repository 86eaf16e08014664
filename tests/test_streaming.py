"""Streams against their batch forms, over several micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.operators import cdc, commission, payments
from fareloom.sources import sinks
from fareloom.sources.marketplace import Marketplace
from fareloom.streaming import jobs

SF = "/root/testdata/sf0.001"


def micro_batches(spark, df, path, n):
    """Write ``df`` as ``n`` files in random order of rows and read them one per micro-batch."""
    df.repartition(n, F.rand(3)).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def changes(spark):
    m = Marketplace(spark, SF)
    return m.changes.select("id", "version", "status", "changed_at").filter(F.col("id").endswith("7"))


def batch_edges(changes):
    return sorted((r.booking_id, r.version, r.previous_status, r.is_insert) for r in commission.completion_edges(changes).collect())


def test_edges_by_join_do_not_depend_on_arrival(spark, changes, folder):
    stream = micro_batches(spark, changes, f"{folder}/in", 3)
    jobs.append_to(jobs.completion_edges_stream(stream), f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = sorted((r.booking_id, r.version, r.previous_status, r.is_insert) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == batch_edges(changes)


def test_edges_with_a_horizon(spark, changes, folder):
    stream = micro_batches(spark, changes, f"{folder}/in", 1)
    jobs.append_to(jobs.completion_edges_stream(stream, "30 days"), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == len(batch_edges(changes))


def test_stateful_edges_take_gaps_and_ignore_replays(spark, changes, folder):
    gaps = changes.filter(F.col("id") < "B2").withColumn("version", F.col("version") * 10)
    gaps.write.parquet(f"{folder}/in")
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema)
    jobs.append_changes(jobs.completion_edges_stateful(reader.parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/cp").awaitTermination()
    want = batch_edges(gaps)
    rows = lambda: sorted((r.booking_id, r.version, r.previous_status, r.is_insert) for r in spark.read.parquet(f"{folder}/out").collect())
    assert rows() == want
    gaps.write.mode("append").parquet(f"{folder}/in")  # the same changes once more
    jobs.append_changes(jobs.completion_edges_stateful(reader.parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert rows() == want


def test_replayed_events_are_dropped(spark, folder):
    events = Marketplace(spark, SF).outbox.select("id", "created_at")
    events.write.parquet(f"{folder}/in")
    events.write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    jobs.append_to(jobs.dedup_stream(stream, "id", "created_at", "40 days"), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == events.count()


def test_projection_over_batches_and_a_replayed_batch(spark, folder):
    m = Marketplace(spark, SF)
    dims = cdc.Dimensions(m.users, m.profiles, m.drivers, m.vehicles)
    log = m.changes.filter(F.col("id").endswith("77")).withColumn("op", F.when((F.col("version") == 2) & (F.col("status") == "cancelled"), "delete").otherwise("update"))
    stream = micro_batches(spark, log, f"{folder}/in", 2)
    jobs.write_projection(stream, dims, f"{folder}/out", f"{folder}/cp").awaitTermination()

    def state(name):
        return sorted((r.id, r.status, r.version) for r in sinks.current(spark, f"{folder}/out/{name}", "id", ["event_at", "version"]).collect())

    last = commission.newest_changes(log).filter("op <> 'delete'")
    want = sorted((r.id, r.version) for r in last.select("id", "version").collect())
    first, second = (state(name) for name in sinks.COLLECTIONS)
    assert first == second
    assert [(i, v) for i, _, v in first] == want
    again = spark.read.parquet(f"{folder}/in").limit(50)
    sinks.write_dual(cdc.documents_of_changes(commission.newest_changes(again), dims), f"{folder}/out", 0)
    sinks.write_dual(cdc.documents_of_changes(commission.newest_changes(spark.read.parquet(f"{folder}/in")), dims), f"{folder}/out", 0)
    assert state("bookings") == first


def test_running_totals(spark, folder):
    day = dt.datetime(2026, 1, 1)
    ledger = spark.range(60).select(
        F.lit("affiliate").alias("scheme"), F.concat(F.lit("I"), (F.col("id") % 3).cast("string")).alias("beneficiary_id"),
        F.lit(2).cast("decimal(10,2)").alias("amount"), (F.lit(day) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("accrued_at"),
    )
    stream = micro_batches(spark, ledger, f"{folder}/in", 3)
    jobs.write_running_totals(jobs.ledger_totals_stream(stream), f"{folder}/out", f"{folder}/cp").awaitTermination()
    rows = sinks.read_batches(spark, f"{folder}/out").groupBy("date", "beneficiary_id").agg(F.max_by("n_commissions", "batch").alias("n"))
    assert rows.agg(F.sum("n")).first()[0] == 60


def test_ingest_splits_good_from_bad(spark, folder):
    hooks = Marketplace(spark, SF).webhooks
    stream = micro_batches(spark, hooks, f"{folder}/in", 2)
    jobs.write_validated(stream, payments.validate_webhooks, f"{folder}/out", f"{folder}/cp").awaitTermination()
    good = sinks.read_batches(spark, f"{folder}/out/good").count()
    bad = sinks.read_batches(spark, f"{folder}/out/quarantine").count()
    assert good == payments.validate_webhooks(hooks).filter("is_valid").count()
    assert good + bad == hooks.count()
