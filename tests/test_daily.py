"""Retention by day against retention by row."""

import datetime as dt

from fareloom.operators import cdc
from fareloom.sources import daily
from fareloom.sources.marketplace import Marketplace

AS_OF = dt.datetime(2024, 1, 29, 13, 30)


def test_dropped_days_leave_what_retain_keeps(spark, folder):
    outbox = Marketplace(spark, "/root/testdata/sf0.001").outbox
    daily.write_log(outbox, "outbox_by_day", f"{folder}/log", "processed_at")
    try:
        days = daily.days_of(spark, "outbox_by_day")
        cutoff = AS_OF - dt.timedelta(days=7)
        plan = daily.edge_rows(spark, "outbox_by_day", "processed_at", cutoff)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "2024-01-22" in plan
        files = spark.read.parquet(f"{folder}/log/day=2024-01-23").inputFiles()
        dropped = daily.drop_older(spark, "outbox_by_day", "processed_at", AS_OF)
        assert dropped == sum(d < cutoff.date() for d in days) > 5
        columns = ["id", "aggregate_id", "created_at", "processed_at"]
        want = cdc.retain(outbox, "processed_at", AS_OF)
        left = spark.table("outbox_by_day")
        assert sorted(map(tuple, left.select(*columns).collect()), key=repr) == sorted(map(tuple, want.select(*columns).collect()), key=repr)
        assert left.filter("processed_at IS NULL").count() > 100
        assert spark.read.parquet(f"{folder}/log/day=2024-01-23").inputFiles() == files  # later days are left alone
        assert daily.drop_older(spark, "outbox_by_day", "processed_at", AS_OF) == 0
        assert spark.table("outbox_by_day").count() == want.count()
    finally:
        spark.sql("DROP TABLE IF EXISTS outbox_by_day")
