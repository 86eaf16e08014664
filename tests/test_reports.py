import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fareloom.operators import reports
from fareloom.sources.tables import write_bookings

START, END = dt.date(2026, 1, 1), dt.date(2026, 1, 31)
SCHEMA = "id string, driver_id string, status string, total_amount decimal(10,2), platform_fee decimal(10,2), driver_earning decimal(10,2), completed_at timestamp_ntz"


def at(day, hour=0, minute=0):
    return dt.datetime(2026, 1, day, hour, minute)


def bookings(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "completed", D(100), D(25), D("75.01"), at(1)),
            ("2", "a", "completed", D(200), D(50), D("150.00"), at(31, 23, 59)),
            ("3", "b", "completed", D(0), D(0), D("225.01"), at(2)),
            ("4", "c", "completed", D(40), None, None, at(2)),
            ("5", None, "completed", D(70), D(7), D(63), at(3)),
            ("6", "a", "cancelled", D(900), D(1), D(1), at(3)),
            ("7", "a", "completed", D(900), D(1), D(1), dt.datetime(2026, 2, 1)),
            ("8", "a", "completed", D(900), D(1), D(1), None),
        ],
        SCHEMA,
    )


def users(spark):
    return spark.createDataFrame([("a", "Ann", "ann@x"), ("b", None, "bob@x"), ("d", "Dan", "dan@x")], "id string, name string, email string")


def test_window_is_closed_on_days(spark):
    ids = {r.id for r in reports.completed_in_window(bookings(spark), START, END).collect()}
    assert ids == {"1", "2", "3", "4", "5"}


def test_ranking_ties_nulls_and_unmatched(spark):
    left = [(r["rank"], r.driver_id, r.driver_name, r.average_earnings) for r in
            reports.driver_earnings_ranking(bookings(spark), users(spark), START, END, how="left").collect()]
    # no earnings sorts first when descending; a and b tie and go by id
    assert left == [(1, "c", None, None), (2, "a", "Ann", D("112.51")), (3, "b", None, D("225.01"))]
    inner = [(r["rank"], r.driver_id, r.driver_name) for r in reports.driver_earnings_ranking(bookings(spark), users(spark), START, END).collect()]
    assert inner == [(1, "a", "Ann"), (2, "b", "bob@x")]


def test_driver_without_bookings_gets_zeros(spark):
    drivers = spark.createDataFrame([("a",), ("z",)], "driver_id string")
    got = {r.driver_id: (r.total_earnings, r.total_orders, r.average_earnings) for r in
           reports.driver_earnings(bookings(spark), drivers, START, END).collect()}
    assert got == {"a": (D("225.01"), 2, D("112.51")), "z": (D("0.00"), 0, D("0.00"))}
    docs = {r.driver_id: json.loads(r.report) for r in reports.driver_earnings_json(bookings(spark), drivers, START, END).collect()}
    assert docs["z"]["dailyEarnings"] is None
    assert [d["date"] for d in docs["a"]["dailyEarnings"]] == ["2026-01-01", "2026-01-31"]


def test_empty_window(spark):
    none = (dt.date(2020, 1, 1), dt.date(2020, 1, 2))
    r = reports.platform_earnings(bookings(spark), *none).first()
    assert (r.total_platform_fee, r.total_revenue, r.total_orders, r.average_commission_rate) == (D("0.00"), D("0.00"), 0, D("0.0000"))
    assert reports.daily_summary_json(bookings(spark), *none).first().report == "[]"
    assert json.loads(reports.platform_earnings_json(bookings(spark), *none).first().report)["dailyEarnings"] is None
    assert reports.drivers_earnings_summary(bookings(spark), *none).first().active_drivers == 0


def test_platform_rate_is_the_mean_of_ratios_without_zero_totals(spark):
    r = reports.platform_earnings(bookings(spark), START, END).first()
    # 0.25, 0.25 and 0.10; the zero total and the missing fee do not count
    assert (r.total_orders, r.average_commission_rate) == (5, D("0.2000"))


def test_distinct_drivers_per_day(spark):
    got = {r.date: (r.orders, r.drivers_count) for r in reports.daily_earnings_summary(bookings(spark), START, END).collect()}
    assert got[dt.date(2026, 1, 2)] == (2, 2)
    assert got[dt.date(2026, 1, 3)] == (1, 0)


@pytest.mark.parametrize("sort_by", ["earnings", "orders", "average"])
@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_join_up_and_keyset_paging_agrees(spark, sort_by, order):
    many = spark.range(600).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("d"), (F.col("id") % 23).cast("string")).alias("driver_id"),
        F.lit("completed").alias("status"), F.lit(10).cast("decimal(10,2)").alias("total_amount"), F.lit(1).cast("decimal(10,2)").alias("platform_fee"),
        F.when(F.col("id") % 23 != 5, (F.col("id") % 4).cast("decimal(10,2)")).alias("driver_earning"),
        F.lit(at(5)).cast("timestamp_ntz").alias("completed_at"),
    )
    people = many.select(F.col("driver_id").alias("id")).distinct().withColumn("name", F.col("id")).withColumn("email", F.lit("x"))
    args = dict(start=START, end=END, limit=5, sort_by=sort_by, sort_order=order)
    pages = [reports.drivers_earnings_page(many, people, page=p, **args).collect() for p in range(1, 7)]
    assert {(r.total, r.total_pages) for page in pages for r in page} == {(23, 5)}
    listed = [r.driver_id for page in pages for r in page]
    assert len(listed) == len(set(listed)) == 23
    column = reports.SORT_COLUMNS[sort_by]
    last = pages[0][-1]
    after = reports.drivers_earnings_after(many, people, last_value=last[column], last_driver=last.driver_id, **args)
    assert [r.driver_id for r in after.collect()] == listed[5:10]


def test_page_with_unknown_sort_goes_by_driver(spark):
    rows = reports.drivers_earnings_page(bookings(spark), users(spark), START, END, sort_by="nonsense").collect()
    assert [r.driver_id for r in rows] == ["a", "b"]
    assert rows[0].total == 3  # drivers without a user record count, but are not listed


def test_layout_prunes_days_and_pushes_filters(spark, folder):
    write_bookings(bookings(spark), folder)
    stored = spark.read.parquet(folder)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = reports.completed_in_window(stored, START, END).select("driver_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(completed_at" in plan and "EqualTo(status,completed)" in plan
    assert "total_amount" not in plan
    assert stored.count() == 8


def test_a_page_past_the_end_keeps_its_pagination(spark):
    from fareloom.plans.queries import END, START
    from fareloom.sources.marketplace import Marketplace

    m = Marketplace(spark, "/root/testdata/sf0.001")
    summary = reports.drivers_earnings_summary(m.bookings, START, END)
    data = json.loads(reports.drivers_page_json(m.bookings, m.users, START, END, page=9999).first()["report"])["data"]
    total = summary.first()["active_drivers"]
    assert data["drivers"] == [] and total > 0
    assert data["pagination"] == {"page": 9999, "limit": 10, "total": total, "totalPages": -(-total // 10)}
