"""The physical plans the jobs are meant to have."""

import re

import pytest

from fareloom.operators import reports, split
from fareloom.plans.queries import END, START, registered
from fareloom.sources.marketplace import Marketplace

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_are_broadcast_to_the_bookings(spark):
    m = Marketplace(spark, SF)
    text = plan(split.revenue_share_lookup(m.bookings, m.rules))
    assert text.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_query_has_a_cartesian_product(spark):
    m = Marketplace(spark, SF)
    rows = split.financial_split(m.bookings, m.rules, m.settings, m.influencers)
    assert "CartesianProduct" not in plan(rows) and "NestedLoop" not in plan(rows)


def test_ranking_numbers_only_the_top_rows(spark):
    m = Marketplace(spark, SF)
    text = plan(reports.driver_earnings_ranking(m.bookings, m.users, START, END))
    assert "TakeOrderedAndProject" in text
    # the window stands above the top-k
    assert text.index("Window") < text.index("TakeOrderedAndProject")


def test_unused_line_items_are_not_read(spark):
    m = Marketplace(spark, SF)
    assert "l_suppkey" not in plan(reports.orders_by_status(m.bookings))
    assert "l_suppkey" not in plan(reports.platform_earnings(m.bookings, START, END))


def test_scans_read_only_the_needed_columns(spark):
    m = Marketplace(spark, SF)
    text = plan(reports.orders_by_status(m.bookings))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert schemas and all("o_totalprice" not in s for s in schemas)


# file scans of a query when every join is shuffled: each side of a lookup is read once
SCANS = {
    "commission_decision_log": 7, "affiliate_commission": 5, "driver_referral_commission": 5, "webhook_outcomes": 4,
    "outbox_build": 12, "projection_latest": 14, "chat_room_rollup": 14, "drivers_earnings_page": 4, "drivers_page_json": 4,
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_shuffled_lookups_read_each_side_once(spark, name):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        text = plan(registered()[name](spark, SF))
    finally:
        for limit in limits:
            spark.conf.unset(limit)
    assert len(re.findall("FileScan parquet", text)) <= SCANS[name]


def test_documents_of_changes_build_no_payload(spark):
    text = plan(registered()["projection_latest"](spark, SF))
    assert "to_json" not in text and "from_json" not in text
