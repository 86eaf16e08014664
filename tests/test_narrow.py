"""What is moved between tasks: only the columns a result needs, and nothing chosen twice."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fareloom.operators import cdc, commission, joins
from fareloom.sources.marketplace import Marketplace
from fareloom.streaming import jobs

@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def market(spark):
    m = Marketplace(spark, "/root/testdata/sf0.001")
    return m, cdc.Dimensions(m.users, m.profiles, m.drivers, m.vehicles)


def test_tombstones_move_no_payload(spark, no_broadcast):
    m, dims = market(spark)
    plan = cdc.projection_tombstones(cdc.booking_events(m.changes, dims))._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "pickup_location" not in plan and "total_amount" not in plan


def test_rows_of_a_lookup_are_told_apart_by_the_columns_named(spark, no_broadcast):
    fact = spark.range(40).select(F.col("id"), (F.col("id") % 3).alias("version"), F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("k"), F.lit("wide").alias("w"))
    dim = spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    wide = joins.lookup(fact, dim, "k")
    narrow = joins.lookup(fact, dim, "k", spread_by=("id", "version"))
    assert sorted(wide.collect(), key=repr) == sorted(narrow.collect(), key=repr)
    hashed = [" w#" in x for df in (wide, narrow) for x in re.findall(r"xxhash64\(.*?\)", df._jdf.queryExecution().analyzed().toString())]
    assert any(hashed) and not any(" w#" in x for x in re.findall(r"xxhash64\(.*?\)", narrow._jdf.queryExecution().analyzed().toString()))
    want = fact.join(dim, "k", "left").select(*fact.columns, "name")
    assert sorted(narrow.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_heavy_keys_are_looked_for_in_the_rows_chosen_from(spark, no_broadcast, monkeypatch):
    m, dims = market(spark)
    asked = []
    monkeypatch.setattr(joins, "heavy_salts", lambda fact, keys: asked.append(fact) or [])
    jobs.projection_batch(m.changes, dims)
    cdc.project_changes(m.changes, m.outbox.filter("false").select("id", "aggregate_id", "created_at"), dims)
    assert len(asked) == 4
    assert all("max_by" not in fact._jdf.queryExecution().analyzed().toString() for fact in asked)


def test_a_room_needs_few_columns_of_its_booking(spark, no_broadcast):
    m, dims = market(spark)
    few = commission.newest_changes(m.changes.select(*cdc.ROOM_SOURCE))
    whole = cdc.chat_rooms(m.chat_events, cdc.documents_of_changes(commission.newest_changes(m.changes), dims))
    got = cdc.chat_rooms(m.chat_events, cdc.documents_of_changes(cdc.with_blanks(few, m.changes.schema), dims))
    assert sorted(got.collect(), key=repr) == sorted(whole.collect(), key=repr)
    assert "total_amount" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_in_the_long_form_lose_only_zeros_behind_the_point(spark):
    values = ["0.00", "120.00", "120.50", "100.05", "-3.10", "0.07", None]
    fields = [f for f, k in cdc.DOCUMENT_KINDS.items() if k == "number"]
    null = {"string": "string", "geo": "struct<latitude:decimal(10,8),longitude:decimal(11,8)>", "timestamp": "timestamp_ntz", "boolean": "boolean"}
    schema = "id string, n decimal(10,2)"
    rows = spark.createDataFrame([(str(i), v and Decimal(v)) for i, v in enumerate(values)], schema)
    rows = rows.withColumns({f: F.col("n") if f in fields else F.lit(None).cast(null[k]) for f, k in cdc.DOCUMENT_KINDS.items()})
    long = cdc.document_fields_long(rows)
    got = {(r.doc_id, r.type_tag, r.value) for r in long.filter(F.col("field") == "tipAmount").collect()}
    texts = [("0", "integer"), ("120", "integer"), ("120.5", "double"), ("100.05", "double"), ("-3.1", "double"), ("0.07", "double")]
    assert got == {(str(i), kind, text) for i, (text, kind) in enumerate(texts)} | {("6", "null", None)}
    assert "regexp_replace" not in long._jdf.queryExecution().analyzed().toString()
