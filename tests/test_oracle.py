"""Every registered query against its SQL statement on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry
from fareloom.plans import oracle, queries

DIRECTORY = "/root/testdata/sf0.001"
QUERIES = queries.registered()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return compare.connect(DIRECTORY)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DIRECTORY)
    assert compare.differences(df.collect(), df.columns, con, SQL[name]) is None


# every batch query, without any broadcast that the session may choose
SHUFFLED = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_matches_sql_without_broadcasts(spark, con, name):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        df = QUERIES[name](spark, DIRECTORY)
        assert compare.differences(df.collect(), df.columns, con, SQL[name]) is None
    finally:
        for limit in limits:
            spark.conf.unset(limit)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
