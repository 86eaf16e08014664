import contextlib

from pyspark.sql import functions as F

from fareloom.operators.joins import fits_broadcast, heavy_hashes, lookup, newest, oldest, previous_value


def fact(spark):
    """One key with a third of the rows, some rows without a key, many single ones."""
    return spark.range(9000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") < 3000, F.lit("hot")).when(F.col("id") % 10 != 0, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
    )


def dim(spark):
    return (
        spark.range(9000)
        .filter("id % 3 = 0")
        .select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") * 2).alias("value"))
        .unionByName(spark.sql("SELECT 'hot' AS key, -1L AS value"))
    )


def rows(df):
    return sorted(df.select("row", "key", "value").collect(), key=str)


@contextlib.contextmanager
def no_broadcast(spark, **more):
    """Every join is shuffled, whatever the sizes, and every partition stays."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        **more,
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_gives_the_same_by_broadcast_and_by_shuffle(spark):
    for how in ("left", "inner"):
        broadcast = rows(lookup(fact(spark), dim(spark), "key", how, limit=1 << 40))
        with no_broadcast(spark):
            shuffled = rows(lookup(fact(spark), dim(spark), "key", how))
            plain = rows(fact(spark).join(dim(spark), "key", how))
        assert broadcast == shuffled == plain


def test_lookup_shuffles_by_key_and_spread(spark):
    with no_broadcast(spark):
        plan = lookup(fact(spark), dim(spark), "key")._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert any("_key_0" in line and "_spread" in line.split("LeftOuter")[0] for line in joins)
    assert any("hashpartitioning(_key_0" in line and "_spread" in line for line in plan.splitlines())


def test_lookup_spreads_heavy_rows_and_rows_without_a_key(spark):
    with no_broadcast(spark):
        df = lookup(fact(spark), dim(spark), "key")
        for condition, n in (("key = 'hot'", 3000), ("key IS NULL", 600)):
            parts = [r["count"] for r in df.filter(condition).groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(parts) == n and max(parts) <= 2 * n / 8, (condition, parts)
        assert df.filter("key = 'hot' AND value = -1").count() == 3000


def test_heavy_hashes_finds_exactly_the_large_keys(spark):
    found = [r[0] for r in heavy_hashes(fact(spark), ["key"], share=100).collect()]
    assert found == [spark.sql("SELECT xxhash64('hot')").first()[0]]
    assert heavy_hashes(fact(spark).filter("key <> 'hot'"), ["key"], share=100).count() == 0
    assert heavy_hashes(fact(spark).filter("false"), ["key"]).count() == 0


def test_fits_broadcast_respects_the_limit(spark):
    assert fits_broadcast(dim(spark), 1 << 40)
    assert not fits_broadcast(dim(spark), 10)
    assert not fits_broadcast(dim(spark), -1)


def test_previous_value_over_slices_equals_a_plain_lag(spark):
    # versions with gaps, a NULL value now and then, one key with nearly all rows
    log = spark.range(4000).select(
        F.when(F.col("id") % 40 == 0, F.concat(F.lit("b"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("key"),
        (F.col("id") * 3 + F.col("id") % 2).alias("version"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("s"), F.col("id").cast("string"))).alias("status"),
    )
    plain = {}
    last = {}
    for r in sorted(log.collect(), key=lambda r: r["version"]):
        plain[(r["key"], r["version"])] = last.get(r["key"], "none")
        last[r["key"]] = r["status"]
    for size in (7, 100, 10**9):
        got = previous_value(log, "key", ["version"], "status", F.floor(F.col("version") / size), "before").collect()
        seen = {(r["key"], r["version"]): "none" if r["before"] is None else r["before"]["value"] for r in got}
        assert len(got) == 4000
        assert seen == plain


def test_newest_and_oldest_break_ties_by_id(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "q")], "k string, t int, id string")
    assert {(r["k"], r["id"]) for r in newest(df, "k", ["t", "id"]).collect()} == {("a", "z"), ("b", "q")}
    assert {(r["k"], r["id"]) for r in oldest(df, "k", ["t", "id"]).collect()} == {("a", "x"), ("b", "q")}
