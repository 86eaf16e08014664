"""URL rules by a sorted sweep over reversed-host keys; SQL functions only.

A rule names a host, which stands for its subdomains too, and the start of a path. With the labels
of a host in reverse, the hosts under a rule begin with its key: the rule is an interval of keys, and
two such intervals are nested or apart. Sorted together, a rule opens where its interval begins and
closes behind its last key, and a page between them falls under it. ``sweep`` keeps the open rules as
a stack: the depth is a running sum of openings and closings, and slot j of the stack is the last rule
that was opened at depth j. A first sweep over hosts gives the rule hosts above a page, a second one
over (rule host, path) the longest path among that host's rules; of those the longest rule wins.

The sorted rows are cut into even slices by range, with the row's own number as last part of the sort
key, so that a host with a third of all pages is spread over many slices. What is open where a slice
begins is carried over from the slices before it by a table of a row for each slice.

Host: what stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z in lower case;
path: what follows, up to ``?``, ``#`` or the end. A null url, or one without ``://``, has neither and
falls under no rule. The longest rule is the one with most characters of host and path, then of host.
A rule given twice with unlike verdicts blocks. Rules without a host are left out; a null path is
empty. Every row is judged for itself, so repeated rows give repeated results, and a url may be of
any length. No pages give no rows, and without rules the default holds. Only the named columns are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import staged

#: Bytes that no UTF-8 text holds: behind all that begins with a key, and between host and path.
BEHIND, BETWEEN = bytearray(b"\xff"), bytearray(b"\xfe")

OPENS, STANDS, CLOSES = 0, 1, 2


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_key(host: Column) -> Column:
    """``a.example.net`` as the bytes of ``net.example.a.``: what lies under a host begins with its key."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, as the module says."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return tuple(F.coalesce(x, F.lit("")) for x in (lower_ascii(F.regexp_extract(url, whole, 1)), F.regexp_extract(url, whole, 2)))


def sweep(points: DataFrame, rules: DataFrame, into: str) -> DataFrame:
    """Each point with the stack, outermost first, of the rules whose keys its key begins with.

    ``points`` has ``_key`` (bytes) and a distinct ``_row``; ``rules`` has distinct keys ``_key`` and
    ``_rule``, what the stack is to hold. Both go through one range exchange.
    """
    spark = points.sparkSession
    kept = [c for c in points.columns if c not in ("_key", "_row")]
    point = F.struct(*kept).alias("_point")
    nothing = F.lit(None)
    opened = rules.select("_key", F.lit(OPENS).alias("_kind"), F.lit(0).cast("long").alias("_row"), F.lit(1).alias("_step"), "_rule")
    closed = rules.select(
        F.concat("_key", F.lit(BEHIND)).alias("_key"), F.lit(CLOSES).alias("_kind"), F.lit(0).cast("long").alias("_row"), F.lit(-1).alias("_step"),
        nothing.cast(rules.schema["_rule"].dataType).alias("_rule"),
    )
    stands = points.select("_key", F.lit(STANDS).alias("_kind"), "_row", F.lit(0).alias("_step"), point)
    events = stands.unionByName(opened.unionByName(closed), allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = staged(events.repartitionByRange(n, "_key", "_kind", "_row").withColumn("_slice", F.spark_partition_id()), "sweep")
    n = max(n, 1 + (slices.agg(F.max("_slice")).first()[0] or 0))

    # a row for each slice, and for each slice and level: as many as the session has partitions, times the depth
    every = F.broadcast(spark.range(n).select(F.col("id").cast("int").alias("_slice")))
    marks = slices.filter(F.col("_kind") != STANDS)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    steps = every.join(marks.groupBy("_slice").agg(F.sum("_step").alias("_sum")), "_slice", "left")
    depths = steps.select("_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    along = Window.partitionBy("_slice").orderBy("_key", "_kind", "_row").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.col("_before") + F.sum("_step").over(along)
    levels = staged(marks.join(F.broadcast(depths), "_slice").withColumn("_level", depth).filter(F.col("_kind") == OPENS).select("_slice", "_level", "_key", "_rule"), "levels")
    deepest = int(levels.agg(F.max("_level")).first()[0] or 0)
    if not deepest:
        return points.withColumn(into, F.array().cast(f"array<{rules.schema['_rule'].dataType.simpleString()}>"))

    last = levels.groupBy("_slice", "_level").agg(F.max_by("_rule", "_key").alias("_rule"))
    grid = every.select("_slice", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(deepest).cast("long"))).alias("_level"))
    earlier = Window.partitionBy("_level").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(last, ["_slice", "_level"], "left").withColumn("_rule", F.last("_rule", ignorenulls=True).over(earlier))
    carried = carried.groupBy("_slice").agg(F.map_from_entries(F.collect_list(F.struct("_level", "_rule"))).alias("_carried"))
    state = depths.join(carried, "_slice")

    placed = slices.join(F.broadcast(state), "_slice").withColumn("_depth", depth)
    opens_at = [(F.col("_kind") == OPENS) & (F.col("_depth") == j) for j in range(1, deepest + 1)]
    slots = [
        F.coalesce(F.last(F.when(here, F.col("_rule")), ignorenulls=True).over(along), F.element_at("_carried", F.lit(j).cast("long")))
        for j, here in enumerate(opens_at, 1)
    ]
    stacked = placed.withColumn(into, F.slice(F.array(*slots), 1, F.col("_depth").cast("int"))).filter(F.col("_kind") == STANDS)
    return stacked.select("_key", "_row", "_point.*", into)


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` has host, path and verdict (``allow`` or ``block``); ``default`` is the verdict of
    pages under no rule.
    """
    path = F.coalesce(F.col("path"), F.lit(""))
    known = rules.filter(F.col("host").isNotNull()).select(lower_ascii(F.col("host")).alias("host"), path.alias("path"), "verdict")
    known = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    hosts = known.select(host_key(F.col("host")).alias("_key")).distinct().withColumn("_rule", F.col("_key"))
    length = F.length("host") + F.length("path")
    paths = known.select(
        F.concat(host_key(F.col("host")), F.lit(BETWEEN), F.col("path").cast("binary")).alias("_key"),
        F.struct(length.alias("length"), F.length("host").alias("of_host"), "host", "path", "verdict").alias("_rule"),
    )

    host, path = parts(F.col(url_column))
    judged = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("_row"))
    above = sweep(judged.withColumn("_key", host_key(F.col("host"))), hosts, "_hosts")
    # a page under no rule host sorts before all rules
    key = F.coalesce(F.concat("_host", F.lit(BETWEEN), F.col("path").cast("binary")), F.lit(bytearray()))
    one = above.select("page_id", "host", "path", "_row", F.explode_outer("_hosts").alias("_host")).withColumn("_key", key)
    # one row of a page for each rule host above it: a number of its own for the order
    one = one.withColumnRenamed("_row", "_page").withColumn("_row", F.xxhash64("_page", "_host"))
    best = sweep(one.drop("_host"), paths, "_rules").withColumn("_best", F.try_element_at("_rules", F.lit(-1)))
    found = best.groupBy("_page").agg(
        F.any_value("page_id").alias("page_id"), F.any_value("host").alias("host"), F.any_value("path").alias("path"), F.max("_best").alias("_best")
    )
    return found.select(
        "page_id", "host", "path", F.concat("_best.host", "_best.path").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
