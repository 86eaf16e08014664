"""Lookups and predecessor search that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is heavy when it owns at least one row in HEAVY_SHARE, or in TASK_PARTS times the session's
# partitions if those are more: then it would make up a good part of a task by itself.
HEAVY_SHARE = 1000
TASK_PARTS = 4

# salts of a heavy key for each such part; many, so that they fall evenly
SALTS = 16

# slots of the frequency sketch per heavy key; keys above the share are always found
SKETCH_SLOTS = 10

# groups of tasks that share a sketch
SKETCH_GROUPS = 64


def lookup_bytes(dim: DataFrame) -> int:
    """An estimate of the size of a lookup side.

    A lookup side has one row per key and is built by one-to-one joins, filters and
    aggregates, so it is no larger than the tables it reads together. Catalyst's own
    estimate multiplies the sides of a join, but is tighter for a plain projection.
    """
    plan = dim._jdf.queryExecution().optimizedPlan()
    return min(sum(_leaf_bytes(plan)), int(str(plan.stats().sizeInBytes())))


def _leaf_bytes(plan) -> list[int]:
    """The sizes of the tables that a plan reads."""
    leaves = plan.collectLeaves()
    return [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast limit in bytes; negative when broadcasting is off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(dim: DataFrame, limit: int | None = None) -> bool:
    """Whether ``dim`` is within the limit, by default the session's. Without access to the
    optimizer's statistics, as over a remote connection, nothing is: the join is then left to Spark."""
    if not hasattr(dim, "_jdf"):
        return False
    limit = broadcast_limit(dim.sparkSession) if limit is None else limit
    return limit >= 0 and lookup_bytes(dim) <= limit


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def heavy_hashes(fact: DataFrame, keys: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """Hashes (``_hash``) of the keys owning at least one ``share``-th of the rows, their rows
    (``_count``) and all rows with a key (``_rows``).

    Frequency sketches of fixed size, for groups of tasks, whose counts are added up: one pass over the
    key columns and no shuffle of keys. It only steers where rows are processed; results do not depend
    on it.
    """
    hashes = fact.filter(_all_present(keys)).select(F.xxhash64(*keys).alias("_hash"))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    sketch = F.expr(f"approx_top_k(_hash, {2 * share}, {share * SKETCH_SLOTS})")
    some = hashes.groupBy(group).agg(sketch.alias("_top"), F.count(F.lit(1)).alias("_n"))
    # of each group its largest keys and, without a hash, all its rows: bounded by the share and the groups
    whole = F.array(F.struct(F.lit(None).cast("long").alias("item"), F.col("_n").alias("count")))
    found = some.select(F.inline(F.concat(whole, "_top"))).groupBy(F.col("item").alias("_hash")).agg(F.sum("count").alias("_count"))
    rows = F.max(F.when(F.col("_hash").isNull(), F.col("_count"))).over(Window.partitionBy())
    return found.withColumn("_rows", rows).filter(F.col("_hash").isNotNull() & (F.col("_count") * share >= F.col("_rows")))


# heavy keys found so far, by a hash of the plan that reads the keys: they only steer where rows go,
# so it does no harm if the data have changed since
_FOUND: dict[tuple[int, int], list[tuple[int, int]]] = {}
REMEMBERED = 256


def heavy_salts(fact: DataFrame, keys: Sequence[str]) -> list[tuple[int, int]]:
    """(hash, salts) of the heavy keys, as many salts as their rows need; found in a job of its own and
    remembered, so that further lookups by the same keys of the same rows do not look again."""
    spark = fact.sparkSession
    parts = TASK_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(HEAVY_SHARE, parts)
    mark = (fact.select(F.xxhash64(*keys)).semanticHash(), share)
    if mark not in _FOUND:
        if len(_FOUND) >= REMEMBERED:
            _FOUND.clear()
        rows = heavy_hashes(fact, keys, share).collect()  # at most ``share`` rows
        _FOUND[mark] = [(r["_hash"], max(1, -(-SALTS * parts * r["_count"] // r["_rows"]))) for r in rows]
    return _FOUND[mark]


def _row_hash(df: DataFrame, columns: Sequence[str] = ()) -> Column:
    """A hash of the row's own values, or of some of them: the same when a lost task runs again."""
    plain = list(columns) or [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
    how: str = "left",
    limit: int | None = None,
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Attach the columns of ``dim`` (unique on ``keys``) to every row of ``fact``.

    A ``dim`` within the broadcast limit is broadcast. Otherwise both sides are shuffled once, by the
    keys and a spread: nothing, but for heavy keys a salt, with a copy of their ``dim``
    row for each; rows without a key have a hash of the row. So no task gets a whole heavy key. Heavy
    keys are looked for in ``keys_from`` where a cheaper DataFrame with the same keys is at hand.
    ``spread_by`` names columns that tell rows apart well: the hash of a row then takes only these, and
    columns the caller drops later are not moved for its sake.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup joins are left or inner, not {how}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in dim.columns if c not in keys]
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), keys, how).select(*fact.columns, *values)
    heavy = heavy_salts(fact if keys_from is None else keys_from, keys)
    own_hash = F.xxhash64(*keys)
    names = [f"_key_{i}" for i in range(len(keys))]
    none = F.lit(0).cast("long")
    spread = F.when(_all_present(keys), none).otherwise(_row_hash(fact, spread_by))
    moved = fact
    packed = dim.select(*keys, F.struct(*values).alias("_found"))
    copies = F.array(none)
    if heavy:
        salts = F.broadcast(fact.sparkSession.createDataFrame(heavy, "_hash long, _salts int"))  # at most a row per heavy key
        moved = moved.withColumn("_hash", own_hash).join(salts, "_hash", "left")
        spread = F.when(F.col("_salts").isNotNull(), F.pmod(_row_hash(fact, spread_by), F.col("_salts"))).otherwise(spread)
        packed = packed.withColumn("_hash", own_hash).join(salts, "_hash", "left")
        numbers = F.sequence(F.lit(0).cast("long"), (F.col("_salts") - 1).cast("long"))
        copies = F.when(F.col("_salts").isNotNull(), numbers).otherwise(copies)
    far = packed.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.explode(copies).alias("_spread"), "_found")
    moved = moved.withColumns({**{n: F.col(k) for k, n in zip(keys, names, strict=True)}, "_spread": spread})
    joined = moved.join(far, [*names, "_spread"], how)
    return joined.select(*fact.columns, *(F.col(f"_found.{c}").alias(c) for c in values))


def previous_value(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    value: str,
    part: Column,
    into: str,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """``value`` of the row before, per key, without one task sorting a whole heavy key.

    Ordinary keys are windowed as they are. The rows of a heavy key, if there is one, are windowed
    slice by slice; ``part`` names the slice and must not decrease along ``order``. The last value of
    each slice, found by a map-side combined ``max_by``, carries over to the next slice. The
    result is a struct, NULL on the first row of a key, so a NULL value and a missing
    predecessor stay apart. Heavy keys are looked for as in ``lookup``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cell = F.struct(F.col(value).alias("value"))
    heavy = [h for h, _ in heavy_salts(df if keys_from is None else keys_from, keys)]
    if not heavy:
        return df.withColumn(into, F.lag(cell).over(Window.partitionBy(*keys).orderBy(*order)))
    marked = df.withColumn("_slice", F.when(F.xxhash64(*keys).isin(heavy), part))
    last = (
        marked.filter(F.col("_slice").isNotNull())
        .groupBy(*keys, "_slice")
        .agg(F.max_by(cell, F.struct(*order)).alias("_last"))
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    carried = last.withColumn("_carried", F.lag("_last").over(across)).drop("_last")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        marked.withColumn("_inside", F.lag(cell).over(inside))
        .join(carried, [*keys, "_slice"], "left")
        .withColumn(into, F.coalesce("_inside", "_carried"))
        .drop("_slice", "_inside", "_carried")
    )


def newest(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key, by a map-side combined ``max_by``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def oldest(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


# slots of the marks that tell rows which may be the newest, for each so many bytes of the tables read; their number
# is a power of two of at least one bitmap, and at most 64 MB of marks
SLOT_BYTES = 16
BITMAP_BITS = 15
MOST_SLOT_BITS = 29


def maybe_newest(df: DataFrame, keys: str | Sequence[str], time: str) -> DataFrame:
    """The rows with the greatest ``time`` per key, and by chance some others: for wide rows that are costly to
    make and to move, before ``newest`` chooses among them.

    Keys and ``time`` are grouped alone, and a hash of each key's greatest marks a slot of a bitmap. A row
    stays where its own slot is marked. Tables of so many rows that most slots would be marked are left as they are.
    """
    if not hasattr(df, "_jdf"):
        return df
    # without the few rows of heavy keys, whose size is not known
    wanted = sum(x for x in _leaf_bytes(df._jdf.queryExecution().optimizedPlan()) if x < 1 << 62) // SLOT_BYTES
    if wanted >> MOST_SLOT_BITS:
        return df
    slots = 1 << max(BITMAP_BITS, wanted.bit_length())
    keys = [keys] if isinstance(keys, str) else list(keys)
    slot = F.pmod(F.xxhash64(*keys, time), F.lit(slots))
    part, bit = F.shiftright(slot, BITMAP_BITS), F.pmod(slot, F.lit(1 << BITMAP_BITS))
    # a maximum is the same however often a row comes, so joins that only widen are left out of it
    best = df.groupBy(*keys).agg(F.max(time).alias(time))
    marks = best.groupBy(part.alias("_marked")).agg(F.bitmap_construct_agg(bit).alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_marked = (part == F.col("_marked")) & (F.getbit(byte, (bit % 8).cast("int")) == 1)
    return df.join(F.broadcast(marks), is_marked, "left_semi")
