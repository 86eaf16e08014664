"""Keyed sinks for micro-batches: one folder per batch, merged on read.

A batch overwrites only its own folder, so a replayed batch changes nothing, and no batch
rewrites the rows of the ones before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.joins import lookup_bytes, newest

COLLECTIONS = ("orders_rt", "bookings")

# up to this size of their files the newest rows are marked where they lie; the marks, a bit for each row,
# then come to some hundred MB at most
MARKED_BYTES = 64 << 30
# 2 ** so many rows of a file have their marks in one bitmap
MARK_BITS = 15


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def is_finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether ``finish`` has marked the batch under ``path``."""
    try:
        return not spark.read.parquet(f"{path}/finished/batch={batch_id}").isEmpty()
    except AnalysisException:  # no such folder
        return False


def finish(spark: SparkSession, path: str, batch_id: int) -> None:
    """Mark a batch as wholly written."""
    write_batch(spark.range(1), f"{path}/finished", batch_id)


def write_dual(documents: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch of documents to both collections.

    The second collection is filled from the written files of the first, so the documents
    are computed once and both hold the same rows. An error in either fails the batch, which
    then runs again as a whole.
    """
    first, second = COLLECTIONS
    write_batch(documents, f"{path}/{first}", batch_id)
    written = documents.sparkSession.read.schema(documents.schema).parquet(f"{path}/{first}/batch={batch_id}")
    write_batch(written, f"{path}/{second}", batch_id)


def newest_in_files(rows: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """``joins.newest`` of rows that are read straight from Parquet files, without moving them.

    Keys, ``order`` and each row's place, its file and number there, are shuffled alone. The places of the
    newest rows go back to the files as bitmaps, a bit for each row up to the last, and the files are read
    once more for those rows. ``rows`` may filter and select, but not join or explode, what it reads.
    """
    if not hasattr(rows, "_jdf") or lookup_bytes(rows) > MARKED_BYTES:
        return newest(rows, keys, order)
    keys = [keys] if isinstance(keys, str) else list(keys)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    best = placed.groupBy(*keys).agg(F.max_by(F.struct("_file", "_row"), F.struct(*order)).alias("_best")).select("_best.*")
    part, bit = F.shiftright("_row", MARK_BITS).alias("_part"), F.pmod("_row", F.lit(1 << MARK_BITS))
    marks = best.groupBy("_file", part).agg(F.bitmap_construct_agg(bit).alias("_marks"), F.max(bit).alias("_last"))
    marks = marks.select("_file", "_part", F.substring("_marks", F.lit(1), (F.shiftright("_last", 3) + 1).cast("int")).alias("_marks"))
    found = placed.withColumns({"_part": part, "_bit": bit.cast("int")}).join(F.broadcast(marks), ["_file", "_part"])
    # past the last mark there is no byte, and no row is taken
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    return found.filter(F.getbit(byte, F.col("_bit") % 8) == 1).select(*rows.columns)


def current(spark: SparkSession, path: str, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key over all batches, deleted ones left out.

    ``order`` is the row's own (time, id): a batch that arrives late cannot undo a newer one.
    """
    rows = read_batches(spark, path).drop("batch")
    return newest_in_files(rows, key, order).filter(~F.col("is_deleted")).drop("is_deleted")


def latest_totals(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The totals each key had in the last batch that touched it."""
    return newest(read_batches(spark, path), key, ["batch"]).drop("batch")
