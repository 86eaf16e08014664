"""Logs laid out by day, whose retention drops folders instead of rewriting rows.

A log is a catalog table over a folder per day of its time column; rows without a time have a
folder of their own. Deleting what is older than some days drops the whole days before the edge from the
table and rewrites the edge day alone; younger days, and rows without a time, are not read at all. What a
day's folder held is left to the storage's own clean-up, since other readers may still be at it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.columns import instant
from fareloom.schemas import RETENTION_DAYS
from fareloom.session import work_path

DAY = "day"


def write_log(rows: DataFrame, table: str, path: str, time: str) -> None:
    """Lay ``rows`` out by the day of ``time`` under ``path``, as the catalog table ``table``."""
    by_day = rows.withColumn(DAY, F.to_date(time))
    by_day.write.mode("overwrite").partitionBy(DAY).option("path", path).saveAsTable(table)


def days_of(spark: SparkSession, table: str) -> list[dt.date]:
    """The days that a log holds; as many as there are folders."""
    named = (r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return sorted(dt.date.fromisoformat(d) for d in named if d[:1].isdigit())


def edge_rows(spark: SparkSession, table: str, time: str, cutoff: dt.datetime) -> DataFrame:
    """The rows of the edge day that stay."""
    log = spark.table(table).filter(F.col(DAY) == F.lit(cutoff.date()))
    return log.filter(F.col(time) >= instant(log, time, cutoff))


def drop_older(spark: SparkSession, table: str, time: str, as_of: dt.datetime, days: int = RETENTION_DAYS) -> int:
    """Delete what is older than ``days``, as ``cdc.retain`` with ``keep_null``; how many days were dropped."""
    cutoff = as_of - dt.timedelta(days=days)
    held = days_of(spark, table)
    old = [d for d in held if d < cutoff.date()]
    for day in old:
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({DAY} = DATE '{day}')")
    if cutoff.date() in held and cutoff.time() != dt.time():
        path = work_path(spark, "edge-day")
        edge_rows(spark, table, time, cutoff).drop(DAY).write.parquet(path)
        kept = spark.read.schema(spark.table(table).drop(DAY).schema).parquet(path)
        kept.createOrReplaceTempView("_edge_day")
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY} = DATE '{cutoff.date()}') SELECT * FROM _edge_day")
        spark.catalog.dropTempView("_edge_day")
    return len(old)
