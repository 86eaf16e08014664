"""Reading and laying out the entity tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.schemas import entity_schemas


def load(spark: SparkSession, directory: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Each entity as a DataFrame with its explicit schema (no inference pass).

    Older files may lack columns added later; Parquet reads those as NULL.
    """
    schemas = entity_schemas()
    return {
        name: spark.read.schema(schemas[name]).parquet(f"{directory}/{name}") for name in (names or schemas)
    }


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the generated test tables."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def write_bookings(bookings: DataFrame, path: str) -> None:
    """Lay bookings out for the reports: a folder per completion day, rows sorted by driver.

    Ranges over (day, driver, id) come out even, so a heavy day or driver is spread over
    several files and a light day stays in one. Each file covers a narrow range of drivers,
    so a report on one driver skips most row groups.
    """
    (
        bookings.withColumn("completed_date", F.to_date("completed_at"))
        .repartitionByRange("completed_date", "driver_id", "id")
        .sortWithinPartitions("completed_date", "driver_id")
        .write.mode("overwrite")
        .partitionBy("completed_date")
        .parquet(path)
    )
