"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM does not compile methods beyond 8000 bytecodes: split the wide projections instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "fareloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    It is named in ``spark.checkpoint.dir``. Its absence is an error: a folder chosen here could be
    one that the other executors do not see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return named.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{work_root(spark)}/fareloom/{label}-{uuid.uuid4().hex}"
