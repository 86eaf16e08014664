"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# what a job has shuffled goes when the job ends, not when the driver happens to collect its garbage
NO_LEFTOVERS = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}

# bytes of a row group where a task has several files open
ROW_GROUP = 32 << 20

Sink = Callable[[DataFrame, int], None]


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session with other settings for a while; a query keeps those it was started under."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    old = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def few_folders(folders: int) -> dict[str, str]:
    """Settings for writing to some folders at once: rows are not sorted, and possibly spilled, by folder. A task
    begins to sort when it has as many files open as the setting names, so it names one more."""
    return {"spark__sql__maxConcurrentOutputFileWriters": str(folders + 1), **NO_LEFTOVERS}


def start(
    df: DataFrame, sink: Sink | str, checkpoint: str, mode: str = "append", every: str | None = None, by_clock: bool = False
) -> StreamingQuery:
    """Feed a stream's micro-batches to ``sink``, a function or the path of a Parquet table.

    The query ends when the input is used up; with ``every`` it stands and looks for more at that
    interval. State is kept in RocksDB, outside the heap. ``by_clock``: the query's state has timers or a
    lifetime on the processing-time clock; if it is to end, it runs no batches without input, for those
    would go on for good.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.format("parquet").option("path", sink) if isinstance(sink, str) else writer.foreachBatch(sink)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with settings(
        df.sparkSession,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__streaming__noDataMicroBatches__enabled="false" if by_clock and not every else "true",
    ):
        return writer.start()
