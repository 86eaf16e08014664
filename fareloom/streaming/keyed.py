"""Keyed state of many keys in one value, so that stateful Python runs per bucket and not per key.

A call into Python and each read or write of its state cost some hundred microseconds, whatever they
carry. Keys are dealt to ``BUCKETS`` buckets by a hash; a bucket's entries are one packed value, read once
and written once for each micro-batch that touches the bucket. So a micro-batch of millions of keys makes
as many calls as there are buckets. A bucket holds its share of the live keys in memory: give a stream of
far more than some ten million live keys more buckets, before its first batch.

Each entry ends with the time it was last written. One older than ``ttl_days`` is as good as gone, and is
dropped when its bucket is touched; a bucket nobody touches for so long goes as a whole.
"""

from __future__ import annotations

import pickle
import sys
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# ship the class itself with the query: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 24 * 3600 * 1000
BUCKETS = 1 << 16
BUCKET = "_bucket"


class BucketProcessor(StatefulProcessor):
    """Keeps the entries of a bucket: plain tuples by key, packed by ``pickle``."""

    def __init__(self, ttl_days: int) -> None:
        self.ttl_ms = ttl_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.packed = handle.getValueState("entries", "packed binary", self.ttl_ms)

    def load(self) -> dict[Any, Any]:
        found = self.packed.get()
        return {} if found is None else pickle.loads(found[0])

    def store(self, entries: dict[Any, Any]) -> None:
        self.packed.update((pickle.dumps(entries, 5),))

    def lives(self, entry: tuple, now: int) -> bool:
        """Whether an entry, whose last item is its time, is still within its lifetime."""
        return now - entry[-1] < self.ttl_ms

    def close(self) -> None:
        pass


def by_bucket(rows: DataFrame, key: str, buckets: int = BUCKETS) -> GroupedData:
    """``rows`` grouped by the bucket of ``key``, which comes first in each row."""
    return rows.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias(BUCKET), "*").groupBy(BUCKET)
