"""Helpers that the text operators share: staging, bounded batches, words, labelled samples."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import work_path

#: Bytes of text that one step of a Python task holds at a time; a longer text is a step of its own.
STEP_BYTES = 12 << 20


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def steps(batch: pa.RecordBatch, columns: str | Sequence[str], size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each part's texts in ``columns`` stay near ``size`` bytes."""
    names = [columns] if isinstance(columns, str) else columns
    lengths = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in names)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def give_back() -> None:
    """Return this process's free memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(work: Callable) -> Callable:
    """``work`` over the batches of a task; when it ends, free memory goes back to the system.

    Python workers outlive their tasks, and what they keep counts against the executor's next stage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, and for each text where its words begin and end."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    full = pc.greater(pc.binary_length(flat), 0)
    if len(flat) and not pc.all(full).as_py():
        before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        flat, bounds = flat.filter(full), before[bounds]
    return flat, bounds


def uniques(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values, and for each value its place among them."""
    if not len(flat):
        return flat, np.zeros(0, np.int64)
    encoded = flat.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], max_chars: int) -> DataFrame:
    """(doc_id, text, label): at most ``per_class[label]`` training rows of a label, chosen by a
    hash of the id, of texts up to ``max_chars`` characters. Both bounds are parameters of the callers.
    A document labelled more than once takes its largest label; null labels and ids do not count.
    """
    rows = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    order = F.xxhash64("_id", F.lit(17))
    chosen = None
    for value, most in per_class.items():
        some = rows.filter(F.col("_label") == value).orderBy(order, "_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.filter(F.length("text") <= max_chars).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    # bounded by the sum of per_class, rows of two numbers
    return texts.join(F.broadcast(chosen), "_id").select(
        F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_label").alias("label")
    )
