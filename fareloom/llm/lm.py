"""Stupid-backoff language-model scores from the corpus itself, each document scored without itself.

Texts, in lower case, become ids of a public byte-level vocabulary, so the unigram table has a fixed
size. Bigrams are counted over the whole corpus into a table partitioned by key. A document's
probability of a word after another is c(v w) / c(v) if the pair occurs in other documents, else
``backoff`` times c(w) / N, and a word that no other document has counts as half an occurrence; all
counts are without the document's own occurrences.

Bigrams that make up at least one in ``heavy`` of the corpus number ``heavy`` at most: a table of
bounded size that every task holds and that resolves most occurrences on the spot. All other
distinct bigrams of every document are exploded to rows and meet the count table by a join on the
key; none of these keys has more than that share of the rows. The parts are summed per document.

Null and empty texts have no tokens, a sum of 0 and a null mean. Every row is scored for itself, so
rows that repeat are scored alike, each seeing the others; a null id stays null. Texts are read whole,
of any length and with any run of white space; one beyond the size of a step is a step of its own. Empty tables give
empty results. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import released, staged, steps
from fareloom.llm.tokens import encode_whole, load_encoder

#: Share of the corpus (one in this many) from which a bigram is resolved by the broadcast table.
HEAVY = 200_000
#: Distinct bigrams that a task holds before it passes their counts on.
HELD = 3_000_000
START = 65_535


def encoded(docs: DataFrame, ranks: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """(row, doc_id, ids): a number of each row, and its token ids as little-endian 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = load_encoder(ranks, pattern)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in steps(batch, "text"):
                texts = pc.utf8_lower(pc.fill_null(part.column("text"), "")).to_pylist()
                ids = [encode_whole(encoder, t).astype("<u2").tobytes() for t in texts]
                numbers = np.arange(row, row + len(ids))
                row += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(numbers), part.column("doc_id"), pa.array(ids, pa.binary())], ["row", "doc_id", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(run), "row long, doc_id long, ids binary")


def pairs_of(ids: bytes) -> np.ndarray:
    """Keys of a text's bigrams: the word before in the upper, the word in the lower 16 bits."""
    words = np.frombuffer(ids, "<u2").astype(np.int64)
    return np.concatenate([[START], words[:-1]]) * 65_536 + words if len(words) else words


def bigram_counts(tokens: DataFrame) -> DataFrame:
    """(key, n) over the whole corpus; tasks add up what they read before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, fresh = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def merge() -> None:
            nonlocal keys, counts, fresh
            more, n = np.unique(np.concatenate(fresh), return_counts=True) if fresh else (keys[:0], counts[:0])
            both, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)
            keys, fresh = both, []

        waiting = 0
        for batch in batches:
            for ids in batch.column("ids"):
                fresh.append(pairs_of(ids.as_py()))
                waiting += len(fresh[-1])
                if waiting > 4_000_000:
                    merge()
                    waiting = 0
            if len(keys) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
                keys, counts = keys[:0], counts[:0]
        merge()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return tokens.mapInArrow(released(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``values`` at ``wanted`` among sorted ``keys``; -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1)


def lm_scores(
    docs: DataFrame, ranks: str, pattern: str, backoff: float = 0.4, heavy: int = HEAVY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every row."""
    spark = docs.sparkSession
    tokens = staged(encoded(docs, ranks, pattern, id_column, text_column), "lm-tokens")
    table = staged(bigram_counts(tokens), "lm-bigrams")
    before = F.shiftrightunsigned("key", 16).cast("int")
    word = F.col("key").bitwiseAND(65_535).cast("int")
    as_before, as_word = np.zeros(65_536), np.zeros(65_536)
    for r in table.groupBy(before.alias("v")).agg(F.sum("n")).collect():  # at most 65,536 rows
        as_before[r[0]] = r[1]
    for r in table.groupBy(word.alias("w")).agg(F.sum("n")).collect():  # at most 65,536 rows
        as_word[r[0]] = r[1]
    total = float(as_word.sum())
    frequent = table.filter(F.col("n") * heavy >= total).orderBy("key").collect()  # at most ``heavy`` rows
    known = (np.array([r[0] for r in frequent], np.int64), np.array([r[1] for r in frequent], np.int64), as_before, as_word)
    shared = spark.sparkContext.broadcast(known)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with the sum of what the heavy table resolves, and its other bigrams: their keys,
        their occurrences, and what they add if the pair is, or is not, found elsewhere."""
        keys, counts, as_before, as_word = shared.value
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                every = pairs_of(ids)
                pair, n = np.unique(every, return_counts=True)
                rest_v = as_before[pair >> 16] - _own(every >> 16, pair >> 16)
                rest_w = as_word[pair & 65_535] - _own(every & 65_535, pair & 65_535)
                absent = np.log(backoff) + np.log(np.maximum(rest_w, 0.5) / max(1.0, total - len(every)))
                given = np.log(np.maximum(rest_v, 1))
                count = _lookup(keys, counts, pair)
                light = count < 0
                sure = n * np.where(count > n, np.log(np.maximum(count - n, 1)) - given, absent)
                out.append((len(every), sure[~light].sum(), pair[light], n[light], absent[light], given[light]))
            size, sure, *lists = zip(*out, strict=True) if out else [()] * 6
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists[0]])]).astype(np.int32)
            kinds = (pa.int64(), pa.int32(), pa.float32(), pa.float32())
            nested = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x) if x else [], k)) for x, k in zip(lists, kinds, strict=True)]
            columns = [batch.column("row"), batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(sure, pa.float64()), *nested]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "sure", "key", "n", "absent", "given"])

    kinds = "row long, doc_id long, n_tokens long, sure double, key array<long>, n array<int>, absent array<float>, given array<float>"
    resolved = staged(tokens.mapInArrow(released(resolve), kinds), "lm-resolved")
    light = resolved.select("row", F.inline(F.arrays_zip("key", "n", "absent", "given")))
    joined = light.join(table.select("key", F.col("n").alias("_count")), "key")
    other = F.col("_count") - F.col("n")
    each = F.col("n") * F.when(other > 0, F.log(other.cast("double")) - F.col("given")).otherwise(F.col("absent"))
    sums = joined.groupBy("row").agg(F.sum(each.cast("double")).alias("_light"))
    found = resolved.select("row", "doc_id", "n_tokens", "sure").join(sums, "row", "left")
    log_prob = F.col("sure") + F.coalesce("_light", F.lit(0.0))
    return found.select(
        "doc_id", "n_tokens", log_prob.alias("log_prob"), F.when(F.col("n_tokens") > 0, log_prob / F.col("n_tokens")).alias("mean_log_prob")
    )


def _own(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How often each wanted value occurs in a text."""
    ordered = np.sort(values)
    return np.searchsorted(ordered, wanted, "right") - np.searchsorted(ordered, wanted, "left")
