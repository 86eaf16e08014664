"""Phrases that occur often, mined in shards and counted over everything (SON partitioning).

Documents are dealt into ``shards`` by a hash of the row. A phrase that occurs ``support`` times occurs
``support / shards`` times in one of them at least, so each shard is mined completely at that lowered
support: words first, then phrases of two words and more, each only where both of its parts that are a
word shorter are frequent in the shard. A shard is mined by many tasks together: they add up what they
read and send a number for each phrase, which is counted by key. The phrases frequent in any shard are
the candidates, and a last pass counts every occurrence of every candidate, by its words.

Which phrases are frequent, the tasks know from a table of 2 ** ``filter_bits`` bits (16 MB by default),
set at a hash of the phrase; one for each length and one for all candidates are sent to the tasks. Its size
is fixed. Where hashes meet, a phrase that is not frequent is counted too: that costs rows, never a result,
since phrases under ``support`` are left out by their exact count. As a corpus outgrows the bits, fewer
phrases are passed over; raise ``filter_bits`` with it.

Everything is per language; a null one is ``und``. Texts are taken in lower case (A-Z), and parted at
``[.,;:!?]`` and line breaks into pieces, those at blanks and tabs into words. Phrases are counted within
pieces, overlaps included. Null and empty texts hold no words. Rows count as often as they are there,
with or without an id. Texts are read whole, of any length: one beyond the size of a step is a step of its
own. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import released, staged, steps, uniques, words

#: What ends a piece; a full stop stands for any of them among the words.
ENDS, STOP = r"[.,;:!?\x0A-\x0D]+", "."

#: Bytes of text in a step, and distinct phrases that a task holds before it passes their counts on.
STEP, HELD = 6 << 20, 3_000_000

#: Bits of a key that name the shard, so that there are 64 at most.
SHARD_BITS = 6
SPREAD = 0x9E3779B1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Pieces:
    """The words of a part's texts in one line, and the hashes of phrases that begin at each."""

    def __init__(self, part: pa.RecordBatch) -> None:
        texts = pc.replace_substring_regex(pc.fill_null(part.column("text"), ""), ENDS, f" {STOP} ")
        flat, bounds = words(texts)
        self.distinct, self.word = uniques(flat)
        stop = self.distinct.index(pa.scalar(STOP, self.distinct.type)).as_py() if len(self.distinct) else -1
        self.whole = self.word != stop
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        langs = part.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        self.shard = part.column("shard").to_numpy().astype(np.uint64)
        self.hashes = self._hash(self.distinct)[self.word]
        self.of_lang = self._hash(self.langs)[self.lang]

    @staticmethod
    def _hash(values: pa.Array) -> np.ndarray:
        return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)

    def starts(self, size: int, parts: np.ndarray | None = None) -> np.ndarray:
        """Where phrases of ``size`` words begin; ``parts`` marks the wanted ones of a word less."""
        if size == 1:
            return np.flatnonzero(self.whole)
        n = max(0, len(self.word) - 1)
        both = parts[:n] & parts[1:] & (self.text[:n] == self.text[1:])
        return np.flatnonzero(both)

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """Key of the phrase at each place: a hash above, the shard in the lowest bits."""
        text = self.text[at]
        key = self.of_lang[text] + np.uint64(size)
        for j in range(size):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + self.hashes[at + j])
        low = np.uint64((1 << SHARD_BITS) - 1)
        return (key & ~low) | self.shard[text]

    def marked(self, at: np.ndarray) -> np.ndarray:
        marks = np.zeros(len(self.word), bool)
        marks[at] = True
        return marks


def slot(key: np.ndarray, bits: int, of_shard: bool) -> np.ndarray:
    """Bit of a key in the table of its shard's phrases, or of all shards' ones."""
    high = key >> np.uint64(64 - bits)
    if of_shard:
        high = (high + (key & np.uint64((1 << SHARD_BITS) - 1)) * np.uint64(SPREAD)) & np.uint64((1 << bits) - 1)
    return high


def slot_column(key: Column, bits: int, of_shard: bool) -> Column:
    """The same of a column."""
    high = F.shiftrightunsigned(key, 64 - bits)
    if of_shard:
        high = (high + key.bitwiseAND((1 << SHARD_BITS) - 1) * F.lit(SPREAD)).bitwiseAND((1 << bits) - 1)
    return high


def bit_table(keys: DataFrame, bits: int, of_shard: bool) -> np.ndarray:
    """The bits set for ``keys`` (key), as 64-bit numbers: 2 ** (bits - 6) of them, however many keys."""
    at = slot_column(F.col("key"), bits, of_shard)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    rows = keys.select(F.shiftrightunsigned(at, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bit").to_numpy()
    return table.view(np.uint64)


def holds(table: np.ndarray, key: np.ndarray, bits: int, of_shard: bool) -> np.ndarray:
    at = slot(key, bits, of_shard)
    return (table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class Tally:
    """Counts of the keys of one task, in bounded memory."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fresh: list[np.ndarray] = []
        self.waiting = 0

    def add(self, keys: np.ndarray) -> bool:
        """Whether enough is held to pass it on."""
        self.fresh.append(keys)
        self.waiting += len(keys)
        if self.waiting > HELD:
            self._merge()
        return len(self.keys) > HELD

    def _merge(self) -> None:
        more, n = np.unique(np.concatenate([self.keys[:0], *self.fresh]), return_counts=True)
        both, place = np.unique(np.concatenate([self.keys, more]), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, n]), len(both)).astype(np.int64)
        self.keys, self.fresh, self.waiting = both, [], 0

    def batch(self) -> pa.RecordBatch:
        self._merge()
        out = pa.RecordBatch.from_arrays([pa.array(self.keys.view(np.int64)), pa.array(self.counts)], ["key", "n"])
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        return out


def frequent_in_shards(rows: DataFrame, size: int, shorter, least: int, bits: int) -> DataFrame:
    """(key) of the phrases of ``size`` words with ``least`` occurrences in a shard; ``shorter`` is the
    broadcast table of those a word shorter."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for part in steps(batch, "text", STEP):
                line = Pieces(part)
                parts = None
                if size > 1:
                    # of every length below: each is a phrase only if it doesn't reach over a piece's end
                    begins = line.starts(1)
                    for m in range(2, size):
                        begins = line.starts(m, line.marked(begins))
                    parts = line.marked(begins[holds(shorter.value, line.keys(begins, size - 1), bits, True)])
                if tally.add(line.keys(line.starts(size, parts), size)):
                    yield tally.batch()
        yield tally.batch()

    counted = rows.mapInArrow(released(tell), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return staged(counted.filter(F.col("n") >= least).select("key"), f"phrases-{size}")


def candidate_counts(rows: DataFrame, candidates, longest: int, bits: int) -> DataFrame:
    """(lang, phrase, size, n): how often each candidate occurs, and under size 0 all words of a language."""
    out = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])

    def counts(line: Pieces) -> Iterator[pa.RecordBatch]:
        n_words = np.bincount(line.lang[line.text[line.whole]], minlength=len(line.langs))
        yield pa.RecordBatch.from_arrays([line.langs.cast(pa.string()), pa.array([""] * len(n_words), pa.string()), pa.array([0] * len(n_words), pa.int32()), pa.array(n_words)], schema=out)
        parts, base = None, max(1, len(line.distinct))
        name = line.lang[line.text] if len(line.word) else np.zeros(0, np.int64)
        for size in range(1, longest + 1):
            at = line.starts(size, parts)
            at = at[holds(candidates.value, line.keys(at, size), bits, False)]
            if not len(at):
                return
            # distinct phrases get distinct numbers: that of all words but the last, then the last
            _, first, number, n = np.unique(name[at] * base + line.word[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
            name = np.zeros(len(line.word), np.int64)
            name[at] = number
            parts = line.marked(at)
            begin = at[first]
            texts = [line.distinct.take(pa.array(line.word[begin + j])) for j in range(size)]
            phrase = texts[0] if size == 1 else pc.binary_join_element_wise(*texts, " ")
            lang = line.langs.take(pa.array(line.lang[line.text[begin]]))
            yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(np.full(len(n), size, np.int32)), pa.array(n.astype(np.int64))], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", STEP):
                yield from counts(Pieces(part))

    return rows.mapInArrow(released(run), "lang string, phrase string, size int, n long").groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame, support: int, longest: int = 4, shards: int = 4, filter_bits: int = 27,
    lang_column: str = "lang", text_column: str = "text",
) -> DataFrame:
    """(lang, phrase, size, n) of all words and phrases with ``support`` occurrences in their language;
    a row of size 0 has the number of all words."""
    context = docs.sparkSession.sparkContext
    text = F.col(text_column).cast("string")
    rows = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), text.alias("text"),
        F.pmod(F.xxhash64(text, F.length(text), *(F.col(c) for c in docs.columns if c == "doc_id")), F.lit(shards)).cast("long").alias("shard"),
    )
    least, every, shorter = -(-support // shards), None, None
    for size in range(1, longest + 1):
        keys = frequent_in_shards(rows, size, shorter, least, filter_bits)
        every = keys if every is None else every.unionByName(keys)
        if size < longest:
            shorter = context.broadcast(bit_table(keys, filter_bits, True))
    candidates = context.broadcast(bit_table(every, filter_bits, False))
    counted = candidate_counts(rows, candidates, longest, filter_bits)
    return staged(counted.filter((F.col("size") == 0) | (F.col("n") >= support)), "phrase-counts")


def joined_words(phrase: Column, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), begin, length), " ")


def collocations(
    docs: DataFrame, support: int = 30, top: int = 2000, absorbed: int = 80, longest: int = 4, shards: int = 4, filter_bits: int = 27,
    lang_column: str = "lang", text_column: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    The score of a phrase with a occurrences is floor(2000000 * a / (l + r)) at its weakest cut into two
    parts with l and r occurrences, in exact arithmetic. A phrase is left out if a longer one with
    ``absorbed`` per cent of its occurrences holds it. Ties go by a, then by the phrase's bytes.
    """
    counts = frequent_phrases(docs, support, longest, shards, filter_bits, lang_column, text_column)
    phrases = counts.filter("size >= 2").withColumnRenamed("n", "a")
    known = counts.filter("size >= 1")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", joined_words(F.col("phrase"), F.lit(1), F.col("k"))).withColumn(
        "rest", joined_words(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k"))
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) DIV (l + r)")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("_cut"))

    # a phrase that holds another holds it within one that is a word longer, which occurs as often at least
    wider = phrases.filter("size >= 3").select(
        "lang", "a", F.explode(F.array(*(joined_words(F.col("phrase"), F.lit(i), F.col("size") - 1) for i in (1, 2)))).alias("phrase")
    )
    wider = wider.groupBy("lang", "phrase").agg(F.max("a").alias("_wider"))
    left_over = weakest.select("lang", "phrase", "_cut.*").join(wider, ["lang", "phrase"], "left")
    left_over = left_over.filter(F.col("_wider").isNull() | (100 * F.col("_wider") < absorbed * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left_over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    n_words = counts.filter("size = 0").select("lang", "n")
    return best.join(n_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
