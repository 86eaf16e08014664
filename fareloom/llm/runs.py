"""Periodic runs of words, found with a run-length grammar made by recompression.

The words of many documents stand one after the other, with a symbol of its own before, between and
behind them. Recompression shortens that sequence level by level: a block round makes each stretch of
one repeated symbol into one symbol, a pair round puts every symbol on the left or right side and makes
each left symbol followed by a right one into one symbol. Equal stretches of a level become equal
symbols but for a few at their ends, so how far two places agree (``Grammar.extend``) is found by
climbing while both stand at the edge of a symbol of the next level, and going down again behind the
last symbols that agree: a few steps a level, and a block of any length is one step.

A run of period q that is at least 2 * q long holds two places i and i + q with i a multiple of q. All
such pairs with equal words are the candidates, (n / 1 + n / 2 + n / 3 ...) in number; extending a pair
to both sides gives the exact run. Periods are tried from the smallest, so the first time that a stretch
is found is under its smallest period. All pairs of all documents of a step go through numpy at once.

Words are what stands between ASCII white space, taken as they are. Null and empty texts have no words
and no runs; equal rows give equal results; a null id stays null. A text of any length is read whole: a
step holds texts of some megabytes together, a longer text is a step of its own, and memory is in
proportion to a step's words. An empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import released, steps, uniques, words

#: Bytes of text that go through one grammar.
STEP = 3 << 20

#: Candidates that are extended together.
TOGETHER = 1 << 19

SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def named(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers from 0."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int32)


class Level:
    """A sequence of symbols and how the next level groups them.

    ``group`` is the place in the next level of each symbol here, ``first`` where each group begins (and
    the length, at its end). With ``blocks`` each group is a stretch of one symbol, else a symbol or two.
    """

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool) -> None:
        self.symbols, self.blocks = symbols, blocks
        sizes = np.diff(first)
        self.first = first
        self.group = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def mirrored(self) -> Level:
        return Level(self.symbols[::-1], (len(self.symbols) - self.first[::-1]).astype(np.int32), self.blocks)


class Grammar:
    """The levels of one sequence, whose first and last symbols occur nowhere else in it."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.levels: list[Level] = []
        symbols, salt = symbols.astype(np.int32), 0
        while len(symbols) > 3:
            cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
            if len(cuts) + 1 < len(symbols):
                first = np.concatenate([[0], cuts, [len(symbols)]]).astype(np.int32)
                self.levels.append(Level(symbols, first, True))
                sizes = np.diff(first).astype(np.int64)
                symbols = named(symbols[first[:-1]].astype(np.int64) * (1 + int(sizes.max())) + sizes)
            left = self._sides(symbols, salt)
            starts = left[:-1] & ~left[1:]
            salt += 1
            if not starts.any():
                continue
            single = np.ones(len(symbols), bool)
            single[1:] = ~starts
            first = np.concatenate([np.flatnonzero(single), [len(symbols)]]).astype(np.int32)
            self.levels.append(Level(symbols, first, False))
            at = first[:-1]
            wide = symbols.astype(np.int64) + 1
            after = np.where(np.diff(first) == 2, wide[np.minimum(at + 1, len(symbols) - 1)], 0)
            symbols = named(wide[at] * (int(wide.max()) + 1) + after)
        self.top = symbols

    @staticmethod
    def _sides(symbols: np.ndarray, salt: int) -> np.ndarray:
        """Left or right for each symbol, by a hash of it: the way round that makes more pairs."""
        x = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 2 + 1) * 0xD1B54A32D192ED03 % 2**64)
        left = ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
        return left if np.count_nonzero(left[:-1] & ~left[1:]) >= np.count_nonzero(~left[:-1] & left[1:]) else ~left

    def mirrored(self) -> Grammar:
        other = object.__new__(Grammar)
        other.levels, other.top = [x.mirrored() for x in self.levels], self.top[::-1]
        return other

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from the places ``a`` and from the places ``b`` on agree; no two are equal."""
        came, a, b = a, a.astype(np.int32), b.astype(np.int32)
        who, waiting = np.arange(len(a)), []
        for level in self.levels:
            stays, climbs = [], []
            while len(who):
                stay, who = self._part(level.symbols, a, b, who)
                over_a, over_b = level.group[a[who]], level.group[b[who]]
                edge = (level.first[over_a] == a[who]) & (level.first[over_b] == b[who])
                up = who[edge]
                a[up], b[up] = over_a[edge], over_b[edge]
                who = who[~edge]
                self._pass(level, a, b, who)
                stays.append(stay)
                climbs.append(up)
            waiting.append(np.concatenate([who, *stays]))
            who = np.concatenate([who, *climbs])
        done = []
        while len(who):
            stay, who = self._part(self.top, a, b, who)
            a[who] += 1
            b[who] += 1
            done.append(stay)
        down = np.concatenate([who, *done])
        for level, stays in zip(reversed(self.levels), reversed(waiting), strict=True):
            who, done = down, [stays]
            a[who], b[who] = level.first[a[who]], level.first[b[who]]
            while len(who):
                stay, who = self._part(level.symbols, a, b, who)
                self._pass(level, a, b, who)
                done.append(stay)
            down = np.concatenate(done)
        return a - came

    @staticmethod
    def _part(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those that stand before unequal symbols, and those before equal ones."""
        same = symbols[a[who]] == symbols[b[who]]
        return who[~same], who[same]

    @staticmethod
    def _pass(level: Level, a: np.ndarray, b: np.ndarray, who: np.ndarray) -> None:
        """Move on by what agrees: what is left of the shorter block, or one symbol."""
        step = 1
        if level.blocks:
            step = np.minimum(level.first[level.group[a[who]] + 1] - a[who], level.first[level.group[b[who]] + 1] - b[who])
        a[who] += step
        b[who] += step


def pairs(symbols: np.ndarray, reach: Callable[[np.ndarray], np.ndarray], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, q): i a multiple of q, equal symbols at i and i + q, q ascending, in parts of bounded size.

    ``reach(q)`` is where the texts that can have a run of period q end; ``longest`` the largest period.
    """
    low = 1
    while low <= longest:
        some = np.arange(low, min(longest, low + TOGETHER) + 1, dtype=np.int64)
        counts = np.maximum(0, (reach(some) - 1) // some)
        fit = max(1, int(np.searchsorted(np.cumsum(counts), 8 * TOGETHER, "right")))
        some, counts = some[:fit], counts[:fit]
        low += fit
        q = np.repeat(some, counts)
        i = (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * q
        equal = np.flatnonzero(symbols[i] == symbols[i + q])
        for begin in range(0, len(equal), TOGETHER):
            here = equal[begin : begin + TOGETHER]
            yield i[here], q[here]


def smallest_periods(found: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct (start, length), each with its smallest period."""
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return [start[fresh], length[fresh], period[fresh]]


def runs_of(symbols: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run in texts of ``counts`` symbols that follow each other."""
    none = np.zeros(0, np.int64)
    order = np.argsort(-counts, kind="stable")  # what can hold a long period stands in front
    sizes = counts[order]
    sizes = sizes[sizes >= least]
    if not len(sizes):
        return none, none, none, none
    order = order[: len(sizes)]
    begins = np.cumsum(sizes + 1) - sizes  # behind a symbol of its own each
    into = np.repeat(begins, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whence = np.repeat((np.cumsum(counts) - counts)[order], sizes) + into - np.repeat(begins, sizes)
    base = int(symbols.max()) + 1
    line = np.full(int(sizes.sum()) + len(sizes) + 1, -1, np.int64)
    line[into] = symbols[whence]
    marks = np.flatnonzero(line < 0)
    line[marks] = base + np.arange(len(marks))
    ends = begins + sizes

    def reach(q: np.ndarray) -> np.ndarray:
        enough = np.searchsorted(-sizes, -np.maximum(least, 2 * q), "right")
        return np.where(enough > 0, ends[np.maximum(enough, 1) - 1], 0)

    ahead = Grammar(line)
    back, n = ahead.mirrored(), len(line)
    line, found = line.astype(np.int32), [(none, none, none)]
    for i, q in pairs(line, reach, int(sizes[0]) // 2):
        after = ahead.extend(i, i + q)
        before = np.zeros(len(i), np.int64)
        inside = np.flatnonzero(i > 0)
        before[inside] = back.extend(n - i[inside], n - i[inside] - q[inside])
        length = before + after + q
        kept = np.flatnonzero(length >= np.maximum(least, 2 * q))
        if len(kept):
            found.append(tuple(smallest_periods([(i[kept] - before[kept], length[kept], q[kept])])))
        if len(found) > 64:
            found = [tuple(smallest_periods(found))]
    start, length, period = smallest_periods(found)
    text = np.searchsorted(begins, start, "right") - 1
    return order[text], start - begins[text], length, period


def as_they_are(ids: list, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return counts, np.ones(len(counts), np.int64)


def word_runs(
    docs: DataFrame, least: int = 12, tails: Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]] = as_they_are,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every row's maximal runs of at least ``least`` words and two periods, and its text without repeats.

    ``tails`` gives, for ids and word counts, from which word on each text repeats itself and after how
    many words (from the end on: never); the repeated text is what is searched. The columns: ``runs`` (by
    start, then period) and how many; the longest run (then the first, then of the smallest period; nulls
    if none) and its exponent in thousandths; SHA-256 of the runs as lines ``start,length,period``, and of
    the words, joined by blanks, that stand in no run behind its first period.
    """
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()),
         ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
         *((x, pa.int64()) for x in ("n_runs", "start", "length", "period", "exponent_milli")),
         ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    )

    def search(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = words(part.column("text"), lower=False)
        distinct, symbols = uniques(flat)
        ids, counts, begins = part.column("doc_id").to_pylist(), np.diff(bounds), bounds[:-1]
        since, every = tails(ids, counts)
        at = np.arange(len(symbols)) - np.repeat(begins, counts)
        a, p = np.repeat(since, counts), np.repeat(every, counts)
        symbols = symbols[np.repeat(begins, counts) + np.where(at >= a, a + (at - a) % p, at)]

        text, start, length, period = runs_of(symbols, counts, least)
        order = np.lexsort((period, start, text))
        text, start, length, period = text[order], start[order], length[order], period[order]
        of_text = np.searchsorted(text, np.arange(len(ids) + 1))

        change = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(change, begins[text] + start + period, 1)
        np.add.at(change, begins[text] + start + length, -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        cuts = np.searchsorted(kept, bounds).astype(np.int32)
        values = distinct.take(pa.array(symbols[kept])) if len(kept) else pa.array([], pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), values.cast(pa.string())), " ")
        collapsed = [hashlib.sha256(x).hexdigest() for x in joined.cast(pa.binary()).to_pylist()]

        rank = np.lexsort((period, start, -length, text))
        best = np.full(len(ids), -1)
        held = np.flatnonzero(np.diff(of_text))
        best[held] = rank[of_text[held]]
        lines = [f"{s},{m},{q}\n" for s, m, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)]
        digests = [hashlib.sha256("".join(lines[i:j]).encode()).hexdigest() for i, j in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True)]
        none = best < 0

        def longest(x: np.ndarray) -> pa.Array:
            return pa.array(np.concatenate([x, [0]])[best], pa.int64(), mask=none)

        each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
        listed = pa.ListArray.from_arrays(pa.array(of_text.astype(np.int32)), each)
        columns = [
            part.column("doc_id"), pa.array(counts, pa.int64()), listed, pa.array(np.diff(of_text), pa.int64()), longest(start), longest(length),
            longest(period), longest(1000 * length // np.maximum(period, 1)), pa.array(digests, pa.string()), pa.array(collapsed, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", STEP):
                yield search(part)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(run), SCHEMA)
