"""Harmonic packing of token sequences.

Pieces fall into reciprocal-capacity classes: a bin of class k takes exactly k pieces of at most
capacity // k tokens. Every task fills its own bins, class by class, so nothing is shuffled. A
document whose length would leave much of its slot empty is cut at the next smaller slot, and the
rest is classed again. When a task ends, the pieces in bins that are not full are laid end to end
into full sequences, and the last rest into sequences whose lengths are powers of two, which need
no padding.

A null or empty text has the end mark alone. Rows are packed one by one, so repeated rows and ties
of id are each packed in full; a null id stays null. A text of any length is cut into pieces; one beyond
the size of a step is a step of its own. An empty table gives an empty result. Only the
two named columns are read, whatever else the table holds.
"""

from __future__ import annotations

import functools
import os
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import give_back, released, steps, uniques, words

SCHEMA = "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long"

#: Words whose ids a worker remembers, none of more than LONGEST characters, bytes of text that it takes at a
#: time, and words that the tokenizer takes at a time.
REMEMBERED, LONGEST, STEP, ASKED = 300_000, 64, 1 << 20, 2000


@functools.cache
def joined() -> str:
    """A pattern of what words cannot be parted beside without a look at the tokenizer's own rules:
    apostrophes, marks, the text form of special tokens; signs and letters that become, or get, a mark
    when they are composed and put in lower case, as the tokenizer does first; and characters too new
    for the tables at hand to tell letters from signs."""
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    known = pc.match_substring_regex(pa.array([chr(c) for c in points]), r"[\pL\pN]").to_pylist()

    def odd(c: int, letter: bool) -> bool:
        kind = unicodedata.category(chr(c))
        if kind == "Cn" or letter != (kind[0] in "LN"):
            return True
        return kind[0] != "M" and any(unicodedata.category(x)[0] == "M" for x in unicodedata.normalize("NFC", chr(c)).lower())

    ranges: list[list[int]] = []
    for c, letter in zip(points, known, strict=True):
        if odd(c, letter):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return f"['\\pM{''.join(f'\\x{{{a:X}}}-\\x{{{b:X}}}' for a, b in ranges)}]|<\\|"


class WordEncoder:
    """Ids of whole texts by a tokenizer that parts words at white space and runs of signs.

    Each distinct word of a step is encoded once, unless it was met in the last steps: a worker holds
    the words met lately, and those met before them until they are as many. Texts with marks or
    apostrophes are parted at white space alone, and those that could hold the text form of a special
    token go through the tokenizer whole.
    """

    def __init__(self, path: str, together: str) -> None:
        self.together = together
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Plain lower-case words need the tokenizer's merges only; all else takes its whole way."""
        plain = [x.isascii() and x.isalpha() and x.islower() for x in texts]
        rest = iter(self.tokenizer.encode_batch_fast([x for x, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        merge = self.tokenizer.model.tokenize
        found = ([t.id for t in merge(x)] if p else next(rest).ids for x, p in zip(texts, plain, strict=True))
        return [struct.pack(f"<{len(x)}I", *x) for x in found]

    def _words(self, distinct: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit numbers."""
        ids = [self.known.get(w) for w in distinct]
        for i, x in enumerate(ids):
            if x is None:
                ids[i] = self.before.get(distinct[i])
                if ids[i] is not None:
                    self._keep(distinct[i], ids[i])
        missing = [i for i, x in enumerate(ids) if x is None]
        for begin in range(0, len(missing), ASKED):
            some = missing[begin : begin + ASKED]
            for i, x in zip(some, self._ids([distinct[i] for i in some]), strict=True):
                ids[i] = x
                self._keep(distinct[i], x)
        return ids

    def _keep(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        if len(self.known) >= REMEMBERED // 2:
            self.known, self.before = {}, self.known
        self.known[word] = ids

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        parted = pc.replace_substring_regex(texts, r"([^\pL\pN\s]+)", r" \1 ")
        # lower case first, or marks first: what is composed differs, so texts with marks stay as they are
        flat, bounds = words(pc.if_else(pc.match_substring_regex(texts, self.together), texts, pc.ascii_lower(parted)), lower=False)
        del parted
        distinct, place = uniques(flat)
        del flat
        ids = self._words(distinct.to_pylist())
        pool = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        del distinct, ids
        first = np.cumsum(lengths) - lengths
        each = lengths[place]
        ends = np.concatenate([[0], np.cumsum(each)])
        for i in range(len(texts)):
            if special[i]:
                yield np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
            else:
                here, size = slice(bounds[i], bounds[i + 1]), each[bounds[i] : bounds[i + 1]]
                at = np.repeat(first[place[here]] - (ends[here] - ends[bounds[i]]), size)
                yield pool[at + np.arange(len(at))]


def tail_classes(capacity: int, tail: int) -> list[int]:
    """Class numbers for pieces of up to ``tail`` tokens, about four to a doubling."""
    found, k = [], max(1, capacity // tail)
    while k < capacity:
        found.append(k)
        k = max(k + 1, k * 5 // 4)
    return [*found, capacity]


def cut(length: int, capacity: int, slack: float, tail: int, small: list[int]) -> list[tuple[int, int]]:
    """(class, tokens) of the pieces of a document of ``length`` tokens, from its start."""
    pieces = [(1, capacity)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if rest <= tail:
            pieces.append((max(x for x in small if x <= k), rest))
            break
        if capacity - k * rest <= slack * capacity:
            pieces.append((k, rest))
            break
        pieces.append((k + 1, capacity // (k + 1)))
        rest -= capacity // (k + 1)
    return pieces


class Bins:
    """Open bins of one task: at most one for each class, so memory is bounded."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next = capacity, first_id
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, k: int, piece: tuple) -> None:
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.close(self.open.pop(k))

    def close(self, held: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in held:
            self.rows.append((doc_id, start, len(ids), ids.tobytes(), doc_tokens, self.next, offset))
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        left = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        for size in sizes:
            held = []
            while size:
                doc_id, start, ids, doc_tokens = left.pop(0)
                held.append((doc_id, start, ids[:size], doc_tokens))
                if len(ids) > size:
                    left.insert(0, (doc_id, start + size, ids[size:], doc_tokens))
                size -= len(held[-1][2])
            self.close(held)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str, together: str) -> WordEncoder:
    """One encoder for each worker process, so that its memory of words outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path, together)
    return _ENCODERS[path]


def harmonic_packing(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, slack: float = 0.02, tail: int = 64,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Pieces with their token ids (little-endian unsigned 32-bit) and their place in a sequence.

    ``slack`` is the share of a bin that may stay empty before a document is cut instead; pieces of
    up to ``tail`` tokens are never cut for it. ``tokenizer`` is the path of a tokenizers file.
    """
    out = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()),
         ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    together = joined()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, small = encoder_of(tokenizer, together), tail_classes(capacity, tail)
        bins = Bins(capacity, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for part in steps(batch, "text", STEP):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text")), strict=True):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    start = 0
                    for k, size in cut(len(ids), capacity, slack, tail, small):
                        bins.add(k, (doc_id, start, ids[start : start + size].copy(), len(ids)))
                        start += size
                if bins.rows:
                    yield bins.batch(out)
            batch = part = ids = None
            give_back()
        bins.finish()
        if bins.rows:
            yield bins.batch(out)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(pack), SCHEMA)
