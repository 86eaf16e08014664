"""Token counts of fields and sections, by offsets in the whole encoded document.

A document's fields are joined by line breaks and encoded once; every token's character span then
meets the spans of the sections. Encoding the sections one by one would count differently where a
token reaches over a boundary. Such a token is given to one section by ``rule``: ``first`` (the
section with its first byte), ``last`` (with its last byte) or ``most`` (with most of its bytes; the
earlier at a tie). A separating line break belongs to the section it ends.

A null or empty field has no section; a document without any text has no rows. Repeated rows give
repeated results. A text may be of any length, long runs of white space included; one beyond the size of
a step is a step of its own. Empty tables give empty results, and only the named columns are read. Offsets are
bytes of UTF-8, from the start of the field.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import released, steps

RULES = ("first", "last", "most")
SCHEMA = "doc_id long, field string, section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def load_encoder(path: str, pattern: str):
    """A byte-level encoder of a ranks file, with the byte length of every id."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


#: White space as the pattern understands it (fixed values: the Unicode property), in runs that would
#: exhaust the pattern's stack.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def encode_whole(encoder, text: str) -> np.ndarray:
    """Ids of a text of any length.

    The pattern takes a run of white space whole but for its last character, which begins the next
    piece, or quite whole at the end of the text. Long runs are cut out that way beforehand.
    """
    ids, at = [], 0
    for run in LONG_BLANKS.finditer(text):
        begin, end = run.start(), run.end() - (run.end() < len(text))
        ids.append(encoder.encode_to_numpy(text[at:begin], disallowed_special=()))
        ids.append(np.array(encoder._encode_single_piece(text[begin:end]), np.uint32))
        at = end
    rest = encoder.encode_to_numpy(text[at:] if at else text, disallowed_special=())
    return np.concatenate([*ids, rest]) if ids else rest


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For each token span its section and whether it crosses; section i is bounds[i] to bounds[i + 1]."""
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    chosen = first.copy()
    for i in np.flatnonzero(crossing):
        spans = np.arange(first[i], last[i] + 1)
        share = np.minimum(ends[i], bounds[spans + 1]) - np.maximum(starts[i], bounds[spans])
        chosen[i] = spans[np.argmax(share)]
    return chosen, crossing


def sections(data: bytes, separator: bytes) -> np.ndarray:
    """Where sections begin, and the end; a section ends with its separator."""
    marks = np.flatnonzero(np.frombuffer(data, np.uint8) == separator[0]) + 1
    return np.unique(np.concatenate([[0], marks, [len(data)]]))


def token_counts(
    docs: DataFrame, ranks: str, pattern: str, fields: Sequence[str] = ("text",), rule: str = "first", id_column: str = "doc_id"
) -> DataFrame:
    """One row for each section (line) of each field: its byte span, its tokens, and those of them
    that cross a boundary."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}, not {rule}")
    names = list(fields)
    cells = [f"f{i}" for i in range(len(names))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = load_encoder(ranks, pattern)
        for part in (p for batch in batches for p in steps(batch, cells)):
            columns = [part.column(c) for c in cells]
            ids, found = part.column("doc_id").to_pylist(), []
            for row, doc_id in enumerate(ids):
                texts = [(n, c[row].as_py()) for n, c in zip(names, columns, strict=True)]
                texts = [(n, t) for n, t in texts if t]
                if not texts:
                    continue
                whole = "\n".join(t for _, t in texts)
                ends = np.cumsum(lengths[encode_whole(encoder, whole)])
                starts = np.concatenate([[0], ends[:-1]])
                bounds, owner, base, at = [], [], [], 0
                for k, (name, text) in enumerate(texts):
                    data = (text + ("\n" if k + 1 < len(texts) else "")).encode()
                    cuts = sections(data, b"\n")
                    bounds.append(cuts[:-1] + at)
                    owner += [name] * (len(cuts) - 1)
                    base += [at] * (len(cuts) - 1)
                    at += len(data)
                bounds = np.concatenate([*bounds, [at]])
                chosen, crossing = attribute(starts, ends, bounds, rule)
                n = len(bounds) - 1
                number = np.arange(n) - np.searchsorted(np.array(base), base)
                found.append((
                    [doc_id] * n, owner, number, bounds[:-1] - base, bounds[1:] - base,
                    np.bincount(chosen, minlength=n), np.bincount(chosen[crossing], minlength=n), [len(ends)] * n,
                ))
                if len(found) == 500:
                    yield _batch(found)
                    found = []
            if found:
                yield _batch(found)

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), *(F.col(n).cast("string").alias(c) for n, c in zip(names, cells, strict=True))
    )
    return rows.mapInArrow(released(count), SCHEMA)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("field", pa.string()), ("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
     ("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("doc_tokens", pa.int64())]
)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = [[x for part in column for x in part] if isinstance(column[0], list) else np.concatenate(column) for column in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
