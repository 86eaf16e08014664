"""Quality scores: random-indexing word vectors, pooled per document, and a small network.

Words (runs of letters and digits, and runs of signs) fall into a fixed number of hash slots. Every
slot has a sparse random index vector; a slot's word vector is the sum of the index vectors of the
words beside its own, over the whole corpus: each task sums what it reads, and the sums meet by
slot. Vectors are scaled to length one. A document is the mean of its words' vectors, weighted by
how rare each slot is, their spread, the logarithm of its length, and how much it repeats itself. A two-layer network in numpy
is fitted on a bounded sample of labelled documents, and its temperature on a part held back.

Null and empty texts have a zero vector and length and take the network's score of it. Repeated
rows are scored alike; a null id stays null. Without labelled rows of both classes every score is
the share of label 1, or 1/2 without any. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import labelled_sample, released, steps, uniques, words

#: Slots of the word table and length of a vector: together the fixed size of the model.
SLOTS, DIM = 1 << 14, 32
#: Numbers that describe a document: mean, spread, length, and two of repetition.
WIDTH = 2 * DIM + 3
#: Words on each side that count as context, and non-zero entries of an index vector.
REACH, ENTRIES = 2, 2
#: Bounds of the labelled sample.
PER_CLASS, MAX_CHARS = {0: 4000, 1: 4000}, 20_000


def index_vectors(slots: int = SLOTS, dim: int = DIM, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every slot's index vector."""
    chance = np.random.default_rng(seed)
    return chance.integers(0, dim, (ENTRIES, slots)), chance.choice([-1.0, 1.0], (ENTRIES, slots))


def slot_words(texts: pa.Array, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every word, and where each text's words begin and end."""
    parted = pc.replace_substring_regex(pc.fill_null(texts, ""), r"([^\pL\pN\s]+)", r" \1 ")
    flat, bounds = words(parted)
    distinct, place = uniques(flat)
    slot = np.fromiter((zlib.crc32(w.as_buffer()) & (slots - 1) for w in distinct), np.int64, len(distinct))
    return slot[place] if len(flat) else place, bounds


def context_sums(slots: np.ndarray, bounds: np.ndarray, places: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed index vectors of the neighbours of each slot's words, and the words counted."""
    n = places.shape[1]
    total = np.zeros(n * DIM)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for reach in range(1, REACH + 1):
        if len(slots) <= reach:
            break
        near = owner[reach:] == owner[:-reach]
        left, right = slots[:-reach][near], slots[reach:][near]
        for row in range(ENTRIES):
            for here, there in ((left, right), (right, left)):
                total += np.bincount(here * DIM + places[row][there], signs[row][there], n * DIM)
    return total.reshape(n, DIM), np.bincount(slots, minlength=n).astype(float)


def word_vectors(docs: DataFrame, text_column: str = "text", slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors by slot, and each slot's share of all words, from every row of the corpus.

    What comes back has one row for a slot, however large the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(slots)
        total, seen = np.zeros((slots, DIM)), np.zeros(slots)
        for batch in batches:
            for part in steps(batch, "text"):
                more, n = context_sums(*slot_words(part.column("text"), slots), places, signs)
                total += more
                seen += n
        used = np.flatnonzero(seen)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[used].ravel()), DIM).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used]), sums], ["slot", "n", "v"])

    rows = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(released(run), "slot long, n double, v array<double>")
    summed = rows.groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(DIM)))
    vectors, share = np.zeros((slots, DIM)), np.zeros(slots)
    for r in summed.collect():  # at most one row for a slot
        vectors[r[0]], share[r[0]] = r[2:], r[1]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(length, 1e-9), share / max(1.0, share.sum())


@dataclass
class Network:
    """Everything a task needs to score a text."""

    vectors: np.ndarray
    weight: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None = None
    centre: np.ndarray | float = 0.0
    scale: np.ndarray | float = 1.0
    temperature: float = 1.0
    prior: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return _sigmoid(_logits((x - self.centre) / self.scale, self.layers) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logits(x: np.ndarray, layers: tuple) -> np.ndarray:
    a, b, c, d = layers
    return np.tanh(x @ a + b) @ c + d


def _shape(own: np.ndarray) -> list[float]:
    """Length, and how much a text repeats: words like the one before, words seen already."""
    again = float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0
    return [np.log1p(len(own)), again, np.log(len(set(own.tolist())) / len(own))]


def pooled(texts: pa.Array, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of word vectors, and log length, for each text."""
    slots, bounds = slot_words(texts, len(vectors))
    x = np.zeros((len(texts), WIDTH))
    both = np.concatenate([vectors, vectors**2, np.ones((len(vectors), 1))], 1).astype(np.float32) * weight[:, None].astype(np.float32)
    for i in range(len(texts)):
        own = slots[bounds[i] : bounds[i + 1]]
        if len(own):
            total = both[own].sum(0, dtype=np.float64)
            mean = total[:DIM] / total[-1]
            x[i] = np.concatenate([mean, np.sqrt(np.maximum(0, total[DIM:-1] / total[-1] - mean**2)), _shape(own)])
    return x


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 16, rounds: int = 400, seed: int = 11) -> dict:
    """Full-batch Adam on four fifths of the rows; the temperature minimises the rest's log loss."""
    if len(y) == 0 or y.min() == y.max():
        return {"prior": float(y.mean()) if len(y) else 0.5}
    chance = np.random.default_rng(seed)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - centre) / scale
    back = np.arange(len(y)) % 5 == 4
    back &= len(y) >= 50
    zt, yt = z[~back], y[~back]
    p = [chance.normal(0, 0.3 / np.sqrt(z.shape[1]) * 3, (z.shape[1], hidden)), np.zeros(hidden), chance.normal(0, 0.3, hidden), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, rounds + 1):
        h = np.tanh(zt @ p[0] + p[1])
        gap = (_sigmoid(h @ p[2] + p[3][0]) - yt) / len(yt)
        inner = np.outer(gap, p[2]) * (1 - h * h)
        g = [zt.T @ inner + 1e-3 * p[0], inner.sum(0), h.T @ gap + 1e-3 * p[2], np.array([gap.sum()])]
        for k in range(4):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    layers = (p[0], p[1], p[2], float(p[3][0]))
    zb, yb = (z[back], y[back]) if back.any() else (z, y)
    logits = _logits(zb, layers)
    tries = np.geomspace(0.25, 8, 41)
    loss = [np.mean(np.logaddexp(0, logits / t) - yb * logits / t) for t in tries]
    return {"layers": layers, "centre": centre, "scale": scale, "temperature": float(tries[int(np.argmin(loss))]), "prior": float(y.mean())}


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS, max_chars: int = MAX_CHARS) -> Network:
    """Word vectors from all of ``docs``; the network from at most ``per_class[label]`` labelled
    texts of a label, none longer than ``max_chars``."""
    vectors, share = word_vectors(docs)
    weight = 1e-3 / (1e-3 + share)
    rows = labelled_sample(docs, labels, "quality", per_class, max_chars).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").collect()
    y = np.array([r["label"] for r in rows], float)
    x = np.concatenate([pooled(pa.array([r["text"] for r in rows[i : i + 500]], pa.string()), vectors, weight) for i in range(0, len(rows), 500)]) if rows else np.zeros((0, WIDTH))
    return Network(vectors, weight, **fit_network(x, y))


def quality(docs: DataFrame, model: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots * DIM numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for part in steps(batch, "text"):
                score = network.score(pooled(part.column("text"), network.vectors, network.weight))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, score double")
