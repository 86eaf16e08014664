"""Toxic spans by a linear-chain conditional random field over words.

Training words get tags from document labels: in a toxic document, a word is tagged if it or its
first letters occur in several toxic documents and in hardly any other. Near copies among the
training documents are left out first, so that a copied document's own words earn no tag. The field
has one weight for each such word or prefix, a bias, and four transitions; it is fitted by gradient
descent on the exact likelihood. Forward-backward marginals then give every word's probability of
being toxic, runs of likely words give the offending offsets, and a small logistic model turns the
largest marginal and the expected number of toxic words into a document score.

Null and empty texts have no words and take the score of a document without toxic words. Repeated
rows are scored alike; a null id stays null. With no labelled rows of either class the score is 0
everywhere. Offsets count characters of the original text. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import give_back, labelled_sample, released, steps, uniques, words

#: Bounds of the labelled sample.
PER_CLASS, MAX_CHARS = {0: 5000, 1: 2500}, 6_000
#: Words of the sample whose marginals are held at a time while fitting.
BLOCK_WORDS = 200_000
#: Lengths of the prefixes that count as features beside the word itself.
PREFIXES = (4, 5)
#: Signs that are cut from both ends of a word before it is looked up.
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_"

SCHEMA = "doc_id long, score double, n_toxic_words double, spans array<struct<start:int,end:int>>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass
class Field:
    """The fitted model: weights by word and prefix, transitions, and the document model."""

    weights: list[dict[str, float]] = field(default_factory=lambda: [{} for _ in range(1 + len(PREFIXES))])
    bias: float = -8.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: tuple[float, float, float] = (-30.0, 0.0, 0.0)


def _keys(distinct: pa.Array) -> list[pa.Array]:
    """The word and its prefixes, without signs at the edges."""
    bare = pc.utf8_trim(distinct, EDGES)
    return [bare, *(pc.utf8_slice_codeunits(bare, 0, n) for n in PREFIXES)]


def emissions(distinct: pa.Array, model: Field) -> np.ndarray:
    """Log-odds of the toxic tag for each distinct word, from its features alone."""
    total = np.full(len(distinct), model.bias)
    for keys, weights in zip(_keys(distinct), model.weights, strict=True):
        if weights:
            at = pc.fill_null(pc.index_in(keys, pa.array(list(weights), pa.string())), -1).to_numpy(zero_copy_only=False)
            total += np.append(np.fromiter(weights.values(), float), 0.0)[at]
    return total


def marginals(scores: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's toxic probability, and of each adjacent pair the probability that both are.

    Texts are walked side by side, longest first: step t handles the t-th word of all texts that
    have one. Ratios of the two states' masses stand for the masses themselves.
    """
    starts, ends = bounds[:-1], bounds[1:]
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    lengths = ends - starts
    e, (stay, on), (off, keep) = np.exp(np.clip(scores, -30, 30)), np.exp(moves[0]), np.exp(moves[1])
    forward, backward = np.empty(len(e)), np.empty(len(e))
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")
    r = None
    for t in range(longest):
        at = starts[: active[t]] + t
        r = e[at] if t == 0 else e[at] * (on + keep * r[: active[t]]) / (stay + off * r[: active[t]])
        forward[at] = r
    b = np.ones(len(lengths))
    for t in range(longest):
        n = active[t]
        at = ends[:n] - 1 - t
        if t:
            x = e[at + 1] * b[:n]
            b = (off + keep * x) / (stay + on * x)
        else:
            b = b[:n]
        backward[at] = b
    odds = forward * backward
    alone = odds / (1 + odds)
    both = np.zeros(len(e))
    if len(e) > 1:
        x, y = forward[:-1], e[1:] * backward[1:]
        both[1:] = keep * x * y / (stay + on * y + off * x + keep * x * y)
        both[starts[lengths > 0]] = 0.0
    return alone, both


def _distinct_texts(rows: list[tuple[str, int]], coordinates: int = 4) -> list[int]:
    """Rows left when texts that share a min-hash coordinate of their word triples count once."""
    seen: set[tuple[int, int]] = set()
    left = []
    for i, (text, _) in enumerate(rows):
        flat, _ = words(pa.array([text]))
        distinct, place = uniques(flat)
        hashed = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in distinct), np.uint64, len(distinct))[place]
        triple = hashed[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[2:]
        if len(triple):
            mixed = [(triple ^ (triple >> np.uint64(29))) * np.uint64(2 * k + 0xBF58476D1CE4E5B9) for k in range(coordinates)]
            keys = {(k, int((m ^ (m >> np.uint64(32))).min())) for k, m in enumerate(mixed)}
            if keys & seen:
                continue
            seen |= keys
        left.append(i)
    return left


def _marks(texts: list[list[list[str]]], labels: np.ndarray, least_share: float = 0.9) -> list[set[str]]:
    """For each kind of feature, those whose documents are toxic far beyond chance.

    A feature in n documents, a of them toxic, passes if a / n is at least ``least_share`` and the
    bound exp(-n KL(a / n, base share)) on such a chance, times the number of features, is under 1/20.
    """
    sizes = np.array([len(keys[0]) for keys in texts], float)
    base = float(np.clip((sizes * labels).sum() / max(1.0, sizes.sum()), 1e-3, 1 - 1e-3))
    found = []
    for kind in range(1 + len(PREFIXES)):
        toxic, every = Counter(), Counter()
        for keys, label in zip(texts, labels, strict=True):
            own = set(keys[kind])
            every.update(own)
            if label:
                toxic.update(own)
        shortest = 2 if kind == 0 else PREFIXES[kind - 1]
        marked = set()
        for key, a in toxic.items():
            n = every[key]
            share = (a - 0.01) / n
            if len(key) < shortest or share < least_share:
                continue
            far = n * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
            if share > base and far > np.log(20.0 * len(every)):
                marked.add(key)
        found.append(marked)
    return found


def _blocks(bounds: np.ndarray) -> list[tuple[int, int]]:
    """Cut the texts into runs of about ``BLOCK_WORDS`` words."""
    cuts = [0, *(np.flatnonzero(np.diff(bounds[:-1] // BLOCK_WORDS)) + 1).tolist(), len(bounds) - 1]
    return list(zip(cuts, cuts[1:], strict=False))


def fit(rows: list[tuple[str, int]], rounds: int = 40, rate: float = 0.4, ridge: float = 0.02) -> Field:
    """Fit the field and the document model on (text, label) rows held in memory.

    Each round sums the exact gradient over blocks of texts of like length, so that the marginals
    of one block are held at a time and a block is walked in few steps.
    """
    rows = sorted((rows[i] for i in _distinct_texts(rows)), key=lambda r: len(r[0]))
    labels = np.array([x for _, x in rows], float)
    if not len(rows) or labels.min() == labels.max():
        return Field()
    flat, bounds = words(pa.array([t for t, _ in rows]))
    distinct, place = uniques(flat)
    place = place.astype(np.int32)
    del flat, rows
    keys = [k.to_pylist() for k in _keys(distinct)]
    texts = [[[k[j] for j in np.unique(place[a:b])] for k in keys] for a, b in zip(bounds, bounds[1:], strict=False)]
    marked = _marks(texts, labels)
    del texts
    # a feature's number for each distinct word and kind; 0 stands for none
    names = [(kind, k) for kind in range(len(marked)) for k in sorted(marked[kind])]
    number = {name: i + 1 for i, name in enumerate(names)}
    features = np.array([[number.get((kind, k), 0) for k in keys[kind]] for kind in range(len(keys))])
    del keys
    tags = (features.max(0) > 0)[place] & np.repeat(labels == 1, np.diff(bounds))
    follows = np.ones(len(place), bool)
    follows[bounds[:-1][np.diff(bounds) > 0]] = False
    before = np.concatenate([[False], tags[:-1]])
    seen_both, seen_on = (tags & before & follows).sum(), (tags & ~before & follows).sum()
    seen_off, n_pairs = (~tags & before & follows).sum(), follows.sum()
    seen = np.bincount(place[tags], minlength=len(distinct))
    blocks = _blocks(bounds)
    weights, bias, moves = np.zeros(len(names) + 1), -4.0, np.zeros((2, 2))
    state = [np.zeros(len(weights) + 5), np.zeros(len(weights) + 5)]
    for step in range(1, rounds + 1):
        score = weights[features].sum(0) + bias
        gap, on, off, both = -seen.astype(float), 0.0, 0.0, 0.0
        for a, b in blocks:
            here = slice(bounds[a], bounds[b])
            p, pair = marginals(score[place[here]], bounds[a : b + 1] - bounds[a], moves)
            gap += np.bincount(place[here], p, minlength=len(distinct))
            last = np.concatenate([[0.0], p])[: len(p)] * follows[here]
            on, off, both = on + (p * follows[here] - pair).sum(), off + (last - pair).sum(), both + pair.sum()
        slope = np.zeros(len(weights))
        for kind in range(len(features)):
            slope += np.bincount(features[kind], gap, minlength=len(weights))
        slope[0] = 0
        pairs = np.array([n_pairs - on - off - both, on, off, both])
        pairs -= [n_pairs - seen_on - seen_off - seen_both, seen_on, seen_off, seen_both]
        g = np.concatenate([slope + ridge * weights, [gap.sum() + ridge * bias], pairs + ridge * moves.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.99 * state[1] + 0.01 * g * g
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights -= move[: len(weights)]
        weights[0] = 0
        bias -= move[len(weights)]
        moves = moves - move[len(weights) + 1 :].reshape(2, 2)
    model = Field(bias=float(bias), moves=moves)
    for (kind, k), w in zip(names, weights[1:], strict=True):
        model.weights[kind][k] = float(w)
    score, parts = emissions(distinct, model), []
    for a, b in blocks:
        own = bounds[a : b + 1] - bounds[a]
        p, _ = marginals(score[place[bounds[a] : bounds[b]]], own, moves)
        parts.append(document_features(p, own))
    model.document = _document_model(*(np.concatenate(x) for x in zip(*parts, strict=True)), labels)
    return model


def document_features(p: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest marginal of each text, and its expected number of toxic words (log scale)."""
    n = len(bounds) - 1
    most, total = np.zeros(n), np.zeros(n)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        most[full] = np.maximum.reduceat(p, bounds[full])
        total[full] = np.add.reduceat(np.where(p > 0.1, p, 0.0), bounds[full])
    return most, np.log1p(total)


def _document_model(most: np.ndarray, total: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic weights by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(most)), most, total])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w -= np.linalg.solve(curve, x.T @ (p - labels) + 0.05 * w)
    return tuple(float(v) for v in w)


def score_texts(texts: pa.Array, model: Field) -> tuple[np.ndarray, np.ndarray, list[list[dict[str, int]]]]:
    """Scores, expected numbers of toxic words, and the spans of likely ones."""
    flat, bounds = words(texts)
    distinct, place = uniques(flat)
    p, _ = marginals(emissions(distinct, model)[place] if len(flat) else np.zeros(0), bounds, model.moves)
    most, total = document_features(p, bounds)
    a, b, c = model.document
    score = 1 / (1 + np.exp(-np.clip(a + b * most + c * total, -30, 30)))
    spans: list[list[dict[str, int]]] = [[] for _ in range(len(texts))]
    for i in np.flatnonzero(most > 0.5):
        hits, last = p[bounds[i] : bounds[i + 1]] > 0.5, -2
        for j, m in enumerate(_WORD.finditer(texts[int(i)].as_py())):
            if hits[j]:
                if last == j - 1:
                    spans[i][-1]["end"] = m.end()
                else:
                    spans[i].append({"start": m.start(), "end": m.end()})
                last = j
    return score, np.expm1(total), spans


def train(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = PER_CLASS, max_chars: int = MAX_CHARS) -> Field:
    """Fit on at most ``per_class[label]`` labelled texts of a label, none longer than ``max_chars``."""
    rows = labelled_sample(docs, labels, "toxic", per_class, max_chars).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id")
    model = fit([(r["text"] or "", r["label"]) for r in rows.collect()])
    give_back()
    return model


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def toxicity(docs: DataFrame, model: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, expected number of toxic words and toxic spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                score, n, spans = score_texts(part.column("text"), model)
                columns = [part.column("doc_id"), pa.array(score), pa.array(n), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_toxic_words", "spans"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(run), SCHEMA)


def keep_clean(docs: DataFrame, model: Field, threshold: float) -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                score, _, _ = score_texts(part.column("text"), model)
                yield part.filter(pa.array(score < threshold)).select(names)

    return docs.mapInArrow(released(run), docs.schema)
