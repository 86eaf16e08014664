"""Scores, vectors and spans of the fitted operators against plain restatements."""

import itertools
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fareloom.llm import quality, tokens, toxicity
from fareloom.llm.queries import importable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- toxicity ---------------------------------------------------------------------------


def chain(text, model):
    """Each word's marginal by all ways to tag the text."""
    w = WORD.findall(text or "")
    e = toxicity.emissions(pa.array([x.lower() if x.isascii() else x for x in w], pa.string()), model) if w else []
    total, one = 0.0, np.zeros(len(w))
    for tags in itertools.product((0, 1), repeat=len(w)):
        mass = np.exp(sum(s for s, t in zip(e, tags, strict=True) if t) + sum(model.moves[a, b] for a, b in zip(tags, tags[1:], strict=False)))
        total += mass
        one += mass * np.array(tags)
    return one / total if w else one


def test_scores_and_offsets_equal_enumeration(spark):
    importable(spark)
    chance = random.Random(8)
    model = toxicity.Field(bias=-1.5, moves=np.array([[0.3, -0.8], [-0.4, 0.9]]), document=(-3.0, 4.0, 1.5))
    model.weights[1].update({"vile": 3.0, "grim": 1.2, "nice": -2.0})
    vocabulary = ["vile", "grim", "nice", "some", "Vile!", "other", "VILE", "x"]
    texts = [" ".join(chance.choices(vocabulary, k=chance.randrange(0, 9))).replace("x ", "x \t\n") for _ in range(150)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.toxicity(df, model).collect():
        text = texts[r.doc_id]
        p = chain(text, model)
        most, total = (p.max(), np.log1p(sum(x for x in p if x > 0.1))) if len(p) else (0.0, 0.0)
        a, b, c = model.document
        assert r.score == pytest.approx(1 / (1 + np.exp(-(a + b * most + c * total))), rel=1e-6)
        assert r.n_toxic_words == pytest.approx(np.expm1(total), abs=1e-9)
        spans, last = [], -2
        for j, m in enumerate(WORD.finditer(text or "")):
            if p[j] > 0.5:
                if last == j - 1:
                    spans[-1] = (spans[-1][0], m.end())
                else:
                    spans.append((m.start(), m.end()))
                last = j
        assert [(s.start, s.end) for s in r.spans] == spans


# --- quality ----------------------------------------------------------------------------


def slots_of(text):
    return quality.slot_words(pa.array([text], pa.string()))[0].tolist()


def test_word_vectors_equal_summed_neighbours(spark):
    importable(spark)
    chance = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + [".", "!", "é"]
    texts = [" ".join(chance.choices(vocabulary, k=chance.randrange(0, 30))) for _ in range(120)] + ["", None, "one"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    vectors, share = quality.word_vectors(docs)
    places, signs = quality.index_vectors()
    want, seen = {}, {}
    for t in texts:
        own = slots_of(t)
        for i, s in enumerate(own):
            seen[s] = seen.get(s, 0) + 1
            total = want.setdefault(s, np.zeros(quality.DIM))
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if j != i:
                    for row in range(quality.ENTRIES):
                        total[places[row][own[j]]] += signs[row][own[j]]
    assert set(np.flatnonzero(share)) == set(seen)
    for s, v in want.items():
        assert share[s] == pytest.approx(seen[s] / sum(seen.values()))
        np.testing.assert_allclose(vectors[s], v / max(np.linalg.norm(v), 1e-9), atol=1e-9)


def test_pooled_documents_equal_weighted_moments():
    chance = np.random.default_rng(4)
    vectors, weight = chance.normal(size=(quality.SLOTS, quality.DIM)), chance.random(quality.SLOTS)
    texts = ["", "one two two three. three", "a b c", "x x x x"]
    got = quality.pooled(pa.array([*texts, None], pa.string()), vectors, weight)
    for x, t in zip(got, [*texts, ""], strict=True):
        own = slots_of(t)
        if not own:
            assert not x.any()
            continue
        w = weight[own]
        mean = (vectors[own] * w[:, None]).sum(0) / w.sum()
        spread = np.sqrt(np.maximum(0, (vectors[own] ** 2 * w[:, None]).sum(0) / w.sum() - mean**2))
        shape = [np.log1p(len(own)), np.mean([a == b for a, b in zip(own, own[1:], strict=False)]) if len(own) > 1 else 0, np.log(len(set(own)) / len(own))]
        # the table is in single precision, so a spread of nothing is the root of a rounding error
        np.testing.assert_allclose(x, np.concatenate([mean, spread, shape]), rtol=1e-4, atol=2e-3)


def accuracy(rows, slots):
    """Held-out accuracy of the model with words in ``slots`` slots."""
    texts = pa.array([t for t, _ in rows])
    places, signs = quality.index_vectors(slots)
    sums, seen = quality.context_sums(*quality.slot_words(texts, slots), places, signs)
    vectors = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    weight = 1e-3 / (1e-3 + seen / seen.sum())
    x, y = quality.pooled(texts, vectors, weight), np.array([k for _, k in rows], float)
    model = quality.Network(vectors, weight, **quality.fit_network(x[:1000], y[:1000]))
    return ((model.score(x[1000:]) >= 0.5) == y[1000:]).mean()


@pytest.mark.parametrize("size", [2_000, 50_000, 500_000])
def test_held_out_accuracy_as_the_vocabulary_outgrows_the_slots(size):
    """Good texts use good words among any others; the words share slots more and more, and nothing is
    lost against sixteen times as many slots."""
    chance = np.random.default_rng(size)
    share = 1 / np.arange(1, size + 1) ** 0.9
    cumulated = np.cumsum(share / share.sum())

    def text(label):
        n = int(chance.integers(60, 160))
        plain = [f"w{i}" for i in np.searchsorted(cumulated, chance.random(n))]
        for i in np.flatnonzero(chance.random(n) < 0.3):
            plain[i] = f"{'good' if label else 'poor'}{int(chance.integers(60))}"
        return " ".join(plain)

    rows = [(text(k % 2), k % 2) for k in range(1500)]
    own, more = accuracy(rows, quality.SLOTS), accuracy(rows, 16 * quality.SLOTS)
    print(f"\n{size} words: {own:.3f} with {quality.SLOTS} slots, {more:.3f} with {16 * quality.SLOTS}")
    assert own > 0.9 and own > more - 0.03


# --- token counts -----------------------------------------------------------------------


@pytest.mark.parametrize("rule", tokens.RULES)
def test_tokens_of_fields_and_lines_equal_a_walk_over_the_bytes(spark, rule):
    importable(spark)
    chance = random.Random(rule)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder, lengths = tokens.load_encoder(ranks, public_tokenizers.PATTERN)
    parts = ["word ", "\n", "\n\n", "  ", "é ", "a\nb", "...", "\n ", "日本", "x"]
    rows = [(i, *("".join(chance.choices(parts, k=chance.randrange(0, 9))) or None for _ in range(3))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, note string")
    fields = ["note", "title", "text"]
    got = {}
    for r in tokens.token_counts(df, ranks, public_tokenizers.PATTERN, fields, rule).collect():
        got.setdefault(r.doc_id, []).append((r.field, r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    for i, title, text, note in rows:
        own = [(n, t) for n, t in zip(fields, (note, title, text), strict=True) if t]
        owner, sections, data = [], [], b""
        for k, (name, t) in enumerate(own):
            part = (t + ("\n" if k + 1 < len(own) else "")).encode()
            number, start = 0, 0
            for at, byte in enumerate(part):
                owner.append(len(sections))
                if byte == 10 or at + 1 == len(part):
                    sections.append([name, number, start, at + 1, 0, 0])
                    number, start = number + 1, at + 1
            data += part
        at = 0
        for n in lengths[encoder.encode_ordinary("\n".join(t for _, t in own))] if own else []:
            mine = owner[at : at + n]
            chosen = {"first": mine[0], "last": mine[-1], "most": max(dict.fromkeys(mine), key=mine.count)}[rule]
            sections[chosen][4] += 1
            sections[chosen][5] += len(set(mine)) > 1
            at += n
        assert sorted(got.get(i, [])) == sorted(map(tuple, sections))
