"""Runs of words against a search of every period by hand."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from fareloom.llm import runs
from fareloom.llm.queries import registered, repeated_tails

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def row(doc_id, w, least=12):
    every = sorted(brute(w, least), key=lambda x: (x[0], x[2]))
    dropped = {i for s, m, q in every for i in range(s + q, s + m)}
    best = max(every, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in every)
    milli = 1000 * best[1] // best[2] if every else None
    return (doc_id, len(every), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def test_query_on_whole_documents(spark):
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r) for r in registered()["op13_recompressed_runs"](spark, SF).collect()}
    some = [d for d in docs if len((d[1] or "").split()) < 3000]
    assert len(some) > 150 and len(got) == len(docs)
    assert sum(row(i, planted(i, t))[1] > 0 for i, t in some) > 10
    for i, t in some:
        assert got[i] == row(i, planted(i, t)), i


@pytest.mark.parametrize("seed", range(6))
def test_texts_full_of_repeats(seed):
    chance = random.Random(seed)
    texts = []
    for _ in range(60):
        w = []
        while len(w) < chance.randrange(0, 160):
            base = [chance.randrange(1 + seed) for _ in range(chance.randrange(1, 9))]
            w += (base * chance.randrange(1, 9))[: chance.randrange(1, 60)]
        texts.append(w)
    a, b = [0], [0, 1]  # Fibonacci words hold the most runs
    for _ in range(11):
        a, b = b, b + a
    texts += [b, [7] * 300, [1, 2] * 100 + [1], []]
    counts = np.array([len(t) for t in texts])
    symbols = np.array([x for t in texts for x in t], np.int64)
    for least in (2, 12):
        found = sorted(zip(*(x.tolist() for x in runs.runs_of(symbols, counts, least)), strict=True))
        assert found == sorted((k, *r) for k, t in enumerate(texts) for r in brute(t, least))


def test_extensions_agree_with_a_plain_comparison():
    chance = np.random.default_rng(1)
    line = np.concatenate([[900], np.tile(chance.integers(0, 3, 40), 6), [5] * 50, chance.integers(0, 2, 300), [901]])
    grammar = runs.Grammar(line)
    a, b = chance.integers(0, len(line), 500), chance.integers(0, len(line), 500)
    a, b = a[a != b], b[a != b]
    want = [next(k for k in range(len(line)) if line[i + k] != line[j + k]) for i, j in zip(a, b, strict=True)]
    assert grammar.extend(a, b).tolist() == want


def test_edges(spark):
    long = " ".join(["one two three"] * 40_000)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (None, "a " * 30), (None, "a " * 30), (4, "a b c"), (5, long), (6, "x" * 1_000_000), (7, " a " * 24)]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n_runs int, runs string")
    got = runs.word_runs(docs, tails=repeated_tails).drop("runs", "n_words").collect()
    want = {(i, t): row(i, planted(i, t)) for i, t in rows if t != long}
    h = zlib.crc32(b"5")
    assert h % 10  # the long text stays as it is
    assert sorted(map(repr, map(tuple, (r for r in got if r["doc_id"] != 5)))) == sorted(repr(want[x]) for x in rows if x[1] != long)
    (five,) = (r for r in got if r["doc_id"] == 5)
    assert (five["n_runs"], five["start"], five["length"], five["period"], five["exponent_milli"]) == (1, 0, 120_000, 3, 40_000_000)
    assert runs.word_runs(docs.limit(0)).collect() == []
