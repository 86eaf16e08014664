"""Frequent phrases against a plain count."""

import random
import re
import string
from collections import Counter

import pytest

from fareloom.llm import collocations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, support, top=2000, absorbed=80, longest=4):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    frequent = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= support}
    wider = Counter()
    for (lang, p), a in frequent.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                wider[lang, p[i : i + m]] = max(wider[lang, p[i : i + m]], a)
    found = {}
    for (lang, p), a in frequent.items():
        if 100 * wider[lang, p] >= absorbed * a:
            continue
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
        for lang, some in found.items()
        for i, (score, a, p, left, right) in enumerate(sorted(some)[:top])
    )


def mined(spark, rows, support, **more):
    docs = spark.createDataFrame([(i % 5, lang, t, 1, "k") for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, n long, key string")
    return sorted(tuple(r) for r in collocations.collocations(docs, support, **more).collect())


@pytest.mark.parametrize("shards,bits", [(1, 20), (4, 27), (7, 8), (64, 12)])
def test_counts_are_whole_however_many_shards_and_bits(spark, shards, bits):
    chance = random.Random(shards)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "Z", "a'b", "w1.w2"]
    rows = []
    for _ in range(300):
        w = chance.choices(vocabulary, weights=[1 / (i + 1) for i in range(16)], k=chance.randrange(0, 40))
        rows.append((chance.choice(["en", "en", "de", None, "und"]), "".join(x + chance.choice([" ", " ", "\t ", ". ", "\n", ",", " "]) for x in w)))
    want = brute(rows, 9)
    assert len(want) > 50
    assert mined(spark, rows, 9, shards=shards, filter_bits=bits) == want


def test_absorbed_phrases_ties_and_tops(spark):
    rows = [("en", "a b c d")] * 40 + [("en", "a b x")] * 10 + [("en", "q r. q r")] * 20 + [("de", "a b c d e")] * 30 + [("fr", "one two")] * 29
    for support, top in ((30, 2000), (30, 1), (10, 2), (1, 3)):
        assert mined(spark, rows, support, top=top) == brute(rows, support, top)


def test_edges(spark):
    rows = [
        (None, None), ("en", ""), ("en", " \t\n.,;"), ("en", "x " * 300_000), (None, "a b " * 40), ("und", "A B " * 40), ("en", "é ü " * 50),
        ("x", "w" * 1_000_000 + " v " + "w" * 1_000_000 + " v"), ("", "k k k"), ("en", "\x00 \x0b\x00 " * 40),
    ]
    assert mined(spark, rows, 30) == brute(rows, 30)
    assert mined(spark, rows, 2) == brute(rows, 2)
    assert mined(spark, [], 30) == []
    assert mined(spark, [("en", None)], 30) == []
