"""The fusion against a plain restatement, and the one-pass fit against a fit by hand."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from fareloom.llm import language
from fareloom.llm.queries import importable

WORDS = {
    "aa": "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split(),
    "bb": "der hund und die katze gehen durch den dunklen wald nach".split(),
    "cc": "un petit oiseau chante sur la branche de notre jardin vert".split(),
}


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def brute(rows, model, right=0.9, suffix_right=0.7, strength=20.0, suffixes=None):
    names, n = model.languages, len(model.languages)
    seen = []
    for i, text, declared, host in rows:
        places, _, letter = language.trigram_places(pa.array([text], pa.string()))
        host = (host or "").lower()
        labels = host.split(".")
        many = len(labels) > 1
        ll = model.table[places].sum(0, dtype=np.float64) / 3 if len(places) else np.zeros(n)
        seen.append((i, ll, declared and declared.strip(" ").lower(), host, labels[-1] if many else "", ".".join(labels[-2:]) if many else host, int(letter.sum())))
    p = [softmax(s[1]) for s in seen]

    def total(keep):
        return sum((q for q, s in zip(p, seen, strict=True) if keep(s)), np.zeros(n))

    def declared_log(name, sure):
        if name not in names:
            return np.zeros(n)
        return np.array([math.log(sure) if x == name else math.log((1 - sure) / max(1, n - 1)) for x in names])

    found = {}
    everything = total(lambda s: True)
    shares = (everything + 1) / (everything.sum() + n)
    for (i, ll, declared, host, suffix, domain, letters), own in zip(seen, p, strict=True):
        of_suffix = total(lambda s, x=suffix: s[4] == x)
        by_suffix = (of_suffix + strength * shares) / (of_suffix.sum() + strength)
        of_domain = total(lambda s, x=(domain, suffix): (s[5], s[4]) == x)
        by_domain = (of_domain + strength * by_suffix) / (of_domain.sum() + strength)
        of_host = total(lambda s, x=host: s[3] == x)
        prior = np.maximum(of_host - own, 0) + strength * by_domain
        logs = ll + np.log(np.maximum(prior, 1e-12)) + declared_log(declared, right) + declared_log((suffixes or {}).get(suffix), suffix_right)
        post = softmax(logs)
        found.setdefault(i, []).append((names[int(post.argmax())], round(float(post.max()), 6), letters))
    return {i: sorted(x) for i, x in found.items()}


def test_fusion_equals_a_plain_restatement(spark):
    importable(spark)
    chance = random.Random(2)
    model = language.fit_trigrams([(" ".join(chance.choices(w, k=30)), k) for k, w in WORDS.items() for _ in range(5)])
    rows = []
    for i in range(250):
        lang = chance.choice(list(WORDS))
        text = chance.choice([None, "", "12 !", " ".join(chance.choices(WORDS[lang], k=chance.randrange(1, 8))), chance.choice(WORDS[lang])[:3]])
        declared = chance.choice([None, "", lang, lang.upper() + " ", "zz", "aa"])
        host = chance.choice([None, "", "localhost", f"www.{lang}.de", f"blog.{lang}.fr", "a.b.co", "hot.example.de", "hot.example.de", "HOT.example.de"])
        rows.append((i % 240, text, declared, host))
    df = spark.createDataFrame(rows, "id long, text string, declared string, host string")
    suffixes = {"de": "bb", "fr": "cc"}
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = language.language_id(df, model, suffix_language=suffixes).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        got = {}
        for r in out:
            got.setdefault(r.id, []).append((r.lang, round(r.probability, 6), r.n_letters))
        want = brute(rows, model, suffixes=suffixes)
        assert {i: [x[0] for x in sorted(v)] for i, v in got.items()} == {i: [x[0] for x in v] for i, v in want.items()}
        for i, v in got.items():
            assert [x[1] for x in sorted(v)] == pytest.approx([x[1] for x in want[i]], abs=2e-6)
            assert [x[2] for x in sorted(v)] == [x[2] for x in want[i]]


def test_the_fit_takes_every_language_and_a_bounded_sample(spark):
    importable(spark)
    rows = [(i, f"x{k} y{k} {'abcdefghij'[k % 10]}{k}{k}", f"l{k:03}") for k in range(120) for i in range(k * 10, k * 10 + 3)]
    rows += [(5000 + i, "one text more", "l000") for i in range(100)] + [(None, "no id", "l000"), (9000, None, "l001"), (9001, "x", None)]
    docs = spark.createDataFrame([(i, t, lang, 1) for i, t, lang in rows], "doc_id long, text string, lang string, _n int")
    model = language.train(docs, per_language=1000)
    assert model.languages == [f"l{k:03}" for k in range(120)]  # more than fifty
    by_hand = language.fit_trigrams([(t, lang) for i, t, lang in rows if i is not None and t is not None and lang])
    np.testing.assert_allclose(model.table, by_hand.table, rtol=1e-6)
    small = language.train(docs, per_language=2)
    assert small.languages == model.languages
    assert language.train(docs.limit(0)).languages == []
