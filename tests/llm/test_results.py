"""Operators against brute force, exact round trips and held-out accuracy."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareloom.llm import components, decontaminate, language, license, neardup, neighbours, quality, tokens, toxicity
from fareloom.llm.queries import registered

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(sets):
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    pairs = {p for members in lists.values() for p in itertools.combinations(sorted(members), 2)}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


def test_near_duplicates_of_chains_and_hot_groups(spark):
    chance = random.Random(5)
    base = [f"w{chance.randrange(9000)}" for _ in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):  # near copies, many of them not alike among themselves
        words = list(base)
        for _ in range(chance.randrange(1, 4)):
            words[chance.randrange(60)] = f"z{chance.randrange(9000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, "one and the same text of some words") for i in range(300)]
    rows += [(2000 + i, " ".join(f"q{i}_{j // 7}" for j in range(40))) for i in range(50)] + [(3000, "short text"), (3001, "Short  TEXT")]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components({i: shingles(t) for i, t in rows})


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 3)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(300)}


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = registered()["op8_harmonic_packing"](spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 2], "<u4")
        own.sort(key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
        assert sum(r.length for r in own) == len(ids)
    padded = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        total = sum(r.length for r in own)
        assert total <= 4096
        padded += 0 if total & (total - 1) == 0 else 4096 - total
    assert padded < 0.02 * sum(r.length for r in rows)


def test_token_counts_cover_every_token(spark):
    df = spark.createDataFrame([(1, "one line\nand two\n\nlast", "a\nb"), (2, None, "x")], "doc_id long, text string, title string")
    encoder, _ = tokens.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for rule in tokens.RULES:
        rows = tokens.token_counts(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["title", "text"], rule).collect()
        assert sum(r.n_tokens for r in rows if r.doc_id == 1) == len(encoder.encode_ordinary("a\nb\none line\nand two\n\nlast"))
        assert [(r.field, r.section) for r in rows if r.doc_id == 1] == [("title", 0), ("title", 1), ("text", 0), ("text", 1), ("text", 2), ("text", 3)]
    got = {rule: tokens.attribute(np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 6]), rule)[0].tolist() for rule in tokens.RULES}
    assert got == {"first": [0, 0, 1], "last": [0, 1, 1], "most": [0, 1, 1]}


def test_marginals_equal_enumeration():
    chance = np.random.default_rng(1)
    scores, moves = chance.normal(0, 1, 7), chance.normal(0, 1, (2, 2))
    bounds = np.array([0, 3, 3, 7])
    p, both = toxicity.marginals(scores, bounds, moves)
    for a, b in ((0, 3), (3, 7)):
        total, one, two = 0.0, np.zeros(b - a), np.zeros(b - a)
        for tags in itertools.product((0, 1), repeat=b - a):
            mass = np.exp(sum(scores[a + i] for i, t in enumerate(tags) if t) + sum(moves[s, t] for s, t in zip(tags, tags[1:], strict=False)))
            total += mass
            one += mass * np.array(tags)
            two[1:] += mass * np.array([s * t for s, t in zip(tags, tags[1:], strict=False)])
        assert np.allclose(p[a:b], one / total) and np.allclose(both[a:b], two / total)


def _held_out(spark, name, label):
    truth = dict(duckdb.connect().execute(f"SELECT doc_id, {label} FROM '{SF}/labels.parquet'").fetchall())
    rows = registered()[name](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(a == b for a, b in own) / len(own)


def test_toxicity_on_held_out_rows(spark):
    assert _held_out(spark, "op1_toxicity_crf", "toxic") > 0.93


def test_quality_on_held_out_rows(spark):
    assert _held_out(spark, "op4_quality_random_indexing", "quality") > 0.93


def test_toxic_spans_give_the_offending_words():
    rows = [(f"some plain words {i} vile{i % 9} thing and more {i * 7}", 1) for i in range(60)]
    rows += [(f"some plain words {i} nice{i % 9} thing and more {i * 7}", 0) for i in range(60)]
    model = toxicity.Field(bias=-4.0, moves=np.zeros((2, 2)), document=(-5.0, 5.0, 5.0))
    model.weights[1]["vile"] = 9.0
    score, _, spans = toxicity.score_texts(pa.array([rows[0][0], rows[60][0], "  Vile3,  vile!"]), model)
    assert score[0] > 0.7 > score[1]
    assert [[rows[0][0][s["start"] : s["end"]] for s in spans[0]], spans[1]] == [["vile0"], []]
    assert spans[2] == [{"start": 2, "end": 15}]


def test_patience_alignment():
    a, b = [9, 1, 2, 3, 8, 4, 5], [1, 2, 7, 3, 4, 5]
    pairs = license.patience(a, b)
    assert [(a[i], b[j]) for i, j in pairs] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert license.increasing([3, 1, 2, 5, 4]) == [1, 2, 4]


def test_license_scan_finds_exact_and_changed_notices(spark, texts):
    got = {r.doc_id for r in registered()["op3_license_patience"](spark, SF).collect()}
    lines = [license.TEMPLATES[k] for k in ("Apache-2.0-line", "MIT-line", "GPL-3.0-line", "CC-BY-NC-4.0-line")]
    assert {i for i, t in texts.items() if any(x in t for x in lines)} == got
    text = "intro words " + license.TEMPLATES["MIT"].replace("granted, free", "given, free") + " end"
    rows = license.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.license, round(r.coverage, 2) < 1) for r in rows] == [("MIT", True)]
    assert text[rows[0].start : rows[0].end].startswith("Permission is")


def test_decontamination_equals_word_windows(spark, texts):
    items = dict(duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
    clean = lambda t: re.findall(r"[^\W_]+", t.lower())
    windows = {i: {tuple(w[k : k + 6]) for k in range(len(w) - 5)} for i, w in ((i, clean(t)) for i, t in items.items())}
    want = set()
    for d, t in texts.items():
        w = clean(t)
        own = {tuple(w[k : k + 6]) for k in range(len(w) - 5)}
        want |= {(d, i) for i, x in windows.items() if len(own & x) >= 0.6 * len(x)}
    got = {(r.doc_id, r.item_id) for r in registered()["op2_template_decontamination"](spark, SF).collect()}
    assert got == want


def test_decontamination_sees_new_parameters_but_not_mixed_ones(spark):
    item = "He said that Anna bought 12 apples for 30 dollars and then Anna gave 12 apples to a friend."
    new = item.replace("Anna", "Peter").replace("12", "15")
    mixed = new[::-1].replace("51", "61", 1)[::-1]
    df = spark.createDataFrame([(1, item), (2, new), (3, mixed), (4, "Nothing of the kind at all is said in this text.")], "doc_id long, text string")
    rows = decontaminate.contaminated(df, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_changed > 0) for r in rows) == [(1, False), (2, True)]


def test_lm_equals_a_direct_count(spark, texts):
    from fareloom.llm import lm

    few = {i: texts[i] for i in sorted(texts)[:60]}
    df = spark.createDataFrame([*few.items(), (10**6, "")], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder, _ = tokens.load_encoder(path, public_tokenizers.PATTERN)
    ids = {i: [-1, *encoder.encode_ordinary(t.lower())] for i, t in few.items()}
    pairs, first, word = Counter(), Counter(), Counter()
    for w in ids.values():
        pairs.update(zip(w, w[1:], strict=False))
        first.update(w[:-1])
        word.update(w[1:])
    total = sum(word.values())
    for heavy in (50, 10**9):
        got = {r.doc_id: r.log_prob for r in lm.lm_scores(df, path, public_tokenizers.PATTERN, heavy=heavy).collect()}
        for i, w in ids.items():
            p, v, u = Counter(zip(w, w[1:], strict=False)), Counter(w[:-1]), Counter(w[1:])
            want = 0.0
            for (a, b), n in p.items():
                rest = pairs[a, b] - n
                want += n * (np.log(rest / (first[a] - v[a])) if rest else np.log(0.4 * max(0.5, word[b] - u[b]) / (total - len(w) + 1)))
            assert got[i] == pytest.approx(want, rel=1e-4)
        assert got[10**6] == 0


def test_recall_of_the_multi_index(spark):
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = neighbours.inverted_multi_index(df, df.filter("vec_id % 20 = 0"), centroids=8, least=10, block=64, crowd=8).collect()
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = v @ v[i]
        want = [int(ids[j]) for j in np.lexsort((ids, -score)) if j != i][:20]
        hit += len(set(want) & {r.vec_id for r in found if r.query_id == ids[i]})
        total += 20
    assert hit / total >= 0.9


def test_multi_sequence_visits_cells_by_summed_distance():
    chance = np.random.default_rng(2)
    left, right = chance.random(6), chance.random(5)
    sizes = {i * 5 + j: 1 for i in range(6) for j in range(5)}
    order = neighbours.multi_sequence(left, right, sizes, 30)
    sums = [left[c // 5] + right[c % 5] for c in order]
    assert sorted(order) == list(range(30)) and sums == sorted(sums)


def test_language_of_pages_and_of_rows_with_little_text(spark):
    rows = registered()["op7_language_fusion"](spark, SF).collect()
    assert sum(r.lang == r.declared for r in rows) / len(rows) > 0.95
    model = language.fit_trigrams([("the cat and the dog", "en"), ("der hund und die katze", "de")])
    many = [(i, "der hund und die katze", "de", "a.example.de") for i in range(50)] + [(99, "", None, "a.example.de"), (98, "", "en", "b.example.org")]
    got = {r.id: r.lang for r in language.language_id(spark.createDataFrame(many, "id long, text string, declared string, host string"), model).collect()}
    assert got[99] == "de" and got[0] == "de"


def test_slots_and_pooling_of_words():
    slots, bounds = quality.slot_words(pa.array(["a b, a", None, "a"]))
    assert bounds.tolist() == [0, 4, 4, 5] and slots[0] == slots[3] == slots[4]
    places, signs = quality.index_vectors()
    total, n = quality.context_sums(slots, bounds, places, signs)
    assert n.sum() == 5 and total.shape == (quality.SLOTS, quality.DIM)


def test_near_duplicates_equal_their_sql(spark):
    import compare

    from fareloom.llm.queries import statements

    df = registered()["op5_minhash_inverted_join"](spark, SF)
    assert compare.differences(df.collect(), df.columns, compare.connect(SF), statements()["op5_minhash_inverted_join"]) is None


def test_the_pipeline_keeps_what_brute_force_keeps(spark, texts):
    """Packed documents are none that a benchmark item or an earlier near copy rules out."""
    rows = registered()["pipeline"](spark, SF).select("doc_id").distinct().collect()
    kept = {r.doc_id for r in rows}
    group = brute_components({i: shingles(t) for i, t in texts.items() if i in kept})
    assert all(group[i] == i for i in kept)
    held = {r.doc_id for r in registered()["op2_template_decontamination"](spark, SF).collect()}
    assert not kept & held
    assert len(kept) > 0.7 * len(texts)


def test_the_field_does_not_depend_on_the_blocks_it_is_fitted_in(monkeypatch):
    chance = np.random.default_rng(5)
    plain = [f"word{i}" for i in range(300)]
    rows = [(" ".join(chance.choice(plain, int(n))), 0) for n in chance.integers(0, 60, 300)]
    rows += [(" ".join([*chance.choice(plain, 20), "vexilt", *chance.choice(plain, 20)]), 1) for _ in range(60)]
    whole = toxicity.fit(rows)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 50)
    cut = toxicity.fit(rows)
    assert whole.weights[0] and whole.weights[0].keys() == cut.weights[0].keys()
    np.testing.assert_allclose(cut.document, whole.document, rtol=1e-6)
    np.testing.assert_allclose(cut.moves, whole.moves, rtol=1e-6)


def _licenses(spark, rows):
    found = license.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {i: sorted(r.license for r in found if r.doc_id == i) for i, _ in rows}


def test_a_notice_needs_its_telling_words_within_a_bounded_span(spark):
    gnu = license.TEMPLATES["GPL-3.0"]
    apache = license.TEMPLATES["Apache-2.0"]
    rows = {
        "Released under the BSD License": ["BSD-line"],
        "Released under the IXC License": [],
        "Licensed under CC BY-SA 4.0": ["CC-BY-SA-4.0-line"],
        "Licensed under CC BY-NC-ND 4.0": ["CC-BY-NC-ND-4.0-line"],
        "Licensed under CC BY-NC 3.0": [],
        "Licensed under the Apache License, Version 1.1": ["Apache-1.1-line"],
        "This work is licensed under the GNU General Public License, version 2": ["GPL-2.0-line"],
        "This work is licensed under the GNU Library General Public License, version 2": [],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": ["CC-BY-SA-4.0-work"],
        "This work is licensed under a Creative Commons Attribution Share Alike 4.0 International License": [],
        "The film was released under the title X and later sold on license.": [],
        "It was released under the wrong name, and a friend from MIT then lost the license.": [],
        gnu: ["GPL-3.0"],
        gnu.replace("version 3", "version 2"): ["GPL-2.0"],
        gnu.replace("version 3", "version 4"): [],
        gnu.replace("General", "Lesser General"): ["LGPL-3.0"],
        gnu.replace("General", "Library General"): [],
        apache.replace("2.0", "1.1"): ["Apache-1.1-line"],
        apache.replace("obtain a copy", "get one copy"): ["Apache-2.0"],
        apache.replace(" ", "\n * ", 8): ["Apache-2.0"],
        "It was released in May. Released under the MIT License, see the license file.": ["MIT-line"],
        "Released under the terms of the MIT License": ["MIT-line"],
    }
    got = _licenses(spark, list(enumerate(rows)))
    assert {t: got[i] for i, t in enumerate(rows)} == rows


def test_decontamination_finds_short_items_and_items_of_numbers(spark):
    items = [
        (1, "What colour has the sky?"), (2, "12 + 7 = 19"), (3, "What is 12 plus 7?"), (4, "So 12 is 12 now"),
        (5, "3.5 kg 7 lb 12 oz 9 g 4 km 8 mm"), (6, "What is Paris?"), (7, "hello"),
    ]
    around = "Some other words stand before it here. {} And then many more words follow after it."
    docs = {
        items[0][1]: {1}, around.format("what colour has the sky?"): {1}, around.format("What colour has the sea?"): set(),
        around.format(items[1][1]): {2}, around.format("12 + 7 = 20"): set(), items[1][1]: {2},
        around.format(items[2][1]): {3}, around.format("What is 15 plus 9?"): {3}, around.format("What is 15 minus 9?"): set(),
        around.format("So 5 is 5 now"): {4}, around.format("So 5 is 6 now"): set(),
        around.format(items[4][1]): {5}, around.format("1 kg 2 lb 3 oz 4 g 5 km 6 mm"): set(),
        around.format("What is Paris?"): {6}, around.format("What is Rome?"): set(), "What is Rome?": {6},
        around.format("Hello!"): {7}, around.format("Nothing."): set(),
    }
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {t: {r.item_id for r in rows if r.doc_id == i} for i, t in enumerate(docs)}
    assert got == docs
    assert {(r.doc_id, r.n_values, r.n_changed) for r in rows if r.item_id == 3} == {(6, 2, 0), (7, 2, 2)}
    assert all(r.coverage == 1 for r in rows)


def test_recall_of_the_multi_index_on_vectors_of_unequal_length(spark):
    chance = np.random.default_rng(4)
    unit = chance.normal(size=(3000, 32))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for sigma in (0.5, 1.0):
        v = unit * np.exp(sigma * chance.normal(size=len(unit)))[:, None]
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        found = neighbours.inverted_multi_index(df, df.filter("vec_id % 50 = 0"), centroids=8, least=10).collect()
        hit = 0
        for i in range(0, len(v), 50):
            score = v @ v[i]
            score[i] = -np.inf
            hit += len(set(np.argsort(-score)[:20].tolist()) & {r.vec_id for r in found if r.query_id == i})
        assert hit / (20 * len(v) / 50) >= 0.9


def test_every_place_of_a_notice_is_listed(spark):
    t = license.TEMPLATES
    between = "\n\n".join(["some words of a file that stand between its head and the next one"] * 3)
    parts = [t["MIT-line"], t["Apache-2.0"], t["MIT-line"], t["MIT"], t["MIT"], t["Apache-2.0"].replace("obtain a copy", "get one copy"), t["MIT-line"]]
    rows = {1: f"\n{between}\n".join(parts), 2: " ".join([t["GPL-3.0"]] * 40), 3: " ".join([t["MIT-line"]] * 500), 4: between}
    found = license.license_scan(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    names = {i: [r.license for r in sorted(found, key=lambda r: r.start) if r.doc_id == i] for i in rows}
    assert names == {
        1: ["MIT-line", "Apache-2.0", "MIT-line", "MIT", "MIT", "Apache-2.0", "MIT-line"],
        2: ["GPL-3.0"] * 40, 3: ["MIT-line"] * 500, 4: [],
    }
    assert all(rows[2][r.start : r.end].startswith("This program") and r.coverage == 1 for r in found if r.doc_id == 2)
