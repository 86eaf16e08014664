"""Token operators on texts that strain a tokenizer: long runs of white space, marks, new characters."""

import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fareloom.llm import lm, packing, tokens
from fareloom.llm.queries import importable

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = list("İiIıTAKSi.,()'’´`!?-–—«»&@#1290 ½²³ßẞΣσςÅåÅKΩéèņ̃̀́̈ͅक़ख़שׁﬁ¡¿…“”;  　 ​‍ͅ⫝⫝̸𝅗𝅥ᄀ각ᆨゔが゛゜\n\t ")


def random_texts(n, seed):
    chance = random.Random(seed)

    def sign():
        if chance.random() < 0.8:
            return chance.choice(SIGNS)
        return chr(chance.choice([chance.randrange(32, 127), chance.randrange(0xA0, 0x2FFF), chance.randrange(0x3000, 0xD7FF), chance.randrange(0xF900, 0x1FFFF)]))

    return ["".join(sign() for _ in range(chance.randrange(1, 14))) for _ in range(n)]


def test_packing_ids_equal_the_tokenizers():
    encode = packing.WordEncoder(WORDS, packing.joined())
    some = ["TAKSİ.", "(İ)", "TAKSİ,", "T̈?.Å", "é́.", "<|endoftext|>", "Ᲊ.", "क़."]
    for begin in range(0, 100_000, 10_000):
        texts = some + random_texts(10_000, begin)
        want = [x.ids for x in encode.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encode(pa.array(texts))] == want


def test_packing_remembers_a_bounded_part_of_the_words(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    encode = packing.WordEncoder(WORDS, packing.joined())
    long = "x" * (packing.LONGEST + 1)
    for begin in range(0, 2000, 30):
        texts = [f"common {long} {' '.join(f'w{i}' for i in range(begin, begin + 30))}", "", None]
        want = [x.ids for x in encode.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert [x.tolist() for x in encode(pa.array(texts))] == want
        assert len(encode.known) + len(encode.before) <= 100 and long not in encode.known | encode.before and "common" in encode.known | encode.before


#: Packs 24 MB of text as a task does and prints by how many MB that raised the process's memory at most.
PACKING = """
import sys
from unittest.mock import MagicMock
import numpy as np
import pyarrow as pa
from fareloom.llm import packing

packing.F, packing.TaskContext, docs = MagicMock(), MagicMock(), MagicMock()
packing.TaskContext.get.return_value.partitionId.return_value = 0
docs.select.return_value.mapInArrow.side_effect = lambda run, schema: run
run = packing.harmonic_packing(docs, sys.argv[1], 2)
chance = np.random.default_rng(5)
vocabulary = np.array([f"{i:x}" + "".join(map(chr, 97 + chance.integers(0, 26, 4))) for i in range(400_000)])

def batches():
    for i in range(4):
        picked = vocabulary[(len(vocabulary) * chance.random((3000, 300)) ** 2).astype(int)].tolist()
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": [" ".join(x) for x in picked]})
    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})

def memory(name):
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith(name)) >> 10

made = list(batches())
packing.give_back() if hasattr(packing, "give_back") else None
open("/proc/self/clear_refs", "w").write("5")
before = memory("VmRSS")
rows = sum(b.num_rows for b in run(iter(made)))
assert rows >= 12000
print(memory("VmHWM") - before)
"""


def test_packing_takes_little_memory():
    done = subprocess.run([sys.executable, "-c", PACKING, WORDS], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 170


@pytest.fixture(scope="module")
def encoder():
    return tokens.load_encoder(RANKS, public_tokenizers.PATTERN)


def test_long_blanks_part_as_the_pattern_does(encoder):
    encode, _ = encoder
    chance = random.Random(3)
    for _ in range(200):
        text = ""
        for _ in range(chance.randrange(1, 5)):
            text += chance.choice(["", "word", "a, b", "1", " x", "é"]) + "".join(chance.choices(" \t\n \x0b", k=chance.choice([1, 2, 999, 1000, 1001, 3000])))
        text += chance.choice(["", "end", "."])
        assert tokens.encode_whole(encode, text).tolist() == encode.encode(text, disallowed_special=())


@pytest.mark.parametrize("n", [1_000_000, 10_000_000, 50_000_000])
def test_millions_of_blanks(encoder, n):
    encode, lengths = encoder
    ids = tokens.encode_whole(encode, "a" + " " * n + "b")
    assert int(lengths[ids].sum()) == n + 2
    assert encode.decode(ids[-2:].tolist()) == "  b"


def test_operators_on_millions_of_blanks(spark):
    importable(spark)
    rows = [(1, "one" + " " * 1_000_000 + "two\n" + "\t " * 700_000), (2, "one two"), (3, " " * 2_000_000), (4, "x" * 2_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r.doc_id: r for r in lm.lm_scores(docs, RANKS, public_tokenizers.PATTERN).collect()}
    counts = tokens.token_counts(docs, RANKS, public_tokenizers.PATTERN).collect()
    for i, t in rows:
        own = sorted((r for r in counts if r.doc_id == i), key=lambda r: r.start)
        assert own[-1].end == len(t) and {r.doc_tokens for r in own} == {scores[i].n_tokens} == {sum(r.n_tokens for r in own)}
    assert all(np.isfinite(r.log_prob) for r in scores.values())
