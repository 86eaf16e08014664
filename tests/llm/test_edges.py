"""Every operator and stage on nulls, empty and long texts, repeats, ties, clashing columns, no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fareloom.llm import decontaminate, language, license, lm, neardup, neighbours, packing, quality, tokens, toxicity
from fareloom.llm.queries import importable, registered

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, rep long, _label int, key string, item_id long"


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    plain = "the quick brown fox jumps over the lazy dog and runs far away from here"
    rows = [
        (1, plain), (2, plain), (2, plain), (3, None), (4, ""), (5, "  \t\n "), (6, "word"), (None, plain), (None, None),
        (7, "lorem " * 30_000), (8, "x" * 100_000), (9, "héllo wörld ça é " * 20), (10, "Released under the MIT License."),
        (11, "<|endoftext|> it's é <|x|> 'S"), (12, "1 2 3 4 5 6 7 8 9 10 11 12"), (13, "\x00\x0b a b 　 힣"),
    ]
    full = [(i, t, "en" if i != 9 else None, "s", None, 0.5, 1, 1, "k", 5) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(1, 13)] + [(1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "jumps over the lazy dog and runs far away"), (2, None), (3, ""), (None, "x"), (1, "jumps over the lazy dog")], "item_id long, text string")


def calls(docs, labels, items):
    empty = docs.limit(0)
    for d in (docs, empty):
        n = 0 if d is empty else docs.count()
        yield "toxicity", toxicity.toxicity(d, toxicity.train(d, labels)), n
        yield "decontaminate", decontaminate.contaminated(d, items), None
        yield "decontaminate, no items", decontaminate.contaminated(d, items.limit(0)), 0
        yield "license", license.license_scan(d), None
        yield "quality", quality.quality(d, quality.train(d, labels)), n
        yield "neardup", neardup.near_duplicates(d), n
        yield "lm", lm.lm_scores(d, RANKS, public_tokenizers.PATTERN), n
        pages = d.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host")).withColumnRenamed("doc_id", "id")
        yield "language", language.language_id(pages, language.train(d)), n
        yield "packing", packing.harmonic_packing(d, WORDS, 2), None
        yield "tokens", tokens.token_counts(d, RANKS, public_tokenizers.PATTERN, ["lang", "text"], "most"), None


def test_operators_take_every_kind_of_row(docs, labels, items):
    for name, result, n in calls(docs, labels, items):
        rows = result.collect()
        assert n is None or len(rows) == n, name


def test_stages_take_every_kind_of_row(spark, docs, labels, items, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    for d in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            d = stage(spark, d, folder)
            assert d.columns == docs.columns, name
            d.collect()
        corpus_pipeline.STAGES[-1][1](spark, d, folder).collect()


def test_neighbours_take_every_kind_of_row(spark):
    importable(spark)
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, None]),
            (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [2.0, 0.0]), (20, [1.0, 0.0]), (40, [float("inf"), 1.0]), (60, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    found = neighbours.inverted_multi_index(df, df.filter("vec_id % 20 = 0")).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in {r.query_id for r in found}}
    assert got == {
        0: [(8, 2.0), (1, 1.0), (2, 1.0), (20, 1.0)],
        20: [(8, 2.0), (0, 1.0), (1, 1.0), (2, 1.0)],
    }
    assert neighbours.inverted_multi_index(df.limit(0), df.limit(0)).count() == 0


def test_every_operator_is_registered_once():
    assert [k.split("_")[0] for k in registered()] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
