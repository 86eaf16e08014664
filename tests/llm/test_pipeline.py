"""Each stage of the pipeline judges rows, not ids, whatever further columns the table has."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fareloom.llm import neardup, toxicity
from fareloom.llm.queries import TOXIC_FROM, importable

SF = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def given():
    con = duckdb.connect()
    english = [t for (t,) in con.execute(f"SELECT text FROM '{SF}/documents.parquet' WHERE lang = 'en' AND n_chars BETWEEN 900 AND 1500 ORDER BY doc_id LIMIT 40").fetchall()]
    item = con.execute(f"SELECT text FROM '{SF}/benchmark.parquet' ORDER BY length(text) DESC LIMIT 1").fetchone()[0]
    toxic = con.execute(f"SELECT text FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id) WHERE toxic = 1 ORDER BY doc_id LIMIT 1").fetchone()[0]
    return english, item, toxic


def table(spark, rows):
    """(doc_id, text, lang) rows with further columns of names that a stage might use itself."""
    docs = spark.createDataFrame([(i, t, lang, "s", None, 1, 2, 3, "x", 4.0) for i, t, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long, _number int, row_key int, row int, ROW_TEXT string, row_id double")
    return docs


def left(df, docs):
    assert df.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_one_id_with_a_clean_and_a_contaminated_text(spark, given):
    importable(spark)
    english, item, _ = given
    docs = table(spark, [(1, english[0], "en"), (1, item, "en"), (2, english[1], "en"), (None, item, "en"), (3, None, "en"), (3, "", None)])
    got = STAGES["decontamination"](spark, docs, SF)
    assert left(got, docs) == sorted([(1, english[0]), (2, english[1]), (3, None), (3, "")], key=repr)


def test_one_id_with_texts_of_two_languages(spark, given):
    importable(spark)
    english = given[0]
    german = duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet' WHERE lang = 'de' ORDER BY n_chars DESC LIMIT 1").fetchone()[0]
    docs = table(spark, [(1, english[0], "en"), (1, german, "en"), (2, english[1], "en"), (2, "12 34 !!", "en")])
    got = STAGES["language"](spark, docs, SF)
    assert left(got, docs) == [(1, english[0]), (2, english[1])]


def test_one_id_with_two_unlike_texts_keeps_both(spark, given):
    importable(spark)
    a, b, c, d = given[0][:4]
    near = a + " and then some more"
    rows = [(2, a, "en"), (2, b, "en"), (2, a, "en"), (5, near, "en"), (5, c, "en"), (6, c, "de"), (7, "", "en"), (7, "", "en"), (8, None, "en"), (None, d, "en"), (None, d, "en"), (9, d, "en")]
    docs = table(spark, rows)
    got = STAGES["near_duplicates"](spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(2, a), (2, b), (5, c), (7, ""), (8, ""), (0, d), (0, d), (9, d)])
    assert {(r._number, r.row, r.row_id) for r in got} == {(1, 3, 4.0)}


def test_one_id_with_a_clean_and_a_toxic_text(spark, given):
    importable(spark)
    english, _, toxic = given
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = table(spark, [(1, english[0], "en"), (1, toxic, "en"), (2, english[1], "en")])
    assert left(toxicity.keep_clean(docs, model, TOXIC_FROM), docs) == [(1, english[0]), (2, english[1])]


def test_a_group_that_is_most_of_the_table_leaves_one(spark, given):
    importable(spark)
    english = given[0]
    rows = [(100 + i, english[0], "en") for i in range(300)] + [(i, t, "en") for i, t in enumerate(english[1:20])] + [(50, english[0], "en")] * 100
    kept = neardup.keep_one(table(spark, rows)).select("doc_id", "text").collect()
    assert sum(r.text == english[0] for r in kept) == 1 and min(r.doc_id for r in kept if r.text == english[0]) == 50


def test_stages_of_empty_tables(spark):
    docs = table(spark, [(1, "x", "en")]).filter(F.lit(False))
    assert neardup.keep_one(docs).collect() == []
