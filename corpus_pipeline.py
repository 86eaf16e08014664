"""From raw documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept. The first four return rows of ``documents`` with its
columns; the last returns pieces of packed sequences. Rows are judged by themselves: where an id repeats
with different texts, a verdict on one row leaves the others alone. Null and empty texts, texts of any
length and columns of any further name are taken. Of rows that repeat both id and text one is left by the
near-duplicate stage, which keeps rows without an id. Empty input gives empty output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import decontaminate, language, neardup, packing, toxicity
from fareloom.llm.common import fresh, staged, table
from fareloom.llm.queries import TOXIC_FROM, importable

#: Documents less likely than this to be in their best language are rejected.
SURE = 0.8


def without(docs: DataFrame, judge) -> DataFrame:
    """The rows that ``judge`` does not return: it gets them with a number for each id and text, in a
    column of a name that they do not have, and returns such numbers in one column."""
    key = fresh(docs, "row_key")
    numbered = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    bad = judge(numbered, key).toDF(key).filter(F.col(key).isNotNull()).distinct()
    return numbered.join(bad, key, "left_anti").select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Drop documents without any letters, of uncertain language, or of another one than declared.

    The declared language of a document is its ``lang``, its host its ``source``.
    """
    importable(spark)
    model = language.train(table(spark, directory, "documents"))

    def uncertain(rows: DataFrame, key: str) -> DataFrame:
        rows = rows.select(F.col(key).alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
        found = language.language_id(rows, model)
        wrong = F.coalesce(F.col("lang") != F.col("declared"), F.lit(False)) & F.col("declared").isin(model.languages)
        return found.filter((F.col("n_letters") == 0) | F.col("lang").isNull() | (F.col("probability") < SURE) | wrong).select("id")

    return without(docs, uncertain)


def drop_toxic(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Drop documents that score as toxic, by a model of the labelled ones among them."""
    importable(spark)
    model = toxicity.train(docs, table(spark, directory, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Keep one document of each group, that with the smallest id."""
    importable(spark)
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Drop documents that hold a benchmark item, be it under new numbers or names."""
    items = table(spark, directory, "benchmark")
    return without(docs, lambda rows, key: decontaminate.contaminated(rows, items, id_column=key).select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their token ids."""
    importable(spark)
    return packing.harmonic_packing(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Fitted models and a tokenizer decide; SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, directory), name)
    return STAGES[-1][1](spark, docs, directory)
