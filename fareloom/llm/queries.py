"""The numbered queries over the test tables, and the SQL of those that SQL can state."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    collocations, decontaminate, language, license, lm, neardup, neighbours, packing, quality, runs, tokens, toxicity, urls,
)
from fareloom.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

TOXIC_FROM, QUALITY_FROM = 0.7, 0.5


#: Rows in an Arrow batch: some 10 MB of ordinary documents, on both sides of the pipe.
BATCH_ROWS = 3000


def importable(spark: SparkSession) -> None:
    """Let local Python workers find the package from wherever the session was started, and keep
    batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def op1_toxicity_crf(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = table(spark, directory, "documents"), table(spark, directory, "labels")
    scored = toxicity.toxicity(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "n_toxic_words", F.size("spans").alias("n_spans"),
    )


def op2_template_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op3_license_patience(spark: SparkSession, directory: str) -> DataFrame:
    return license.license_scan(table(spark, directory, "documents"))


def op4_quality_random_indexing(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = table(spark, directory, "documents"), table(spark, directory, "labels")
    scored = quality.quality(docs, quality.train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"))


def op5_minhash_inverted_join(spark: SparkSession, directory: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, directory, "documents"))


def op6_stupid_backoff(spark: SparkSession, directory: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return lm.lm_scores(table(spark, directory, "documents"), ranks, public_tokenizers.PATTERN)


def op7_language_fusion(spark: SparkSession, directory: str) -> DataFrame:
    model = language.train(table(spark, directory, "documents"))
    found = language.language_id(language.page_rows(table(spark, directory, "pages")), model)
    return found.withColumnRenamed("id", "page_id")


def op8_harmonic_packing(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.harmonic_packing(table(spark, directory, "documents"), path, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_inverted_multi_index(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "embeddings")
    return neighbours.inverted_multi_index(rows, rows.filter(F.col("vec_id") % 20 == 0))


def op10_offset_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokens.token_counts(table(spark, directory, "documents"), ranks, public_tokenizers.PATTERN)


def repeated_tails(ids: list, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From which word on, and after how many words, a tenth of the documents repeat themselves."""
    hashes = np.array([1 if i is None else zlib.crc32(str(i).encode()) for i in ids], np.int64)
    g, some = hashes // 10, (hashes % 10 == 0) & (counts > 0)
    since = np.where(some, g % np.maximum(counts, 1), counts)
    return since, np.where(some, 1 + (counts - since) // (3 + g % 8), 1)


def op13_recompressed_runs(spark: SparkSession, directory: str) -> DataFrame:
    found = runs.word_runs(table(spark, directory, "documents"), least=12, tails=repeated_tails)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op11_son_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations.collocations(table(spark, directory, "documents"), support=30, top=2000, absorbed=80)


URL_RULES = """VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
"""


def op12_url_rules(spark: SparkSession, directory: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM ({URL_RULES}) AS rules (verdict, host, path)")
    return urls.url_filter(table(spark, directory, "pages"), rules)


_OPERATORS = (
    op1_toxicity_crf, op2_template_decontamination, op3_license_patience, op4_quality_random_indexing,
    op5_minhash_inverted_join, op6_stupid_backoff, op7_language_fusion, op8_harmonic_packing,
    op9_inverted_multi_index, op10_offset_token_counts, op11_son_collocations, op12_url_rules,
    op13_recompressed_runs,
)


def ready(query: Query) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        importable(spark)
        return query(spark, directory)

    return run


def registered() -> dict[str, Query]:
    import corpus_pipeline

    return {f.__name__: ready(f) for f in _OPERATORS} | {"pipeline": ready(corpus_pipeline.run)}


def statements() -> dict[str, str]:
    """SQL for the queries that it can state within the time of a check."""
    return {"op5_minhash_inverted_join": NEAR_DUPLICATES, "op11_son_collocations": COLLOCATIONS, "op12_url_rules": URL_VERDICTS}


# runs of five words per document, pairs that share one, exact similarity, and the smallest id reached
NEAR_DUPLICATES = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM cut
), one AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.other = pairs.a
)
SELECT sets.doc_id, CAST(len(any_value(sets.s)) AS BIGINT) AS n_shingles, min(reach.other) AS component_id,
  sets.doc_id = min(reach.other) AS kept
FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id
"""

# every rule against every page, the longest that fits
URL_VERDICTS = rf"""
WITH rules (verdict, host, path) AS ({URL_RULES}), cut AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), fits AS (
  SELECT c.n, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY c.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM cut c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON f.n = c.n AND f.place = 1
"""

# every phrase counted, every cut scored, every phrase inside another compared
COLLOCATIONS = r"""
WITH lines AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM lines
), cut AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM cut, range(1, 5) AS sizes (size) WHERE len(w) >= size
), counts AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS w, a FROM counts WHERE size >= 2 AND a >= 30
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM candidates c, range(1, 4) AS ks (k)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  WHERE k < c.size
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, c.a AS wider
  FROM candidates c, range(2, 4) AS ms (m), range(1, 4) AS starts (i) WHERE m < c.size AND i + m - 1 <= c.size
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest w
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.wider >= 80 * w.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""
