"""Language of pages or documents by Bayesian fusion of four kinds of evidence.

Text: a byte-trigram model per language, fitted on a bounded sample of texts with known language.
Markup: the language that the page declares, taken as right with a fixed probability. Address: the
country suffix of the host, likewise. Host: how the other rows of the same host came out by their
text, smoothed towards the host's domain, that towards its suffix, and that towards all rows. The
host counts are sums of text posteriors by grouped aggregation; a row's own share is taken out of
its host's count before it is used. Hosts meet their rows by a lookup that spreads the rows of a heavy
host over as many salts as they need, so that one host with a third of all rows is no task's alone.

Null or empty texts give no text evidence, null or unknown declarations and hosts give none either;
a row without any evidence gets the global shares. Ties go to the first language by name. Rows that
repeat are judged alike and both count for their host. Without training texts the languages are
those of ``languages``; if there are none the result is null. Only the named columns are read. Texts are
read whole, of any length: one beyond the size of a step is a step of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import STEP_BYTES, released, staged, steps
from fareloom.operators.joins import lookup

#: Bounds of the training sample, by language.
PER_LANGUAGE, MAX_CHARS = 400, 20_000
#: Hash places of trigrams.
PLACES = 1 << 16

# Country suffixes and the language most used there.
SUFFIX_LANGUAGE = {
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es",
    "uk": "en", "us": "en", "ie": "en", "au": "en", "nz": "en",
}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass
class Trigrams:
    """Log probability of each trigram place, a column for each language."""

    languages: list[str]
    table: np.ndarray


def trigram_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the trigram at every byte (0 where it is no evidence), text bounds, letters."""
    texts = pc.fill_null(texts, "")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    x = _FOLD[data].astype(np.uint32)
    places = np.zeros(len(x), np.uint32)
    if len(x) > 2:
        code = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
        code ^= code >> np.uint32(15)
        blank = x == 32
        two = (blank[:-2].astype(np.uint8) + blank[1:-1] + blank[2:]) > 1
        places[:-2] = np.where(two, 0, code % np.uint32(PLACES - 1) + 1)
    for back in (1, 2):  # trigrams that reach into the next text
        ends = bounds[1:] - back
        places[ends[ends >= bounds[:-1]]] = 0
    return places, bounds, (x != 32)


def trigram_table(languages: Sequence[str], counts: np.ndarray, smooth: float = 0.5) -> Trigrams:
    """The model of counts of trigram places, a column for each language."""
    counts = counts + smooth
    counts[0] = 0
    table = np.log(np.maximum(counts, smooth) / counts.sum(0, keepdims=True))
    table[0] = 0
    return Trigrams(list(languages), table.astype(np.float32))


def fit_trigrams(rows: Sequence[tuple[str, str]], smooth: float = 0.5) -> Trigrams:
    """Fit on (text, language) rows at hand."""
    languages = sorted({lang for _, lang in rows})
    counts = np.zeros((PLACES, len(languages)))
    for k, lang in enumerate(languages):
        places, _, _ = trigram_places(pa.array([t for t, x in rows if x == lang], pa.string()))
        counts[:, k] += np.bincount(places, minlength=PLACES)
    return trigram_table(languages, counts, smooth)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> Trigrams:
    """Fit on documents with a language: at most ``per_language`` of each, chosen by a hash of the id,
    none longer than ``max_chars``. Every language that occurs is learnt, so the model has a column
    for each; texts are counted where they are, and only counts come back.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") <= max_chars))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id")
    # tasks pass on no more than per_language ids of a language
    chosen = known.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language)
    ids = staged(chosen.select("doc_id", "lang").distinct(), "language-sample")
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", STEP_BYTES // 4):
                places, bounds, _ = trigram_places(part.column("text"))
                langs = part.column("lang").dictionary_encode()
                names, owner = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
                key, n = np.unique(np.repeat(owner, np.diff(bounds)) * PLACES + places, return_counts=True)
                columns = [names.take(pa.array(key // PLACES)).cast(pa.string()), pa.array((key % PLACES).astype(np.int32)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "place", "n"])

    counted = texts.mapInArrow(released(count), "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most PLACES rows of a language
    codes = found.column("lang").combine_chunks().dictionary_encode() if found.num_rows else pa.array([], pa.string()).dictionary_encode()
    names = codes.dictionary.to_pylist()
    languages = sorted(names)
    column = np.array([languages.index(n) for n in names], np.int64)[codes.indices.to_numpy()] if names else np.zeros(0, np.int64)
    counts = np.zeros((PLACES, len(languages)))
    counts[found.column("place").to_numpy(), column] = found.column("n").to_numpy()
    return trigram_table(languages, counts)


def text_evidence(rows: DataFrame, model: Trigrams) -> DataFrame:
    """Each row with ``ll``, its log likelihood by language, and ``n_letters``; the text itself goes."""
    names = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model)  # PLACES * languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.table
        for batch in batches:
            for part in steps(batch, "text", STEP_BYTES // 4):  # a few numbers for each byte
                places, bounds, letter = trigram_places(part.column("text"))
                n = len(bounds) - 1
                ll, letters = np.zeros((n, table.shape[1])), np.zeros(n, np.int64)
                for i in range(n):
                    here = slice(bounds[i], bounds[i + 1])
                    if bounds[i + 1] > bounds[i]:
                        ll[i] = table[places[here]].sum(0, dtype=np.float64)
                        letters[i] = letter[here].sum()
                # overlapping trigrams see each letter three times
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * ll.shape[1], pa.array(ll.ravel() / 3))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), lists, pa.array(letters)], [*names, "ll", "n_letters"])

    kept = rows.select(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", ll array<double>, n_letters long"
    return rows.mapInArrow(released(run), schema)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _declared_log(languages: Sequence[str], declared: Column, right: float) -> Column:
    """Log probability of a declaration under each language; no evidence if it names none of them."""
    wrong = math.log((1 - right) / max(1, len(languages) - 1))
    at = F.array_position(F.array(*(F.lit(x) for x in languages)), declared)
    each = [F.when(at == i + 1, F.lit(math.log(right))).when(at > 0, F.lit(wrong)).otherwise(F.lit(0.0)) for i in range(len(languages))]
    return F.array(*each)


def _sums(n: int, prefix: str = "") -> list[Column]:
    return [F.sum(F.get("p", F.lit(i))).alias(f"{prefix}{i}") for i in range(n)]


def host_priors(rows: DataFrame, n: int, strength: float) -> DataFrame:
    """(host, counts, domain prior) from rows of (host, domain, suffix, p): sums by host, then by
    domain, suffix and over all of those sums."""
    hosts = rows.groupBy("host", "domain", "suffix").agg(*_sums(n, "h"))
    domains = hosts.groupBy("domain", "suffix").agg(*(F.sum(f"h{i}").alias(f"d{i}") for i in range(n)))
    suffixes = domains.groupBy("suffix").agg(*(F.sum(f"d{i}").alias(f"s{i}") for i in range(n)))
    everything = suffixes.agg(*(F.sum(f"s{i}").alias(f"g{i}") for i in range(n)))

    def total(x: str) -> Column:
        return sum((F.col(f"{x}{i}") for i in range(n)), F.lit(0.0))

    shares = suffixes.crossJoin(F.broadcast(everything)).select(  # everything is one row
        "suffix", *(((F.col(f"s{i}") + strength * (F.col(f"g{i}") + 1) / (total("g") + n)) / (total("s") + strength)).alias(f"sp{i}") for i in range(n))
    )
    domains = domains.join(shares, "suffix").select(
        "domain", "suffix", *(((F.col(f"d{i}") + strength * F.col(f"sp{i}")) / (total("d") + strength)).alias(f"dp{i}") for i in range(n))
    )
    return hosts.join(domains, ["domain", "suffix"]).select(
        "host", F.array(*(F.col(f"h{i}") for i in range(n))).alias("_counts"), F.array(*(F.col(f"dp{i}") for i in range(n))).alias("_prior")
    )


def language_id(
    rows: DataFrame, model: Trigrams, languages: Sequence[str] = (), declared_right: float = 0.9, suffix_right: float = 0.7,
    strength: float = 20.0, suffix_language: Mapping[str, str] = SUFFIX_LANGUAGE,
) -> DataFrame:
    """The language of each row of (id, text, declared, host).

    Returns id, lang, probability, text_lang (by text alone), declared, host, n_letters.
    """
    names = model.languages or sorted(languages)
    if not model.languages:
        model = Trigrams(list(names), np.zeros((PLACES, len(names)), np.float32))
    n = len(names)
    clean = rows.select(
        F.col("id").cast("long").alias("id"),
        F.col("text").cast("string").alias("text"),
        F.lower(F.trim("declared")).alias("declared"),
        F.lower(F.coalesce("host", F.lit(""))).alias("host"),
    )
    if not n:
        none = F.lit(None).cast("string")
        return clean.select("id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared", "host", F.lit(0).cast("long").alias("n_letters"))
    seen = text_evidence(clean, model)
    labels = F.split("host", r"\.")
    size = F.size(labels)
    seen = seen.select(
        "*",
        F.when(size > 1, F.element_at(labels, -1)).otherwise("").alias("suffix"),
        F.when(size > 1, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(F.col("host")).alias("domain"),
    ).withColumn("p", _softmax(F.col("ll")))
    seen = staged(seen, "language")
    priors = staged(host_priors(seen, n, strength), "hosts")
    suffixes = F.create_map(*(F.lit(x) for pair in suffix_language.items() for x in pair)) if suffix_language else F.create_map()
    own = F.transform(F.arrays_zip("_counts", "p", "_prior"), lambda x: (F.greatest(x["_counts"] - x["p"], F.lit(0.0)) + strength * x["_prior"]))
    log_prior = F.transform(own, lambda x: F.log(F.greatest(x, F.lit(1e-12))))
    evidence = [F.col("ll"), log_prior, _declared_log(names, F.col("declared"), declared_right), _declared_log(names, F.element_at(suffixes, F.col("suffix")), suffix_right)]
    total = evidence[0]
    for more in evidence[1:]:
        total = F.zip_with(total, more, lambda a, b: a + b)
    listed = F.array(*(F.lit(x) for x in names))

    def best(p: Column) -> Column:
        return F.element_at(listed, F.array_position(p, F.array_max(p)).cast("int"))

    fused = lookup(seen, priors, "host", "inner", keys_from=seen.select("host")).withColumn("_post", _softmax(total))
    return fused.select(
        "id", best(F.col("_post")).alias("lang"), F.array_max("_post").alias("probability"),
        F.when(F.col("n_letters") > 0, best(F.col("p"))).alias("text_lang"), "declared", "host", "n_letters",
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """(id, text, declared, host) of web pages: the text without scripts, styles, comments and tags."""
    bare = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]{1,8};", " ")
    return pages.select(
        F.col("page_id").alias("id"),
        bare.alias("text"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)), F.lit("")).alias("declared"),
        F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1).alias("host"),
    )
