"""Benchmark items in documents, found under new numbers, names and units.

Texts are brought to templates: a unit after a number, every number, in digits or in words, and every
capitalised word inside a sentence become placeholders; other words lose case and signs. Capitalised
words that follow each other are one name, as are the words of one number. Whether the word that begins
a sentence is a name cannot be told, so windows with such a word are taken both ways. All windows of ``width``
template words of the documents meet those of the benchmark by a hash join. Windows with few plain
words (under half) are no evidence. Matches are lined up by the distance of their places; on one
line, each benchmark value (a number, name or unit) must always stand for the same document value,
or the line is a chance likeness and does not count. A document holds an item if its consistent
lines cover ``min_coverage`` of the item's windows.

A text with fewer words than ``width`` is one window. An item that short is looked for in longer
documents too, in windows of its own length: as a template if it has the plain words that any window
needs (half of ``width``), or else by its words as they are. By its words as they are is also how
an item is looked for that has no window with enough plain words (arithmetic, tables, lists of
names); signs and case do not count there either. All values of such windows are compared. The
documents are read once for all these kinds of windows, which are at most two for each length.

Null and empty texts have none; a text of any length is taken whole, as one row. Rows without
an id take no part. Repeated rows and repeated lines count once; an item that occurs twice under one
id counts as the union of its windows. Empty tables give empty results. Only the named columns are
read. Everything is built-in column functions and joins. Before the join, a filter of fixed size drops
windows that cannot be in the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units that may follow a number.
UNITS = (
    "mm cm m km kg g mg lb lbs oz l ml s sec seconds min minutes h hours hour days day weeks week months month years year"
    " meters metres miles mile feet foot inches inch dollars dollar euros euro cents percent degrees mph kmh watts volts"
).split()

# Words for numbers; those that are articles as well are left out.
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ONES = "one two three four five six seven eight nine".split()
NUMBER_WORDS = (
    "zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million"
    " null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend"
    " zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille"
    " cero dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil"
).split()

# control characters, so that plain texts stay in one byte a character: before a placeholder's letter,
# behind the word that begins a sentence, and between the words of one name or number
HOLDS, STARTS, JOINT = "\x01", "\x02", "\x03"
NUMBER, NAME, UNIT = f"{HOLDS}n", f"{HOLDS}a", f"{HOLDS}u"
#: All words for numbers up to a hundred and for some beyond.
NUMERALS = [*TENS, *ONES, *NUMBER_WORDS, *(f"{t}{JOINT}{o}" for t in TENS for o in ONES)]
#: Benchmark windows up to which they are sent to every task: 64 bytes each, so 13 MB at most.
SENT_WINDOWS = 200_000


#: Bits of the filter that document windows pass before they are joined, for each benchmark window, and
#: how many there are at least and at most: half a megabyte.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 18, 1 << 22


class Kind(NamedTuple):
    """Windows that some items need beside those of ``width`` template words."""

    size: int
    raw: bool  # of the words as they are

    @property
    def column(self) -> str:
        return f"windows_{self.size}_{'raw' if self.raw else 'template'}"


def _parts(text: Column) -> Column:
    """Lower-case words between signs and white space."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}\x01-\x03]+"), lambda w: w != "")


def templates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, base, words, raw): each text's words with a mark behind those that begin sentences, its
    template words, and its words as they are where the regular expressions made placeholders (else null).
    """
    capital = r"\p{Lu}[\p{L}\p{M}]"
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    bare = F.translate(F.col(text).cast("string"), f"{HOLDS}{STARTS}{JOINT}", "")
    # words of one name or number become one word
    whole = F.regexp_replace(bare, rf"\b({capital}+)[ \t]{{1,3}}(?={capital})", f"$1{JOINT}")
    whole = F.regexp_replace(whole, rf"(?i)(?<=ty)[ -](?=(?:{'|'.join(ONES)})\b)", JOINT)
    counted = F.regexp_replace(F.col("_source"), rf"(\d\s?)(?i:{units})\b", f"$1{UNIT}")
    names = F.regexp_replace(counted, rf"\p{{Lu}}(?<=[\p{{L}}\p{{N}},;]\s.)[\p{{L}}\p{{M}}{JOINT}]+", NAME)
    begins = F.regexp_replace(names, rf"({capital}[\p{{L}}\p{{M}}{JOINT}]*)", f"$1{STARTS}")
    numbers = F.regexp_replace(begins, r"\d+(?:[.,:/]\d+)*", NUMBER)
    joined = F.regexp_replace(F.col("_source"), r"(?<=\d)[.,:/](?=\d)", "")  # a number stays one word
    known = rows.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
    formed = known.select(F.col(key).alias("key"), whole.alias("_source"))
    formed = formed.select("key", "_source", numbers.alias("_template"))
    formed = formed.select("key", _parts(F.col("_template")).alias("base"), F.when(F.instr("_template", HOLDS) > 0, _parts(joined)).alias("raw"))

    return formed.select("key", "base", F.transform("base", lambda _, i: template_word(i)).alias("words"), "raw")


def bare_word(w: Column) -> Column:
    """A word without the mark of a beginning."""
    return F.rtrim(w, F.lit(STARTS))


def template_word(place: Column) -> Column:
    """The template word at a place: number words, and units behind them, are placeholders too."""
    own, before = bare_word(F.get("base", place)), bare_word(F.get("base", place - 1))
    measured = F.coalesce(before.isin(NUMERALS), F.lit(False))
    return F.when(own.isin(NUMERALS), NUMBER).when(own.isin(UNITS) & measured, UNIT).otherwise(own)


def value(place: Column, begins: bool = False) -> Column:
    """The word that stands at a placeholder, and with ``begins`` that which begins a sentence; else null."""
    own = F.coalesce(F.get("raw", place), bare_word(F.get("base", place)))
    stands = F.instr(template_word(place), HOLDS) > 0
    return F.when(stands | F.endswith(F.get("base", place), F.lit(STARTS)) if begins else stands, own)


def word_hash(word: str) -> int:
    """What ``F.xxhash64`` gives for a word."""
    return int.from_bytes(xxhash.xxh64_digest(word.encode(), seed=42), "big", signed=True)


def hashed(parts: DataFrame, width: int, kinds: Sequence[Kind] = (), likely: Callable[[Column], Column] | None = None) -> DataFrame:
    """``parts`` with ``windows``, the hash of every window, ``_first``, the places of words that begin a
    sentence, ``begins``, the places of windows with such a word (between ``likely`` neighbours), ``named``,
    the hashes of the words with those as names, and the hashes of the windows of each of ``kinds``."""
    # a pass over the strings and one over their hashes: these run for every word of the corpus
    bare = F.transform("base", lambda w: F.when(F.endswith(w, F.lit(STARTS)), F.xxhash64(bare_word(w))).otherwise(F.xxhash64(w)))
    numerals, units = ([word_hash(w) for w in some] for some in (NUMERALS, UNITS))

    def placeholders(h: Column, i: Column) -> Column:
        measured = F.coalesce(F.get("_bare", i - 1).isin(numerals), F.lit(False))
        special = F.when(h.isin(numerals), F.lit(word_hash(NUMBER))).when(measured, F.lit(word_hash(UNIT))).otherwise(h)
        return F.when(h.isin([*numerals, *units]), special).otherwise(h)

    hashes = [F.transform("_bare", placeholders).alias("_hashes")]
    if any(k.raw for k in kinds):
        hashes.append(F.transform(F.coalesce("raw", F.transform("base", bare_word)), lambda w: F.xxhash64(w)).alias("_raw_hashes"))
    # _hashes is named more than once, so that it stays a column and is not computed in each window
    each = parts.withColumn("_bare", bare).select("*", *hashes).drop("_bare")
    last = F.greatest(F.size("_hashes") - width, F.lit(0))
    every = F.when(F.size("_hashes") > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("_hashes", i + 1, width))))
    first = F.filter(F.transform("base", lambda w, i: F.when(F.endswith(w, F.lit(STARTS)), i)), lambda i: i.isNotNull())
    named = F.zip_with("base", "_hashes", lambda w, h: F.when(F.endswith(w, F.lit(STARTS)), F.lit(word_hash(NAME))).otherwise(h))

    def own(kind: Kind) -> Column:
        source = "_raw_hashes" if kind.raw else "_hashes"
        starts = F.sequence(F.lit(0), F.greatest(F.size(source) - kind.size, F.lit(0)))
        found = F.transform(starts, lambda i: F.xxhash64(F.slice(source, i + 1, kind.size), F.lit(int(kind.raw))))
        return F.when(F.size(source) >= kind.size, found).otherwise(F.array().cast("array<bigint>"))

    columns = {"windows": every, "_last": last, "_first": first, "named": named} | {k.column: own(k) for k in kinds}
    each = each.withColumns(columns)

    def places(low: Column, high: Column, wanted: Column) -> Column:
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.col("_last"))
        return F.when(wanted & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    def around(s: Column) -> Column:
        # a window holds two neighbours of the word: behind it, on both sides, or before it where it is last
        ahead, beside, behind = (F.lit(True) if likely is None else likely(pair) for pair in neighbours(s))
        return F.concat(places(s - (width - 3), s, ahead), places(s - (width - 2), s - (width - 2), beside), places(s - (width - 1), s - (width - 1), behind))

    short = F.when(F.size("_first") > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    begins = F.when(F.size("base") <= width, short).otherwise(F.array_distinct(F.flatten(F.transform("_first", around))))
    return each.withColumn("begins", begins).drop("_last", "_hashes", "_raw_hashes")


def neighbours(s: Column) -> tuple[Column, Column, Column]:
    """Hashes of the two words behind, on both sides of, and before the one at a place."""
    near = ((1, 2), (-1, 1), (-2, -1))
    return tuple(F.xxhash64(F.get("named", s + a), F.get("named", s + b), F.lit(a)) for a, b in near)


def own_rows(kind: Kind, wanted: Callable[[Column], Column]) -> Column:
    """Rows as in ``rows_of`` of the windows of a kind: one for each two values from both ends inwards."""
    windows = F.col(kind.column)
    places = F.when(F.size(windows) > 0, F.sequence(F.lit(0), F.size(windows) - 1)).otherwise(F.array().cast("array<int>"))

    def two(i: Column, k: int) -> Column:
        name = F.get(windows, i) if k == 0 else F.xxhash64(F.get(windows, i), F.lit(k))
        return F.struct(i.alias("at"), name.alias("hash"), value(i + k).alias("first"), value(i + kind.size - 1 - k).alias("last"))

    def rows(i: Column) -> Column:
        return F.array(*(two(i, k) for k in range((kind.size + 1) // 2)))

    return F.flatten(F.transform(F.filter(places, lambda i: wanted(F.get(windows, i))), rows))


def rows_of(
    parts: DataFrame, width: int, wanted: Callable[[Column], Column], *more: Callable[[Column, bool], Column], kinds: Sequence[Kind] = ()
) -> DataFrame:
    """(key, at, hash, first, last, ...) of the ``wanted`` windows, those of ``kinds`` among them:
    place, hash, and the values behind the first and the last word."""
    end = F.size("base") - 1

    def row(i: Column, name: Column, begins: bool) -> Column:
        own = [i.alias("at"), name.alias("hash"), value(i, begins).alias("first"), value(F.least(i + width - 1, end), begins).alias("last")]
        return F.struct(*own, *(f(i, begins) for f in more))

    def name(i: Column) -> Column:
        return F.xxhash64(F.slice("named", i + 1, width))

    plain = F.transform("windows", lambda h, i: F.when(wanted(h), row(i, h, False)))
    named = F.transform("begins", lambda i: F.when(wanted(name(i)), row(i, name(i), True)))
    found = [F.filter(x, lambda r: r.isNotNull()) for x in (plain, named)]
    return parts.select("key", F.inline(F.concat(*found, *(own_rows(k, wanted) for k in kinds))))


def kinds_of(parts: DataFrame, width: int) -> DataFrame:
    """``parts`` of the items that need windows of a kind of their own, with its ``length`` and ``as_is``."""
    plain = lambda words: F.size(F.filter(words, lambda w: F.instr(w, HOLDS) == 0))
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
    eligible = F.exists(starts, lambda i: 2 * plain(F.slice("words", i + 1, width)) >= width)
    some = parts.filter((n > 0) & ((n < width) | ~eligible))
    return some.withColumns({"length": F.least(F.lit(width), n), "as_is": (n >= width) | (2 * plain(F.col("words")) < width)})


def bit_filter(hashes: DataFrame, bits: int) -> Callable[[Column], Column]:
    """Whether a hash may be among ``hashes``: a fixed number of bits, a power of two, set by grouped aggregation."""
    word, bit = f"int(shiftright(hash & {bits - 1}L, 6))", "int(hash & 63L)"
    sets = hashes.groupBy(F.expr(word).alias("w")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("b"))
    held = [0] * (bits // 64)
    for r in sets.collect():  # at most bits / 64 rows
        held[r["w"]] = r["b"]
    array = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")
    return lambda h: F.getbit(F.get(array, F.shiftright(h.bitwiseAND(F.lit(bits - 1).cast("long")), 6).cast("int")), h.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1


def contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = 6, min_coverage: float = 0.5,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, n_values, n_changed) of each item a document holds.

    ``n_values`` counts the item's distinct values on its best line, ``n_changed`` those that
    differ in the document: above 0 for a question under new parameters.
    """
    size = lambda i, begins: F.least(F.lit(width), F.size("words")).alias("size")

    def plain(i: Column, begins: bool) -> Column:
        some = F.filter(F.slice("words", i + 1, width), lambda w: F.instr(w, HOLDS) == 0)
        first = F.filter(F.slice("base", i + 1, width), lambda w: F.endswith(w, F.lit(STARTS)) & ~bare_word(w).isin(NUMERALS))
        return (F.size(some) - F.size(first) if begins else F.size(some)).alias("plain")

    source = templates(benchmark, item_column, item_text)
    asked = hashed(source, width)
    items = rows_of(asked, width, lambda h: h.isNotNull(), plain, size)
    items = items.filter(2 * F.col("plain") >= F.col("size")).drop("plain", "size")
    special = kinds_of(source, width)
    kinds = sorted(Kind(*r) for r in special.select("length", "as_is").distinct().collect())  # at most 2 * width rows
    for kind in kinds:
        theirs = hashed(special.filter((F.col("length") == kind.size) & (F.col("as_is") == kind.raw)), width, [kind])
        items = items.unionByName(theirs.select("key", F.inline(own_rows(kind, lambda h: h.isNotNull()))))
    items = items.select(
        F.col("key").alias("item_id"), F.col("at").alias("item_at"), "hash", F.col("first").alias("item_first"), F.col("last").alias("item_last")
    )
    items = items.dropDuplicates(["item_id", "item_at", "hash"])
    totals = items.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows"))
    n_windows = items.count()
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * n_windows):
        bits *= 2
    likely = bit_filter(items.select("hash"), bits)
    if n_windows <= SENT_WINDOWS:  # the same rows either way
        items = F.broadcast(items)
    pairs = asked.select(F.explode(F.flatten(F.transform("_first", lambda s: F.array(*neighbours(s))))).alias("hash"))
    own = hashed(templates(docs, id_column, text_column), width, kinds, bit_filter(pairs, bits) if width >= 3 else None)
    found = rows_of(own, width, likely, kinds=kinds).withColumnRenamed("key", "doc_id").join(items, "hash")

    def pair(a: str, b: str) -> Column:
        return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(F.col(a).alias("item"), F.col(b).alias("doc")))

    line = ["doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("line")]
    # at most one window of an item at each of its places on a line: lists as long as the item
    lines = found.groupBy(*line).agg(
        F.collect_set("item_at").alias("places"),
        F.array_union(F.collect_set(pair("item_first", "first")), F.collect_set(pair("item_last", "last"))).alias("values"),
    )
    names = F.array_distinct(F.transform("values", lambda v: v["item"]))
    lines = lines.filter(F.size(names) == F.size("values")).select(
        "doc_id", "item_id", "places",
        F.struct(
            F.size("places").alias("n"), F.size("values").alias("n_values"),
            F.size(F.filter("values", lambda v: v["item"] != v["doc"])).alias("n_changed"),
        ).alias("best"),
    )
    covered = lines.select("doc_id", "item_id", "best", F.explode("places").alias("place")).groupBy("doc_id", "item_id")
    held = covered.agg(F.countDistinct("place").alias("n"), F.max("best").alias("best")).join(totals, "item_id")
    coverage = F.col("n") / F.col("n_windows")
    return held.filter(coverage >= min_coverage).select(
        "doc_id", "item_id", F.col("n").alias("n_windows"), coverage.alias("coverage"), F.col("best.n_values").alias("n_values"), F.col("best.n_changed").alias("n_changed")
    )
