"""Near-duplicate documents through an inverted join of min-hash signatures.

A document's set is its distinct runs of ``width`` lower-case words. Documents with equal sets form
a class; the smallest id stands for it, so copies never meet one by one. Each class has a signature
of ``COORDINATES`` minima and is posted under every (coordinate, value) pair. A value that only one
class has links nothing and is skipped, and a class with fewer than ``MATCHES`` shared values cannot
reach that many collisions with any other, so it is skipped as a whole. What is left is merged under
the first ``PREFIX`` coordinates only. Two classes of similarity s agree on none of them with chance
(1 - s) ** PREFIX: 1e-6 at 0.75; and on fewer than MATCHES of all with chance 1e-5 there.

A list of n classes is not expanded into n * n pairs. First every class meets a few members of each
of its lists, the best of those with enough collisions is confirmed on the full sets, and components
of the confirmed links follow. After that most lists lie within one component. In the others, every class outside the list's largest component still meets all classes of other components
there, in blocks of a bounded number of bytes: collisions are counted, full sets confirm, and only links that
join two components are passed on. So every pair that collides often enough is either tested or
already connected, whatever the size of a list.

Null and empty texts have no set and are linked with nothing; with fewer than ``width`` words, the
whole sequence is the one shingle. Rows that repeat an id are judged by their own text. Texts are read
whole, of any length: one beyond the size of a step is a step of its own, and a set larger than a block
is a block of its own. A null id
takes part through its class but is never the smallest; alone it has a null component and is kept.
Empty tables give empty results. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import fresh, released, staged, steps, uniques, words
from fareloom.llm.components import components

COORDINATES, MATCHES, PREFIX = 64, 32, 10
#: Members of each list that all its classes meet.
HEADS = 3
#: Bytes of full sets in a block of a list.
BLOCK_BYTES = 8 << 20
#: Bytes of a signature, which every class has besides its set.
SIG_BYTES = 4 * COORDINATES

_CHANCE = np.random.default_rng(41)
_MULTIPLY = _CHANCE.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _CHANCE.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_BY_PLACE = _CHANCE.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's set, as sorted 64-bit hashes."""
    flat, bounds = words(texts)
    distinct, place = uniques(flat)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in distinct), np.uint64, len(distinct))
    hashes = hashes[place] if len(flat) else np.zeros(0, np.uint64)
    n = max(0, len(hashes) - width + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs += hashes[k : k + n] * _BY_PLACE[k]
    runs = _mixed(runs)
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        elif b > a:
            short = (hashes[a:b] * _BY_PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield _mixed(np.array([short]))
        else:
            yield np.zeros(0, np.uint64)


def signature(own: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate's hash over a set."""
    out = np.empty(COORDINATES, np.uint32)
    for k in range(COORDINATES):
        out[k] = ((own * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).min()
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n, fp_a, fp_b, sig): size of the set, two hashes of it, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                n, a, b, sig = [], [], [], []
                for own in shingle_sets(part.column("text"), width):
                    n.append(len(own))
                    a.append(own.sum(dtype=np.uint64))
                    b.append(_mixed(own ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64))
                    sig.append(signature(own).view(np.int32) if len(own) else None)
                numbers = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int32()), *numbers, pa.array(sig, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "fp_a", "fp_b", "sig"])

    return docs.mapInArrow(released(run), "doc_id long, text_hash long, n int, fp_a long, fp_b long, sig array<int>")


def sets_of(texts: DataFrame, width: int) -> DataFrame:
    """(rep, fp_a, want, set) of (rep, want, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                own = list(shingle_sets(part.column("text"), width))
                a = np.array([x.sum(dtype=np.uint64) for x in own], np.uint64).view(np.int64)
                lists = pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(a), part.column("want"), lists], ["rep", "fp_a", "want", "set"])

    return texts.mapInArrow(released(run), "rep long, fp_a long, want long, set array<long>")


def _alike(common, n_a, n_b, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def star_links(posts: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of each class with the likeliest of the heads of its lists."""
    heads = posts.groupBy("key").agg(
        F.array_distinct(F.array(*(F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(HEADS)))).alias("heads")
    )
    pairs = posts.join(staged(heads, "heads"), "key").select("rep", F.explode("heads").alias("head")).filter(F.col("rep") != F.col("head")).distinct()
    sig = classes.select("rep", "sig")
    met = pairs.join(sig, "rep").join(sig.select(F.col("rep").alias("head"), F.col("sig").alias("head_sig")), "head")
    same = F.size(F.filter(F.zip_with("sig", "head_sig", lambda a, b: a == b), lambda x: x))
    best = met.select("rep", "head", same.alias("same")).filter(F.col("same") >= MATCHES).groupBy("rep").agg(F.max_by("head", F.struct("same", "head")).alias("head"))
    both = best.join(sets, "rep").join(sets.select(F.col("rep").alias("head"), F.col("set").alias("head_set")), "head")
    common = F.size(F.array_intersect("set", "head_set"))
    return both.filter(_alike(common, F.size("set"), F.size("head_set"), percent)).select(F.col("rep").alias("a"), F.col("head").alias("b"))


def _labels(reps: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, n, comp) of every class in ``reps``."""
    found = components(links).withColumnRenamed("id", "rep")
    return staged(reps.join(found, "rep", "left").select("rep", "n", F.coalesce("component", "rep").alias("comp")), "labels")


def block_links(posts: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components within a list, every pair across them tested."""
    lists = posts.join(found, "rep").withColumn("bytes", 8 * F.col("n").cast("long") + SIG_BYTES)
    sizes = lists.groupBy("key", "comp").agg(F.sum("bytes").alias("bytes"))
    keys = sizes.groupBy("key").agg(F.max_by("comp", F.struct("bytes", "comp")).alias("major"), F.max("bytes").alias("most"), F.sum("bytes").alias("all"))
    keys = keys.filter(F.col("most") < F.col("all")).select(
        "key", "major", F.ceil((F.col("all") - F.col("most")) / BLOCK_BYTES).cast("int").alias("rows"), F.ceil(F.col("all") / BLOCK_BYTES).cast("int").alias("cols")
    )
    open_lists = lists.join(staged(keys, "open"), "key")

    def side(rows: DataFrame, own: str, other: str, name: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("rep", F.lit(name)), F.col(own)).cast("int").alias(own[0])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])
        return rows.select("key", "rep", "comp", mine, every, F.lit(name).alias("side"))

    dealt = side(open_lists.filter(F.col("comp") != F.col("major")), "rows", "cols", 0).unionByName(side(open_lists, "cols", "rows", 1))
    full = dealt.join(classes.select("rep", "sig").join(sets.select("rep", "set"), "rep"), "rep")
    # one task sees whole blocks, one after the other
    full = full.repartition("key", "r", "c").sortWithinPartitions("key", "r", "c", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ends = np.flatnonzero(_changes(batch)) + 1
            cuts = [0, *ends.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and not _same_block(held[-1], batch, a):
                    yield from _links(held, percent)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from _links(held, percent)

    return full.select("key", "r", "c", "side", "rep", "comp", "sig", "set").mapInArrow(released(run), "a long, b long")


def _changes(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(c).to_numpy() for c in ("key", "r", "c")]
    return np.any([x[1:] != x[:-1] for x in columns], axis=0)


def _same_block(held: pa.RecordBatch, batch: pa.RecordBatch, at: int) -> bool:
    return all(held.column(c)[0] == batch.column(c)[at] for c in ("key", "r", "c"))


def _links(held: list[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of one block pair that join components not yet joined in it."""
    table = pa.Table.from_batches(held).combine_chunks()
    side = table.column("side").to_numpy()
    if side.min() == side.max():
        return
    rep, comp = table.column("rep").to_numpy(), table.column("comp").to_numpy()
    sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(len(rep), COORDINATES)
    lists = table.column("set").combine_chunks()
    bounds, values = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
    size = np.diff(bounds)
    coordinate = int(table.column("key")[0].as_py()) >> 32
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    root = {c: c for c in np.unique(comp).tolist()}

    def top(c: int) -> int:
        while root[c] != c:
            c = root[c]
        return c

    found = []
    for i in left:
        agree = sig[right] == sig[i]
        # a pair is tested in the first list that both are in
        first = agree[:, :PREFIX].argmax(1) == coordinate
        for j in right[first & (agree.sum(1) >= MATCHES) & (comp[right] != comp[i])]:
            a, b = top(int(comp[i])), top(int(comp[j]))
            if a == b:
                continue
            common = len(np.intersect1d(values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]], assume_unique=True))
            if _alike(common, int(size[i]), int(size[j]), percent):
                root[max(a, b)] = min(a, b)
                found.append((int(rep[i]), int(rep[j])))
    if found:
        a, b = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def groups(docs: DataFrame, width: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, n, component, component_id) of every row: the size of its set, a number of its
    component (null without a set, or where no row of its class has an id), and the smallest id there."""
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    marks = staged(signatures(rows, width), "signatures")
    prints = ["fp_a", "fp_b", "n"]
    classes = marks.filter(F.col("n") > 0).groupBy(*prints).agg(F.min("doc_id").alias("cls"), F.first("sig").alias("sig"))
    # classes are told apart by their prints: an id may stand for two texts
    classes = staged(classes.filter(F.col("cls").isNotNull()).withColumn("rep", F.xxhash64(*prints)), "classes")
    spread = classes.select("rep", F.posexplode("sig").alias("at", "value"))
    key = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
    posts = spread.select("rep", key.alias("key"))
    # counted before the shuffle, and joined from a table: a value that very many classes share is split
    shared = staged(posts.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("key"), "shared")
    live = staged(posts.join(shared, "key"), "posts")
    able = live.groupBy("rep").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= MATCHES).select("rep")
    prefix = live.filter(F.col("key") < F.lit(PREFIX << 32).cast("long")).join(able, "rep", "left_semi")
    lists = staged(prefix.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("key"), "kept-keys")
    posts = staged(prefix.join(lists, "key", "left_semi"), "lists")
    reps = staged(posts.select("rep").distinct(), "reps")
    chosen = classes.join(reps, "rep", "left_semi")
    texts = rows.join(chosen.select(F.col("cls").alias("doc_id"), "rep", F.col("fp_a").alias("want")), "doc_id").select("rep", "want", "text")
    sets = sets_of(texts, width).filter(F.col("fp_a") == F.col("want")).select("rep", "set").dropDuplicates(["rep"])
    sets = staged(sets, "sets")
    chosen = staged(chosen.select("rep", "sig", "n"), "chosen")
    links = staged(star_links(posts, chosen, sets, percent), "star")
    sized = chosen.select("rep", "n")
    found = _labels(sized, links)
    found = _labels(sized, links.union(staged(block_links(posts, found, chosen, sets, percent), "blocks")))
    named = classes.select("rep", "cls", *prints).join(found.select("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    least = staged(named.groupBy("comp").agg(F.min("cls").alias("component_id")), "smallest")
    named = staged(named.join(least, "comp").select(*prints, F.col("comp").alias("component"), "component_id"), "named")
    return marks.select("doc_id", "text_hash", *prints).join(named, prints, "left").drop("fp_a", "fp_b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    out = groups(docs, width, percent, id_column, text_column)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group, with all its columns: the smallest id's, and of its texts the one with the
    smallest hash. Rows without a set, or without an id, stay, but of rows that repeat id and text one.
    """
    found = staged(groups(docs, width, percent, id_column, text_column), "groups").filter(F.col("doc_id").isNotNull())
    grouped = found.filter(F.col("component").isNotNull())
    first = grouped.groupBy("component").agg(F.min("doc_id").alias("doc_id"))
    # of the smallest id's rows in a group the one with the smallest hash: numbers only, so added up before the shuffle
    chosen = grouped.join(staged(first, "first"), ["component", "doc_id"]).groupBy("component", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    kept = chosen.select("doc_id", "text_hash").union(found.filter(F.col("component").isNull()).select("doc_id", "text_hash")).distinct()
    own, text = fresh(docs, "row_id"), fresh(docs, "row_text")
    rows = docs.withColumns({own: F.col(id_column).cast("long"), text: F.xxhash64(F.col(text_column).cast("string"))})
    kept = staged(kept.select(F.col("doc_id").alias(own), F.col("text_hash").alias(text)), "kept")
    plain = [f.name for f in docs.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
    whole = fresh(docs, "row")
    # rows that repeat id and text are reduced to one before they are shuffled
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias(whole)
    some = rows.filter(F.col(own).isNotNull()).groupBy(own, text).agg(one).join(kept, [own, text], "left_semi")
    return some.select(f"{whole}.*").unionByName(rows.filter(F.col(own).isNull()).select(docs.columns))
