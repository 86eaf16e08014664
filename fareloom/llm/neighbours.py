"""Nearest vectors by an inverted multi-index.

The sample's mean is taken from every vector first: a query's product with it is the same for all, so
the order stays, and what is left points in all directions even where the vectors lie to one side.
Each half of such a direction is quantised by a codebook of its own. A pair of centroids and a
tier of lengths (steps of a third of a doubling around the median; one tier if lengths are alike)
name a cell. A vector of length s is among the nearest if its direction's product with the query is
above t / s, where t is the score of the last one wanted, as a probe of the sample puts it. So cells
are visited in order of how much the sum of the query halves' products with the centroids is above
t / s of their tier, the largest first, found with a heap over the two sorted lists, until the
visited cells hold ``share`` of all distinct vectors (``least`` at least). Their vectors are reranked
by their exact inner product. The share follows the data: some queries are tried on the sample, and it is the
share at which ``recall`` of their nearest vectors there have been met. On vectors without any structure a
query's neighbours lie in most cells, so that it is large; where vectors form clusters it is small.

Codebooks are fitted on a bounded sample (``sample`` vectors, by a hash of the id); every row is
indexed. Neighbouring cells are laid into shelves of about ``block`` rows, and a cell with more is
dealt over several, so a cell with a third of all rows is spread; the queries that visit a shelf are
dealt into blocks of ``crowd``. A shelf and a block of queries meet in one small matrix product. Copies
count once towards the share, so a cell full of copies does not end the search.

Null, zero and non-finite vectors, vectors with null components or of another length than most, and
rows without an id take no part. Rows that repeat an id are all candidates, but one id is listed once
for a query, by its best score; of query rows that repeat an id, the one with the smallest vector asks. Ties go to the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import released, staged

SAMPLE = 20_000

#: Vectors of the sample that a query is tried on to guess its last score: 1 MB at 64 components.
PROBE = 2000

#: Queries on which the share is measured, and nearest vectors of the sample that each must meet at least.
TRIED, MET = 128, 4

#: Tiers of lengths below and above the median's; what is shorter or longer goes to the outermost.
TIERS = (-6, 12)


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the rows that take part, as double precision."""
    kept = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return kept.filter(F.col("id").isNotNull() & (F.size("v") > 0) & sound & F.exists("v", lambda x: x != 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """Lloyd's rounds from distinct random rows; empty centroids stay where they are."""
    x = np.unique(x, axis=0)
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        for j in np.flatnonzero(n):
            centres[j] = x[near == j].mean(0)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(x, centres).argmin(1)


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the lengths; a zero vector stays one."""
    most = np.abs(v).max(1)
    v = v / np.where(most > 0, most, 1)[:, None]
    length = np.sqrt((v * v).sum(1))
    return v / np.where(length > 0, length, 1)[:, None], most * length


def tiers(lengths: np.ndarray, middle: float) -> np.ndarray:
    """Tiers of lengths, counted from 0."""
    step = np.floor(3 * np.log2(np.maximum(lengths / middle, 2.0 ** TIERS[0])) + 0.5)
    return np.clip(step, *TIERS).astype(np.int64) - TIERS[0]


def multi_sequence(left: np.ndarray, right: np.ndarray, sizes: dict[int, int], budget: float, offsets: dict[int, float] | None = None) -> list[int]:
    """Cells in order of summed cost until those visited hold ``budget`` vectors.

    ``left`` and ``right`` are the costs of the centroids of the two halves, ``offsets`` those of the
    tiers. A cell goes on the heap when both its neighbours nearer to the origin have been taken.
    """
    offsets = offsets or {0: 0.0}
    rank_l, rank_r = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    cost_l, cost_r = left[rank_l].tolist(), right[rank_r].tolist()
    heap = [(cost_l[0] + cost_r[0] + x, t, 0, 0) for t, x in offsets.items()]
    heapq.heapify(heap)
    all_taken = {t: [0] * len(rank_l) for t in offsets}
    found, held = [], 0
    while heap and held < budget:
        _, t, i, j = heapq.heappop(heap)
        taken, x = all_taken[t], offsets[t]
        cell = (t * len(rank_l) + int(rank_l[i])) * len(rank_r) + int(rank_r[j])
        taken[i] = j + 1
        if cell in sizes:
            found.append(cell)
            held += sizes[cell]
        if i + 1 < len(rank_l) and taken[i + 1] == j:
            heapq.heappush(heap, (cost_l[i + 1] + cost_r[j] + x, t, i + 1, j))
        if j + 1 < len(rank_r) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (cost_l[i] + cost_r[j + 1] + x, t, i, j + 1))
    return found


def lay(cells: list[tuple[int, int]], block: int) -> list[tuple[int, int, int]]:
    """(cell, first shelf, shelves): cells in order on shelves of about ``block`` rows."""
    laid, shelf, used = [], 0, 0
    for cell, n in cells:
        if used and used + n > block:
            shelf, used = shelf + 1, 0
        parts = -(-n // block)
        laid.append((int(cell), shelf, parts))
        shelf, used = (shelf + parts, 0) if parts > 1 else (shelf, used + n)
    return laid


def needed_share(
    tried: list[tuple[int, np.ndarray]], ids: np.ndarray, x: np.ndarray, cells: np.ndarray, ordered: Callable, k: int, recall: float
) -> float:
    """The share of the sample in the cells visited when ``recall`` of the queries' ``k`` nearest sample
    vectors have been met; ``ordered`` gives the cells in a query's order."""
    sizes = {int(c): int(n) for c, n in zip(*np.unique(cells, return_counts=True), strict=True)}
    met = []
    for own, q in tried:
        score = np.where(ids == own, -np.inf, x @ q)
        near = np.argpartition(-score, min(k, len(score) - 1))[:k]
        order = ordered(q, sizes)
        before = dict(zip(order, np.cumsum([sizes[c] for c in order]).tolist(), strict=True))
        met += [before[int(c)] / len(x) for c in cells[near[np.isfinite(score[near])]]]
    return float(np.quantile(met, recall, method="higher")) if met else 1.0


def inverted_multi_index(
    rows: DataFrame, queries: DataFrame, k: int = 20, centroids: int = 24, share: float | None = None, least: int = 4000, block: int = 8192, crowd: int = 512,
    id_column: str = "vec_id", vector_column: str = "embedding", sample: int = SAMPLE, recall: float = 0.96,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, its own id apart.

    Without ``share``, cells are visited until ``recall`` of the nearest vectors should have been met.
    """
    spark = rows.sparkSession
    base, asked = usable(rows, id_column, vector_column), usable(queries, id_column, vector_column)
    taken = base.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(sample).collect()
    lengths = pd.Series([len(r["v"]) for r in taken], dtype="int64").mode()
    dim = int(lengths.iloc[0]) if len(lengths) else 0
    schema = "query_id long, rank int, vec_id long, score double"
    if dim < 2:
        return spark.createDataFrame([], schema)
    base, asked = base.filter(F.size("v") == dim), asked.filter(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    sampled = np.array([r["id"] for r in taken if len(r["v"]) == dim])
    whole = np.array([r["v"] for r in taken if len(r["v"]) == dim])
    mean = whole.mean(0)
    probe = whole[:PROBE] - mean
    x, lengths = directions(whole - mean)
    half, middle = dim // 2, float(np.median(lengths[lengths > 0])) if lengths.any() else 1.0
    books = (kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids))
    height, width = len(books[0]), len(books[1])

    def cell_of(unit: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (tiers(length, middle) * height + nearest(unit[:, :half], books[0])) * width + nearest(unit[:, half:], books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(-1, dim)
            unit, length = directions(v - mean)
            cell = cell_of(unit, length)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int64))], ["id", "v", "cell"])

    indexed = staged(base.mapInArrow(released(assign), "id long, v array<double>, cell long"), "multi-index")
    counted = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("v")).alias("distinct"))
    cells = sorted(tuple(r) for r in counted.collect())  # at most centroids ** 2 cells a tier
    distinct = {c: int(d) for c, _, d in cells}
    scales = {t: middle * 2 ** ((t + TIERS[0]) / 3) for t in sorted({c // (height * width) for c in distinct})}
    rank = min(len(probe), max(1, round(k * len(probe) / max(1, sum(n for _, n, _ in cells)))))
    if share is None:
        total = sum(n for _, n, _ in cells)
        tried = [(r["id"], np.array(r["v"])) for r in asked.orderBy(F.xxhash64("id", F.lit(37)), "id").limit(TRIED).collect()]

        def ordered(q: np.ndarray, sizes: dict[int, int]) -> list[int]:
            last = np.partition(probe @ q, len(probe) - rank)[len(probe) - rank]
            offsets = {t: float(last) / s for t, s in scales.items()}
            return multi_sequence(-q[:half] @ books[0].T, -q[half:] @ books[1].T, sizes, float("inf"), offsets)

        share = needed_share(tried, sampled, whole, cell_of(x, lengths), ordered, max(MET, round(k * len(whole) / max(1, total))), recall)
    budget = max(least, share * sum(distinct.values()))
    shelves = lay([(c, n) for c, n, _ in cells], block)
    first_shelf = {c: (first, parts) for c, first, parts in shelves}

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, shelf, wanted = batch.column("id"), [], [], []
            v = batch.column("v").flatten().to_numpy().reshape(-1, dim)
            left, right = -v[:, :half] @ books[0].T, -v[:, half:] @ books[1].T
            last = np.partition(v @ probe.T, len(probe) - rank, axis=1)[:, len(probe) - rank]
            for i in range(len(v)):
                by_shelf: dict[int, list[int]] = {}
                offsets = {t: float(last[i]) / s for t, s in scales.items()}
                for cell in multi_sequence(left[i], right[i], distinct, budget, offsets):
                    first, parts = first_shelf[cell]
                    for s in range(first, first + parts):
                        by_shelf.setdefault(s, []).append(cell)
                at += [i] * len(by_shelf)
                shelf += list(by_shelf)
                wanted += list(by_shelf.values())
            columns = [ids.take(pa.array(at, pa.int64())), batch.column("v").take(pa.array(at, pa.int64()))]
            columns += [pa.array(shelf, pa.int64()), pa.array(wanted, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "shelf", "cells"])

    visits = staged(asked.mapInArrow(released(visit), "id long, v array<double>, shelf long, cells array<long>"), "visits")
    crowds = {r["shelf"]: -(-r["n"] // crowd) for r in visits.groupBy("shelf").agg(F.count(F.lit(1)).alias("n")).collect()}
    salt = F.xxhash64("id", "v", F.lit(31))
    # bounded: a row for each cell, and one for each shelf
    by_cell = F.broadcast(spark.createDataFrame(shelves or [(-1, 0, 1)], "cell long, _first long, _parts int"))
    by_shelf = F.broadcast(spark.createDataFrame([(int(s), int(n)) for s, n in crowds.items()] or [(-1, 1)], "shelf long, _crowds int"))
    entries = (
        indexed.join(by_cell, "cell")
        .withColumn("shelf", F.col("_first") + F.pmod(salt, F.col("_parts")))
        .join(by_shelf, "shelf")
        .select("shelf", "id", "v", "cell", F.explode(F.sequence(F.lit(0), F.col("_crowds") - 1)).alias("crowd"))
    )
    visitors = visits.join(by_shelf, "shelf").select("shelf", "id", "v", "cells", F.pmod(salt, F.col("_crowds")).cast("int").alias("crowd"))

    def rerank(here: pd.DataFrame, who: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(here) and len(who):
            v, q, ids = np.stack(here["v"].to_numpy()), np.stack(who["v"].to_numpy()), here["id"].to_numpy()
            names, cell = np.unique(here["cell"].to_numpy(), return_inverse=True)
            rough = q @ v.T
            repeated = len(np.unique(ids)) < len(ids)
            for i, (query, wanted) in enumerate(zip(who["id"].to_numpy(), who["cells"], strict=True)):
                others = np.flatnonzero(np.isin(names, wanted)[cell] & (ids != query))
                if len(others) > k and not repeated:
                    lowest = np.partition(rough[i, others], len(others) - k)[len(others) - k]
                    others = others[rough[i, others] >= lowest - 1e-9 * (1 + abs(lowest))]
                # a fixed order of additions: copies of a vector score the same in every block
                score = np.cumsum(v[others] * q[i], axis=1)[:, -1]
                order = np.lexsort((ids[others], -score))
                if repeated:
                    order = order[np.sort(np.unique(ids[others][order], return_index=True)[1])]
                order = order[:k]
                found.append(pd.DataFrame({"query_id": query, "vec_id": ids[others][order], "score": score[order]}))
        return pd.concat(found)

    keys = ["shelf", "crowd"]
    near = entries.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
