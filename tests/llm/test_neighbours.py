"""Recall of the nearest vectors, whatever way the vectors lie."""

import numpy as np
import pytest

from fareloom.llm import neighbours
from fareloom.llm.queries import importable

N, DIM, ASKED, K = 20_000, 64, 100, 20


def vectors(kind):
    chance = np.random.default_rng(11)
    plain = chance.normal(size=(N, DIM))
    if kind.startswith("mean"):
        return plain + float(kind.split()[1])
    if kind == "one side":
        return plain + 8 * chance.normal(size=DIM)
    if kind == "clusters":
        return 4 * chance.normal(size=(50, DIM))[chance.integers(0, 50, N)] + plain
    if kind == "heavy tails":
        return chance.standard_t(2, size=(N, DIM))
    if kind == "uneven lengths":
        return plain * chance.lognormal(0, 0.7, size=(N, 1))
    return plain / np.linalg.norm(plain, axis=1)[:, None]


@pytest.mark.parametrize("kind", ["unit", "mean 0", "mean 3", "mean 5", "mean 10", "one side", "clusters", "heavy tails", "uneven lengths"])
def test_recall(spark, kind):
    importable(spark)
    v = vectors(kind)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = neighbours.inverted_multi_index(rows, rows.filter(f"vec_id % {N // ASKED} = 0"), k=K).collect()
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in range(0, N, N // ASKED)}
    hits = 0
    for q, ids in found.items():
        scores = v @ v[q]
        scores[q] = -np.inf
        hits += len(ids & set(np.argsort(-scores)[:K].tolist()))
    recall = hits / (ASKED * K)
    print(f"\n{kind}: {recall:.3f}")
    assert recall >= 0.9


def test_vectors_that_are_all_alike_or_the_mean_itself(spark):
    importable(spark)
    rows = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)] + [(40, [2.0, 4.0]), (40, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = neighbours.inverted_multi_index(rows, rows.filter("vec_id in (0, 40)"), k=3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (0, 1, 40, 10.0), (0, 2, 1, 5.0), (0, 3, 2, 5.0), (40, 1, 0, 3.0), (40, 2, 1, 3.0), (40, 3, 2, 3.0),
    ]
