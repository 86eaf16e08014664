"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import staged


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of each node (the larger ones, or the smaller ones and itself) at the
    smallest of its neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))) if larger_only else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # a table of its own: Spark splits the rows of a hot node only where the join's sides come straight from shuffles
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    met = both.join(least, "a")
    if larger_only:
        out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b"))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b): the smallest id it is connected with.

    Large-star and small-star rounds end in one star for each component; a node with very many
    neighbours is only ever aggregated, never collected. Every round is staged.
    """
    links = staged(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        links = staged(_star(_star(links, True), False).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
