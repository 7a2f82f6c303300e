"""Connected components of a table of links, as repeated joins (large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import discard, land

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """Smallest member of each component: rows (``node``, ``component``) for every node that has a link.

    ``links`` has two BIGINT columns ``a`` and ``b``. Each round points every node at the smallest neighbour it knows,
    first the larger neighbours of each node, then the smaller ones; the number of rounds grows with the logarithm of
    the longest path. Minima are pre-aggregated before each shuffle, no group is gathered, and each round is landed in
    the shared folder. Repeated links, loops and NULL ends (left out) do no harm; without links there are no rows.
    """
    spark = links.sparkSession
    edges = land(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "links",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before or not after[0]:
            break
        before = after
        step = land(_small_star(_large_star(edges)), "links")
        discard(spark, edges)
        edges = step
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return (
        both.filter("b > a").join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
