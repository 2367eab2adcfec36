"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest node in sight; after few rounds (about the
logarithm of the longest path) every node points at its component's smallest node. A round is two
aggregations and two joins on the node; hubs are pre-aggregated before the shuffle, and the joins
are plain ones that adaptive execution splits when a hub is hot. Rounds are written to the shared
folder, so that a lost executor only repeats its part of one round. Nothing is collected but a
count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import staged

#: The tables between rounds are read several times; their number of files follows from their rows.
ROWS_PER_FILE = 250_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a, b (any ordered type, no nulls). Returns node, root for every node that
    has a link to another one; root is the component's smallest node, and has a row itself."""
    files = lambda df, count: df.coalesce(max(4, -(-count // ROWS_PER_FILE)))
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        after = staged(files(_small_star(_large_star(edges)), mark[0]), "stars")
        seen, edges = mark, after
        mark = _mark(edges)
        if mark == seen:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
