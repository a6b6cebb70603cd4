"""Connected components of a graph given as edges, by alternating star rewiring.

Each round points every node's larger neighbours, then its smaller ones, at the
smallest node it sees; the rounds end when nothing changes.  Rounds grow with the
logarithm of the longest path.  Each round's edges are a written table, so lost
executors cost one round at most and lineage stays short; the driver sees two sums.

A node with very many neighbours is never one group: the smallest neighbour is an
aggregate with partial sums, and the neighbours meet it in a join whose large
partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Point each node's neighbours at the smallest of them and the node itself.

    Only neighbours above the node when ``larger``, else only those below and itself.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    met = both.join(least, "a")
    if larger:
        return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    pointed = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return pointed.where("a != b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node of an edge (node) and its component's smallest node (component).

    Edges between equal or NULL nodes are ignored; an empty table gives an empty result.
    """
    pairs = edges.select(edges[a].alias("a"), edges[b].alias("b")).where("a != b")
    current = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        current = written(_stars(_stars(current, larger=True), larger=False), "edges")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
