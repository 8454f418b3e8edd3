"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a shuffle by node with partial minima; no node's neighbours are gathered into one row. The link
table is written to the shared folder after each round, so lineage stays short and a lost executor costs
one round at most. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import _store

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (the larger ones, or the smaller ones) to the least of it and its neighbours."""
    if large:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # not the grouping column itself: the join gets exchanges of its own, so a node of very many links can be split
        least = arcs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").bitwiseXOR(F.lit(0)).alias("n"), F.least("a", "m").alias("m"))
        out = arcs.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b")
    else:  # of every node, the smaller neighbours: edges hold (smaller, larger)
        least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "n")
        joined = edges.join(least, F.col("b") == F.col("n"))
        out = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).unionByName(joined.select(F.col("m").alias("x"), F.col("b").alias("y")))
        out = out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return out.where("a < b").distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component): the least node that is reachable, for every node in ``links`` (a, b: numbers)."""
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = _store.written(edges, folder, "edges-0")
    before = None
    for k in range(1, MAX_ROUNDS):
        edges = _store.written(_star(_star(edges, True), False), folder, f"edges-{k}")
        # a forest of stars stays as it is: every larger node has one link, and no centre is a larger node
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
