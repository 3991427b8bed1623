"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on node ids; nothing but two
totals per round reaches the driver. Hubs are safe: minima combine map-side and
the joins are plain sort-merge joins whose large partitions AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import materialize


def _star(pairs: DataFrame, low: DataFrame) -> DataFrame:
    return pairs.join(low, "node")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("near")))
    low = both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("m", "node").alias("m"))
    out = _star(both, low).where(F.col("near") > F.col("node"))
    return out.select(F.col("near").alias("hi"), F.col("m").alias("lo")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
    low = down.groupBy("node").agg(F.min("near").alias("m"))
    moved = _star(down, low).where(F.col("near") != F.col("m")).select(F.col("near").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(low.select(F.col("node").alias("hi"), F.col("m").alias("lo"))).distinct()


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")),
                           F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node long, root long) for every node of ``edges``; root is the smallest node reachable.

    Loops and nodes without edges do not appear. Runs until a round changes
    nothing (rounds grow with the logarithm of the longest chain).
    """
    e = edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo")).distinct()
    e = materialize(e, "edges")
    before = _sum(e)
    while before[0]:
        e = materialize(_small(_large(e)), "edges")
        after = _sum(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
