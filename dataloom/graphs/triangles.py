"""Triangles of an undirected graph from degree-ordered forward lists.

Every edge points from the vertex of lower (degree, id) to that of higher. A
vertex of any degree then has at most sqrt(2 m) edges pointing away from it: a
hub is pointed at. Wedges are made from forward lists only, so there are at
most m * sqrt(2 m) of them, and a wedge is a triangle when an edge closes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.session import fixed


def forward(edges: DataFrame) -> DataFrame:
    """(a, b): each undirected edge once, from lower to higher (degree, id); loops and repeated edges are left out."""
    pair = edges.where("src <> dst").select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    pair = fixed(pair, "edges")
    degree = pair.select(F.explode(F.array("x", "y")).alias("v")).groupBy("v").agg(F.count("*").alias("d"))
    degree = fixed(degree, "degrees")  # its joins then deal both sides anew, so a hub's edges can be split

    def side(c: str) -> DataFrame:
        return degree.select(F.col("v").alias(c), F.struct(F.col("d").alias("d"), F.col("v").alias("v")).alias(f"o{c}"))

    placed = pair.join(side("x"), "x").join(side("y"), "y")
    return placed.select(F.least("ox", "oy").alias("a"), F.greatest("ox", "oy").alias("b"))


def wedges(pointing: DataFrame) -> DataFrame:
    """(u, v, w): pairs of a vertex's forward edges, v before w. ``pointing`` is the result of ``forward``."""
    lists = pointing.groupBy("a").agg(F.array_sort(F.collect_list("b")).alias("l"))  # at most sqrt(2 m) long
    heads = lists.select(F.col("a.v").alias("u"), "l", F.posexplode("l").alias("p", "v"))
    return heads.select("u", F.col("v.v").alias("v"), F.explode(F.expr("slice(l, p + 2, size(l))")).alias("w")).select("u", "v", F.col("w.v").alias("w"))


def triangle_count(edges: DataFrame) -> DataFrame:
    """(v, triangles) for every vertex of ``edges(src, dst)``, direction ignored; vertices of loops only have none.

    The vertices of a null-ended edge are not counted. Nothing is capped.
    """
    pointing = fixed(forward(edges), "forward-edges")
    closing = pointing.select(F.col("a.v").alias("v"), F.col("b.v").alias("w"))
    closed = wedges(pointing).join(closing, ["v", "w"])
    found = closed.select(F.explode(F.array("u", "v", "w")).alias("v")).groupBy("v").agg(F.count("*").alias("triangles"))
    vertices = edges.where("src IS NOT NULL AND dst IS NOT NULL").select(F.explode(F.array("src", "dst")).alias("v")).distinct()
    return vertices.join(found, "v", "left").select("v", F.coalesce("triangles", F.lit(0).cast("long")).alias("triangles"))
