"""§2.14 graph and iterative jobs over graphs derived from lineitem:
suppliers and parts linked by the lines that ship them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from dataloom.graphs import iterative as GI
from dataloom.graphs.triangles import triangle_count
from dataloom.learn.als import als_error
from dataloom.operators.joins import salted_join
from dataloom.plans.registry import query
from dataloom.session import fixed, table

_SP_SQL = """sp AS (SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS src, 'p' || CAST(l_partkey AS VARCHAR) AS dst FROM lineitem),
und AS (SELECT src, dst FROM sp UNION SELECT dst, src FROM sp)"""


def _sp(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
                     F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")).distinct()


def _pagerank_sql(iters: int = 10) -> str:
    parts = [_SP_SQL, "deg AS (SELECT src, COUNT(*) AS d FROM und GROUP BY src)", "r0 AS (SELECT src AS v, 1.0 AS rank FROM deg)"]
    for i in range(1, iters + 1):
        parts.append(f"r{i} AS (SELECT u.dst AS v, 0.15 + 0.85 * SUM(r.rank / g.d) AS rank FROM und u JOIN deg g ON u.src = g.src "
                     f"JOIN r{i - 1} r ON u.src = r.v GROUP BY u.dst)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT v, round(rank, 6) AS rank FROM r{iters}"


@query("gr_pagerank", _pagerank_sql())
def gr_pagerank(spark, sf):
    """10 rounds of PageRank over the supplier-part graph (both directions)."""
    sp = _numbered(spark, sf)
    r = GI.pagerank(sp.union(sp.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), iterations=10)
    return r.select(_vertex(F.col("v")).alias("v"), F.round("rank", 6).alias("rank"))


@query(
    "gr_connected_components",
    "WITH RECURSIVE " + _SP_SQL + """,
    lab(v, l) AS (SELECT src, src FROM und UNION SELECT u.dst, lab.l FROM lab JOIN und u ON lab.v = u.src)
    SELECT v, min(l) AS label FROM lab GROUP BY v""",
)
def gr_connected_components(spark, sf):
    """Components over numbered vertices; a component's label is the least of its vertices' names."""
    found = fixed(GI.connected_components(_numbered(spark, sf)).select(_vertex(F.col("v")).alias("v"), "label"), "components")
    least = found.groupBy(F.col("label").alias("of")).agg(F.min("v").alias("least"))
    return salted_join(found, least, ["label"], ["of"], how="left").select("v", F.col("least").alias("label"))


def _numbered(spark, sf):
    """The supplier -> part graph with whole numbers as vertices: even ones are suppliers, odd ones parts."""
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_suppkey").cast("long") * 2).alias("src"), (F.col("l_partkey").cast("long") * 2 + 1).alias("dst")).distinct()


def _vertex(v):
    """The name of a numbered vertex."""
    return F.concat(F.when(v.bitwiseAND(F.lit(1)) == 0, F.lit("s")).otherwise(F.lit("p")), F.shiftright(v, 1).cast("string"))


def _weighted(spark, sf):
    li = table(spark, sf, "lineitem")
    e = li.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("a"),
                  F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("b"),
                  (1.0 + F.col("l_partkey") % 3).alias("w")).distinct()
    return e.select(F.col("a").alias("src"), F.col("b").alias("dst"), "w").union(e.select(F.col("b").alias("src"), F.col("a").alias("dst"), "w"))


def _sssp_sql(iters: int = 30) -> str:
    parts = ["""we AS (SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS a, 'p' || CAST(l_partkey AS VARCHAR) AS b, 1.0 + l_partkey % 3 AS w FROM lineitem)""",
             "e AS (SELECT a AS src, b AS dst, w FROM we UNION ALL SELECT b, a, w FROM we)",
             "vs AS (SELECT src AS v FROM e UNION SELECT dst FROM e)",
             "d0 AS (SELECT v, CASE WHEN v = 's0' THEN 0.0 END AS d FROM vs)"]
    for i in range(1, iters + 1):
        parts.append(f"d{i} AS (SELECT x.v, CASE WHEN x.d IS NULL THEN r.nd WHEN r.nd IS NULL THEN x.d ELSE least(x.d, r.nd) END AS d FROM d{i - 1} x "
                     f"LEFT JOIN (SELECT e.dst AS v, min(p.d + e.w) AS nd FROM e JOIN d{i - 1} p ON e.src = p.v WHERE p.d IS NOT NULL GROUP BY e.dst) r ON x.v = r.v)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT v, d FROM d{iters}"


@query("gr_sssp", _sssp_sql())
def gr_sssp(spark, sf):
    """Shortest weighted distance from supplier 0 to every vertex (null: unreachable)."""
    return GI.sssp(_weighted(spark, sf), "s0")


@query(
    "gr_aggregate_messages",
    """SELECT 'p' || CAST(l.l_partkey AS VARCHAR) AS v, COUNT(*) AS n_msgs, round(AVG(s.s_acctbal), 8) AS mean_attr
       FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       WHERE s.s_acctbal > 0 GROUP BY 1""",
)
def gr_aggregate_messages(spark, sf):
    """Each supplier with a positive balance sends its balance to the parts it
    ships; per part: number of messages and their mean."""
    s = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), "s_acctbal")
    out = GI.aggregate_messages(_sp(spark, sf), s, "s_acctbal", lambda a: a > 0)
    return out.select("v", "n_msgs", F.round("mean_attr", 8).alias("mean_attr"))


_DAG_SQL = """e AS (SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem
          UNION SELECT 's' || CAST(s_suppkey AS VARCHAR), 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier
          UNION SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation)"""


_TOGETHER_SQL = """pair AS (SELECT DISTINCT a.l_partkey AS x, b.l_partkey AS y FROM lineitem a JOIN lineitem b
                             ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'R')"""


def _together(spark, sf):
    """Parts returned from one order (an order has a handful of lines)."""
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct()
    baskets = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("l"))
    heads = baskets.select("l", F.posexplode("l").alias("p", "src"))
    return heads.select("src", F.explode(F.expr("slice(l, p + 2, size(l))")).alias("dst")).distinct()


@query(
    "gr_triangle_count",
    "WITH " + _TOGETHER_SQL + """,
    tri AS (SELECT e.x AS a, e.y AS b, f.y AS c FROM pair e JOIN pair f ON e.y = f.x JOIN pair g ON g.x = e.x AND g.y = f.y),
    per AS (SELECT v, COUNT(*) AS t FROM (SELECT a AS v FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri) GROUP BY v),
    vs AS (SELECT x AS v FROM pair UNION SELECT y FROM pair)
    SELECT vs.v, coalesce(per.t, 0) AS triangles FROM vs LEFT JOIN per ON vs.v = per.v""",
)
def gr_triangle_count(spark, sf):
    """Triangles at every part of the graph of parts that were returned from one order."""
    return triangle_count(_together(spark, sf))


@query(
    "gr_transitive_closure",
    "WITH RECURSIVE " + _DAG_SQL + """,
    tc(src, dst) AS (SELECT src, dst FROM e UNION SELECT tc.src, e.dst FROM tc JOIN e ON tc.dst = e.src)
    SELECT src, dst FROM tc""",
)
def gr_transitive_closure(spark, sf):
    """All reachable pairs in the part -> supplier -> nation -> region graph."""
    li, s, n = table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "nation")
    e = (li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"))
         .union(s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))))
         .union(n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))))
    return GI.transitive_closure(e.distinct())


@query(
    "gr_graph_summary",
    "WITH " + _SP_SQL + """,
    deg AS (SELECT src AS v, COUNT(*) AS out_deg FROM sp GROUP BY src),
    ind AS (SELECT dst AS v, COUNT(*) AS in_deg FROM sp GROUP BY dst)
    SELECT coalesce(deg.v, ind.v) AS v, coalesce(ind.in_deg, 0) AS in_deg, coalesce(deg.out_deg, 0) AS out_deg FROM deg FULL JOIN ind ON deg.v = ind.v""",
)
def gr_graph_summary(spark, sf):
    """Degrees of the supplier -> part graph (in and out)."""
    return GI.degrees(_sp(spark, sf))


@query("it_kmeans_manual")
def it_kmeans_manual(spark, sf):
    """Lloyd iterations as aggregates: k centres (small, broadcast as literals),
    nearest centre per point, new centre = per-cluster average."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    k, dim = 4, 64
    centres = [np.array(r[0], dtype=float) for r in e.orderBy("vec_id").limit(k).select("embedding").collect()]
    moved = 1.0
    while moved > 1e-6:  # until the centres stand still: every step lowers the sum of squares, so it ends
        dist = [F.aggregate(F.zip_with("embedding", F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
                for c in centres]
        assigned = e.withColumn("cl", F.array_position(F.array(*dist), F.array_min(F.array(*dist))) - 1)
        rows = assigned.groupBy("cl").agg(*[F.avg(F.col("embedding")[i]).alias(f"m{i}") for i in range(dim)]).collect()
        moved = 0.0
        for r in rows:
            new = np.array([r[f"m{i}"] for i in range(dim)])
            moved += float(((new - centres[int(r["cl"])]) ** 2).sum())
            centres[int(r["cl"])] = new
    return assigned.select("vec_id", "cl")


@query("it_logreg_manual")
def it_logreg_manual(spark, sf):
    """Batch-gradient logistic regression: one aggregate per round."""
    li = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("double").alias("y"),
                                             (F.col("l_discount") * 10).alias("x1"), (F.col("l_quantity") / 50).alias("x2"))
    w = np.zeros(3)
    for _ in range(10):
        z = F.lit(w[0]) + F.lit(w[1]) * F.col("x1") + F.lit(w[2]) * F.col("x2")
        err = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col("y")
        g = li.agg(F.avg(err).alias("g0"), F.avg(err * F.col("x1")).alias("g1"), F.avg(err * F.col("x2")).alias("g2")).first()
        w -= 1.0 * np.array([g["g0"], g["g1"], g["g2"]])
    return li.agg(F.count("*").alias("n")).select("n", F.lit(float(w[0])).alias("w0"), F.lit(float(w[1])).alias("w1"), F.lit(float(w[2])).alias("w2"))


@query("it_als_manual")
def it_als_manual(spark, sf):
    """Alternating least squares in half steps over blocks: the normal equations
    (sum f f^T, sum r f) of an entity are summed in the block that has its
    ratings, and its small rank x rank system is solved there in numpy."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), F.col("l_quantity").alias("r"))
    return als_error(lines, rank=4, lam=0.1, iterations=5)
