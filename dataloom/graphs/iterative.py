"""Graph and iterative jobs as rounds of joins and aggregates.

Graphs are ``edges(src, dst[, w])`` DataFrames. Inputs are written once to the
shared scratch folder, and so is the state after every round: a lost executor
recomputes nothing older than its round, and several readers see the same rows.
Loops run until nothing changes; only row counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.session import fixed, scratch_path


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85, bucket_links: int = 2_000_000, keep_every: int = 5, list_links: int = 1 << 16) -> DataFrame:
    """Iterated rank: rank(v) = (1 - d) + d * sum(rank(u) / outdeg(u)) over u -> v.

    Starting rank 1.0 for every vertex with out-links; a vertex without
    incoming contributions drops out, as in the classic example.

    The links are a table bucketed by source, one file a bucket and one row with
    a list a source, so a round sorts and joins sources, not links, and shuffles
    the ranks and the contributions. A source of more links than an average
    bucket or a list holds is cut into mirrors, each with a part of its links in
    another bucket; its rank goes to all of them. There are fewer such
    sources than buckets and full lists. What flows into a hub is added up before the shuffle.
    """
    spark = edges.sparkSession
    links = fixed(edges.select("src", "dst").distinct(), "distinct-links")
    total = links.count()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_links))
    degrees = fixed(links.groupBy("src").agg(F.count("*").alias("deg")), "out-degrees")
    part = max(1, min(list_links, -(-total // n)))
    mirrors = F.ceil(F.col("deg") / part).cast("int")
    hubs = F.broadcast(fixed(degrees.where(F.col("deg") > part).select(F.col("src").alias("hub"), mirrors.alias("k")), "hubs"))  # fewer than total / part rows
    mirror = F.pmod(F.xxhash64("dst"), mirrors).cast("int")
    path = scratch_path(spark, "links")
    name = "links_" + path.rsplit("-", 1)[-1]
    (links.join(degrees, "src").withColumn("mirror", mirror).repartition(n, "src", "mirror")
     .groupBy("src", "mirror", "deg").agg(F.collect_list(F.struct("dst")).alias("out"))
     .write.bucketBy(n, "src", "mirror").option("path", path).saveAsTable(name))
    adj = spark.table(name)
    ranks = degrees.select(F.col("src").alias("v"), F.lit(1.0).alias("rank"))
    for done in range(1, iterations + 1):
        to = ranks.join(hubs, F.col("v") == F.col("hub"), "left").select(
            "v", "rank", F.explode(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1)).alias("m"))
        contrib = adj.join(to, (adj.src == to.v) & (adj.mirror == to.m)).select(F.explode("out").alias("l"), (F.col("rank") / F.col("deg")).alias("c")).select(F.col("l.dst").alias("v"), "c")
        ranks = contrib.groupBy("v").agg((F.lit(1 - damping) + F.lit(damping) * F.sum("c")).alias("rank"))
        if done % keep_every == 0 or done == iterations:  # a lost executor costs at most so many rounds
            ranks = fixed(ranks, "ranks")
    spark.sql(f"DROP TABLE {name}")
    return ranks


def _large_star(stars: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex moves to the least vertex of its neighbourhood."""
    both = stars.select(F.col("hi").alias("v"), F.col("lo").alias("w")).unionByName(stars.select(F.col("lo").alias("v"), F.col("hi").alias("w")))
    least = both.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("v", "m").alias("m"))
    return both.join(least, "v").where(F.col("w") > F.col("v")).select(F.col("w").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, moves to the least of them."""
    least = stars.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = stars.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Component id = least vertex id reachable (undirected): alternating large and small stars.

    The number of rounds grows with the logarithm of the longest path, and the
    loop ends when a round leaves every star as it was.
    """
    edges = fixed(edges.select("src", "dst").distinct(), "edges")
    vertices = edges.select(F.col("src").alias("v")).union(edges.select("dst")).distinct()
    stars = fixed(edges.where("src <> dst").select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")).distinct(), "stars")
    while True:
        new = fixed(_small_star(_large_star(stars)), "stars")
        same = new.count() == stars.count() and new.join(stars, ["hi", "lo"], "left_anti").isEmpty()
        stars = new
        if same:
            break
    found = stars.select(F.col("hi").alias("v"), F.col("lo").alias("l"))
    return vertices.join(found, "v", "left").select("v", F.coalesce("l", "v").alias("label"))


def sssp(edges: DataFrame, source) -> DataFrame:
    """Single-source shortest paths (non-negative ``w``): only vertices whose distance fell relax their edges."""
    edges = fixed(edges.select("src", "dst", "w"), "weighted-edges")
    vertices = edges.select(F.col("src").alias("v")).union(edges.select("dst")).distinct()
    dist = fixed(vertices.select("v", F.when(F.col("v") == F.lit(source), F.lit(0.0)).alias("d"), (F.col("v") == F.lit(source)).alias("fell")), "distances")
    while not dist.where("fell").isEmpty():
        relax = edges.join(dist.where("fell"), edges.src == dist.v).groupBy(F.col("dst").alias("v")).agg(F.min(F.col("d") + F.col("w")).alias("nd"))
        closer = F.coalesce(F.col("nd") < F.col("d"), F.col("nd").isNotNull())
        dist = fixed(dist.join(relax, "v", "left").select("v", F.when(closer, F.col("nd")).otherwise(F.col("d")).alias("d"), closer.alias("fell")), "distances")
    return dist.select("v", "d")


def transitive_closure(edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """All reachable (src, dst) pairs, of the vertices in ``sources(src)`` if given.

    Each round extends only the pairs found in the round before, until none is
    new. The output has a row per reachable pair: state the sources where
    the graph is not shallow.
    """
    step = fixed(edges.select("src", "dst").distinct(), "edges")
    onward = step.select(F.col("src").alias("mid"), F.col("dst").alias("next"))
    new = fixed(step if sources is None else step.join(sources.select("src").distinct(), "src", "left_semi"), "pairs")
    known = new
    while not new.isEmpty():
        longer = new.join(onward, new.dst == onward.mid).select("src", F.col("next").alias("dst")).distinct()
        new = fixed(longer.join(known, ["src", "dst"], "left_anti"), "pairs")
        known = known.unionByName(new)
    return known


def degrees(edges: DataFrame) -> DataFrame:
    """In and out degree per vertex (vertices seen on either side)."""
    o = edges.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("out_deg"))
    i = edges.groupBy(F.col("dst").alias("v")).agg(F.count("*").alias("in_deg"))
    return o.join(i, "v", "full").select("v", F.coalesce("in_deg", F.lit(0)).alias("in_deg"), F.coalesce("out_deg", F.lit(0)).alias("out_deg"))


def aggregate_messages(edges: DataFrame, vertices: DataFrame, attr: str, keep) -> DataFrame:
    """Send each source's attribute to its destination when ``keep(src_attr)``
    holds; per destination: message count and mean."""
    m = edges.join(vertices.select(F.col("id").alias("src"), F.col(attr).alias("a")), "src").filter(keep(F.col("a")))
    return m.groupBy(F.col("dst").alias("v")).agg(F.count("*").alias("n_msgs"), F.avg("a").alias("mean_attr"))
