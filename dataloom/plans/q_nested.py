"""§2.5 nested FOREACH blocks and §2.8 set operations / reshaping."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from dataloom.operators import groups as G
from dataloom.operators import order as O
from dataloom.plans.registry import query
from dataloom.session import table


@query(
    "nest_filter",
    """SELECT o_custkey, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
              round(SUM(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 2) AS urgent_total
       FROM orders GROUP BY o_custkey""",
)
def nest_filter(spark, sf):
    """FILTER inside the group's bag = conditional aggregates (one pass)."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"),
        F.round(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))), 2).alias("urgent_total"))


@query(
    "nest_order",
    """SELECT o_custkey, o_orderkey, o_orderdate, rn FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 2""",
)
def nest_order(spark, sf):
    """ORDER of the bag then its first two: a per-group top-n (partial before the shuffle)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    r = G.top_n(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2, out="rn")
    return r.withColumn("rn", F.col("rn").cast("long"))


@query(
    "nest_distinct",
    """SELECT o_custkey, COUNT(DISTINCT o_orderpriority) AS n_priorities,
              array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS statuses
       FROM orders GROUP BY o_custkey""",
)
def nest_distinct(spark, sf):
    """DISTINCT of a bag: distinct count, and the distinct set of a column with few values."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.count_distinct("o_orderpriority").alias("n_priorities"),
        F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@query(
    "nest_limit",
    """SELECT o_custkey, o_orderkey FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
)
def nest_limit(spark, sf):
    """LIMIT 3 of each group's bag (stable: lowest order keys)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return G.top_n(o, ["o_custkey"], ["o_orderkey"], 3)


@query(
    "nest_foreach",
    """SELECT l_orderkey, round(SUM(l_quantity * l_extendedprice), 2) AS weighted,
              array_to_string(list_sort(list(l_returnflag || CAST(l_linenumber AS VARCHAR))), ',') AS tags
       FROM lineitem GROUP BY l_orderkey""",
)
def nest_foreach(spark, sf):
    """FOREACH over the bag of an order's lines (bounded per order): projection
    with ``transform`` then a fold with ``aggregate``."""
    li = table(spark, sf, "lineitem")
    bag = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_extendedprice", "l_returnflag", "l_linenumber")).alias("b"))
    return bag.select(
        "l_orderkey",
        F.round(F.aggregate(F.transform("b", lambda t: t["l_quantity"] * t["l_extendedprice"]), F.lit(0.0), lambda a, x: a + x), 2).alias("weighted"),
        F.array_join(F.sort_array(F.transform("b", lambda t: F.concat(t["l_returnflag"], t["l_linenumber"].cast("string")))), ",").alias("tags"))


# ------------------------------------------------------------------ §2.8


@query(
    "set_union_all",
    """SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R'
       UNION ALL SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_quantity > 45""",
)
def set_union_all(spark, sf):
    li = table(spark, sf, "lineitem")
    a = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_returnflag")
    b = li.filter(F.col("l_quantity") > 45).select("l_orderkey", "l_returnflag")
    return a.union(b)


@query(
    "set_union_onschema",
    """SELECT c_custkey AS "key", c_acctbal AS amount, c_mktsegment AS seg, NULL AS name FROM customer
       UNION ALL SELECT s_suppkey, CAST(s_nationkey AS DOUBLE), NULL, s_name FROM supplier""",
)
def set_union_onschema(spark, sf):
    """UNION ONSCHEMA: by name, missing columns null, int widened to double."""
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("seg"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").cast("double").alias("amount"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "set_distinct",
    """SELECT 'distinct' AS kind, l_suppkey, l_returnflag, NULL AS l_linenumber FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem)
       UNION ALL
       SELECT 'keep_first', l_suppkey, l_returnflag, l_linenumber FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
)
def set_distinct(spark, sf):
    """DISTINCT rows, and drop-duplicates on a subset keeping the first by an order."""
    li = table(spark, sf, "lineitem")
    d = li.select("l_suppkey", "l_returnflag").distinct().select(F.lit("distinct").alias("kind"), "l_suppkey", "l_returnflag",
                                                                   F.lit(None).cast("int").alias("l_linenumber"))
    first = G.top_n(li.select("l_suppkey", "l_returnflag", "l_linenumber"), ["l_suppkey", "l_returnflag"], ["l_linenumber"], 1)
    return d.unionByName(first.select(F.lit("keep_first").alias("kind"), "l_suppkey", "l_returnflag", "l_linenumber"))


_A = "SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity > 25"
_B = "SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_discount < 0.04"


def _ab(spark, sf):
    li = table(spark, sf, "lineitem")
    a = li.filter(F.col("l_quantity") > 25).select("l_suppkey", "l_returnflag")
    b = li.filter(F.col("l_discount") < 0.04).select("l_suppkey", "l_returnflag")
    return a, b


@query("set_intersect", f"""SELECT 'distinct' AS kind, * FROM ({_A} INTERSECT {_B}) UNION ALL SELECT 'all', * FROM ({_A} INTERSECT ALL {_B})""")
def set_intersect(spark, sf):
    a, b = _ab(spark, sf)
    return a.intersect(b).select(F.lit("distinct").alias("kind"), "*").unionByName(a.intersectAll(b).select(F.lit("all").alias("kind"), "*"))


@query("set_except", f"""SELECT 'distinct' AS kind, * FROM ({_A} EXCEPT {_B}) UNION ALL SELECT 'all', * FROM ({_A} EXCEPT ALL {_B})""")
def set_except(spark, sf):
    a, b = _ab(spark, sf)
    return a.subtract(b).select(F.lit("distinct").alias("kind"), "*").unionByName(a.exceptAll(b).select(F.lit("all").alias("kind"), "*"))


@query(
    "bag_diff_subtract",
    """SELECT p_partkey,
              array_to_string(list_sort(list_distinct(list_concat(list_filter(a, lambda x: NOT list_contains(b, x)), list_filter(b, lambda x: NOT list_contains(a, x))))), ',') AS diff_,
              array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))), ',') AS subtract_
       FROM (SELECT p_partkey, string_split(p_name, ' ') || [p_brand] AS a, [p_type, p_brand, 'ring'] AS b FROM part)""",
)
def bag_diff_subtract(spark, sf):
    """DIFF (symmetric difference) and SUBTRACT of two bags held in one row."""
    p = table(spark, sf, "part")
    a = F.concat(F.split("p_name", " "), F.array("p_brand"))
    b = F.array(F.col("p_type"), F.col("p_brand"), F.lit("ring"))
    return p.select(
        "p_partkey", F.array_join(F.array_sort(F.array_union(F.array_except(a, b), F.array_except(b, a))), ",").alias("diff_"),
        F.array_join(F.array_sort(F.array_except(a, b)), ",").alias("subtract_"))


@query(
    "reshape_melt",
    """SELECT l_orderkey, l_linenumber, variable, value FROM (
         SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
         UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
         UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)""",
)
def reshape_melt(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "variable", "value")


@query(
    "reshape_unstack_transpose",
    """SELECT variable, round(SUM(value) FILTER (WHERE l_returnflag = 'A'), 4) AS A, round(SUM(value) FILTER (WHERE l_returnflag = 'N'), 4) AS N,
              round(SUM(value) FILTER (WHERE l_returnflag = 'R'), 4) AS R
       FROM (SELECT l_returnflag, 'qty' AS variable, l_quantity AS value FROM lineitem
             UNION ALL SELECT l_returnflag, 'disc', l_discount FROM lineitem) GROUP BY variable""",
)
def reshape_unstack_transpose(spark, sf):
    """Transpose of the per-flag sums: unpivot to long, then pivot the flags to columns."""
    li = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc"))
    long = li.unpivot(["l_returnflag"], ["qty", "disc"], "variable", "value")
    return long.groupBy("variable").pivot("l_returnflag", ["A", "N", "R"]).agg(F.round(F.sum("value"), 4))


def _safe(v: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", v)


@query(
    "reshape_dummies",
    """SELECT o_orderkey,
              CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS prio_1_URGENT, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS prio_2_HIGH,
              CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS prio_3_MEDIUM, CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS prio_4_NOT_SPECIFIED,
              CAST(o_orderpriority = '5-LOW' AS INTEGER) AS prio_5_LOW
       FROM orders""",
)
def reshape_dummies(spark, sf, categories=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")):
    """One 0/1 column for each of the categories that the caller names."""
    o = table(spark, sf, "orders")
    cats = categories
    return o.select("o_orderkey", *[F.when(F.col("o_orderpriority") == v, 1).otherwise(0).alias(f"prio_{_safe(v)}") for v in sorted(cats)])


@query(
    "reshape_reindex",
    """WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
            spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
            c AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
       SELECT spine.day, coalesce(c.n, 0) AS n_orders FROM spine LEFT JOIN c ON spine.day = c.day""",
)
def reshape_reindex(spark, sf):
    """Daily date spine from min to max, left-joined with counts, missing = 0."""
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    spine = o.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    counts = o.groupBy("day").agg(F.count("*").alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "reshape_factorize",
    """SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS code FROM part""",
)
def reshape_factorize(spark, sf):
    """Codes 0..k-1 per distinct value (sorted), via the distributed dense rank."""
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    r = O.global_rank(p, ["p_type"], dense=True, out="code")
    return r.withColumn("code", (F.col("code") - 1).cast("long"))
