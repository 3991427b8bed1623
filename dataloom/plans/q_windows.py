"""§2.6 window functions and §2.7 ordering / limits / partitioning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dataloom.operators import order as O
from dataloom.operators import seqwin as SW
from dataloom.plans.registry import query
from dataloom.session import scratch_path, table


def _r(c, d=6):
    return F.round(c, d)


# A supplier's line items, ordered by every output column so that rows tied on
# the order are identical in the output too (the data repeats line numbers).
_W_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
_W_SQL = "PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity"
_COLS_SQL = "l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", *_W_ORDER)


@query(
    "win_row_number_rank",
    f"""SELECT {_COLS_SQL}, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity, l_shipdate, l_orderkey, l_linenumber) AS rn,
               rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS rnk, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS drnk
        FROM lineitem""",
)
def win_row_number_rank(spark, sf):
    """row_number / rank / dense_rank per supplier from positions and
    distributed ranks (no per-supplier task)."""
    li = _lines(spark, sf)
    pos = SW.over(li, ["l_suppkey"], ["l_quantity", "l_shipdate", "l_orderkey", "l_linenumber"], running={"rn": ("count", "*")})
    rk = O.group_rank(pos, ["l_suppkey"], ["l_quantity"])
    return rk.select(*li.columns, "rn", F.col("rank_min").cast("long").alias("rnk"),
                     F.col("rank_dense").cast("long").alias("drnk"))


@query(
    "win_ntile",
    f"""SELECT {_COLS_SQL}, ntile(4) OVER ({_W_SQL}) AS ntile_sql,
               CAST(CASE WHEN 4 >= cnt THEN rn ELSE floor((rn - 1) * 4 / cnt) + 1 END AS BIGINT) AS ntile_over
        FROM (SELECT *, row_number() OVER ({_W_SQL}) AS rn, COUNT(*) OVER (PARTITION BY l_suppkey) AS cnt FROM lineitem)""",
)
def win_ntile(spark, sf):
    """Standard ntile (larger buckets first) and the Over variant floor((rn-1)*n/cnt)+1,
    both from the row's position and its supplier's size."""
    pos = SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, running={"i": ("count", "*")}, whole={"n": ("count", "*")})
    i, n = F.col("i"), F.col("n")
    q, r = F.floor(n / 4), n % 4
    big = r * (q + 1)
    std = F.when(i <= big, F.ceil(i / (q + 1))).otherwise(r + F.ceil((i - big) / q)).cast("long")
    over = F.when(F.lit(4) >= n, i).otherwise(F.floor((i - 1) * 4 / n) + 1).cast("long")
    return pos.select("l_suppkey", *_W_ORDER, std.alias("ntile_sql"), over.alias("ntile_over"))


@query(
    "win_percent_rank_cume_dist",
    f"""SELECT {_COLS_SQL}, percent_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS pct_rank,
               cume_dist() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS cume_dist_,
               row_number() OVER ({_W_SQL}) / COUNT(*) OVER (PARTITION BY l_suppkey) AS cume_dist_over
        FROM lineitem""",
)
def win_percent_rank_cume_dist(spark, sf):
    """percent_rank / cume_dist (peers included) from distributed ranks; the
    Over variant row_number / count from positions."""
    pos = SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, running={"i": ("count", "*")}, whole={"n": ("count", "*")})
    rk = O.group_rank(pos, ["l_suppkey"], ["l_quantity"])
    n = F.col("n")
    pct = F.when(n == 1, F.lit(0.0)).otherwise((F.col("rank_min") - 1) / (n - 1))
    return rk.select("l_suppkey", *_W_ORDER, pct.alias("pct_rank"), (F.col("rank_max") / n).alias("cume_dist_"),
                     (F.col("i") / n).alias("cume_dist_over"))


@query(
    "win_lead_lag",
    f"""SELECT {_COLS_SQL}, lead(l_quantity, 1, 0) OVER ({_W_SQL}) AS lead1, lag(l_quantity, 2, -1) OVER ({_W_SQL}) AS lag2
        FROM lineitem""",
)
def win_lead_lag(spark, sf):
    """lead(1, default 0) and lag(2, default -1)."""
    return SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, lambda w: {
        "lead1": F.lead("l_quantity", 1, 0).over(w), "lag2": F.lag("l_quantity", 2, -1).over(w)}, before=2, behind=1)


@query(
    "win_first_last_nth",
    f"""SELECT {_COLS_SQL}, first_value(l_quantity) OVER w AS first_, last_value(l_quantity) OVER w AS last_,
               nth_value(l_quantity, 2) OVER w AS second_
        FROM lineitem WINDOW w AS ({_W_SQL} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""",
)
def win_first_last_nth(spark, sf):
    """first / last / 2nd value over ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING."""
    q = F.col("l_quantity")
    return SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, lambda w: {
        "first_": F.first(q).over(w.rowsBetween(-2, 1)), "last_": F.last(q).over(w.rowsBetween(-2, 1)),
        "second_": F.nth_value(q, 2).over(w.rowsBetween(-2, 1))}, before=2, behind=1)


@query(
    "win_rows_frame",
    f"""SELECT {_COLS_SQL}, SUM(l_quantity) OVER w AS sum4, round(AVG(l_quantity) OVER w, 6) AS avg4, MIN(l_quantity) OVER w AS min4,
               MAX(l_quantity) OVER w AS max4, COUNT(*) OVER w AS cnt4,
               SUM(l_quantity) OVER ({_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
        FROM lineitem WINDOW w AS ({_W_SQL} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""",
)
def win_rows_frame(spark, sf):
    """ROWS frames (2 preceding .. 1 following) and the default Over frame
    (start to current ROW), over ranges with lent rows and carried totals."""
    q = F.col("l_quantity")

    def frames(w):
        w = w.rowsBetween(-2, 1)
        return {"sum4": F.sum(q).over(w), "avg4": _r(F.avg(q).over(w)), "min4": F.min(q).over(w), "max4": F.max(q).over(w), "cnt4": F.count("*").over(w)}

    return SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, frames, before=2, behind=1, running={"running": ("sum", "l_quantity")})


@query(
    "win_range_frame",
    """SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity,
              SUM(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY epoch(l_shipdate) RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS qty_7d
       FROM lineitem""",
)
def win_range_frame(spark, sf):
    """RANGE frame over a time key: quantity shipped by the supplier in the
    last 7 days. Rows are first summed per (supplier, ship time) (partial
    aggregation absorbs a hot supplier); the RANGE window then runs over that
    table, whose size per supplier is bounded by the distinct ship times, and
    the result is joined back to the rows."""
    li = _lines(spark, sf)
    per_t = li.groupBy("l_suppkey", F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("__t")).agg(
        F.sum("l_quantity").alias("__q"))
    w = Window.partitionBy("l_suppkey").orderBy("__t").rangeBetween(-7 * 86400, 0)
    frames = per_t.select(F.col("l_suppkey").alias("__k"), "__t", F.sum("__q").over(w).alias("qty_7d"))
    rows = li.withColumn("__t", F.unix_seconds(F.col("l_shipdate").cast("timestamp")))
    return rows.join(frames, (rows.l_suppkey == frames.__k) & (rows.__t == frames.__t)).select(*li.columns, "qty_7d")


@query(
    "win_stitch",
    f"""SELECT {_COLS_SQL}, SUM(l_quantity) OVER ({_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS over_sum,
               max(l_quantity) OVER (PARTITION BY l_suppkey) AS group_max
        FROM lineitem""",
)
def win_stitch(spark, sf):
    """Stitch: windowed results beside the original rows (running sum and group max, by carried totals)."""
    return SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, running={"over_sum": ("sum", "l_quantity")}, whole={"group_max": ("max", "l_quantity")})


@query(
    "win_running",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_discount, SUM(l_quantity) OVER w AS cumsum,
              round(product(1 + l_discount) OVER w, 6) AS cumprod,
              MIN(l_quantity) OVER w AS cummin, MAX(l_quantity) OVER w AS cummax, COUNT(*) OVER w - 1 AS cumcount
       FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_quantity, l_discount
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_running(spark, sf):
    """cumsum / cumprod / cummin / cummax / cumcount along each order's lines."""
    order = ["l_linenumber", "l_shipdate", "l_quantity", "l_discount"]
    li = table(spark, sf, "lineitem").select("l_orderkey", *order)
    w = Window.partitionBy("l_orderkey").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    q = F.col("l_quantity")
    return li.select(
        "l_orderkey", *order, F.sum(q).over(w).alias("cumsum"), F.round(F.product(1 + F.col("l_discount")).over(w), 6).alias("cumprod"),
        F.min(q).over(w).alias("cummin"), F.max(q).over(w).alias("cummax"), (F.count("*").over(w) - 1).alias("cumcount"))


@query(
    "win_rolling",
    f"""SELECT {_COLS_SQL}, CASE WHEN COUNT(l_quantity) OVER w >= 2 THEN COUNT(l_quantity) OVER w END AS roll_count,
               CASE WHEN COUNT(l_quantity) OVER w >= 2 THEN SUM(l_quantity) OVER w END AS roll_sum,
               CASE WHEN COUNT(l_quantity) OVER w >= 2 THEN MIN(l_quantity) OVER w END AS roll_min,
               CASE WHEN COUNT(l_quantity) OVER w >= 2 THEN MAX(l_quantity) OVER w END AS roll_max,
               CASE WHEN COUNT(l_quantity) OVER w >= 2 THEN round(AVG(l_quantity) OVER w, 6) END AS roll_mean
        FROM lineitem WINDOW w AS ({_W_SQL} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def win_rolling(spark, sf):
    """rolling(3, min_periods=2)."""
    q = F.col("l_quantity")

    def frames(w):
        w = w.rowsBetween(-2, 0)
        return {"c": F.count(q).over(w), "s": F.sum(q).over(w), "mn": F.min(q).over(w), "mx": F.max(q).over(w), "av": F.avg(q).over(w)}

    out = SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, frames, before=2)
    ok = F.col("c") >= 2
    return out.select("l_suppkey", *_W_ORDER, F.when(ok, F.col("c")).alias("roll_count"), F.when(ok, F.col("s")).alias("roll_sum"),
                      F.when(ok, F.col("mn")).alias("roll_min"), F.when(ok, F.col("mx")).alias("roll_max"),
                      F.when(ok, _r(F.col("av"))).alias("roll_mean"))


@query(
    "win_expanding",
    f"""SELECT {_COLS_SQL}, COUNT(l_quantity) OVER w AS exp_count, SUM(l_quantity) OVER w AS exp_sum, MIN(l_quantity) OVER w AS exp_min,
               MAX(l_quantity) OVER w AS exp_max, round(AVG(l_quantity) OVER w, 6) AS exp_mean
        FROM lineitem WINDOW w AS ({_W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_expanding(spark, sf):
    """Expanding count / sum / min / max / mean per supplier, computed by
    range partitions + carried partition totals (a hot supplier spans tasks)."""
    running = {f"exp_{k}": (k, "l_quantity") for k in ("count", "sum", "min", "max")}
    r = SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, running=running)
    return r.withColumn("exp_mean", _r(F.col("exp_sum") / F.col("exp_count")))


@query(
    "win_diff_pct",
    f"""SELECT {_COLS_SQL}, l_quantity - lag(l_quantity, 1) OVER ({_W_SQL}) AS diff1,
               round(l_quantity / lag(l_quantity, 1) OVER ({_W_SQL}) - 1, 6) AS pct_change
        FROM lineitem""",
)
def win_diff_pct(spark, sf):
    """diff / pct_change against the previous row of the supplier."""
    out = SW.over(_lines(spark, sf), ["l_suppkey"], _W_ORDER, lambda w: {"prev": F.lag("l_quantity").over(w)}, before=1)
    return out.select("l_suppkey", *_W_ORDER, (F.col("l_quantity") - F.col("prev")).alias("diff1"),
                      _r(F.col("l_quantity") / F.col("prev") - 1).alias("pct_change"))


@query(
    "rank_global",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC) AS rank_price,
              dense_rank() OVER (ORDER BY l_extendedprice DESC) AS dense_rank_price
       FROM lineitem""",
)
def rank_global(spark, sf):
    """RANK rel BY price DESC [DENSE] over the whole table, without a
    single-partition window (range partitions + broadcast offsets)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return O.global_rank(li, ["l_extendedprice"], [False], out="rank_price", dense_out="dense_rank_price")


@query(
    "rank_methods",
    f"""SELECT {_COLS_SQL},
               CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS DOUBLE) AS rank_min,
               CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) + COUNT(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1 AS DOUBLE) AS rank_max,
               (2 * rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) + COUNT(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / 2.0 AS rank_avg,
               CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS DOUBLE) AS rank_dense,
               CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) - 1 AS DOUBLE) / (COUNT(*) OVER (PARTITION BY l_suppkey) - 1) AS rank_pct
        FROM lineitem""",
)
def rank_methods(spark, sf):
    """pandas-style rank per supplier (min / max / average / dense / percent),
    computed from global ranks so no supplier's rows meet in one task."""
    li = _lines(spark, sf)
    rk = O.group_rank(li, ["l_suppkey"], ["l_quantity"], out_prefix="rank_")
    n = li.groupBy(F.col("l_suppkey").alias("__k")).agg(F.count("*").alias("__n"))
    out = rk.join(n, rk.l_suppkey == n.__k)
    return out.select(
        *li.columns, F.col("rank_min").cast("double").alias("rank_min"), F.col("rank_max").cast("double").alias("rank_max"),
        F.col("rank_average").cast("double").alias("rank_avg"), F.col("rank_dense").cast("double").alias("rank_dense"),
        F.try_divide((F.col("rank_min") - 1).cast("double"), (F.col("__n") - 1).cast("double")).alias("rank_pct"))


# ------------------------------------------------------------------ §2.7


@query(
    "sort_total",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem
       ORDER BY l_returnflag DESC NULLS LAST, l_extendedprice ASC NULLS FIRST, l_orderkey, l_linenumber""",
)
def sort_total(spark, sf):
    """Total order with mixed directions and null placement (range-partitioned sort)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return O.sort_total(li, F.col("l_returnflag").desc_nulls_last(), F.col("l_extendedprice").asc_nulls_first(), "l_orderkey", "l_linenumber")


@query("sort_custom_key", "SELECT p_partkey, p_name FROM part ORDER BY length(p_name) DESC, p_name")
def sort_custom_key(spark, sf):
    """ORDER USING a comparator, as a sort on a derived key."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return p.orderBy(F.length("p_name").desc(), "p_name")


@query("sort_within", "SELECT l_suppkey, l_shipdate, l_orderkey FROM lineitem")
def sort_within(spark, sf):
    """Secondary sort: hash-partition by supplier, sort inside each partition."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey")
    return li.repartition("l_suppkey").sortWithinPartitions("l_suppkey", "l_shipdate")


@query(
    "limit_n",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_quantity LIMIT (SELECT COUNT(*) FROM supplier)""",
)
def limit_n(spark, sf):
    """LIMIT by a scalar expression (the number of suppliers), after an order."""
    n = table(spark, sf, "supplier").count()
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return li.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_quantity").limit(n)


@query(
    "topk_order_limit",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def topk_order_limit(spark, sf):
    """ORDER + LIMIT = top-k (TakeOrderedAndProject: per-task heaps, no full sort)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, 10, F.desc("o_totalprice"), F.col("o_orderkey"))


@query("part_control")
def part_control(spark, sf):
    """PARALLEL / repartition by hash and range / coalesce: rows per partition."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    h = li.repartition(6, "l_suppkey").groupBy(F.spark_partition_id().alias("pid")).count().withColumn("kind", F.lit("hash"))
    r = li.repartitionByRange(4, "l_orderkey").groupBy(F.spark_partition_id().alias("pid")).count().withColumn("kind", F.lit("range"))
    c = li.coalesce(2).groupBy(F.spark_partition_id().alias("pid")).count().withColumn("kind", F.lit("coalesce"))
    return h.unionByName(r).unionByName(c)


@query(
    "part_transforms",
    """SELECT year(o_orderdate) AS yr, month(o_orderdate) AS mo, COUNT(*) AS n, COUNT(DISTINCT day(o_orderdate)) AS n_days,
              COUNT(DISTINCT o_orderkey % 16) AS n_buckets
       FROM orders GROUP BY 1, 2""",
)
def part_transforms(spark, sf):
    """Layout by year / month / day / bucket: derived columns, written with
    partitionBy(yr, mo) to the shared folder and read back by partition discovery."""
    o = table(spark, sf, "orders")
    laid = o.select(
        "o_orderkey", F.year("o_orderdate").cast("long").alias("yr"), F.month("o_orderdate").cast("long").alias("mo"),
        F.dayofmonth("o_orderdate").alias("dy"), F.hour("o_orderdate").alias("hr"), F.pmod("o_orderkey", F.lit(16)).alias("bkt"))
    path = scratch_path(spark, "part-transforms")
    laid.write.mode("overwrite").partitionBy("yr", "mo").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("yr").cast("long").alias("yr"), F.col("mo").cast("long").alias("mo")).agg(
        F.count("*").alias("n"), F.count_distinct("dy").alias("n_days"), F.count_distinct("bkt").alias("n_buckets"))


@query(
    "row_ids",
    """SELECT COUNT(*) AS n, COUNT(*) AS n_uid, COUNT(*) AS n_idx, 0 AS first_idx, COUNT(*) - 1 AS last_idx FROM orders""",
)
def row_ids(spark, sf):
    """Unique ids (monotonically_increasing_id) and consecutive indexes (zipWithIndex form), summed up:
    every id is unique and the indexes run from 0 without a gap."""
    o = table(spark, sf, "orders").select("o_orderkey")
    ids = O.row_index(o.withColumn("uid", F.monotonically_increasing_id()), out="idx")
    return ids.agg(F.count("*").alias("n"), F.count_distinct("uid").alias("n_uid"), F.count_distinct("idx").alias("n_idx"),
                   F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query(
    "custom_input_zip",
    """SELECT a.c_custkey, b.p_name FROM (SELECT c_custkey FROM customer) a POSITIONAL JOIN (SELECT p_name FROM part) b
       WHERE a.c_custkey IS NOT NULL AND b.p_name IS NOT NULL""",
)
def custom_input_zip(spark, sf):
    """Zip two datasets by position: consecutive index on each, joined on it."""
    a = O.row_index(table(spark, sf, "customer").select("c_custkey"), out="i")
    b = O.row_index(table(spark, sf, "part").select("p_name"), out="i")
    return a.join(b, "i").select("c_custkey", "p_name")
