"""§2.4 grouping and aggregation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dataloom.operators import groups as G
from dataloom.operators import quantile as Q
from dataloom.plans.fixtures import CUSTOMER_NULLS_SQL, customer_nulls, with_ctes
from dataloom.plans.registry import query
from dataloom.session import scratch_path, table


def _r(c, d=6):
    return F.round(c, d)


@query(
    "group_bag",
    """SELECT o_custkey, COUNT(*) AS n_rows, max(o_orderkey) AS max_orderkey, round(SUM(o_totalprice), 4) AS total
       FROM orders GROUP BY o_custkey""",
)
def group_bag(spark, sf):
    """GROUP BY custkey into bags of at most 4 rows (small here to exercise the
    chunking), then each key's chunks are folded back: nothing is lost or
    duplicated and no bag grows with the data."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    bags = G.group_bag(o, ["o_custkey"], max_bag=4)
    per_chunk = bags.select(
        "o_custkey", F.size("bag").alias("n"), F.array_max(F.transform("bag", lambda t: t["o_orderkey"])).alias("mx"),
        F.aggregate("bag", F.lit(0.0), lambda acc, t: acc + t["o_totalprice"]).alias("s"),
    )
    return per_chunk.groupBy("o_custkey").agg(
        F.sum("n").alias("n_rows"), F.max("mx").alias("max_orderkey"), F.round(F.sum("s"), 4).alias("total"))


@query(
    "group_all",
    """SELECT COUNT(*) AS n, round(SUM(l_extendedprice), 2) AS revenue, round(AVG(l_discount), 6) AS avg_disc,
              max(l_shipdate) AS last_ship FROM lineitem""",
)
def group_all(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
                  _r(F.avg("l_discount")).alias("avg_disc"), F.max("l_shipdate").alias("last_ship"))


@query("group_any", "SELECT COUNT(*) AS n, SUM(l_quantity) AS qty FROM lineitem")
def group_any(spark, sf):
    """GROUP ANY: rows scattered over 16 arbitrary groups for parallel work; the groups' results folded into one."""
    li = table(spark, sf, "lineitem")
    g = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16))
    any_group = li.groupBy(g.alias("grp")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    return any_group.agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"))


@query(
    "group_cogroup",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT coalesce(c.k, s.k) AS nation_key, coalesce(c.n, 0) AS n_customers, coalesce(s.n, 0) AS n_suppliers,
                       round(c.bal, 2) AS customer_balance
                FROM (SELECT nation AS k, COUNT(*) AS n, SUM(bal) AS bal FROM customer_nulls GROUP BY nation) c
                FULL JOIN (SELECT s_nationkey AS k, COUNT(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey) s
                ON c.k = s.k WHERE coalesce(c.n, 0) > 0""",
    ),
)
def group_cogroup(spark, sf):
    """COGROUP customers BY nation (INNER), suppliers BY nation: per key counts;
    the null-nation customers stay a group of their own."""
    c = customer_nulls(spark, sf)
    s = table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    out = G.cogroup_counts(
        {"customers": (c, ["nation"]), "suppliers": (s, ["s_nationkey"])}, ["nation_key"], inner=["customers"],
        aggs={"customers": [F.round(F.sum("bal"), 2).alias("customer_balance")]},
    )
    return out.select("nation_key", "n_customers", "n_suppliers", "customer_balance")


def _bucketed(spark, df, name, key, sort=True):
    """Write ``df`` as a table bucketed (and sorted) on ``key`` into the shared
    scratch folder and return it; joins / groups on ``key`` then skip the shuffle.
    As many buckets as shuffle partitions; the table's name goes, its files stay."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    tname = f"{name}_{path.rsplit('-', 1)[-1]}"
    w = df.write.mode("overwrite").option("path", path).bucketBy(n, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(tname)
    out = spark.table(tname)
    spark.sql(f"DROP TABLE {tname}")
    return out


@query("group_collected", "SELECT o_custkey, COUNT(*) AS n_orders, round(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def group_collected(spark, sf):
    """'collected': input already clustered by key (bucketed table): the group-by
    runs without an Exchange."""
    o = _bucketed(spark, table(spark, sf, "orders"), "orders_by_cust", "o_custkey")
    return o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "group_merge",
    """SELECT o.o_orderkey, COUNT(l.l_orderkey) AS n_lines, o.o_totalprice FROM orders o LEFT JOIN lineitem l
       ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_totalprice""",
)
def group_merge(spark, sf):
    """'merge' cogroup of inputs bucketed and sorted on the same key: the join
    and the group-by need no Exchange on either side."""
    o = _bucketed(spark, table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "orders_by_key", "o_orderkey")
    li = _bucketed(spark, table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "lines_by_key", "l_orderkey")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.groupBy("o_orderkey", "o_totalprice").agg(F.count("l_orderkey").alias("n_lines")).select(
        "o_orderkey", "n_lines", "o_totalprice")


@query(
    "agg_count",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT n.n_nationkey, COUNT(c.name) AS count_, COUNT(c.c_custkey) AS count_star
                FROM nation n LEFT JOIN customer_nulls c ON c.nation = n.n_nationkey GROUP BY n.n_nationkey""",
    ),
)
def agg_count(spark, sf):
    """COUNT skips tuples whose first field (name) is null; COUNT_STAR counts all;
    nations without customers (empty bag) count 0."""
    c = customer_nulls(spark, sf)
    n = table(spark, sf, "nation").select("n_nationkey")
    j = n.join(c, c.nation == n.n_nationkey, "left")
    return j.groupBy("n_nationkey").agg(F.count("name").alias("count_"), F.count("c_custkey").alias("count_star"))


@query(
    "agg_sum_avg_min_max",
    """SELECT o_orderpriority, round(SUM(o_totalprice), 2) AS sum_, round(AVG(o_totalprice), 4) AS avg_,
              min(o_totalprice) AS min_, max(o_totalprice) AS max_, min(o_orderstatus) AS min_str, max(o_orderstatus) AS max_str,
              min(o_orderdate) AS min_date, max(o_orderdate) AS max_date, CAST(SUM(o_custkey) AS BIGINT) AS sum_long
       FROM orders GROUP BY o_orderpriority""",
)
def agg_sum_avg_min_max(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderpriority").agg(
        F.round(F.sum("o_totalprice"), 2).alias("sum_"), F.round(F.avg("o_totalprice"), 4).alias("avg_"),
        F.min("o_totalprice").alias("min_"), F.max("o_totalprice").alias("max_"), F.min("o_orderstatus").alias("min_str"),
        F.max("o_orderstatus").alias("max_str"), F.min("o_orderdate").alias("min_date"), F.max("o_orderdate").alias("max_date"),
        F.sum("o_custkey").alias("sum_long"),
    )


@query(
    "agg_distinct",
    """SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n_parts, CAST(SUM(DISTINCT l_quantity) AS DOUBLE) AS distinct_qty_sum
       FROM lineitem GROUP BY l_suppkey""",
)
def agg_distinct(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"), F.sum_distinct("l_quantity").alias("distinct_qty_sum"))


@query("agg_approx_distinct")
def agg_approx_distinct(spark, sf):
    """HyperLogLog distinct counts (2 % and 5 % target error) per supplier."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.approx_count_distinct("l_partkey", 0.02).alias("approx_parts"),
        F.approx_count_distinct("l_orderkey", 0.05).alias("approx_orders"),
    )


@query(
    "agg_stats",
    """WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mu FROM lineitem GROUP BY l_returnflag),
            p AS (SELECT l_orderkey, product(1 + l_discount) AS prod FROM lineitem GROUP BY l_orderkey),
            s AS (SELECT l.l_returnflag, var_pop(l_quantity) AS var_pop_, var_samp(l_quantity) AS var_samp_,
                         stddev_pop(l_quantity) AS stddev_pop_, stddev_samp(l_quantity) AS stddev_samp_,
                         avg(power(l_quantity - m.mu, 3)) / power(avg(power(l_quantity - m.mu, 2)), 1.5) AS skewness_,
                         avg(power(l_quantity - m.mu, 4)) / power(avg(power(l_quantity - m.mu, 2)), 2) - 3 AS kurtosis_,
                         stddev_samp(l_quantity) / sqrt(COUNT(*)) AS sem_, avg(abs(l_quantity - m.mu)) AS mad_,
                         max(pr.prod) AS max_order_product
                  FROM lineitem l JOIN m ON l.l_returnflag = m.l_returnflag JOIN p pr ON pr.l_orderkey = l.l_orderkey
                  GROUP BY l.l_returnflag)
       SELECT l_returnflag, round(var_pop_, 6) AS var_pop_, round(var_samp_, 6) AS var_samp_, round(stddev_pop_, 6) AS stddev_pop_,
              round(stddev_samp_, 6) AS stddev_samp_, round(skewness_, 6) AS skewness_, round(kurtosis_, 6) AS kurtosis_,
              round(sem_, 6) AS sem_, round(mad_, 6) AS mad_, round(max_order_product, 6) AS max_order_product FROM s""",
)
def agg_stats(spark, sf):
    """variance / stddev (pop, sample), skewness, kurtosis, product, sem and mad
    (mad needs the group mean: a second pass joined on the key)."""
    li = table(spark, sf, "lineitem")
    prod = li.groupBy("l_orderkey").agg(F.product(1 + F.col("l_discount")).alias("prod"))
    base = li.join(prod, "l_orderkey")
    q = F.col("l_quantity")
    s = base.groupBy("l_returnflag").agg(
        _r(F.var_pop(q)).alias("var_pop_"), _r(F.variance(q)).alias("var_samp_"), _r(F.stddev_pop(q)).alias("stddev_pop_"),
        _r(F.stddev(q)).alias("stddev_samp_"), _r(F.skewness(q)).alias("skewness_"), _r(F.kurtosis(q)).alias("kurtosis_"),
        _r(F.stddev_samp(q) / F.sqrt(F.count("*"))).alias("sem_"), _r(F.max("prod")).alias("max_order_product"),
    )
    mad = G.mean_abs_deviation(li, ["l_returnflag"], "l_quantity").select("l_returnflag", _r(F.col("mad_l_quantity")).alias("mad_"))
    return s.join(mad, "l_returnflag")


@query(
    "agg_corr_cov",
    """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS corr_qty_price,
              round(covar_pop(l_quantity, l_extendedprice), 4) AS cov_qty_price, round(covar_samp(l_discount, l_tax), 9) AS covs_disc_tax,
              round(corr(l_quantity, l_discount), 6) AS corr_qty_disc, round(corr(l_extendedprice, l_discount), 6) AS corr_price_disc,
              round(covar_pop(l_quantity, l_discount), 8) AS cov_qty_disc
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_corr_cov(spark, sf):
    """Pairwise corr / covariance (COV divides by n = covar_pop), all pairs in one aggregate."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        _r(F.corr("l_quantity", "l_extendedprice")).alias("corr_qty_price"),
        F.round(F.covar_pop("l_quantity", "l_extendedprice"), 4).alias("cov_qty_price"),
        F.round(F.covar_samp("l_discount", "l_tax"), 9).alias("covs_disc_tax"),
        _r(F.corr("l_quantity", "l_discount")).alias("corr_qty_disc"),
        _r(F.corr("l_extendedprice", "l_discount")).alias("corr_price_disc"),
        F.round(F.covar_pop("l_quantity", "l_discount"), 8).alias("cov_qty_disc"),
    )


@query(
    "agg_percentile",
    """SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median_, quantile_cont(l_quantity, 0.9) AS p90,
              quantile_disc(l_quantity, 0.25) AS approx_p25, quantile_disc(l_quantity, 0.75) AS approx_p75
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_percentile(spark, sf):
    """Exact (interpolated) median / p90 by selection over running value counts,
    and sketch-based approximate quartiles (mergeable, bounded memory)."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")
    exact = Q.percentiles(li, ["l_returnflag"], "l_quantity", {"median_": 0.5, "p90": 0.9})
    rough = li.groupBy("l_returnflag").agg(
        F.percentile_approx("l_quantity", 0.25, 100000).alias("approx_p25"),
        F.percentile_approx("l_quantity", 0.75, 100000).alias("approx_p75"),
    )
    return exact.join(rough, exact["l_returnflag"].eqNullSafe(rough["l_returnflag"])).select(
        exact["l_returnflag"], "median_", "p90", "approx_p25", "approx_p75")


@query(
    "agg_mode_value_counts",
    """WITH vc AS (SELECT l_returnflag, l_quantity, COUNT(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_quantity),
            tot AS (SELECT l_returnflag, SUM(cnt) AS total, COUNT(*) AS nunique FROM vc GROUP BY l_returnflag),
            rk AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY cnt DESC, l_quantity) AS rnk FROM vc)
       SELECT rk.l_returnflag, rk.l_quantity, rk.cnt, round(rk.cnt / tot.total, 6) AS frac, rk.rnk,
              tot.nunique, (SELECT l_quantity FROM rk r2 WHERE r2.l_returnflag = rk.l_returnflag AND r2.rnk = 1) AS mode_
       FROM rk JOIN tot ON rk.l_returnflag = tot.l_returnflag WHERE rk.rnk <= 5""",
)
def agg_mode_value_counts(spark, sf):
    """Normalised value counts (top 5 per flag), mode (lowest among ties), nunique."""
    li = table(spark, sf, "lineitem")
    vc = li.groupBy("l_returnflag", "l_quantity").agg(F.count("*").alias("cnt"))
    tot = vc.groupBy("l_returnflag").agg(F.sum("cnt").alias("total"), F.count("*").alias("nunique"))
    mode = Q.modes(vc.select("l_returnflag", F.col("l_quantity").alias("value"), F.col("cnt").alias("n")), ["l_returnflag"], "mode_")
    w = Window.partitionBy("l_returnflag").orderBy(F.desc("cnt"), "l_quantity")
    rk = vc.withColumn("rnk", F.row_number().over(w)).filter(F.col("rnk") <= 5)
    return rk.join(tot, "l_returnflag").join(mode, "l_returnflag").select(
        "l_returnflag", "l_quantity", "cnt", _r(F.col("cnt") / F.col("total")).alias("frac"), F.col("rnk").cast("long").alias("rnk"),
        "nunique", "mode_")


@query(
    "agg_collect",
    """SELECT l_orderkey, array_to_string(list_sort(list(CAST(l_linenumber AS VARCHAR))), ',') AS lines,
              array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags
       FROM lineitem GROUP BY l_orderkey""",
)
def agg_collect(spark, sf):
    """collect_list / collect_set per order (an order has a bounded number of lines)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.array_join(F.sort_array(F.collect_list(F.col("l_linenumber").cast("string"))), ",").alias("lines"),
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"),
    )


@query(
    "agg_first_last",
    """SELECT l_orderkey, arg_min(l_quantity, (epoch(l_shipdate) * 100 + l_linenumber, l_quantity)) AS first_qty,
              arg_max(l_quantity, (epoch(l_shipdate) * 100 + l_linenumber, l_quantity)) AS last_qty
       FROM lineitem GROUP BY l_orderkey""",
)
def agg_first_last(spark, sf):
    """first / last by an explicit order (ship date, line number, value): min_by / max_by."""
    li = table(spark, sf, "lineitem")
    k = F.struct(
        (F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double") * 100 + F.col("l_linenumber")).alias("t"),
        F.col("l_quantity").alias("q"),
    )
    return li.groupBy("l_orderkey").agg(F.min_by("l_quantity", k).alias("first_qty"), F.max_by("l_quantity", k).alias("last_qty"))


@query(
    "agg_max_by",
    """SELECT l_suppkey, arg_max(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) AS max_orderkey,
              arg_max(l_linenumber, (l_extendedprice, l_orderkey, l_linenumber)) AS max_linenumber,
              arg_min(l_orderkey, (l_extendedprice, -l_orderkey, -l_linenumber)) AS min_orderkey
       FROM lineitem GROUP BY l_suppkey""",
)
def agg_max_by(spark, sf):
    """Row holding the max (min) price per supplier, ties broken by key."""
    li = table(spark, sf, "lineitem")
    hi = F.struct("l_extendedprice", "l_orderkey", "l_linenumber")
    lo = F.struct("l_extendedprice", (-F.col("l_orderkey")).alias("a"), (-F.col("l_linenumber")).alias("b"))
    best = F.max_by(F.struct("l_orderkey", "l_linenumber"), hi)
    return li.groupBy("l_suppkey").agg(best.alias("b"), F.min_by("l_orderkey", lo).alias("min_orderkey")).select(
        "l_suppkey", F.col("b.l_orderkey").alias("max_orderkey"), F.col("b.l_linenumber").alias("max_linenumber"), "min_orderkey")


@query(
    "agg_bool",
    """SELECT l_orderkey, bool_and(l_returnflag = 'N') AS all_n, bool_or(l_discount > 0.09) AS any_big_discount
       FROM lineitem GROUP BY l_orderkey""",
)
def agg_bool(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.bool_and(F.col("l_returnflag") == "N").alias("all_n"),
                                        F.bool_or(F.col("l_discount") > 0.09).alias("any_big_discount"))


@query(
    "agg_topn_bag",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn
         FROM lineitem) WHERE rn <= 3""",
)
def agg_topn_bag(spark, sf):
    """TOP(3, price, bag) per supplier (descending); partial top-n before the shuffle."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return G.top_n(li, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 3)


@query(
    "agg_pivot",
    """SELECT l_returnflag, SUM(l_quantity) FILTER (WHERE l_linestatus = 'F') AS F_sum_qty,
              round(AVG(l_extendedprice) FILTER (WHERE l_linestatus = 'F'), 4) AS F_avg_price,
              SUM(l_quantity) FILTER (WHERE l_linestatus = 'O') AS O_sum_qty,
              round(AVG(l_extendedprice) FILTER (WHERE l_linestatus = 'O'), 4) AS O_avg_price
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_pivot(spark, sf):
    """Pivot with the value list given (no extra pass to find the values)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"))


@query(
    "agg_cube",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT s AS seg, n AS nation, CAST(grouping(s, n) AS BIGINT) AS gid, COUNT(*) AS cnt, round(SUM(bal), 2) AS bal
                FROM (SELECT coalesce(seg, 'unknown') AS s, coalesce(CAST(nation AS VARCHAR), 'unknown') AS n, bal FROM customer_nulls)
                GROUP BY CUBE(s, n)""",
    ),
)
def agg_cube(spark, sf):
    """CUBE(seg, nation): data nulls first become 'unknown', so the all-marker
    (null) is distinct from them."""
    c = customer_nulls(spark, sf)
    return G.cube(c, ["seg", "nation"], [F.grouping_id().alias("gid"), F.count("*").alias("cnt"), F.round(F.sum("bal"), 2).alias("bal")])


@query(
    "agg_rollup",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS cnt, SUM(l_quantity) AS qty
       FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)""",
)
def agg_rollup(spark, sf):
    li = table(spark, sf, "lineitem")
    return G.rollup(li, ["l_returnflag", "l_linestatus"], [F.count("*").alias("cnt"), F.sum("l_quantity").alias("qty")])


@query(
    "agg_cube_rollup_mix",
    """SELECT l_returnflag, l_linestatus, ship_year, tax_band, CAST(grouping(l_returnflag, l_linestatus, ship_year, tax_band) AS BIGINT) AS gid,
              COUNT(*) AS cnt, SUM(l_quantity) AS qty
       FROM (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year, CAST(round(l_tax * 100) AS BIGINT) AS tax_band, l_quantity FROM lineitem)
       GROUP BY CUBE(l_returnflag, l_linestatus), ROLLUP(ship_year, tax_band)""",
)
def agg_cube_rollup_mix(spark, sf):
    """CUBE(a, b), ROLLUP(c, d) in one clause = the product of their grouping sets."""
    li = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").cast("long").alias("ship_year"),
        F.round(F.col("l_tax") * 100).cast("long").alias("tax_band"), "l_quantity")
    li.createOrReplaceTempView("li_mix")
    return spark.sql(
        """SELECT l_returnflag, l_linestatus, ship_year, tax_band, grouping_id() AS gid, COUNT(*) AS cnt, SUM(l_quantity) AS qty
           FROM li_mix GROUP BY CUBE(l_returnflag, l_linestatus), ROLLUP(ship_year, tax_band)""")


@query(
    "agg_partial_final",
    """SELECT l_returnflag, round(exp(avg(ln(l_quantity))), 6) AS geo_mean_qty, COUNT(*) AS n, max(l_extendedprice) AS max_price
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_partial_final(spark, sf):
    """A user algebraic aggregate (geometric mean) in initial / intermediate /
    final form: per (key, salt) partial sums of logs and counts, then merged."""
    li = table(spark, sf, "lineitem")
    salt = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16))
    part = li.groupBy("l_returnflag", salt.alias("salt")).agg(
        F.sum(F.log("l_quantity")).alias("sl"), F.count("*").alias("n"), F.max("l_extendedprice").alias("mx"))
    return part.groupBy("l_returnflag").agg(
        _r(F.exp(F.sum("sl") / F.sum("n"))).alias("geo_mean_qty"), F.sum("n").alias("n"), F.max("mx").alias("max_price"))


@query(
    "agg_reduce_fold",
    """SELECT COUNT(*) AS count_, SUM(l_quantity) AS sum_, round(AVG(l_quantity), 6) AS mean_, max(l_quantity) AS max_,
              min(l_quantity) AS min_, round(var_pop(l_quantity), 6) AS variance_, round(stddev_pop(l_quantity), 6) AS stdev_,
              round(var_samp(l_quantity), 6) AS sample_variance, round(stddev_samp(l_quantity), 6) AS sample_stdev,
              COUNT(*) FILTER (WHERE l_returnflag = 'R') AS count_key_r, SUM(l_quantity) FILTER (WHERE l_orderkey = 7) AS lookup_7
       FROM lineitem""",
)
def agg_reduce_fold(spark, sf):
    """reduce / fold / stats / countByKey / lookup as one aggregate pass."""
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity")
    return li.agg(
        F.count("*").alias("count_"), F.sum(q).alias("sum_"), _r(F.avg(q)).alias("mean_"), F.max(q).alias("max_"),
        F.min(q).alias("min_"), _r(F.var_pop(q)).alias("variance_"), _r(F.stddev_pop(q)).alias("stdev_"),
        _r(F.var_samp(q)).alias("sample_variance"), _r(F.stddev_samp(q)).alias("sample_stdev"),
        F.count_if(F.col("l_returnflag") == "R").alias("count_key_r"),
        F.sum(F.when(F.col("l_orderkey") == 7, q)).alias("lookup_7"),
    )


@query("agg_estimated")
def agg_estimated(spark, sf):
    """count / sum / mean from a 10 % Bernoulli sample, scaled up, with normal
    95 % bounds (the sampling is the feature of this operator)."""
    li = table(spark, sf, "lineitem")
    p = 0.1
    s = li.filter(F.rand(11) < p).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("s"),
                                       F.avg("l_quantity").alias("m"), F.stddev("l_quantity").alias("sd"))
    return s.select(
        (F.col("n") / p).alias("count_est"), (F.sqrt(F.col("n") * (1 - p)) / p * 1.96).alias("count_err"),
        (F.col("s") / p).alias("sum_est"), F.col("m").alias("mean_est"), (F.col("sd") / F.sqrt("n") * 1.96).alias("mean_err"),
    )


@query(
    "agg_skew_salted",
    """SELECT l_returnflag, SUM(l_quantity) AS sum_l_quantity, COUNT(l_quantity) AS count_l_quantity, max(l_quantity) AS max_l_quantity
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_skew_salted(spark, sf):
    """Three return flags each hold about a third of the rows: two-level salted aggregate."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey", "l_linenumber")
    return G.salted_sum_count_max(li, ["l_returnflag"], "l_quantity")


@query("agg_freq_items")
def agg_freq_items(spark, sf):
    """Frequent items (support 0.2): a superset of the values above the support."""
    li = table(spark, sf, "lineitem")
    return li.stat.freqItems(["l_returnflag", "l_linestatus", "l_linenumber"], 0.2)


@query(
    "agg_histogram",
    """SELECT 'even' AS kind, CAST(CASE WHEN l_quantity >= 50 THEN 11 WHEN l_quantity < 0 THEN 0 ELSE floor(l_quantity / 5) + 1 END AS BIGINT) AS bucket, COUNT(*) AS cnt
       FROM lineitem GROUP BY 2
       UNION ALL
       SELECT 'edges', CAST(CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 20 THEN 2 WHEN l_quantity < 35 THEN 3 ELSE 4 END AS BIGINT), COUNT(*)
       FROM lineitem GROUP BY 2""",
)
def agg_histogram(spark, sf):
    """Counts per bucket: 10 even buckets over [0, 50) and given edges."""
    li = table(spark, sf, "lineitem")
    even = li.groupBy(F.width_bucket("l_quantity", F.lit(0.0), F.lit(50.0), F.lit(10)).alias("bucket")).agg(F.count("*").alias("cnt"))
    q = F.col("l_quantity")
    edges = F.when(q < 10, 1).when(q < 20, 2).when(q < 35, 3).otherwise(4).cast("long")
    eg = li.groupBy(edges.alias("bucket")).agg(F.count("*").alias("cnt"))
    return even.select(F.lit("even").alias("kind"), "bucket", "cnt").unionByName(eg.select(F.lit("edges").alias("kind"), "bucket", "cnt"))


@query(
    "agg_describe",
    """SELECT l_returnflag, COUNT(l_quantity) AS count_, round(AVG(l_quantity), 6) AS mean_, round(stddev_samp(l_quantity), 6) AS std_,
              min(l_quantity) AS min_, quantile_disc(l_quantity, 0.25) AS p25, quantile_disc(l_quantity, 0.5) AS p50,
              quantile_disc(l_quantity, 0.75) AS p75, max(l_quantity) AS max_
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_describe(spark, sf):
    """describe / summary per group: count, mean, std, min, quartiles (sketch), max."""
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(
        F.count(q).alias("count_"), _r(F.avg(q)).alias("mean_"), _r(F.stddev(q)).alias("std_"), F.min(q).alias("min_"),
        F.percentile_approx(q, 0.25, 100000).alias("p25"), F.percentile_approx(q, 0.5, 100000).alias("p50"),
        F.percentile_approx(q, 0.75, 100000).alias("p75"), F.max(q).alias("max_"))


@query("agg_observe", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0.05")
def agg_observe(spark, sf):
    """Named metrics gathered while the query runs (no second pass); they are
    reported to query listeners under the name ``lineitem_metrics``. (The
    ``Observation`` wrapper is avoided: on 4.1 it leaves a non-serialisable
    manager in the session that later breaks ML model closures.)"""
    li = table(spark, sf, "lineitem")
    out = li.observe("lineitem_metrics", F.count(F.lit(1)).alias("rows"), F.max("l_quantity").alias("max_qty")).filter(
        F.col("l_discount") > 0.05)
    return out.select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "agg_having",
    """SELECT l_suppkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_suppkey HAVING SUM(l_quantity) > avg(l_quantity) * 600""",
)
def agg_having(spark, sf):
    li = table(spark, sf, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty"), F.avg("l_quantity").alias("a"))
    return g.filter(F.col("qty") > F.col("a") * 600).select("l_suppkey", "qty")


@query(
    "group_cardinality_scan",
    """SELECT COUNT(DISTINCT o_orderstatus) AS o_orderstatus, COUNT(DISTINCT o_orderpriority) AS o_orderpriority,
              COUNT(DISTINCT o_custkey) AS o_custkey FROM orders""",
)
def group_cardinality_scan(spark, sf):
    """Distinct count of each categorical column in one aggregate, to choose an encoding tier."""
    o = table(spark, sf, "orders")
    cols = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    return o.agg(*[F.count_distinct(c).alias(c) for c in cols])
