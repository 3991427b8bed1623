"""Null / index / rounding rules of the reference on literal rows,
and brute-force checks of the operators Spark does not have built in."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dataloom.functions import dates as D
from dataloom.functions import mathx as M
from dataloom.functions import strings as S
from dataloom.operators import groups as G
from dataloom.operators import joins as J
from dataloom.operators import order as O
from dataloom.operators import project as P


def one(df):
    return [tuple(r) for r in df.collect()]


def test_substring_indexof_zero_based(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",)], "s string")
    out = one(df.select(S.substring0(F.col("s"), 1, 4).alias("a"), S.substring0(F.col("s"), 1, 99).alias("b"),
                        S.index_of(F.col("s"), "c").alias("c"), S.last_index_of(F.col("s"), "b").alias("d")))
    assert out == [("bcd", "bcdef", 2, 1), ("b", "b", -1, 1)]


def test_strsplit_java_limit_zero_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a,b,,",), (",a",), ("a,,b",)], "s string")
    got = [r[0] for r in df.select(S.strsplit(F.col("s"), ",", 0)).collect()]
    assert got == [["a", "b"], ["", "a"], ["a", "", "b"]]
    assert [r[0] for r in df.select(S.strsplit(F.col("s"), ",", 2)).collect()][0] == ["a", "b,,"]


def test_regex_rules(spark):
    df = spark.createDataFrame([("abc123",), ("xyz",)], "s string")
    out = one(df.select(S.regex_extract(F.col("s"), "([0-9]+)", 1), S.matches(F.col("s"), "[a-z]+"),
                        S.regex_extract_all(F.col("s"), "([a-z]+)([0-9]+)")))
    assert out == [("123", False, ["abc", "123"]), (None, True, None)]


def test_tokenize_and_ucfirst(spark):
    df = spark.createDataFrame([('hello "big" (world),x*y',)], "s string")
    assert df.select(S.tokenize(F.col("s"))).first()[0] == ["hello", "big", "world", "x", "y"]
    assert df.select(S.ucfirst(F.lit("abc"))).first()[0] == "Abc"


def _fnv_reference(s: str) -> int:
    h = 33554467
    for b in s.encode("utf-8"):
        sb = b - 256 if b >= 128 else b
        h = ((h * 16777619) & 0xFFFFFFFF) ^ (sb & 0xFFFFFFFF)
    if h >= 2**31:
        h -= 2**32
    return abs(h)


def test_fnv_matches_brute_force(spark):
    words = ["", "a", "hello world", "Étion dans", "ümlaut ß"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(S.hash_fnv32(F.col("s"))).collect()]
    assert got == [_fnv_reference(w) for w in words]


def test_divide_and_rounding(spark):
    df = spark.createDataFrame([(7, 2, 2.5), (7, 0, -2.5), (-7, 2, 0.125)], "a int, b int, x double")
    out = one(df.select(M.int_divide(F.col("a"), F.col("b")), M.divide(F.col("a"), F.col("b")), M.round_to(F.col("x"), 0),
                        M.round_half_up(F.col("x"))))
    assert out == [(3, 3.5, 2.0, 3), (None, None, -2.0, -2), (-3, -3.5, 0.0, 0)]


def test_yes_no_and_keyword_label(spark):
    df = spark.createDataFrame([("Y",), ("no",), ("1",), ("maybe",), (None,)], "s string")
    assert [r[0] for r in df.select(S.yes_no(F.col("s"))).collect()] == [1, 0, 1, None, None]
    lab = S.keyword_label(F.col("s"), [("y", 2), ("n", 1)], 0)
    assert [r[0] for r in df.select(lab).collect()] == [2, 1, 0, 2, 0]


def test_between_truncates_toward_zero(spark):
    df = spark.createDataFrame([("2020-01-31 00:00:00", "2020-05-30 00:00:00")], "a string, b string").select(
        F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    assert df.select(D.between("MONTH", F.col("b"), F.col("a")), D.between("MONTH", F.col("a"), F.col("b"))).first() == (3, -3)


def test_parse_first_and_epoch(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("5/1/2024 10:00:00",), ("5/1/2024 10:00",), ("1704067207",), ("bad",)], "s string")
    got = [r[0] for r in df.select(D.parse_first(F.col("s"), ["yyyy-MM-dd HH:mm:ss", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm"])).collect()]
    assert [str(g) if g else None for g in got] == ["2024-01-05 10:00:00", "2024-01-05 10:00:00", "2024-01-05 10:00:00",
                                                    "2024-01-01 00:00:07", None]


def test_flatten_bag_rules(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, bag array<string>")
    got = sorted(one(df.select("k", P.flatten_bag(F.col("bag")).alias("v"))), key=repr)
    assert got == [(1, "a"), (1, "b"), (3, None)]


def test_split_route_otherwise_all(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    r = P.split_route(df, {"lo": F.col("x") < 3}, otherwise="rest", keep_nulls=True)
    assert sorted([x[0] for x in r["rest"].collect()], key=lambda v: (v is None, v)) == [5, None]
    r2 = P.split_route(df, {"lo": F.col("x") < 3}, otherwise="rest", keep_nulls=False)
    assert [x[0] for x in r2["rest"].collect()] == [5]


def test_assert_rows_fails(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    with pytest.raises(Exception):
        P.assert_rows(df, F.col("x") > 0, "x must be positive").collect()


def test_cube_unknown_marker(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "d string, v int")
    out = {(r["d"], r["s"]) for r in G.cube(df, ["d"], [F.sum("v").alias("s")]).collect()}
    assert out == {("a", 1), ("unknown", 2), (None, 3)}


def test_group_bag_chunks_bounded(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), "id")
    bags = G.group_bag(df, ["k"], max_bag=50)
    sizes = [r[0] for r in bags.select(F.size("bag")).collect()]
    assert max(sizes) <= 80 and sum(sizes) == 1000


def test_cogroup_null_keys_separate(spark):
    a = spark.createDataFrame([(1,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    out = sorted(one(G.cogroup_counts({"a": (a, ["k"]), "b": (b, ["k"])}, ["key"])), key=repr)
    assert out == sorted([(1, 1, 1), (None, 1, 0), (None, 0, 1)], key=repr)


def test_asof_matches_pandas(spark):
    random.seed(1)
    left = [(i, random.choice("ab"), float(random.randint(0, 100))) for i in range(60)]
    right = [(random.choice("ab"), float(random.randint(0, 100)), float(j)) for j in range(40)]
    ldf = spark.createDataFrame(left, "id int, g string, t double")
    rdf = spark.createDataFrame(right, "g string, t double, val double").dropDuplicates(["g", "t"])
    for tol in (None, 10.0):
        got = {r["id"]: r["val"] for r in J.asof_join(ldf, rdf, "t", ["g"], tolerance=tol).collect()}
        lp = pd.DataFrame(left, columns=["id", "g", "t"]).sort_values("t")
        rp = rdf.toPandas().sort_values("t")
        exp = pd.merge_asof(lp, rp, on="t", by="g", tolerance=tol, direction="backward")
        for _, r in exp.iterrows():
            e = None if pd.isna(r["val"]) else r["val"]
            assert got[r["id"]] == e


def test_range_join_matches_brute_force(spark):
    pts = spark.createDataFrame([(i, float(i) * 0.7) for i in range(100)], "pid int, x double")
    rng = spark.createDataFrame([(j, float(j) * 3, float(j) * 3 + 5.5) for j in range(25)], "rid int, lo double, hi double")
    got = {(r["pid"], r["rid"]) for r in J.range_join(pts, rng, "x", "lo", "hi", bucket=4.0).collect()}
    exp = {(i, j) for i in range(100) for j in range(25) if j * 3 <= i * 0.7 < j * 3 + 5.5}
    assert got == exp


def test_bloom_and_salted_joins_equal_plain(spark):
    a = spark.range(0, 3000).select((F.col("id") % 500).alias("k"), "id")
    a = a.unionByName(spark.range(0, 2000).select(F.lit(7).cast("long").alias("k"), (F.col("id") + 10_000).alias("id")))
    b = spark.range(0, 400).select(F.col("id").alias("k2"), (F.col("id") * 3).alias("v"))
    plain = sorted(one(a.join(b, a.k == b.k2).select("id", "v")))
    assert sorted(one(J.bloom_join(a, b, ["k"], ["k2"]).select("id", "v"))) == plain
    assert sorted(one(J.salted_join(a, b, ["k"], ["k2"], hot_fraction=0.05).select("id", "v"))) == plain


def test_global_and_group_rank_match_pandas(spark):
    random.seed(3)
    rows = [(random.choice("xyz"), random.randint(0, 20)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v int")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    gr = O.global_rank(df, ["v"], [False], out="r").toPandas()
    exp = pdf["v"].rank(method="min", ascending=False)
    assert sorted(gr["r"].tolist()) == sorted(exp.astype(int).tolist())
    m = O.group_rank(df, ["g"], ["v"]).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    p = pdf.sort_values(["g", "v"]).reset_index(drop=True)
    for meth, col in (("min", "rank_min"), ("max", "rank_max"), ("average", "rank_average"), ("dense", "rank_dense")):
        assert m[col].astype(float).tolist() == p.groupby("g")["v"].rank(method=meth).astype(float).tolist()


def test_row_index_consecutive(spark):
    df = spark.range(0, 1000, numPartitions=7)
    idx = [r[0] for r in O.row_index(df, out="i").select("i").collect()]
    assert sorted(idx) == list(range(1000))


def test_fits_broadcast_bound(spark):
    assert J.fits_broadcast(spark.range(10), 80)
    assert not J.fits_broadcast(spark.range(11), 80)


def test_running_agg_matches_window_with_hot_key(spark):
    from pyspark.sql import Window

    rows = [(0 if i % 3 else i % 7, i, float((i * 37) % 101)) for i in range(3000)]  # key 0 holds two thirds
    df = spark.createDataFrame(rows, "k int, t int, v double")
    got = O.running_agg(df, ["k"], ["t"], "v", partitions=6)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "t", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("c"), F.min("v").over(w).alias("mn"),
                    F.max("v").over(w).alias("mx"))
    a = sorted(one(got.select("k", "t", "run_sum", "run_count", "run_min", "run_max")))
    b = sorted(one(exp))
    assert a == b


def test_seqwin_frames_match_native_windows(spark):
    from pyspark.sql import Window

    from dataloom.operators import seqwin as SW

    rows = [(0 if i % 4 else 1 + i % 5, i, float((i * 53) % 97)) for i in range(2000)]  # key 0 holds three quarters
    df = spark.createDataFrame(rows, "k int, t int, v double")
    pos = SW.with_position(df, ["k"], ["t"])
    got = SW.frame(pos, ["k"], -2, 1, {
        "s": lambda x: F.sum(x("v")), "c": lambda x: F.count(x("v")), "f": SW.first_in_frame("v"), "l": SW.last_in_frame("v"),
        "n2": SW.nth_in_frame(2, "v"), "lag2": SW.shift_value(-2, "v", -1.0), "lead1": SW.shift_value(1, "v", 0.0)})
    w = Window.partitionBy("k").orderBy("t")
    f = w.rowsBetween(-2, 1)
    exp = df.select("k", "t", "v", F.sum("v").over(f).alias("s"), F.count("v").over(f).alias("c"), F.first("v").over(f).alias("f"),
                    F.last("v").over(f).alias("l"), F.nth_value("v", 2).over(f).alias("n2"), F.lag("v", 2, -1.0).over(w).alias("lag2"),
                    F.lead("v", 1, 0.0).over(w).alias("lead1"))
    cols = ["k", "t", "v", "s", "c", "f", "l", "n2", "lag2", "lead1"]
    assert sorted(one(got.select(*cols))) == sorted(one(exp.select(*cols)))


def test_distributed_fill_matches_window(spark):
    from pyspark.sql import Window

    from dataloom.operators import seqwin as SW

    rows = [(i % 3 if i % 7 else None, i, None if i % 4 else float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    got = SW.fill_directional(df.withColumn("b", F.col("v")), ["v"], ["t"], ["k"], forward=True)
    got = SW.fill_directional(got, ["b"], ["t"], ["k"], forward=False)
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v"),
                    F.first("v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(one(got.select("k", "t", "v", "b")), key=key) == sorted(one(exp), key=key)


def test_asof_nearest_matches_pandas(spark):
    random.seed(5)
    left = [(i, random.choice("ab"), float(random.randint(0, 200))) for i in range(50)]
    right = [(random.choice("ab"), float(random.randint(0, 200)), float(j)) for j in range(30)]
    ldf = spark.createDataFrame(left, "id int, g string, t double")
    rdf = spark.createDataFrame(right, "g string, t double, val double").dropDuplicates(["g", "t"])
    got = {r["id"]: r["val"] for r in J.asof_join(ldf, rdf, "t", ["g"], direction="nearest").collect()}
    lp = pd.DataFrame(left, columns=["id", "g", "t"]).sort_values("t")
    exp = pd.merge_asof(lp, rdf.toPandas().sort_values("t"), on="t", by="g", direction="nearest")
    for _, r in exp.iterrows():
        assert got[r["id"]] == (None if pd.isna(r["val"]) else r["val"])


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_without_tolerance_matches_pandas(spark, direction):
    random.seed(9)
    left = [(i, "a" if i % 5 else "b", float(random.randint(0, 300))) for i in range(80)]
    right = [("a" if j % 4 else "b", float(random.randint(0, 300)), float(j)) for j in range(60)]
    ldf = spark.createDataFrame(left, "id int, g string, t double")
    rdf = spark.createDataFrame(right, "g string, t double, val double").dropDuplicates(["g", "t"])
    got = {r["id"]: r["val"] for r in J.asof_join(ldf, rdf, "t", ["g"], direction=direction).collect()}
    lp = pd.DataFrame(left, columns=["id", "g", "t"]).sort_values("t")
    exp = pd.merge_asof(lp, rdf.toPandas().sort_values("t"), on="t", by="g", direction=direction)
    for _, r in exp.iterrows():
        assert got[r["id"]] == (None if pd.isna(r["val"]) else r["val"])


def _window_sessions(df, key, ts, gap_seconds):
    """Batch sessionization: a new session when the gap to the previous event
    of the key reaches ``gap_seconds``; session id by cumulative sum."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(ts)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    prev = F.lag(t).over(w)
    new = F.when(prev.isNull() | (t - prev >= gap_seconds * 1_000_000), 1).otherwise(0)
    s = df.withColumn("__new", new).withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(key, "__sid").agg(
        F.min(ts).alias("session_start"), (F.max(ts) + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count("*").alias("n")).drop("__sid")


def test_distributed_sessions_match_window_form(spark):
    from dataloom.operators import seqwin as SW

    random.seed(11)
    rows = [(0 if i % 3 else i % 4, 60 * random.randint(0, 3000)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, s long").select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    a = sorted(one(SW.sessions(df, "k", "ts", 1800).select("k", "session_start", "session_end", "n")))
    b = sorted(one(_window_sessions(df, "k", "ts", 1800).select("k", "session_start", "session_end", "n")))
    assert a == b


def test_log_query_stats_rejects_to_null_key(spark):
    from dataloom.plans.q_jobs import log_query_stats

    ok = '10.0.0.1 - bob [01/Jan/2024:00:00:07 +0000] "GET /a HTTP/1.1" 200 512 "http://r/" "UA"'
    dash = '10.0.0.1 - bob [01/Jan/2024:00:00:08 +0000] "GET /a HTTP/1.1" 304 - "http://r/" "UA"'
    junk = "not a log line"
    df = spark.createDataFrame([(ok,), (dash,), (junk,)], "value string")
    got = sorted(one(log_query_stats(df)), key=repr)
    assert got == sorted([("10.0.0.1", "bob", "GET /a HTTP/1.1", 2, 512), (None, None, None, 1, 0)], key=repr)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_salted_join_modes_match_the_plain_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [("a", 1), ("b", 2), (None, 3), (None, 4), ("lone", 5)], "k string, v long")
    right = spark.createDataFrame([("hot", 10), ("hot", 11), ("a", 12), ("none", 13), (None, 14)], "rk string, w long")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        plain = left.join(right, left.k == right.rk, how)
        salted = J.join(left, right, ["k"], ["rk"], how=how, strategy="skewed")
        assert salted.columns == plain.columns and _rows(salted) == _rows(plain), how


def test_broadcast_check_runs_no_job_and_falls_back(spark):
    df = spark.range(1 << 24)
    assert J.checked_broadcast(df, 1 << 20) is df
    assert "BroadcastExchange" in spark.range(5).join(J.checked_broadcast(spark.range(10)), "id")._jdf.queryExecution().toString()


def test_bloom_join_sizes_its_bitmap(spark):
    left, right = spark.range(5000).withColumnRenamed("id", "k"), spark.range(0, 5000, 7).withColumnRenamed("id", "rk")
    for bits in (None, 1 << 20):
        assert J.bloom_join(left, right, ["k"], ["rk"], bits=bits).count() == right.count()


def test_asof_null_keys_match_nothing(spark):
    left = spark.createDataFrame([("a", 5.0), (None, 5.0), ("a", None)], "k string, t double")
    right = spark.createDataFrame([("a", 1.0, "x"), (None, 1.0, "nullrow")], "k string, t double, w string")
    got = {(r.k, r.t): r.w for r in J.asof_join(left, right, "t", ["k"]).collect()}
    assert got == {("a", 5.0): "x", (None, 5.0): None, ("a", None): None}


def test_graph_loops_run_to_the_end(spark):
    from dataloom.graphs import iterative as GI

    path = spark.createDataFrame([(i, i + 1, 1.0) for i in range(500)] + [(900, 900, 1.0)], "src long, dst long, w double")
    labels = {r.v: r.label for r in GI.connected_components(path).collect()}
    assert labels == {**{i: 0 for i in range(501)}, 900: 900}
    short = path.where("src < 60")
    assert {r.v: r.d for r in GI.sssp(short, 0).collect()} == {i: float(i) for i in range(61)}
    assert GI.transitive_closure(short.where("src < 20")).count() == 21 * 20 // 2
    from_two = GI.transitive_closure(short.where("src < 20"), spark.createDataFrame([(2,)], "src long"))
    assert sorted(r.dst for r in from_two.collect()) == list(range(3, 21))


def test_pagerank_rounds_do_not_shuffle_the_links(spark):
    from dataloom.graphs import iterative as GI

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    real = GI.fixed
    GI.fixed = lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name)
    try:
        GI.pagerank(spark.createDataFrame([(i % 50, i % 49) for i in range(500)], "src long, dst long"), 2)
    finally:
        GI.fixed = real
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = 0
    for lines in (p.splitlines() for p in plans):
        for at in (i for i, x in enumerate(lines) if "Bucketed: true" in x):
            join = max(i for i, x in enumerate(lines[:at]) if "SortMergeJoin" in x)
            assert not any("Exchange" in x for x in lines[join:at]), lines
            scans += 1
    assert scans == 2  # one a round
