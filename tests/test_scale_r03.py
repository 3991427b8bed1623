"""Steps that were rewritten so that their time, memory and shuffles grow no faster than the tables."""

from __future__ import annotations

import datetime
import glob
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dataloom.graphs import iterative as GI
from dataloom.learn import als
from dataloom.learn import matrix as M
from dataloom.operators import joins as J
from dataloom.plans import q_graphs, q_jobs, q_learn, q_project, q_sources, q_streaming
from dataloom.session import ensure_checkpoint_dir, scratch_path
from dataloom.streaming import streams as ST


def test_only_what_may_be_a_number_is_cast(spark):
    """The guard keeps every text that casts to a double, and words are not tried."""
    texts = ["1", "-2.5", "+.5", "5.", ".", "1e5", "1E-5", "1.5f", "2D", " 7 ", "\t8\n", "nan", "NaN", "-NaN", "inf", "+Infinity", "-INF", "infinit", "0x1p3", "0X.8P1d",
             "", " ", "abc", "1a", "a1", "{\"k\":", "76}", "--1", "1 2", "click", "d", "1_000", "٣", "1\n", " 1", "9" * 400, "1e", "+", "Infinityf", "nanf"]
    texts += [s + z + str(v) for v in (2**31, 2**31 - 1, 2**63, 2**63 - 1, 2**31 + 1, 10**9, 10**10, 10**18, 10**19) for s in ("", "-", "+") for z in ("", "000")]
    texts += ["\x7f12\x7f", "12\u00a0", "+ 1", "1.0", "0", "-0", "00", "\n3", "3\r\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = df.select("t", *q_project.numeric_checks(t), *[t.try_cast(k).isNotNull().alias(k) for k in ("int", "long", "double")], t.rlike(q_project.MAY_BE_NUMBER).alias("tried")).collect()
    assert [r for r in got if (r.is_int, r.is_long, r.is_double) != (r.int, r.long, r.double)] == []
    assert not any(r.tried for r in got if r.t in ("abc", "a1", "{\"k\":", "76}", "click", "d"))


def test_range_join_has_tasks_for_its_pairs(spark):
    """Small sides with many pairs: a bucket that holds nearly all is cut, equal points too, and no pair is lost or doubled."""
    pts = spark.createDataFrame([(i, 5.0 if i % 10 else float(i)) for i in range(300)] + [(300, None)], "pid int, x double").coalesce(1)
    rng = spark.createDataFrame([(i, i / 10, i / 10 + 6.0) for i in range(60)], "rid int, lo double, hi double").coalesce(1)
    ranges = rng.collect()
    want = sorted((p.pid, r.rid) for p in pts.collect() for r in ranges if p.x is not None and r.lo <= p.x < r.hi)
    for how in ("inner", "left"):
        out = J.range_join(pts, rng, "x", "lo", "hi", bucket=2.0, how=how, task_pairs=500)
        assert out.columns == ["pid", "x", "rid", "lo", "hi"]
        got = sorted((r.pid, r.rid) for r in out.collect() if r.rid is not None)
        assert got == want
    alone = {r.pid for r in J.range_join(pts, rng, "x", "lo", "hi", 2.0, "left", task_pairs=500).where("rid IS NULL").collect()}
    assert alone == set(range(301)) - {p for p, _ in want} and 300 in alone
    spread = J.range_join(pts, rng, "x", "lo", "hi", bucket=2.0, task_pairs=500).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) < len(want) / 4


def test_block_products_come_out_in_parts(spark):
    """Products are right, and no block's numbers are Python objects."""
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (40, 23)).astype(float)
    df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(40) for j in range(23)], "i long, j long, v double")
    blocks = M.to_blocks(df, 4)
    got = np.zeros((23, 23))
    for r in M.from_blocks(M.multiply_blocks(M.transpose(blocks), blocks)).collect():
        got[r.i, r.j] += r.v
    assert np.allclose(got, a.T @ a)
    column = pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float64())).slice(1)
    assert [M._numbers(column)(k).tolist() for k in range(2)] == [[], [3.0]]
    assert M._lists([np.array([1.0, 2.0]), np.zeros(0)]).to_pylist() == [[1.0, 2.0], []]


def test_files_go_by_the_bytes_of_texts(spark, tmp_path):
    """Texts that compress to almost nothing still make files of a bounded size."""
    spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word and "), 500_000).alias("text")).limit(60).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet").select("text")
    assert ST.data_bytes(d) >= 60 * 4_500_000 > 10 * J.plan_bytes(d)
    assert ST.stage_files(d, f"{tmp_path}/staged", 2, fmt="text", file_bytes=32 << 20) >= 4
    wide = spark.createDataFrame([("ab", [1, 2], None)], "s string, l array<long>, n string")
    assert ST.data_bytes(wide) == 8 * 4 + 2 + 16 and ST.data_bytes(wide.where("false")) == 0
    got = q_sources.src_whole_text(spark, str(tmp_path))
    assert got.first().asDict() == {"n_chars": 60 * 4_500_001, "n_docs": 60}
    assert len(got.inputFiles()) >= 8


def _clicks(spark, path, n):
    """Events every 7 seconds by 5 users, of which 3 are customers; one without a user."""
    at = datetime.datetime(2024, 1, 1)
    kinds = ("view", "click", "error")
    spark.createDataFrame([(i, at + datetime.timedelta(seconds=7 * i), None if i == 5 else i * i % 5, kinds[i % 3], float(i), "{}") for i in range(n)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    spark.createDataFrame([(i,) for i in (0, 1, 2)], "c_custkey long").write.parquet(f"{path}/customer.parquet")
    return str(path)


def _stores(folder):
    """State stores by stateful step of the checkpoints below ``folder``."""
    return {step: len(glob.glob(f"{step}/[0-9]*")) for step in glob.glob(f"{folder}/state/[0-9]*")}


def test_state_stores_follow_the_rows(spark, tmp_path):
    """Few rows have few stores, whatever the session's shuffle partitions; more stores give the same rows and the session's number is left alone."""
    sf = _clicks(spark, tmp_path, 200)
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    with ST.state_stores(spark, 10**9):
        assert spark.conf.get(key) == was
    with ST.state_stores(spark, 250_001):
        assert spark.conf.get(key) == "3"
    with ST.state_stores(spark, 0):
        assert spark.conf.get(key) == "1"
    with ST.state_stores(spark, None):
        assert spark.conf.get(key) == was
    base = re.sub("^file:", "", ensure_checkpoint_dir(spark)) + "/dataloom-scratch/*-ckpt-*"
    before = set(glob.glob(base))
    got = q_streaming.st_clickstream_metrics(spark, sf)
    made = [_stores(c) for c in set(glob.glob(base)) - before]
    assert len(made) == 5 and sorted(len(m) for m in made) == [1, 1, 1, 2, 2] and {n for m in made for n in m.values()} == {1}
    assert spark.conf.get(key) == was
    sink, ck = scratch_path(spark, "many-sink"), scratch_path(spark, "many-ckpt")
    stream = q_streaming._events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 minute")
    ST.run_append(q_streaming.clickstream_metrics(stream, spark.read.parquet(f"{sf}/customer.parquet"))["active_users"], sink, ck, state_rows=250_000)
    assert set(_stores(re.sub("^file:", "", ck)).values()) == {3}
    rows = lambda df: sorted(map(tuple, df.select("window_start", "key", "value").collect()), key=str)
    assert rows(spark.read.parquet(sink)) == rows(got.where("metric = 'active_users'"))
    ev = spark.read.parquet(f"{sf}/events.parquet")
    closed = ev.agg(F.max("ts")).first()[0] - datetime.timedelta(minutes=1)
    spans = {"active_users": 15}
    for name, metric in q_streaming.clickstream_metrics(ev, spark.read.parquet(f"{sf}/customer.parquet")).items():
        want = [r for r in rows(metric) if r[0] + datetime.timedelta(seconds=spans.get(name, 30)) <= closed]
        assert want and rows(got.where(F.col("metric") == name)) == want


def _lines(spark, path, rows):
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_partkey long").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_numbered_vertices_keep_their_names(spark, tmp_path):
    """Vertices are numbers in every round; names and least labels are those of the texts, null keys too."""
    sf = _lines(spark, tmp_path, [(1, 9, 10), (1, 10, 10), (2, 2, 7), (2, 2, 7), (3, -3, -4), (4, None, 5), (4, 11, None), (5, None, None)])
    got = {(r.v, r.label) for r in q_graphs.gr_connected_components(spark, sf).collect()}
    assert got == {("s9", "p10"), ("s10", "p10"), ("p10", "p10"), ("s2", "p7"), ("p7", "p7"), ("s-3", "p-4"), ("p-4", "p-4"), ("p5", "p5"), ("s11", "s11"), (None, None)}
    ranks = {r.v: r["rank"] for r in q_graphs.gr_pagerank(spark, sf).collect()}
    assert ranks["s2"] == ranks["p7"] == ranks["s-3"] == 1.0 and ranks["p10"] > 1 > ranks["s9"] == ranks["s10"]
    edges = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "src long, dst long")
    assert {r.v: r["rank"] for r in GI.pagerank(edges, iterations=1, list_links=1).collect()} == {None: 0.575, 2: 0.575}
    assert dict(q_graphs._numbered(spark, sf).dtypes) == {"src": "bigint", "dst": "bigint"}


def test_orders_are_gathered_once_for_both_miners(spark, tmp_path, monkeypatch):
    rows = [(o, n, f, "O", q) for o in range(30) for n, (f, q) in enumerate([("A", 5.0), ("N", 15.0), ("A", 5.0)][: 1 + o % 3])]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    made = []
    real = q_learn.fixed
    monkeypatch.setattr(q_learn, "fixed", lambda df, name: made.append(name) or real(df, name))
    got = {(r.kind, r.pattern): r.freq for r in q_learn.mod_frequent_patterns(spark, str(tmp_path)).where("kind <> 'rule'").collect()}
    assert got == {("itemset", "AO0"): 30, ("itemset", "NO1"): 20, ("itemset", "AO0,NO1"): 20, ("sequence", "A"): 30, ("sequence", "N"): 20,
                   ("sequence", "A>N"): 20, ("sequence", "A>A"): 10, ("sequence", "N>A"): 10, ("sequence", "A>N>A"): 10}
    assert made == ["orders-of-lines"]
    few = q_learn.LOCAL_ITEMS
    monkeypatch.setattr(q_learn, "LOCAL_ITEMS", 3)
    assert few > 3 and {(r.kind, r.pattern): r.freq for r in q_learn.mod_frequent_patterns(spark, str(tmp_path)).where("kind <> 'rule'").collect()} == got


def test_terms_are_counted_where_their_document_is(spark, tmp_path):
    """One shuffle of texts, none of (document, term) rows; documents of one id or none count as one."""
    docs = [(1, "a b a"), (1, "b c"), (2, "A-c"), (3, None), (4, ""), (None, "a z"), (None, "z")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = q_learn.ml_tfidf(spark, str(tmp_path))
    want = {(1, "a"): 2, (1, "b"): 2, (1, "c"): 1, (2, "a"): 1, (2, "c"): 1, (None, "a"): 1, (None, "z"): 2}
    assert {(r.doc_id, r.term): r.tf for r in out.collect()} == want
    n_of = {t: len([k for k in want if k[1] == t]) for t in "abcz"}
    assert all(r.tfidf == round(r.tf * math.log(8 / (n_of[r.term] + 1)), 6) for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert "hashpartitioning(term" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_users_of_shared_ngrams_are_counted_in_blocks(spark):
    """Many small blocks give each n-gram's different users per hour; users and hours may be null, n-grams meet users inside a block only."""
    queries = ["a b c", "A b", "b c d", "x", "x y", "d", "a b c d a b", " ", None, "http://a b", "?!", "y x y x"]
    rows = [(None if (i * 7) % 11 == 0 else i % 5, None if i % 13 == 0 else f"240101{i % 3:02d}0000", queries[(i * i + i // 3) % len(queries)]) for i in range(400)]
    log = spark.createDataFrame(rows, "user long, time string, query string")
    want = {}
    for user, time, query in rows:
        if query and query.strip() and not query.startswith("http"):
            w = [x for x in re.split("[^a-z0-9_]+", query.lower()) if x]
            for g in {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}:
                want.setdefault((g, time and time[6:8]), set()).add(user)
    want = sorted(((g, h, len(u)) for (g, h), u in want.items()), key=str)
    for sizes in ((3, 10, 4), (1 << 20, 1 << 20, 1 << 20)):
        counts, names = q_jobs.hour_ngram_counts(log, None, *sizes)
        got = counts.join(names, "unit").select("ngram", "hour", "count").collect()
        assert sorted(map(tuple, got), key=str) == want
    nothing, _ = q_jobs.hour_ngram_counts(log.where("user = 99"))
    assert nothing.count() == 0


def test_als_ships_factors_not_outer_products(spark):
    """Blocks and chunks of any size give the error of plain half steps; keys and ratings may be null, lines repeat."""
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 40, 900), rng.integers(0, 25, 900) * 3 - 9, rng.integers(1, 50, 900))]
    rows += [(None, 3, 1.0), (4, None, 2.0), (None, None, 3.0), (7, 900, None), (7, 901, 5.0), (99, 3, 4.0), (5, -9, None)]
    lines = spark.createDataFrame(rows, "u long, i int, r double")
    rated = {}
    for u, i, r in rows:
        if u is not None and i is not None:
            rated.setdefault((u, i), []).extend([] if r is None else [r])
    rated = {k: sum(v) / len(v) if v else None for k, v in rated.items()}
    first = spark.createDataFrame([(i,) for i in {i for _, i in rated}], "id int").select("id", *[(F.abs(F.hash("id", F.lit(j))) % 1000 / 1000.0).alias(f"f{j}") for j in range(4)])
    items = {r[0]: np.array(r[1:]) for r in first.collect()}
    for _ in range(5):
        users = _half_step(rated, items, 0)
        items = _half_step(rated, users, 1)
    off = [(float(users[u] @ items[i]) - r) ** 2 for (u, i), r in rated.items() if r is not None]
    want = (math.sqrt(sum(off) / len(off)), len(rated))
    for sizes in ((100, 7), (10**6, 10**6)):
        got = als.als_error(lines, block_ratings=sizes[0], chunk=sizes[1]).first()
        assert got.n == want[1] and math.isclose(got.rmse, want[0], rel_tol=1e-9)
    none = als.als_error(lines.where("u IS NULL")).first()
    assert (none.rmse, none.n) == (None, 0)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("laid_", "routes_", "ratings_"))]


def _half_step(rated, others, side):
    """Factors of one side (0: users) from the other's."""
    sums = {}
    for key, r in rated.items():
        f = others[key[1 - side]]
        a, b = sums.setdefault(key[side], (0.1 * np.eye(len(f)), np.zeros(len(f))))
        a += np.outer(f, f)
        b += f * (r or 0.0)
    return {k: np.linalg.solve(a, b) for k, (a, b) in sums.items()}
