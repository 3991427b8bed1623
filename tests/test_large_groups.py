"""Python functions over many small groups, and jobs that once did less or read and wrote their rows again and again."""

from __future__ import annotations

from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dataloom.operators import groups as G
from dataloom.plans import REGISTRY
from dataloom.plans import q_udfs as U


@pytest.fixture
def lines(spark, tmp_path):
    """Orders of 1 to 4 lines with null keys and quantities, and orders without lines."""
    rows = [(None if k % 50 == 7 else k, n, None if (k + n) % 9 == 0 else float(k % 13 + n), float(100 * k + n) / 100)
            for k in range(600) for n in range(1, k % 4 + 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, float(k)) for k in range(500, 700)], "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path), rows


def calls(spark, monkeypatch, module, name):
    """Counts how often a function of groups is called."""
    seen, plain = spark.sparkContext.accumulator(0), getattr(module, name)

    def one(df):
        seen.add(1)
        return plain(df)

    def two(left, right):
        seen.add(1)
        return plain(left, right)

    monkeypatch.setattr(module, name, one if plain.__code__.co_argcount == 1 else two)
    return seen


def test_key_buckets_are_whole_and_bounded(spark, monkeypatch):
    df = spark.range(50_000).select(F.when(F.col("id") % 1000 > 0, F.col("id") % 7001).alias("k"))
    n = G.bucket_count(df, df, rows=1000)
    assert n == 100 and G.bucket_count(df.limit(0)) == 1
    at = df.groupBy("k").agg(F.count_distinct(G.key_bucket("k", n)).alias("d"), F.min(G.key_bucket("k", n)).alias("b"))
    assert at.where("d > 1 OR (b = -1) <> (k IS NULL)").isEmpty()
    assert df.groupBy(G.key_bucket("k", n)).count().agg(F.max("count")).first()[0] < 2000


def test_shares_of_many_orders_in_one_call(spark, lines, monkeypatch):
    path, rows = lines
    seen = calls(spark, monkeypatch, U, "_shares")
    total = defaultdict(float)
    for k, _, q, _ in rows:
        total[k] += q or 0.0
    got = Counter((r.l_orderkey, r.l_linenumber, None if r.share is None else round(r.share, 9)) for r in REGISTRY["udf_group_map"].fn(spark, path).collect())
    assert got == Counter((k, n, None if q is None else round(q / total[k], 9)) for k, n, q, _ in rows)
    assert 0 < seen.value < 5


def test_spreads_of_many_orders_in_one_call(spark, lines):
    path, rows = lines
    by = defaultdict(list)
    for k, _, q, _ in rows:
        if q is not None:
            by[k].append(q)
    spread = {k: max(v) - min(v) for k, v in by.items()}
    df = REGISTRY["udf_pandas_agg"].fn(spark, path)
    got = Counter((r.l_orderkey, r.l_linenumber, r.spread_over, r.spread) for r in df.collect())
    assert got == Counter((k, n, spread.get(k), spread.get(k)) for k, n, _, _ in rows if k is not None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_spreads(" in plan and "specifiedwindowframe(RangeFrame, currentrow$(), currentrow$())" in plan  # no Arrow batch per order


def test_summaries_of_many_orders_in_one_call(spark, lines, monkeypatch):
    path, rows = lines
    seen = calls(spark, monkeypatch, U, "_order_summaries")
    n, price = Counter(k for k, *_ in rows), defaultdict(float)
    for k, _, _, p in rows:
        price[k] += p
    want = {(k, n[k], round((k if k is not None and k >= 500 else 0) - price[k], 2)) for k in {*n, *range(500, 700)}}
    got = [tuple(r) for r in REGISTRY["udf_cogroup_map"].fn(spark, path).collect()]
    assert len(got) == len(want) and set(got) == want
    assert 0 < seen.value < 5


def test_buffers_of_many_keys_are_merged_in_one_call(spark, lines):
    path, rows = lines
    df = spark.read.parquet(f"{path}/lineitem.parquet").repartition(5)

    def merge(a, b):
        return a[0] + b[0], max(a[1], b[1])

    out = U.typed_aggregate(df, "l_orderkey", "s double, m int", (0.0, 0), lambda a, x: (a[0] + x.l_extendedprice, max(a[1], x.l_linenumber)), merge)
    got = [(r.l_orderkey, round(r.s, 6), r.m) for r in out.collect()]
    by = defaultdict(list)
    for k, n, _, p in rows:
        by[k].append((p, n))
    assert len(got) == len(by) and set(got) == {(k, round(sum(p for p, _ in v), 6), max(n for _, n in v)) for k, v in by.items()}
    assert "FlatMapGroupsInPandas [bucket" in out._jdf.queryExecution().executedPlan().toString()


def test_closure_of_every_part(spark):
    from conftest import SF_SMALL
    from dataloom.session import table

    got = {tuple(r) for r in REGISTRY["gr_transitive_closure"].fn(spark, SF_SMALL).collect()}
    bought = {r[0] for r in table(spark, SF_SMALL, "lineitem").select("l_partkey").distinct().collect()}
    assert {s for s, _ in got if s[0] == "p"} == {f"p{k}" for k in bought}  # not only those of one size
    supplied = {s for s, d in got if s[0] == "s" and d[0] == "r"}
    assert supplied == {f"s{r[0]}" for r in table(spark, SF_SMALL, "supplier").select("s_suppkey").collect()}


def test_training_rows_are_joined_and_drawn_once(spark):
    from conftest import SF_SMALL
    from dataloom.plans import q_learn as Q

    drawn = Q._split(spark, SF_SMALL)
    names = [c for c in drawn[0].columns if c != "features"]
    for got, want in zip(drawn, Q._assembled(spark, SF_SMALL).randomSplit([0.8, 0.2], seed=42)):
        assert got.select(names).exceptAll(want.select(names)).isEmpty() and want.select(names).exceptAll(got.select(names)).isEmpty()
    for df in (*drawn, Q._kept_lines(spark, SF_SMALL, *Q._NUM), Q._orders_of_customers(spark, SF_SMALL)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_pairs_meet_once_without_joins(spark):
    from dataloom.learn import lsh as L
    from dataloom.learn import partners as P

    lines = spark.createDataFrame([(b, i) for b in range(40) for i in range(b % 5 + 1)], "basket long, i long")
    assert "Join" not in P.partners(lines, None)._jdf.queryExecution().executedPlan().toString()
    sets = spark.createDataFrame([(k, [k % 7, k % 3 + 10, k % 2 + 20]) for k in range(60)], "id long, v array<long>")
    members, pairs = L.similar(sets, "id", "v", L.jaccard_hashes(12, 1, 7), L.jaccard, 0.5, 12)
    sure = [tuple(r) for r in pairs.collect()]
    assert len({x[:2] for x in sure}) == len(sure) > 0 and all(a < b for a, b, _ in sure)
    seen = spark.sparkContext.accumulator(0)
    counted = pairs.where(F.udf(lambda a: seen.add(1) or True, "boolean")("a"))
    assert L.links(members, counted).count() == 60
    assert seen.value == len(sure)  # no pair is made a second time for its other end


def test_word_vectors_in_parts(spark, tmp_path, monkeypatch):
    from dataloom.plans import q_learn as Q

    texts = ["alpha beta gamma delta " * 20, "beta gamma epsilon " * 30, "delta alpha epsilon zeta " * 25, None]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts * 10)], "doc_id long, text string").where("text IS NOT NULL").write.parquet(f"{tmp_path}/documents.parquet")
    made = []
    plain = Q.MF.Word2Vec

    monkeypatch.setattr(Q, "MF", SimpleNamespace(**{**vars(Q.MF), "Word2Vec": lambda **given: made.append(given["numPartitions"]) or plain(**given)}))
    monkeypatch.setattr(Q, "WORD_PART", 2000)
    rows = REGISTRY["ml_word2vec"].fn(spark, str(tmp_path)).collect()
    assert made[0] > 4 and {"alpha", "beta", "gamma", "delta", "epsilon", "zeta"} <= {r.word for r in rows}
