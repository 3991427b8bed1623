"""Triangles, factorisations, distribution tests, correlations, evaluation metrics, hashing joins and exact selection
against brute force, numpy, pandas and the library's own evaluators."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MultilabelClassificationEvaluator, RankingEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from dataloom.graphs import iterative as GI
from dataloom.graphs import triangles as T
from dataloom.learn import lsh as L
from dataloom.learn import matrix as M
from dataloom.learn import metrics as E
from dataloom.learn import stats as S
from dataloom.operators import joins as J
from dataloom.operators import quantile as Q


# triangles


def test_triangles_match_all_triples(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 25), rng.randint(0, 25)) for _ in range(120)] + [(3, 3), (99, 99), (1, None), (None, 2)]
    near = {}
    for a, b in edges:
        if a is not None and b is not None:
            near.setdefault(a, set())
            near.setdefault(b, set())
            if a != b:
                near[a].add(b)
                near[b].add(a)
    want = {v: sum(1 for x, y in itertools.combinations(sorted(n), 2) if y in near[x]) for v, n in near.items()}
    got = {r.v: r.triangles for r in T.triangle_count(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == want
    assert T.triangle_count(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_a_hub_makes_few_wedges(spark):
    n = 10_000
    hub = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    ring = spark.range(1, n + 1).select(F.col("id").alias("src"), (F.col("id") % n + 1).alias("dst"))
    edges = hub.unionByName(ring)
    assert T.wedges(T.forward(edges)).count() <= 3 * n  # plain wedges of the hub: n * (n - 1) / 2
    got = {r.v: r.triangles for r in T.triangle_count(edges).where("v < 5").collect()}
    assert got == {0: n, 1: 2, 2: 2, 3: 2, 4: 2}


# matrices


def rows_of(spark, a):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(a)], "i long, x array<double>").repartition(7)


def test_qr_and_svd_match_numpy(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 9)) * 10.0 ** np.arange(-2, 7)[None, :]
    df = rows_of(spark, a).unionByName(spark.createDataFrame([(-1, None)], "i long, x array<double>"))
    out, r = M.qr(df, "x")
    q = np.array([x.q for x in out.orderBy("i").collect()])
    assert q.shape == (300, 9) and (np.diag(r) > 0).all() and np.allclose(np.tril(r, -1), 0)
    assert np.abs(q.T @ q - np.eye(9)).max() < 1e-12 and np.abs(q @ r - a).max() < 1e-6
    assert np.allclose(M.qr_r(df, "x", fan_in=2), r, rtol=1e-9)
    b = rng.normal(size=(200, 6)) @ np.diag([5, 4, 3, 2, 1, 0]) @ rng.normal(size=(6, 6))
    u, s, v = M.svd(rows_of(spark, b), "x", 6)
    true = np.linalg.svd(b, compute_uv=False)
    assert len(s) == 5 and np.allclose(s, true[:5])
    u = np.array([x.u for x in u.orderBy("i").collect()])
    assert np.allclose(u * s @ v.T, b, atol=1e-9) and np.allclose(u.T @ u, np.eye(5), atol=1e-9)
    with pytest.raises(ValueError):
        M.qr(rows_of(spark, b), "x")
    with pytest.raises(Exception, match="must hold 2 numbers"):
        M.qr_r(spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "x array<double>").coalesce(1), "x")


def test_blocks_transpose_and_multiply(spark):
    rng = np.random.default_rng(3)
    a = np.where(rng.random((23, 17)) < 0.4, rng.normal(size=(23, 17)), 0)
    entries = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(23) for j in range(17) if a[i, j]], "i long, j long, v double")

    def dense(df, n, m):
        out = np.zeros((n, m))
        for r in df.collect():
            out[r.i, r.j] += r.v
        return out

    blocks = M.to_blocks(entries, 5)
    assert np.allclose(dense(M.from_blocks(blocks), 23, 17), a)
    assert np.allclose(dense(M.from_blocks(M.transpose(blocks)), 17, 23), a.T)
    assert np.allclose(dense(M.transpose(entries), 17, 23), a.T)
    assert np.allclose(dense(M.from_blocks(M.multiply_blocks(M.transpose(blocks), blocks)), 17, 17), a.T @ a)
    assert np.allclose(dense(M.multiply(entries, M.transpose(entries)), 23, 23), a @ a.T)
    whole = rows_of(spark, a)
    assert np.allclose(dense(M.gram(whole, "x"), 17, 17), a.T @ a)
    assert np.allclose(dense(M.gram(whole, "x", a.mean(axis=0).tolist()), 17, 17), np.cov(a.T) * 22)


# distribution tests and correlations


def test_ks_matches_the_library_and_brute_force(spark):
    rng = random.Random(4)
    values = [("a", rng.gauss(0.3, 1.2)) for _ in range(400)] + [("b", float(rng.randint(-3, 3))) for _ in range(300)] + [("b", None), ("a", float("nan"))]
    df = spark.createDataFrame(values, "g string, x double").repartition(5)
    clean = df.where("x IS NOT NULL AND NOT isnan(x)")
    got = {r.g: r for r in S.ks_one_sample(df, "x", S.normal_cdf(0.1, 1.1), ["g"]).collect()}
    for g in "ab":
        lib = KolmogorovSmirnovTest.test(clean.where(F.col("g") == g), "x", "norm", 0.1, 1.1).first()
        assert got[g].statistic == pytest.approx(lib.statistic, abs=1e-12)
        assert got[g].p_value == pytest.approx(lib.pValue, abs=0.02)  # the library's is exact for small samples
    whole = S.ks_one_sample(df, "x", S.normal_cdf(0.1, 1.1)).collect()
    lib = KolmogorovSmirnovTest.test(clean, "x", "norm", 0.1, 1.1).first()
    assert len(whole) == 1 and whole[0].n == 700 and whole[0].statistic == pytest.approx(lib.statistic, abs=1e-12)
    two = S.ks_two_samples(df, "x", F.col("g") == "b").first()
    a, b = (np.sort([x for h, x in values if h == g and x is not None and not math.isnan(x)]) for g in "ab")
    at = np.concatenate([a, b])
    want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
    assert (two.n1, two.n2) == (400, 300) and two.statistic == pytest.approx(want, abs=1e-12)
    assert S.ks_one_sample(df.where("false"), "x", S.uniform_cdf(0, 1)).count() == 0
    assert S.ks_two_samples(df.where("g = 'a'"), "x", F.col("g") == "b").count() == 0


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(5)
    p = pd.DataFrame({"a": rng.integers(0, 4, 500).astype(float), "b": rng.normal(size=500), "d": 1e9 + rng.random(500)})
    p["c"] = p.b + 0.2 * p.a
    p["flat"] = 7.0
    df = spark.createDataFrame(p).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 7.0)], "a double, b double, d double, c double, flat double"))
    cols = list(p.columns)
    for method in ("pearson", "spearman"):
        want = p.corr(method).to_numpy()
        got = np.full((5, 5), np.nan)
        for r in S.correlation(df.repartition(6), cols, method).collect():
            got[r.i, r.j] = np.nan if r.correlation is None else r.correlation
        assert np.allclose(got, want, atol=1e-7, equal_nan=True)
    assert S.correlation(df.where("false"), cols).count() == 0


# evaluation


def test_silhouette_matches_the_evaluator(spark):
    rng = np.random.default_rng(6)
    rows = [(int(c), (rng.normal(size=5) + 2 * c + 1).tolist()) for c in rng.integers(0, 4, 300)] + [(9, [40.0] * 5)]
    df = spark.createDataFrame(rows, "c int, x array<double>").withColumn("features", array_to_vector("x"))
    for distance in ("squaredEuclidean", "cosine"):
        want = ClusteringEvaluator(predictionCol="c", distanceMeasure=distance).evaluate(df)
        out = E.silhouette(df.select("c", "x"), "x", "c", distance)
        assert out.columns == ["c", "x", "silhouette"]
        assert out.agg(F.avg("silhouette")).first()[0] == pytest.approx(want, abs=1e-9)
    assert E.silhouette(df.where("c = 1").select("c", "x"), "x", "c").agg(F.max("silhouette")).first()[0] == 0


def test_ranking_scores_match_the_evaluator(spark):
    rng = random.Random(7)
    rows = [([float(x) for x in rng.sample(range(30), rng.randint(0, 12))], [float(x) for x in rng.sample(range(30), rng.randint(1, 9))]) for _ in range(60)]
    df = spark.createDataFrame(rows, "p array<double>, r array<double>")
    got = E.ranking_scores(df, "p", "r", [1, 5, 20]).first()
    by = lambda name, k=10: RankingEvaluator(predictionCol="p", labelCol="r", metricName=name, k=k).evaluate(df)
    assert got.queries == 60 and got.map == pytest.approx(by("meanAveragePrecision"))
    for k in (1, 5, 20):
        for mine, name in (("map", "meanAveragePrecisionAtK"), ("ndcg", "ndcgAtK"), ("precision", "precisionAtK"), ("recall", "recallAtK")):
            assert got[f"{mine}_{k}"] == pytest.approx(by(name, k)), (mine, k)
    more = df.unionByName(spark.createDataFrame([([1.0], []), (None, [1.0])], df.schema))
    assert E.ranking_scores(more, "p", "r", [5]).first().map == pytest.approx(got.map * 60 / 61)


def test_label_set_scores_match_the_evaluator(spark):
    rng = random.Random(8)
    rows = [(sorted(map(float, rng.sample(range(6), rng.randint(0, 4)))), sorted(map(float, rng.sample(range(5), rng.randint(1, 4))))) for _ in range(80)]
    df = spark.createDataFrame(rows, "p array<double>, l array<double>")
    got = E.label_set_scores(df, "p", "l").first()
    by = lambda name, **k: MultilabelClassificationEvaluator(predictionCol="p", labelCol="l", metricName=name, **k).evaluate(df)
    for mine, name in (("subset_accuracy", "subsetAccuracy"), ("accuracy", "accuracy"), ("hamming_loss", "hammingLoss"), ("precision", "precision"),
                       ("recall", "recall"), ("f1", "f1Measure"), ("micro_precision", "microPrecision"), ("micro_recall", "microRecall"), ("micro_f1", "microF1Measure")):
        assert got[mine] == pytest.approx(by(name)), mine
    assert got.macro_f1 == pytest.approx(np.mean([by("f1MeasureByLabel", metricLabel=float(x)) for x in range(5)]))


# hashing joins


def test_similar_vectors_are_found(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * 4
    x = np.concatenate([centres[rng.integers(0, 40, 400)] + rng.normal(size=(400, 16)) * 0.15, np.repeat(centres[:1], 300, axis=0), rng.normal(size=(200, 16)) * 4])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (10**6, None)], "id long, v array<double>")
    hashes = L.euclid_hashes(4.0, 8, 3, 1)
    members, pairs = L.similar(df, "id", "v", hashes, L.euclid, 1.2, 8, block=64)
    cls = {r.id: r["class"] for r in members.collect()}
    assert set(cls) == set(range(len(x))) and all(cls[i] == 400 for i in range(400, 700))
    reps = sorted(set(cls.values()))
    d = np.linalg.norm(x[reps][:, None] - x[reps][None], axis=2)
    true = {(reps[i], reps[j]) for i, j in zip(*np.nonzero(d <= 1.2)) if i < j}
    rows = pairs.collect()
    got = {(r.a, r.b): r.distance for r in rows}
    assert len(rows) == len(got) and set(got) <= true and len(got) >= 0.9 * len(true) > 500
    assert all(abs(v - np.linalg.norm(x[a] - x[b])) < 1e-9 for (a, b), v in got.items())
    n = {r.id: r.n_links for r in L.links(members, pairs).collect()}
    sizes = {c: list(cls.values()).count(c) for c in reps}
    for i in (0, 5, 400, 650, 750):
        assert n[i] == sizes[cls[i]] - 1 + sum(sizes[b if a == cls[i] else a] for a, b in got if cls[i] in (a, b))


def test_similar_sets_and_a_hot_bucket(spark):
    rng = random.Random(10)
    base = [sorted(rng.sample(range(1000), 12)) for _ in range(30)]
    sets = [sorted(set(rng.choice(base)[: rng.randint(10, 12)]) | set(rng.sample(range(1000), rng.randint(0, 1)))) for _ in range(250)] + [[], [], [5]]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, v array<long>")
    members, pairs = L.similar(df, "id", "v", L.jaccard_hashes(16, 2, 3), L.jaccard, 0.25, 16, block=20)
    cls = {r.id: r["class"] for r in members.collect()}
    reps = sorted(set(cls.values()))

    def apart(a, b):
        return 1 - len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 0

    true = {(a, b) for a, b in itertools.combinations(reps, 2) if apart(sets[a], sets[b]) <= 0.25}
    got = {(r.a, r.b): r.distance for r in pairs.collect()}
    assert set(got) <= true and len(got) >= 0.9 * len(true) > 50 and all(abs(v - apart(sets[a], sets[b])) < 1e-6 for (a, b), v in got.items())
    # one bucket for all rows: every pair is compared exactly once, block by block
    one = L.similar(df, "id", "v", lambda column: np.zeros((len(column), 3), np.int64), L.jaccard, 0.25, 3, block=20)[1].collect()
    assert len(one) == len(true) and {(r.a, r.b) for r in one} == true


# selection, ranks of hubs, ties


def test_percentiles_of_a_million_values(spark):
    df = spark.range(0, 1_000_000).select(F.lit("one").alias("g"), (F.col("id") * 7 % 1_000_000).alias("x"))
    df = df.unionByName(spark.createDataFrame([("two", 5), ("two", None), ("three", None), (None, 4), (None, 8)], "g string, x long"))
    out = Q.percentiles(df, ["g"], "x", {"m": 0.5, "p90": 0.9, "top": 1.0, "least": 0.0})
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    assert got == {"one": (499_999.5, pytest.approx(899_999.1), 999_999.0, 0.0), "two": (5.0, 5.0, 5.0, 5.0), None: (6.0, pytest.approx(7.6), 8.0, 4.0)}
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in text.lower() and "collect_list" not in text
    assert Q.percentiles(df, ["g"], "x", {"d": 0.25}, interpolate=False).where("g = 'one'").first().d == 249_999
    assert Q.percentiles(df.drop("g"), [], "x", {"m": 0.5}).first().m == pytest.approx(499_997.5, abs=3)
    modes = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("b", 2), ("b", None)], "g string, x int")
    assert {tuple(r) for r in Q.modes(Q.value_counts(modes, ["g"], "x"), ["g"]).collect()} == {("a", 1), ("b", 2)}


def test_pagerank_cuts_hubs_into_mirrors(spark):
    n = 4000
    hub = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    ring = spark.range(1, n + 1).select(F.col("id").alias("src"), (F.col("id") % 50).alias("dst"))
    edges = [(r.src, r.dst) for r in hub.unionByName(ring).distinct().collect()]
    degree = pd.Series([a for a, _ in edges]).value_counts()
    rank = {v: 1.0 for v in degree.index}
    for _ in range(3):
        new = {}
        for a, b in edges:
            if a in rank:
                new[b] = new.get(b, 0.0) + rank[a] / degree[a]
        rank = {v: 0.15 + 0.85 * c for v, c in new.items()}
    got = {r.v: r["rank"] for r in GI.pagerank(hub.unionByName(ring), iterations=3, keep_every=2).collect()}
    assert got.keys() == rank.keys() and all(abs(got[v] - rank[v]) < 1e-9 for v in rank)


@pytest.mark.parametrize("tolerance", [None, 60.0])
def test_asof_ties_do_not_depend_on_the_partitioning(spark, tolerance):
    left = spark.createDataFrame([(1, "a", 10.0), (2, "a", 11.0), (3, "b", 10.0)], "id int, k string, t double")
    right = spark.createDataFrame([("a", 10.0, f"v{i}", i) for i in range(8)] + [("b", 9.0, "w", 1), ("b", 9.0, None, 2)], "k string, t double, v string, n int")
    seen = {d: {str(sorted(map(tuple, J.asof_join(left, right.repartition(p), "t", ["k"], tolerance=tolerance, direction=d).collect()))) for p in (1, 2, 3, 5, 7, 8, 16)}
            for d in ("backward", "forward")}
    assert all(len(x) == 1 for x in seen.values())
