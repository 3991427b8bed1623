"""Steps whose time, memory or disk grew faster than the tables in the fourth round's findings."""

from __future__ import annotations

import inspect
import random
import subprocess
import sys

import numpy as np
from conftest import ROOT, SF_SMALL
from pyspark.sql import functions as F

from dataloom.learn import als
from dataloom.learn import lsh as L
from dataloom.operators import joins as J
from dataloom.plans import q_learn


def test_links_are_counted_where_pairs_are_found(spark):
    """Counts are those of the pairs, in blocks of any size, and few rows leave the tasks however many pairs there are."""
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(9), rng.randint(0, 5))) for _ in range(300)] + [sorted(rng.sample(range(5000), 30)) for _ in range(60)] * 2
    df = spark.createDataFrame(list(enumerate(sets)) + [(None, [1]), (999, None)], "id long, v array<long>")
    vectors = np.random.default_rng(3).normal(size=(200, 4)).tolist()
    ve = spark.createDataFrame(list(enumerate(vectors)), "id long, v array<double>")
    for rows, hashes, distance, most in ((df.where(F.size("v") < 9), L.jaccard_hashes(6, 2, 7), L.jaccard, 0.5), (df, L.jaccard_hashes(6, 2, 7), L.jaccard, 0.5),
                                         (ve, L.euclid_hashes(4.0, 6, 1, 7), L.euclid, 1.5), (ve, L.euclid_hashes(0.5, 6, 4, 7), L.euclid, 1.5)):
        members, pairs = L.similar(rows, "id", "v", hashes, distance, most, 6, block=50)
        listed = [(r.a, r.b) for r in pairs.collect()]
        assert len(listed) == len(set(listed)) > 0 and all(a < b for a, b in listed)
        other, counts = L.similar(rows, "id", "v", hashes, distance, most, 6, block=70, counts=True)
        assert sorted(map(tuple, L.links(other, counts).collect())) == sorted(map(tuple, L.links(members, pairs).collect()))
    near = L.similar(ve, "id", "v", L.euclid_hashes(1e6, 8, 1, 7), L.euclid, 1e6, 8, counts=True)[1].collect()
    assert len(near) <= 400 and sum(r.m for r in near) == 200 * 199


def test_range_join_cuts_both_sides(spark):
    """A bucket of many pairs is a grid of pieces: both sides are copied a little, not one of them to every piece of the other."""
    pts = spark.range(400).select(F.col("id").alias("pid"), (F.col("id") % 7 / 7).alias("x"))
    rng = spark.range(400).select(F.col("id").alias("rid"), F.lit(0.0).alias("lo"), (F.col("id") % 5 / 5).alias("hi"))
    out = J.range_join(pts, rng, "x", "lo", "hi", bucket=10.0, task_pairs=1600)
    want = sorted((p.pid, r.rid) for p in pts.collect() for r in rng.collect() if r.lo <= p.x < r.hi)
    assert sorted((r.pid, r.rid) for r in out.collect()) == want
    shuffles = [n for n in _nodes(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "RepartitionByExpression"]
    copies = [spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, n).count() for n in shuffles]
    assert len(copies) == 2 and max(copies) <= 400 * 10 and min(copies) >= 400 * 10  # one hundred pieces: ten by ten


def _nodes(plan):
    yield plan
    for k in range(plan.children().size()):
        yield from _nodes(plan.children().apply(k))


def test_blocks_of_a_factorisation_do_not_grow(spark, monkeypatch):
    """Few ratings keep the library's ten blocks; of more there are more blocks, not larger ones."""
    assert (q_learn._blocks(0), q_learn._blocks(1000)) == (10, 10)
    assert q_learn._blocks(216_000_000) >= 216_000_000 // q_learn.BLOCK_RATINGS > 50
    made = []
    plain = q_learn.ALS
    monkeypatch.setattr(q_learn, "BLOCK_RATINGS", 100)
    monkeypatch.setattr(q_learn, "ALS", lambda **given: made.append(plain(**given)) or made[-1])
    for query in (q_learn.mod_recommend_als, q_learn.mod_recommend_new_parts):
        assert query(spark, SF_SMALL).count() > 0
    assert len(made) == 2 and all(m.getNumUserBlocks() == m.getNumItemBlocks() > 40 for m in made)


def test_ratings_of_a_block_fit_a_worker():
    """A block of the size the job makes is laid out in less than 600 MB of Python's memory beyond the start."""
    most = inspect.signature(als.als_error).parameters["block_ratings"].default
    code = """
import resource, sys
import numpy as np, pyarrow as pa
from dataloom.learn.als import _lay_out
n = int(sys.argv[1])
rng = np.random.default_rng(0)
rows = pa.table({"block": pa.array(np.zeros(n, np.int32)), "own": rng.integers(0, n // 40, n), "other": rng.integers(0, n, n), "home": pa.array(rng.integers(0, 18, n), pa.int32()), "r": rng.random(n)})
_lay_out(1 << 20)([pa.scalar(0)], rows)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1000)
"""
    peak = int(subprocess.run([sys.executable, "-c", code, str(most)], capture_output=True, text=True, check=True, cwd=ROOT).stdout.split()[-1])
    assert peak < 700
