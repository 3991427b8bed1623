"""Windows over ranges, streams that give up their state, records of fixed length."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dataloom.operators import seqwin as SW
from dataloom.plans import q_streaming
from dataloom.session import scratch_path, table
from dataloom.sources import io as IO
from dataloom.streaming import streams as S


@pytest.mark.parametrize("ranges", [1, 8, 61])
def test_windows_over_ranges_match_plain_lists(spark, ranges):
    """A key of four fifths of the rows, null keys and values, and ranges of one row or none."""
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), i * 11 % 307, rng.choice([None, *range(9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)

    def made(w):
        return {"lag3": F.lag("v", 3, -1).over(w), "lead2": F.lead("t", 2).over(w), "near": F.sum("v").over(w.rowsBetween(-3, 2)),
                "n": F.count("*").over(w.rowsBetween(-3, 2))}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        got = SW.over(df, ["k"], ["t"], made, before=3, behind=2, running={"place": ("count", "*"), "upto": ("sum", "v"), "low": ("min", "v")},
                      whole={"size": ("count", "*"), "top": ("max", "v"), "all": ("sum", "v"), "known": ("count", "v")}).collect()
        assert SW.over(df.where("false"), ["k"], ["t"], made, before=3, behind=2, whole={"size": ("count", "*")}).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 300
    some = lambda f, x: f([v for v in x if v is not None]) if any(v is not None for v in x) else None
    lists = {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        lists.setdefault(k, []).append((t, v))
    for r in got:
        own = lists[r.k]
        i = next(i for i, (t, _) in enumerate(own) if t == r.t)
        v = [x for _, x in own]
        frame = v[max(0, i - 3): i + 3]
        assert (r.lag3, r.lead2) == (v[i - 3] if i >= 3 else -1, own[i + 2][0] if i + 2 < len(own) else None)
        assert (r.near, r.n, r.place, r.upto, r.low) == (some(sum, frame), len(frame), i + 1, some(sum, v[: i + 1]), some(min, v[: i + 1]))
        assert (r.size, r.top, r["all"], r.known) == (len(v), some(max, v), some(sum, v), sum(x is not None for x in v))


def test_closed_windows_give_up_their_state(spark):
    """At the end only the window of the last arrival is held, of hundreds that came out."""
    s = q_streaming._closing_stream(spark, SF_SMALL, "2 HOURS")
    agg = S.window_counts(s, "ts", "1 hour", None, ["event_type"], [F.count("*").alias("n")])
    sink = scratch_path(spark, "closed")
    left = S.run_append(agg, sink, scratch_path(spark, "closed-ckpt"))
    out = spark.read.parquet(sink)
    assert left <= 2 < 100 < out.count() and out.where("event_type IS NULL").count() == 0
    assert out.agg(F.sum("n")).first()[0] == table(spark, SF_SMALL, "events").count()


def test_records_of_a_fixed_length(spark):
    rows = [(1, "abc", None), (-20, "", 2.5), (None, "ab cd", -1.0), *[(k, f"x{k}", k / 4) for k in range(5000)]]
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(3)
    widths = {"a": 7, "b": 6, "c": 8}
    back = IO.read_fixed_records(spark, IO.write_fixed_records(df, scratch_path(spark, "fixed-records"), widths), widths, batch=100)
    got = back.select(F.col("a").cast("long"), "b", F.col("c").cast("double")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((a, b or None, c)) for a, b, c in rows)
    with pytest.raises(Exception, match="b is longer than 2"):
        IO.write_fixed_records(df, scratch_path(spark, "fixed-records"), {"a": 7, "b": 2})
    pairs = spark.createDataFrame([("k1", "v"), ("k1", "w w"), ("", "é")], "k string, v string")
    assert sorted(map(tuple, IO.read_hadoop_pairs(spark, IO.write_hadoop_pairs(pairs, scratch_path(spark, "pairs"))).collect())) == [("", "é"), ("k1", "v"), ("k1", "w w")]
