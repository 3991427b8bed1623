"""Rows that once did less than the whole job."""

from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dataloom.learn import partners as P
from dataloom.plans import REGISTRY
from dataloom.session import table


def brute_partners(baskets, top):
    """The partners of each item by log-likelihood ratio, from sets of items."""
    n, single, both = len(baskets), Counter(i for b in baskets for i in b), Counter((i, j) for b in baskets for i in b for j in b if i != j)

    def h(*c):
        return sum(c) * math.log(sum(c)) - sum(x * math.log(x) for x in c if x)

    out = {}
    for (i, j), k in both.items():
        if k * n > single[i] * single[j]:
            a, b, c, d = k, single[i] - k, single[j] - k, n - single[i] - single[j] + k
            out.setdefault(i, []).append((-round(2 * (h(a + b, c + d) + h(a + c, b + d) - h(a, b, c, d)), 9), j))
    return {i: [j for _, j in sorted(found)[:top]] for i, found in out.items()}


def test_recommended_parts_are_new(spark):
    rng = random.Random(2)
    lines = [(b, b % 25, rng.choice([rng.randint(0, 40), b % 7])) for b in range(200) for _ in range(rng.randint(1, 5))]
    df = spark.createDataFrame([*lines, (None, 1, 2), (3, 3, None)], "basket long, u long, i long")
    baskets, bought = {}, {}
    for b, u, i in lines:
        baskets.setdefault(b, set()).add(i)
        bought.setdefault(u, set()).add(i)
    for top in (2, 5, None):
        want = brute_partners(list(baskets.values()), top)
        pairs = P.partners(df, top)
        got = {}
        for r in pairs.collect():
            got.setdefault(r.i, set()).add(r.other)
        assert got == {i: set(x) for i, x in want.items()}
        new = {(r.u, r.i) for r in P.new_items(df.where("i IS NOT NULL AND basket IS NOT NULL"), pairs).collect()}
        assert new == {(u, j) for u, has in bought.items() for i in has for j in want.get(i, []) if j not in has}
    recs = REGISTRY["mod_recommend_new_parts"].fn(spark, SF_SMALL).collect()
    candidates = {(r.u, r.i) for r in REGISTRY["mod_recommend_candidates"].fn(spark, SF_SMALL).collect()}
    per = Counter(r.u for r in recs)
    assert recs and {(r.u, r.i) for r in recs} <= candidates and all(per[u] == min(3, n) for u, n in Counter(u for u, _ in candidates).items())
    assert len(candidates) < 10 * table(spark, SF_SMALL, "lineitem").count()


def test_search_engines_by_whole_host_and_suffix(spark, tmp_path):
    from dataloom.functions import weblog as W

    rows = [("http://www.google.de/search?q=a+b", "Google Germany", None), ("http://uk.search.yahoo.com/s?x=1&p=two%20words", "Yahoo! UK", "two words"),
            ("http://search.yahoo.com/search?p=z&ei=1", "Yahoo!", "z"), ("http://WWW.Google.co.uk/search?hl=en&q=purpose+of+life#x", "Google UK", "purpose of life"),
            ("http://technorati.com/search/some+thing?x=1", "Technorati", "some thing"), ("http://notgoogle.com/?q=1", None, None),
            ("http://com/?q=1", None, None), ("http://www.google.com/search?hl=q", "Google", None), ("nothing", None, None), (None, None, None)]
    df = spark.createDataFrame([r[:1] for r in rows], "url string").withColumn("host", F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1))
    got = {r.url: (r.engine, r.term) for r in W.search_host(df, "host", W.host_table(spark)).withColumn("term", W.search_term(F.col("url"), F.col("keys"))).collect()}
    assert got == {u: (e, t) for u, e, t in rows}
    assert W.host_table(spark).where("engine IS NOT NULL").count() == 305
    (tmp_path / "hosts.tsv").write_text("host\tengine\tkeys\nexample.com\tExample\tzz\nblog.example.com\tBlog\t\nexample.com\tExample\tzz\n")
    urls = spark.createDataFrame([("http://m.example.com/?zz=1",), ("http://a.blog.example.com/?zz=1",), ("http://google.de/?q=1",)], "url string")
    named = W.search_host(urls.withColumn("host", F.regexp_extract("url", "//([^/]+)", 1)), "host", W.host_table(spark, str(tmp_path / "hosts.tsv")))
    assert sorted((r.engine or "", r.term or "") for r in named.withColumn("term", W.search_term(F.col("url"), F.col("keys"))).collect()) == [("", ""), ("Blog", ""), ("Example", "1")]


def test_date_part_of_a_log_stamp(spark):
    from dataloom.functions import weblog as W

    df = spark.createDataFrame([("25/Dec/2008:23:30:00 -0700",), ("no date",), (None,)], "s string")
    assert [r[0] for r in df.select(W.date_part(F.col("s"))).collect()] == ["2008-12-26", None, None]
    assert df.select(W.date_part(F.col("s"), out="yyyy")).first()[0] == "2008"
