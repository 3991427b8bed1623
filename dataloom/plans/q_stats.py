"""§2.13 continued: factorisations, distribution tests, correlations and
evaluation metrics written as Spark jobs of their own."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from dataloom.learn import matrix as M
from dataloom.learn import metrics as E
from dataloom.learn import stats as S
from dataloom.plans.registry import query
from dataloom.session import table


def _rounded(c, digits=6):
    return M.positive_zero(F.round(c, digits))


_CELLS_SQL = "x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(64)) AS j FROM embeddings)"


@query(
    "stat_matrix_qr",
    f"""WITH {_CELLS_SQL}, g AS (SELECT a.j AS i, b.j AS j, SUM(a.v * b.v) AS v FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY 1, 2)
       SELECT 'r_t_r' AS part, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(v, 6) + 0.0 AS v FROM g
       UNION ALL SELECT 'q_t_q', CAST(i AS BIGINT), CAST(j AS BIGINT), CASE WHEN i = j THEN 1.0 ELSE 0.0 END FROM g
       UNION ALL SELECT 'rest', vec_id, CAST(0 AS BIGINT), 0.0 FROM embeddings""",
)
def stat_matrix_qr(spark, sf):
    """A = QR of all embeddings by a tree of local factors: R'R (which is A'A),
    Q'Q (which is 1), and for every row the largest difference of A and QR."""
    a = table(spark, sf, "embeddings").select("vec_id", "embedding")
    with_q, r = M.qr(a, "embedding")
    with_q = with_q.select("vec_id", "embedding", "q")
    back = M.times(with_q, "q", r, "qr")
    off = F.array_max(F.zip_with("embedding", "qr", lambda x, y: F.abs(x - y)))
    long = lambda df: df.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), _rounded(F.col("v")).alias("v"))
    rtr = long(M.entries(r.T @ r, a)).withColumn("part", F.lit("r_t_r"))
    qtq = long(M.gram(with_q, "q")).withColumn("part", F.lit("q_t_q"))
    rest = back.select(F.col("vec_id").alias("i"), F.lit(0).cast("long").alias("j"), _rounded(off).alias("v"), F.lit("rest").alias("part"))
    return rtr.unionByName(qtq).unionByName(rest).select("part", "i", "j", "v")


@query(
    "stat_matrix_svd",
    f"""WITH {_CELLS_SQL}, g AS (SELECT a.j AS i, b.j AS j, SUM(a.v * b.v) AS v FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY 1, 2),
            n AS (SELECT SUM(CASE WHEN i = j THEN v END) AS t2, SUM(v * v) AS t4 FROM g)
       SELECT 'sum of squares' AS part, CAST(0 AS BIGINT) AS i, round(t2, 4) AS v FROM n
       UNION ALL SELECT 'sum of fourth powers', 0, round(t4, 2) FROM n
       UNION ALL SELECT 'length of u', i, 1.0 FROM range(8) t(i)
       UNION ALL SELECT 'length of v', i, 1.0 FROM range(8) t(i)
       UNION ALL SELECT 'rest', i, 0.0 FROM range(8) t(i)""",
)
def stat_matrix_svd(spark, sf):
    """Singular values of all embeddings (their squares sum up to the squared
    entries of A, their fourth powers to those of A'A), and the first eight
    directions: lengths of the columns of U and V, and A'u = s v."""
    a = table(spark, sf, "embeddings").select("embedding")
    _, every, _ = M.svd(a, "embedding", 64, out=None, least=0.0)
    with_u, s, v = M.svd(a, "embedding", 8)
    top = len(s)
    both = with_u.select(F.concat("u", F.transform("embedding", lambda x: x.cast("double"))).alias("w"))
    g = np.zeros((top + v.shape[0],) * 2)
    for r in M.gram(both, "w").where((F.col("i") < top) | (F.col("i") == F.col("j"))).collect():  # 8 rows of the small matrix
        g[r.i, r.j] = r.v
    rows = [("sum of squares", 0, round(float((every ** 2).sum()), 4)), ("sum of fourth powers", 0, round(float((every ** 4).sum()), 2))]
    for k in range(top):
        rows += [("length of u", k, round(float(g[k, k]), 6)), ("length of v", k, round(float((v[:, k] ** 2).sum()), 6)),
                 ("rest", k, abs(round(float(np.abs(g[k, top:] - s[k] * v[:, k]).max()), 6)))]
    return spark.createDataFrame(rows, "part string, i long, v double")


_SHIPPED_SQL = "a AS (SELECT l_suppkey AS i, l_partkey % 100 AS j, SUM(l_quantity) AS v FROM lineitem GROUP BY 1, 2)"


@query(
    "stat_matrix_blocks",
    f"""WITH {_SHIPPED_SQL}, p AS (SELECT a.j AS i, b.j AS j, SUM(a.v * b.v) AS v FROM a JOIN a b ON a.i = b.i GROUP BY 1, 2)
       SELECT 'transposed' AS part, j AS i, i AS j, round(v, 4) AS v FROM a
       UNION ALL SELECT 'product', i, j, round(v, 4) FROM p""",
)
def stat_matrix_blocks(spark, sf):
    """Quantities by supplier and part class as blocks of 32 x 32: transposed, and A'A as a product of blocks."""
    li = table(spark, sf, "lineitem")
    a = li.groupBy(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 100).alias("j")).agg(F.sum("l_quantity").alias("v"))
    blocks = M.to_blocks(a, 32)
    turned = M.transpose(blocks)
    out = lambda df, part: M.from_blocks(df).select(F.lit(part).alias("part"), "i", "j", F.round("v", 4).alias("v"))
    return out(turned, "transposed").unionByName(out(M.multiply_blocks(turned, blocks), "product"))


_KS_P = " + ".join(f"{2 if k % 2 else -2}.0 * exp(-2.0 * {k * k} * t2)" for k in range(1, 41))


@query(
    "stat_ks_test",
    f"""WITH v AS (SELECT l_returnflag AS g, l_quantity AS x, COUNT(*) AS c FROM lineitem GROUP BY 1, 2),
            s AS (SELECT *, SUM(c) OVER (PARTITION BY g ORDER BY x) AS upto, SUM(c) OVER (PARTITION BY g) AS n FROM v),
            f AS (SELECT *, greatest(0.0, least(1.0, x / 50.0)) AS f FROM s),
            one AS (SELECT 'quantity is uniform' AS test, g, max(n) AS n, max(greatest(abs(upto / n - f), abs(f - (upto - c) / n))) AS d FROM f GROUP BY g),
            v2 AS (SELECT l_linestatus AS g, l_extendedprice AS x, SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS c1,
                          SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS c2 FROM lineitem GROUP BY 1, 2),
            s2 AS (SELECT g, SUM(c1) OVER w AS u1, SUM(c2) OVER w AS u2, SUM(c1) OVER (PARTITION BY g) AS n1, SUM(c2) OVER (PARTITION BY g) AS n2
                   FROM v2 WINDOW w AS (PARTITION BY g ORDER BY x)),
            two AS (SELECT 'price of returned lines' AS test, g, max(n1 * n2 / (n1 + n2)) AS n, max(abs(u1 / n1 - u2 / n2)) AS d FROM s2 GROUP BY g),
            t AS (SELECT test, g, d, n * d * d AS t2 FROM (SELECT * FROM one UNION ALL SELECT * FROM two))
       SELECT test, g AS "group", round(d, 8) AS statistic,
              round(CASE WHEN t2 < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, {_KS_P})) END, 6) AS p_value FROM t""",
)
def stat_ks_test(spark, sf):
    """Kolmogorov-Smirnov over all lines: quantities of each return flag against a
    uniform law, and prices of returned against other lines for each line status."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    one = S.ks_one_sample(li, "l_quantity", S.uniform_cdf(0.0, 50.0), ["l_returnflag"])
    two = S.ks_two_samples(li, "l_extendedprice", F.col("l_returnflag") == "R", ["l_linestatus"])
    pick = lambda df, test, key: df.select(F.lit(test).alias("test"), F.col(key).alias("group"),
                                           F.round("statistic", 8).alias("statistic"), F.round("p_value", 6).alias("p_value"))
    return pick(one, "quantity is uniform", "l_returnflag").unionByName(pick(two, "price of returned lines", "l_linestatus"))


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_RANKED = ", ".join(f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS c{k}" for k, c in enumerate(_COLS))
_PAIRS = [(i, j) for i in range(len(_COLS)) for j in range(len(_COLS))]


@query(
    "stat_correlation",
    "WITH d AS (SELECT " + ", ".join(f"{c} AS c{k}" for k, c in enumerate(_COLS)) + f" FROM lineitem), r AS (SELECT {_RANKED} FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{m}' AS method, CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, round(corr(c{i}, c{j}), 6) + 0.0 AS correlation FROM {t}"
                         for m, t in (("pearson", "d"), ("spearman", "r")) for i, j in _PAIRS),
)
def stat_correlation(spark, sf):
    """Pearson and Spearman correlation matrices of the numbers of all lines."""
    li = table(spark, sf, "lineitem").select(*_COLS)
    both = [S.correlation(li, _COLS, m).select(F.lit(m).alias("method"), "i", "j", _rounded("correlation").alias("correlation"))
            for m in ("pearson", "spearman")]
    return both[0].unionByName(both[1])


@query(
    "mod_evaluate_clusters",
    """WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(64)) AS j FROM embeddings WHERE label IS NOT NULL),
            p AS (SELECT vec_id, any_value(label) AS label, SUM(v * v) AS sq FROM x GROUP BY vec_id),
            c AS (SELECT label, COUNT(*) AS n, SUM(sq) AS psi FROM p GROUP BY label), y AS (SELECT label, j, SUM(v) AS s FROM x GROUP BY 1, 2),
            k AS (SELECT x.vec_id, y.label AS other, SUM(x.v * y.s) AS dot FROM x JOIN y ON x.j = y.j GROUP BY 1, 2),
            d AS (SELECT p.vec_id, p.label, k.other, c.n, greatest(p.sq * c.n + c.psi - 2 * k.dot, 0) AS total
                  FROM k JOIN p ON p.vec_id = k.vec_id JOIN c ON c.label = k.other),
            ab AS (SELECT vec_id, label, max(CASE WHEN label = other THEN n END) AS own, max(CASE WHEN label = other THEN total / greatest(n - 1, 1) END) AS a,
                          min(CASE WHEN label <> other THEN total / n END) AS b FROM d GROUP BY 1, 2),
            s AS (SELECT label, CASE WHEN own = 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
       SELECT label, COUNT(*) AS points, round(avg(s), 6) + 0.0 AS silhouette FROM s GROUP BY label""",
)
def mod_evaluate_clusters(spark, sf):
    """Silhouette (squared Euclidean) of the embeddings' labels, averaged for each of them."""
    e = table(spark, sf, "embeddings").select("label", "embedding")
    out = E.silhouette(e, "embedding", "label")
    return out.groupBy("label").agg(F.count("*").alias("points"), _rounded(F.avg("silhouette")).alias("silhouette"))


_RANKING_SQL = """b AS (SELECT o_custkey AS u, p_brand AS i, SUM(CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN l_quantity ELSE 0 END) AS q,
                               COUNT(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1997-01-01') AS later
                        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
     k AS (SELECT u, i, q, later > 0 AS rel, row_number() OVER (PARTITION BY u ORDER BY q DESC, i) AS pos FROM b WHERE q > 0),
     r AS (SELECT u, COUNT(*) FILTER (WHERE later > 0) AS n FROM b GROUP BY u),
     h AS (SELECT r.u, r.n, k.pos, coalesce(k.rel, false) AS rel, SUM(CASE WHEN k.rel THEN 1 ELSE 0 END) OVER (PARTITION BY r.u ORDER BY k.pos) AS hits
           FROM r LEFT JOIN k ON r.u = k.u)"""


def _ranking_columns(k: int) -> str:
    ideal = f"list_sum([{', '.join(f'1.0 / log2({i + 1}.0)' for i in range(1, k + 1))}][1:least(n, {k})])"
    return f"""round(avg(CASE WHEN n > 0 THEN ap{k} / least(n, {k}) ELSE 0 END), 6) AS map_{k}, round(avg(CASE WHEN n > 0 THEN dcg{k} / {ideal} ELSE 0 END), 6) AS ndcg_{k},
              round(avg(CASE WHEN n > 0 THEN top{k} / {k}.0 ELSE 0 END), 6) AS precision_{k}, round(avg(CASE WHEN n > 0 THEN top{k} / n ELSE 0 END), 6) AS recall_{k}"""


@query(
    "mod_evaluate_ranking",
    f"""WITH {_RANKING_SQL},
     s AS (SELECT u, any_value(n) AS n, coalesce(SUM(CASE WHEN rel THEN hits / pos END), 0) AS ap, """ + ", ".join(
        f"coalesce(SUM(CASE WHEN rel AND pos <= {k} THEN hits / pos END), 0) AS ap{k}, coalesce(SUM(CASE WHEN rel AND pos <= {k} THEN 1.0 / log2(pos + 1.0) END), 0) AS dcg{k}, "
        f"COUNT(*) FILTER (WHERE rel AND pos <= {k}) AS top{k}" for k in (3, 10)) + f""" FROM h GROUP BY u)
       SELECT COUNT(*) AS queries, round(avg(CASE WHEN n > 0 THEN ap / n ELSE 0 END), 6) AS "map", {_ranking_columns(3)}, {_ranking_columns(10)} FROM s""",
)
def mod_evaluate_ranking(spark, sf):
    """Brands by a customer's quantities before 1997 as a ranking for the brands
    bought since: MAP, and MAP, NDCG, precision and recall at 3 and 10."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")).alias("early"))
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    brands = lines.groupBy("o_custkey", "p_brand").agg(F.sum(F.when(F.col("early"), F.col("l_quantity")).otherwise(0)).alias("q"),
                                                       F.max(~F.col("early")).alias("later"))
    # a customer has no more entries than there are brands
    ranked = F.array_sort(F.collect_list(F.when(F.col("q") > 0, F.struct((-F.col("q")).alias("q"), F.col("p_brand").alias("i")))))
    lists = brands.groupBy("o_custkey").agg(F.transform(ranked, lambda s: s["i"]).alias("p"), F.collect_list(F.when(F.col("later"), F.col("p_brand"))).alias("r"))
    out = E.ranking_scores(lists, "p", "r", [3, 10])
    return out.select("queries", *[F.round(c, 6).alias(c) for c in out.columns if c != "queries"])


@query(
    "mod_evaluate_label_sets",
    """WITH d AS (SELECT DISTINCT l_orderkey AS o, l_returnflag || l_linestatus AS f, true AS l FROM lineitem),
            e AS (SELECT DISTINCT l_orderkey AS o, l_returnflag || l_linestatus AS f, true AS p FROM lineitem WHERE l_quantity > 20),
            m AS (SELECT coalesce(d.o, e.o) AS o, coalesce(d.f, e.f) AS f, coalesce(p, false) AS p, coalesce(l, false) AS l FROM d FULL JOIN e ON d.o = e.o AND d.f = e.f),
            r AS (SELECT o, COUNT(*) AS u, COUNT(*) FILTER (WHERE p) AS np, COUNT(*) FILTER (WHERE l) AS nl, COUNT(*) FILTER (WHERE p AND l) AS b FROM m GROUP BY o),
            k AS (SELECT f, 2 * COUNT(*) FILTER (WHERE p AND l) / (COUNT(*) FILTER (WHERE p) + COUNT(*) FILTER (WHERE l)) AS f1 FROM m GROUP BY f)
       SELECT COUNT(*) AS documents, round(avg(CASE WHEN u = b THEN 1.0 ELSE 0.0 END), 6) AS subset_accuracy, round(avg(b / u), 6) AS accuracy,
              round(SUM(u - b) / (COUNT(*) * (SELECT COUNT(*) FROM k)), 6) AS hamming_loss, round(avg(CASE WHEN np > 0 THEN b / np ELSE 0 END), 6) AS "precision",
              round(avg(b / nl), 6) AS recall, round(avg(2 * b / (np + nl)), 6) AS f1, round(SUM(b) / SUM(np), 6) AS micro_precision,
              round(SUM(b) / SUM(nl), 6) AS micro_recall, round(2 * SUM(b) / (SUM(np) + SUM(nl)), 6) AS micro_f1, round((SELECT avg(f1) FROM k), 6) AS macro_f1
       FROM r""",
)
def mod_evaluate_label_sets(spark, sf):
    """The flags of an order's lines of more than 20 pieces as a prediction of all its flags."""
    li = table(spark, sf, "lineitem").withColumn("f", F.concat("l_returnflag", "l_linestatus"))
    sets = li.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_quantity") > 20, F.col("f"))).alias("p"), F.collect_set("f").alias("l"))
    out = E.label_set_scores(sets, "p", "l")
    return out.select("documents", *[F.round(c, 6).alias(c) for c in out.columns if c != "documents"])
