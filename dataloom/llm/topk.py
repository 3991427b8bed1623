"""Exact top-k inner products by a three-phase uniform threshold.

Each vector's components are dealt over ``lists`` local score lists; a score is
the sum of one local score from each list.

1. Gather: every list gives its ``k`` best entries per query; the gathered
   candidates' whole scores are looked up and the k-th best of them over all
   blocks is a lower bound ``tau`` of the query's k-th best score.
2. Broadcast the cutoff: an object whose score reaches ``tau`` has a local score
   of at least ``tau / lists`` in some list, so every list sends its entries
   from that cutoff up. Lists that stay silent are known to be below it, which
   bounds each sent object from above; objects bounded below ``tau`` are out.
3. Resolve: the objects that are left get their missing local scores, and the
   k best are exact. No object is lost: a silent object is below ``tau``.

Vectors and queries are dealt over blocks by hash and every (query block,
vector block) pair is one task's matrix product, so memory is bounded by the
block sizes and nothing is collected or broadcast whole; the cutoffs travel to
their query blocks through a join.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, prepare


def quantise(df: DataFrame, id_col: str, vec_col: str, scale: float = 1024.0) -> DataFrame:
    """(vec_id, v array<long>, dim): floor(scale * x) in double; vectors null, or with null or non-finite components, go.

    Exactly repeated rows count once; a null id takes no part.
    """
    x = F.col("x")
    fine = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fine)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(scale)).cast("long")).alias("v"),
                       F.size("x").alias("dim")).distinct()


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, 0), np.int64)


def _local_scores(q: np.ndarray, v: np.ndarray, lists: int) -> list[np.ndarray]:
    """Per list the matrix of local scores; in double precision where that is exact."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    kind = np.float64 if largest < 2.0**52 else np.int64
    q, v = q.astype(kind), v.astype(kind)
    edges = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(edges[:-1], edges[1:])]


def _own(q: pd.DataFrame, v: pd.DataFrame) -> np.ndarray:
    return q["query_id"].to_numpy()[:, None] == v["vec_id"].to_numpy()[None, :]


def top_k(df: DataFrame, is_query: F.Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
          scale: float = 1024.0, lists: int = 4, query_block: int = 512, vector_block: int = 2048) -> DataFrame:
    """The ``k`` best rows (all, if fewer) of each query row: query_id, rank from 1, vec_id, score long.

    Ties go to the smaller id; a query's own id is no candidate. Vectors of
    different lengths are not compared. A table without queries or candidates
    gives no rows. Scores are exact while they fit a long.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = materialize(quantise(df, id_col, vec_col, scale), "quantised")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("w"), F.col("dim").alias("dim"))
    dims = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).collect()}
    blocks = spark.createDataFrame([(d, math.ceil(n / vector_block), max(1, math.ceil(q / query_block))) for d, (n, q) in dims.items()] or [(0, 1, 1)],
                                   "dim int, nv int, nq int")
    by_row, by_query = F.xxhash64("vec_id", "v"), F.xxhash64("query_id", "w")
    sized = F.broadcast(blocks)  # one row per vector length
    vectors = rows.join(sized, "dim").select(
        "dim", F.pmod(by_row, "nv").cast("int").alias("vb"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), "vec_id", "v")
    queries = asked.join(sized, "dim").select(
        "dim", F.pmod(by_query, "nq").cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), "query_id", "w")
    key = ["dim", "qb", "vb"]

    def gather(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "score": []})
        local = _local_scores(_matrix(q["w"]), _matrix(v["v"]), lists)
        total, own = sum(local), _own(q, v)
        best = min(k + 1, len(v))
        seen = np.zeros(total.shape, bool)
        for s in local:
            np.put_along_axis(seen, np.argpartition(-s, best - 1, axis=1)[:, :best], True, axis=1)
        r, c = np.nonzero(seen & ~own)
        out = pd.DataFrame({"query_id": q["query_id"].to_numpy()[r], "score": total[r, c].astype(np.int64), "row": r})
        out = out.sort_values(["row", "score"], ascending=[True, False])
        return out[out.groupby("row").cumcount() < k][["query_id", "score"]]

    gathered = vectors.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(
        lambda v, q: gather(q, v), "query_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"))
    cutoff = gathered.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k)
    cutoff = materialize(cutoff.groupBy("query_id").agg(F.min("score").alias("tau"), F.count("*").alias("n")), "cutoffs")
    cutoff = cutoff.select("query_id", F.when(F.col("n") == k, F.col("tau")).alias("tau"))  # fewer than k known: no cutoff
    informed = asked.join(cutoff, "query_id", "left").join(sized, "dim").select(
        "dim", F.pmod(by_query, "nq").cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), "query_id", "w", "tau")

    def resolve(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        local, own = _local_scores(_matrix(q["w"]), _matrix(v["v"]), lists), _own(q, v)
        open_end = q["tau"].isna().to_numpy()[:, None]
        tau = q["tau"].fillna(0).astype("int64").to_numpy()[:, None]
        uniform = -((-tau) // lists)  # ceil: scores are integers
        bound = np.zeros(local[0].shape, local[0].dtype)
        sent = np.zeros(bound.shape, bool)
        for s in local:
            high = s >= uniform
            sent |= high
            bound += np.where(high, s, uniform)
        r, c = np.nonzero((open_end | (sent & (bound >= tau))) & ~own)
        score = sum(s[r, c] for s in local).astype(np.int64)
        keep = open_end[r, 0] | (score >= tau[r, 0])
        return pd.DataFrame({"query_id": q["query_id"].to_numpy()[r][keep], "vec_id": v["vec_id"].to_numpy()[c][keep], "score": score[keep]})

    resolved = vectors.groupBy(*key).cogroup(informed.groupBy(*key)).applyInPandas(
        lambda v, q: resolve(q, v), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return resolved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
