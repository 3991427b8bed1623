"""Evaluation of clusterings, rankings and label sets as aggregates over their rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dataloom.learn.matrix import stacked
from dataloom.session import ship_package

#: numbers that all tasks may hold for the clusters together (256 MB)
MOST_CENTRE_NUMBERS = 32 * 1024 * 1024


def silhouette(df: DataFrame, features: str, cluster: str, distance: str = "squaredEuclidean") -> DataFrame:
    """The rows of ``df`` with ``silhouette``: (b - a) / max(a, b) of the mean distances to the own and to the nearest other cluster.

    The mean distance of a point to a cluster follows from the cluster's size,
    the sum of its vectors and the sum of their squared norms, so one pass
    gives these sums and a second scores each point against them: no pair of
    points is made. ``distance`` is ``squaredEuclidean`` or ``cosine``. A point
    that is alone in its cluster scores 0. Rows with a null vector or cluster
    are left out; with a single cluster every score is 0. The clusters' sums are held by every task;
    more than ``MOST_CENTRE_NUMBERS`` numbers are refused.
    """
    if distance not in ("squaredEuclidean", "cosine"):
        raise ValueError(f"distance must be squaredEuclidean or cosine, not {distance}")
    spark = df.sparkSession
    ship_package(spark)
    name = "cluster as text"
    rows = df.where(F.col(features).isNotNull() & F.col(cluster).isNotNull()).withColumn(name, F.col(cluster).cast("string"))
    first = rows.select(F.size(features)).first()
    n = first[0] if first else 0
    groups = rows.select(name).distinct().count()
    if groups * n > MOST_CENTRE_NUMBERS:
        raise ValueError(f"{groups} clusters of {n} numbers do not fit a task")

    def shaped(x: np.ndarray) -> np.ndarray:
        if distance == "cosine":
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            if (norm == 0).any():
                raise ValueError("a zero vector has no cosine distance")
            x = x / norm
        return x

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size, sum and squared norms of each cluster of a task."""
        sums: dict = {}
        for b in batches:
            x = shaped(stacked(b.column(1), n))
            clusters, code = np.unique(np.array(b.column(0).to_pylist(), object).astype(str), return_inverse=True)
            for k, c in enumerate(clusters.tolist()):
                own = x[code == k]
                part = np.concatenate([[len(own), (own * own).sum()], own.sum(axis=0)])
                sums[c] = sums[c] + part if c in sums else part
        at = pa.array(np.tile(np.arange(n + 2, dtype=np.int32), len(sums)))
        who = pa.array(np.repeat(np.array(list(sums), object), n + 2), pa.string())
        yield pa.RecordBatch.from_arrays([who, at, pa.array(np.concatenate([*sums.values(), []]), pa.float64())], ["c", "at", "v"])

    vectors = rows.select(F.col(name).alias("c"), F.col(features).cast("array<double>").alias("x"))
    cells = vectors.mapInArrow(local, "c string, at int, v double").groupBy("c", "at").agg(F.sum("v").alias("v"))
    total = cells.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("s")).collect()
    names = {r["c"]: k for k, r in enumerate(total)}
    sums = np.array([r["s"] for r in total]).reshape(-1, n + 2)
    shared = spark.sparkContext.broadcast((names, sums))  # bounded above

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sums = shared.value
        size, norms, centre = sums[:, 0], sums[:, 1], sums[:, 2:]
        for b in batches:
            x = shaped(stacked(b.column(b.schema.get_field_index(features)), n))
            own = np.array([names[c] for c in b.column(b.schema.get_field_index(name)).to_pylist()], int)
            dots = x @ centre.T
            if distance == "cosine":
                summed = size - dots
            else:
                summed = (x * x).sum(axis=1)[:, None] * size + norms - 2 * dots
            summed = np.maximum(summed, 0)
            row = np.arange(len(x))
            a = summed[row, own] / np.maximum(size[own] - 1, 1)
            other = summed / size
            other[row, own] = np.inf
            near = other.min(axis=1, initial=np.inf)
            top = np.maximum(a, near)
            with np.errstate(invalid="ignore"):
                s = np.where((size[own] > 1) & (len(size) > 1) & (top > 0), (near - a) / top, 0.0)
            yield b.append_column("silhouette", pa.array(np.where(np.isfinite(s), s, 0.0)))

    return rows.mapInArrow(score, StructType(list(rows.schema.fields)).add("silhouette", "double")).drop(name)


def _hits(pred: Column, relevant: Column) -> Column:
    """1.0 or 0.0 for each place of the ranking."""
    return F.transform(pred, lambda p: F.when(F.array_contains(relevant, p), 1.0).otherwise(0.0))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _ideal(n: Column) -> Column:
    """The gains 1 / log2(place + 1) of the first n places, added up."""
    return F.when(n > 0, _sum(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: 1 / F.log2(i + 1.0)))).otherwise(0.0)


def ranking_scores(df: DataFrame, predicted: str, relevant: str, at: Sequence[int]) -> DataFrame:
    """(queries, map, and for each k in ``at``: map_k, ndcg_k, precision_k, recall_k), means over the rows of ``df``.

    ``predicted`` is a list, best first, ``relevant`` a list without order,
    whose repeats count once. A row without relevant items scores 0 and counts. Rows
    with a null list are left out; an empty table gives nulls and 0 queries.
    """
    rows = df.where(F.col(predicted).isNotNull() & F.col(relevant).isNotNull()).select(
        F.col(predicted).alias("p"), F.array_distinct(relevant).alias("r"))
    rows = rows.select(_hits(F.col("p"), F.col("r")).alias("h"), F.size("r").alias("n"))
    some = F.col("n") > 0

    def precisions(h: Column) -> Column:
        """Precision at each place that is a hit, added up."""
        return F.aggregate(h, F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("hits"), F.lit(0.0).alias("sum")),
                           lambda s, x: F.struct((s["at"] + 1).alias("at"), (s["hits"] + x).alias("hits"),
                                                 (s["sum"] + x * (s["hits"] + x) / (s["at"] + 1)).alias("sum")))["sum"]

    def gains(h: Column) -> Column:
        return _sum(F.transform(h, lambda x, i: x / F.log2(i + 2.0)))

    mean = lambda c, name: F.avg(F.when(some, c).otherwise(0.0)).alias(name)
    out = [F.count("*").alias("queries"), mean(precisions(F.col("h")) / F.col("n"), "map")]
    for k in at:
        top = F.slice("h", 1, k)
        out += [mean(precisions(top) / F.least("n", F.lit(k)), f"map_{k}"), mean(gains(top) / _ideal(F.least("n", F.lit(k))), f"ndcg_{k}"),
                mean(_sum(top) / k, f"precision_{k}"), mean(_sum(top) / F.col("n"), f"recall_{k}")]
    return rows.agg(*out)


def label_set_scores(df: DataFrame, predicted: str, labels: str) -> DataFrame:
    """One row of means over documents with a predicted and a true set of labels.

    documents, subset_accuracy, accuracy, hamming_loss, precision, recall, f1,
    micro_precision, micro_recall, micro_f1, macro_f1. Repeats in a set count
    once. Sets that are both empty agree (accuracy 1, the other shares 0).
    ``hamming_loss`` and ``macro_f1`` go over the labels that occur in true sets.
    Rows with a null set are left out.
    """
    rows = df.where(F.col(predicted).isNotNull() & F.col(labels).isNotNull()).select(
        F.array_distinct(predicted).alias("p"), F.array_distinct(labels).alias("l"))
    rows = rows.withColumn("both", F.size(F.array_intersect("p", "l")).cast("long"))
    rows = rows.withColumn("np", F.size("p").cast("long")).withColumn("nl", F.size("l").cast("long"))
    # per label: how often predicted, true, both; all means of the rest follow from sums over the rows
    marks = rows.select(F.explode(F.array_union("p", "l")).alias("label"), "p", "l").select(
        "label", F.array_contains("p", F.col("label")).cast("long").alias("in_p"), F.array_contains("l", F.col("label")).cast("long").alias("in_l"))
    per = marks.groupBy("label").agg(F.sum("in_p").alias("np"), F.sum("in_l").alias("nl"), F.sum(F.col("in_p") * F.col("in_l")).alias("both"))
    over = per.where("nl > 0").agg(F.count("*").alias("n_labels"), F.avg(2 * F.col("both") / (F.col("np") + F.col("nl"))).alias("macro_f1"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    union = F.col("np") + F.col("nl") - F.col("both")
    sums = rows.agg(
        F.count("*").alias("documents"), F.avg((union == F.col("both")).cast("double")).alias("subset_accuracy"),
        F.avg(F.when(union > 0, F.col("both") / union).otherwise(1.0)).alias("accuracy"), F.sum(union - F.col("both")).alias("wrong"),
        F.avg(share(F.col("both"), F.col("np"))).alias("precision"), F.avg(share(F.col("both"), F.col("nl"))).alias("recall"),
        F.avg(share(2 * F.col("both"), F.col("np") + F.col("nl"))).alias("f1"),
        F.sum("both").alias("b"), F.sum("np").alias("p"), F.sum("nl").alias("l"))
    n_labels, macro = over.first()  # two numbers
    return sums.select("documents", "subset_accuracy", "accuracy", (F.col("wrong") / (F.col("documents") * F.lit(n_labels))).alias("hamming_loss"),
                       "precision", "recall", "f1", share(F.col("b"), F.col("p")).alias("micro_precision"), share(F.col("b"), F.col("l")).alias("micro_recall"),
                       share(2 * F.col("b"), F.col("p") + F.col("l")).alias("micro_f1"),
                       F.lit(macro).cast("double").alias("macro_f1"))
