"""GROUP / COGROUP / CUBE / ROLLUP and aggregate helpers.

A bag is never materialised as one unbounded array: ``group_bag`` splits a
group's rows into chunks of at most ``max_bag`` rows (one output row per
chunk), so a key holding a third of the data still spreads over many rows and
tasks. Aggregates go through Spark's partial (map-side) + final aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dataloom.operators.joins import checked_broadcast
from dataloom.session import fixed

UNKNOWN = "unknown"


def group_bag(df: DataFrame, keys: Sequence[str], max_bag: int = 10_000, bag: str = "bag") -> DataFrame:
    """GROUP df BY keys: rows (keys..., part, n_parts, bag) with |bag| <= ~max_bag.

    The number of chunks of a key comes from its exact count (a partial
    aggregate); rows are spread over chunks by a hash of a row id, which is
    written with the rows first, so a retried task sees the same ids.
    Null keys form one group, as in a single-input GROUP.
    """
    keys = list(keys)
    cols = [c for c in df.columns]
    df = fixed(df.withColumn("__id", F.monotonically_increasing_id()), "rows")
    counts = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("__n"))
    counts = counts.withColumn("n_parts", F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(max_bag))).cast("int"))
    # null-safe join back so the null-key group keeps its rows
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    j = df.join(counts, cond, "inner").select(*cols, "__id", "n_parts")
    part = F.pmod(F.xxhash64("__id"), F.col("n_parts"))
    return (
        j.withColumn("part", part.cast("int"))
        .groupBy(*keys, "part", "n_parts")
        .agg(F.collect_list(F.struct(*[F.col(c) for c in cols if c not in keys])).alias(bag))
    )


def key_bucket(key: str, n: int) -> Column:
    """Which of ``n`` buckets a key lies in; null keys have a bucket of their own.

    A Python function that is called once per key pays its call and its Arrow
    batch for every few rows: group by the bucket instead and let one call see
    many whole groups, with ``n`` from ``bucket_count``.
    """
    return F.when(F.col(key).isNull(), F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64(key), F.lit(n).cast("long")))


def bucket_count(*inputs: DataFrame, rows: int = 20_000) -> int:
    """As many buckets as keep one at about ``rows`` rows of all inputs, however large they are."""
    return max(1, -(-sum(df.count() for df in inputs) // rows))


def cogroup_counts(
    inputs: Mapping[str, tuple[DataFrame, Sequence[str]]],
    key_names: Sequence[str],
    inner: Sequence[str] = (),
    aggs: Mapping[str, Sequence[Column]] | None = None,
) -> DataFrame:
    """COGROUP a BY ka, b BY kb ...: one row per key with per-input summaries.

    Each input is reduced to (key, n_<name>, extra aggregates) first, then the
    summaries are full-outer-joined on the key; null keys never join, so nulls
    of different inputs stay separate groups. ``inner`` names inputs whose
    empty bags drop the key (COGROUP ... INNER).
    """
    out = None
    for name, (df, ks) in inputs.items():
        extra = list((aggs or {}).get(name, []))
        s = df.groupBy(*[F.col(k).alias(n) for k, n in zip(ks, key_names)]).agg(F.count("*").alias(f"n_{name}"), *extra)
        if out is None:
            out = s
        else:
            cond = reduce(lambda a, b: a & b, [out[n] == s[n] for n in key_names])
            out = out.join(s, cond, "full").select(
                *[F.coalesce(out[n], s[n]).alias(n) for n in key_names],
                *[out[c] for c in out.columns if c not in key_names],
                *[s[c] for c in s.columns if c not in key_names],
            )
    for name in inputs:
        out = out.withColumn(f"n_{name}", F.coalesce(F.col(f"n_{name}"), F.lit(0)))
    for name in inner:
        out = out.filter(F.col(f"n_{name}") > 0)
    return out


def with_unknown(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Data nulls become 'unknown' so they differ from the CUBE / ROLLUP all-marker."""
    return df.withColumns({d: F.coalesce(F.col(d).cast("string"), F.lit(UNKNOWN)) for d in dims})


def cube(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """CUBE(dims): all 2^n groupings; the all-marker is null."""
    return with_unknown(df, dims).cube(*dims).agg(*aggs)


def rollup(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """ROLLUP(dims): the n+1 hierarchical groupings."""
    return with_unknown(df, dims).rollup(*dims).agg(*aggs)


def salted_sum_count_max(df: DataFrame, keys: Sequence[str], value: str, salts: int = 32) -> DataFrame:
    """Two-level aggregate for skewed keys: (keys, salt) partials, then keys.

    Built-in algebraic aggregates already combine map-side; the explicit salt
    additionally spreads the final merge of one hot key over ``salts`` tasks.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    part = df.withColumn("__salt", salt).groupBy(*keys, "__salt").agg(
        F.sum(value).alias("__s"), F.count(value).alias("__c"), F.max(value).alias("__m")
    )
    return part.groupBy(*keys).agg(
        F.sum("__s").alias(f"sum_{value}"), F.sum("__c").alias(f"count_{value}"), F.max("__m").alias(f"max_{value}")
    )


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str | None = None) -> DataFrame:
    """TOP(n) per group by ``order`` (add tie-breakers for a stable pick).

    ``row_number() <= n`` lets Spark plan a WindowGroupLimit: each map task
    keeps only its own n best rows per key before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = F.row_number().over(w)
    res = df.withColumn("__rn", rn).filter(F.col("__rn") <= n)
    return res.withColumnRenamed("__rn", out) if out else res.drop("__rn")


def mean_abs_deviation(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """avg(|x - mean|) per group, two passes: group means joined back.

    The means table has one row per group; it is broadcast only when its size
    is proven small, else the join shuffles.
    """
    means = df.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    j = df.join(checked_broadcast(means), list(keys))
    return j.groupBy(*keys).agg(F.avg(F.abs(F.col(value) - F.col("__mean"))).alias(f"mad_{value}"))
