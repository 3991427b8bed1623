"""Exact percentiles and modes from counts of distinct values.

A percentile is the value at a rank. Counts per (key, value) give each value
its range of ranks through running counts over range partitions with carried
totals, and the value whose range holds the wanted rank is picked by a filter:
no group's values ever meet in one buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dataloom.operators import order as O
from dataloom.session import fixed


def value_counts(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, value, n) of the values that are not null; partial counts before the shuffle absorb a hot value."""
    return df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("value")).agg(F.count("*").alias("n"))


def percentiles(df: DataFrame, keys: Sequence[str], col: str, wanted: dict[str, float], interpolate: bool = True) -> DataFrame:
    """One row per key with a non-null value: keys and a column for each (name, share) of ``wanted``.

    With ``interpolate`` the value at rank share * (n - 1), between the two
    neighbours of that rank; else the least value whose cumulative share reaches ``share``. Null
    values are left out; null keys are a group; NaN is the largest value.
    """
    if not all(0 <= p <= 1 for p in wanted.values()):
        raise ValueError("a percentile is a share between 0 and 1")
    keys = list(keys)
    run = O.running_agg(value_counts(df, keys, col), keys, ["value"], "n", prefix="r_")
    run = fixed(run.select(*keys, "value", (F.col("r_sum") - F.col("n")).alias("before"), F.col("r_sum").alias("upto")), "running-counts")
    total = run.groupBy(*[F.col(k).alias(f"own {k}") for k in keys]).agg(F.max("upto").alias("total"))
    on = [run[k].eqNullSafe(total[f"own {k}"]) for k in keys]
    at = run.join(total, on) if keys else run.withColumn("total", F.lit(total.first()["total"]))

    def place(p: float) -> tuple[Column, Column, Column]:
        if not interpolate:
            rank = F.greatest(F.ceil(F.col("total") * p) - 1, F.lit(0))
            return rank, rank, F.lit(0.0)
        exact = F.lit(float(p)) * (F.col("total") - 1)
        return F.floor(exact), F.ceil(exact), exact - F.floor(exact)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), F.col("value")))

    places = {name: place(p) for name, p in wanted.items()}
    near = None
    for lo, hi, _ in places.values():
        hit = ((F.col("before") <= hi) & (lo < F.col("upto")))
        near = hit if near is None else near | hit
    # of each key only the values next to a wanted rank go on
    parts = [x for name, (lo, hi, share) in places.items()
             for x in (value_at(lo).alias(f"lo {name}"), value_at(hi).alias(f"hi {name}"), F.max(share).alias(f"share {name}"))]
    got = at.where(near).groupBy(*keys).agg(*parts)
    if not interpolate:
        return got.select(*keys, *[F.col(f"lo {name}").alias(name) for name in wanted])
    between = lambda n: F.col(f"lo {n}") + (F.col(f"hi {n}") - F.col(f"lo {n}")) * F.col(f"share {n}")
    return got.select(*keys, *[F.when(F.col(f"lo {n}") == F.col(f"hi {n}"), F.col(f"lo {n}").cast("double")).otherwise(between(n)).alias(n) for n in wanted])


def modes(counts: DataFrame, keys: Sequence[str], out: str = "mode") -> DataFrame:
    """(keys, out): the commonest value of each key, the least of equally common ones, from ``value_counts``.

    One (count, value) pair per key is kept and merged, whatever the number of values.
    """
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("v")))
    return counts.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(out))
