"""Tests and correlations over whole columns, without a sort in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dataloom.learn import matrix as M
from dataloom.operators import order as O
from dataloom.session import fixed, ship_package


def normal_cdf(mean: float = 0.0, sd: float = 1.0) -> Callable[[Column], Column]:
    """The distribution function of a normal law (``erf`` is not among Spark's functions; it runs over the distinct values)."""

    @F.pandas_udf("double")
    def erf(z: pd.Series) -> pd.Series:
        return z.map(math.erf)

    return lambda x: (1 + erf((x - mean) / (sd * math.sqrt(2)))) / 2


def uniform_cdf(low: float, high: float) -> Callable[[Column], Column]:
    return lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))


def kolmogorov_p(statistic: Column, n: Column, terms: int = 100) -> Column:
    """The limiting p-value of a Kolmogorov-Smirnov statistic over ``n`` (two samples: n1 n2 / (n1 + n2)) values."""
    t2 = n * statistic * statistic
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * t2))
    # below this the series needs more terms than are added, and p is 1 to ten digits
    return F.when(t2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _cumulated(df: DataFrame, keys: list[str], counts: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """Per (keys, x): the first two counts and their running sums ``c0``, ``c1`` up to and with x."""
    names = list(counts)
    per = df.groupBy(*keys, "x").agg(*[c.alias(n) for n, c in counts.items()])
    run = O.running_agg(per, keys, ["x"], names[0], prefix="r_", extra_sum=names[-1])
    return run.withColumnRenamed("r_sum", "c0").withColumnRenamed("r_xsum", "c1"), names


def _by(keys: list[str], a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with those of ``b`` of equal (also null) keys; without keys ``b`` is one row."""
    if not keys:
        one = b.first()
        return a.withColumns({c: F.lit(one[c] if one else None) for c in b.columns})
    names = [f"own {k}" for k in keys]
    right = b.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in b.columns if c not in keys])
    on = [a[k].eqNullSafe(right[n]) for k, n in zip(keys, names)]
    return a.join(right, on).drop(*names)


def ks_one_sample(df: DataFrame, col: str, cdf: Callable[[Column], Column], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, statistic, p_value): the largest gap between the values' distribution and ``cdf``.

    At every distinct value both sides of its step are compared. Running counts
    come from range partitions with carried totals, so neither a group nor the
    whole column is sorted in one task. Null and NaN values are left out; without values there is no row.
    """
    keys = list(keys)
    value = F.col(col).cast("double")
    rows = df.select(*keys, value.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    run, _ = _cumulated(rows, keys, {"one": F.count("*")})
    run = fixed(run, "running-counts")
    size = run.groupBy(*keys).agg(F.sum("one").alias("n"))
    at = _by(keys, run, size).withColumn("f", cdf(F.col("x")))
    gap = F.greatest(F.abs(F.col("c0") / F.col("n") - F.col("f")), F.abs(F.col("f") - (F.col("c0") - F.col("one")) / F.col("n")))
    out = at.groupBy(*keys).agg(F.max("n").alias("n"), F.max(gap).alias("statistic")).where("n IS NOT NULL")
    return out.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("n")))


def ks_two_samples(df: DataFrame, col: str, second: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n1, n2, statistic, p_value): the largest gap between the rows where ``second`` is false and where it is true.

    Rows where it is null, and null and NaN values, are left out; a group without one of the samples has no row.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(col).cast("double").alias("x"), second.cast("int").alias("b"))
    rows = rows.where(F.col("x").isNotNull() & ~F.isnan("x") & F.col("b").isNotNull())
    run, _ = _cumulated(rows, keys, {"n1": F.sum(1 - F.col("b")), "n2": F.sum("b")})
    run = fixed(run, "running-counts")
    size = run.groupBy(*keys).agg(F.sum("n1").alias("all1"), F.sum("n2").alias("all2")).where("all1 > 0 AND all2 > 0")
    at = _by(keys, run, size)
    gap = F.max(F.abs(F.col("c0") / F.col("all1") - F.col("c1") / F.col("all2"))).alias("statistic")
    out = at.groupBy(*keys).agg(F.max("all1").alias("n1"), F.max("all2").alias("n2"), gap).where("n1 IS NOT NULL")
    return out.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))))


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each of ``cols`` replaced by its average rank (1-based, ties share the mean of their places) over the whole table.

    Only the distinct values of a column are ranked, over range partitions; the
    ranks come back by a join that is broadcast by Spark where they are few.
    """
    for c in cols:
        per = df.groupBy(F.col(c).alias("x")).agg(F.count("*").alias("n"))
        run = O.running_agg(per, [], ["x"], "n", prefix="r_")
        rank = fixed(run.select("x", (F.col("r_sum") - (F.col("n") - 1) / 2).alias("rank of x")), "ranks")
        df = df.join(rank, df[c] == rank["x"]).drop("x").withColumn(c, F.col("rank of x")).drop("rank of x")
    return df


def correlation(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """(i, j, correlation) of all pairs of ``cols``, by position; ``spearman`` is that of the average ranks.

    Means first, then one matrix of centred products that is added up in each
    task and by (i, j) afterwards, so neither step gathers rows. Rows with a
    null or NaN in any of the columns are left out; a constant column has a
    null correlation with all others and with itself.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"method must be pearson or spearman, not {method}")
    ship_package(df.sparkSession)
    cols = list(cols)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    names = rows.columns
    for c in names:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c))
    if method == "spearman":
        rows = average_ranks(rows, names)
    means = rows.agg(*[F.avg(c) for c in names]).first()
    if means[0] is None:
        return df.sparkSession.createDataFrame([], "i int, j int, correlation double")
    products = fixed(M.gram(rows.select(F.array(*names).alias("x")), "x", list(means)), "products")
    own = products.where("i = j").select(F.col("i").alias("k"), F.col("v").alias("s"))
    both = (products.join(own.select(F.col("k").alias("i"), F.col("s").alias("si")), "i")
            .join(own.select(F.col("k").alias("j"), F.col("s").alias("sj")), "j"))
    return both.select("i", "j", F.when((F.col("si") > 0) & (F.col("sj") > 0), F.col("v") / F.sqrt(F.col("si") * F.col("sj"))).alias("correlation"))
