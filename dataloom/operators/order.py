"""ORDER / RANK / LIMIT / row ids without single-partition windows.

A global rank or row index over the whole input is computed the way a
distributed sort does it: range-partition, count each partition, turn the
counts into offsets (one small row per partition, broadcast: bounded by the
partition count, not the data), then add the offset to a rank local to each
partition. No ``Window.orderBy`` without a partition key on large input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dataloom.session import ensure_checkpoint_dir


def _materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a range-partitioned frame that two branches read.

    Range bounds are sampled from the input; when the input's row order is not
    deterministic (it comes from a shuffle), two evaluations could place rows
    in different ranges. One checkpoint into the shared folder fixes the
    assignment for both branches and for task retries.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _offsets(counts: DataFrame, pid: str, n: str) -> DataFrame:
    """Exclusive prefix sums of per-partition counts (a tiny table)."""
    w = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__off", F.coalesce(F.sum(n).over(w), F.lit(0)))


def row_index(df: DataFrame, out: str = "row_index", start: int = 0) -> DataFrame:
    """Consecutive index in the current partition order (``zipWithIndex``).

    Uses ``monotonically_increasing_id`` (partition id in the upper bits) and
    per-partition offsets; the partition-count table is broadcast. The ids are
    checkpointed once, so both branches and a retried task see the same order.
    """
    tagged = _materialize(df.withColumn("__mid", F.monotonically_increasing_id())).withColumn("__pid", F.shiftright(F.col("__mid"), 33))
    counts = tagged.groupBy("__pid").agg(F.count("*").alias("__n"), F.min("__mid").alias("__first"))
    offs = F.broadcast(_offsets(counts, "__pid", "__n"))
    return (
        tagged.join(offs, "__pid")
        .withColumn(out, F.col("__off") + (F.col("__mid") - F.col("__first")) + F.lit(start))
        .drop("__mid", "__pid", "__n", "__first", "__off")
    )


def global_rank(
    df: DataFrame,
    order: Sequence[str],
    ascending: Sequence[bool] | None = None,
    dense: bool = False,
    out: str = "rank",
    partitions: int | None = None,
    dense_out: str | None = None,
) -> DataFrame:
    """RANK rel BY cols [DENSE]: standard rank (gaps) or dense rank, no gaps;
    with ``dense_out`` both in one pass.

    The distinct sort keys are counted first (partial aggregation absorbs a hot
    key), those key rows are range-partitioned, ranked inside each range and
    shifted by broadcast per-range offsets; the rank is joined back on the key.
    """
    order = list(order)
    asc = list(ascending) if ascending is not None else [True] * len(order)
    keys = df.groupBy(*order).agg(F.count("*").alias("__cnt"))
    sort_cols = [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in zip(order, asc)]
    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _materialize(keys.repartitionByRange(nparts, *sort_cols).withColumn("__pid", F.spark_partition_id()))
    w_local = Window.partitionBy("__pid").orderBy(*sort_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({"__b": F.coalesce(F.sum("__cnt").over(w_local), F.lit(0)),
                                "__db": F.coalesce(F.count(F.lit(1)).over(w_local), F.lit(0))})
    totals = ranged.groupBy("__pid").agg(F.sum("__cnt").alias("__n"), F.count(F.lit(1)).alias("__dn"))
    wo = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = F.broadcast(totals.select("__pid", F.coalesce(F.sum("__n").over(wo), F.lit(0)).alias("__off"),
                                     F.coalesce(F.sum("__dn").over(wo), F.lit(0)).alias("__doff")))
    rank = F.col("__off") + F.col("__b") + 1
    drank = F.col("__doff") + F.col("__db") + 1
    outs = [(drank if dense else rank).alias(out)] + ([drank.alias(dense_out)] if dense_out else [])
    ranked = local.join(offs, "__pid").select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *outs)
    cond = None
    for i, c in enumerate(order):
        e = F.col(c).eqNullSafe(F.col(f"__o{i}"))
        cond = e if cond is None else cond & e
    return df.join(ranked, cond).select(*df.columns, out, *([dense_out] if dense_out else []))


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out_prefix: str = "rank_",
    partitions: int | None = None,
) -> DataFrame:
    """pandas-style ranks inside each group, all methods in one distributed pass.

    Adds ``<prefix>min`` (SQL rank), ``<prefix>max`` (last position of the tie),
    ``<prefix>average`` and ``<prefix>dense``. Works on the distinct
    (keys, order) table with its peer counts: global rank and dense rank by
    range partitions + broadcast offsets, minus each group's first rank. No
    group's rows ever meet in one task; one join brings the ranks back.
    """
    keys, order = list(keys), list(order)
    allc = keys + order
    kt = df.groupBy(*allc).agg(F.count("*").alias("__peers"))
    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c).asc_nulls_first() for c in allc]
    ranged = _materialize(kt.repartitionByRange(nparts, *sort_cols).withColumn("__pid", F.spark_partition_id()))
    w_local = Window.partitionBy("__pid").orderBy(*sort_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__b", F.coalesce(F.sum("__peers").over(w_local), F.lit(0))).withColumn(
        "__db", F.coalesce(F.count(F.lit(1)).over(w_local), F.lit(0)))
    totals = ranged.groupBy("__pid").agg(F.sum("__peers").alias("__n"), F.count(F.lit(1)).alias("__dn"))
    wo = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = F.broadcast(totals.select("__pid", F.coalesce(F.sum("__n").over(wo), F.lit(0)).alias("__off"),
                                     F.coalesce(F.sum("__dn").over(wo), F.lit(0)).alias("__doff")))
    g = local.join(offs, "__pid").select(
        *allc, "__peers", (F.col("__off") + F.col("__b") + 1).alias("__r"), (F.col("__doff") + F.col("__db") + 1).alias("__d"))
    starts = g.groupBy(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)]).agg(
        F.min("__r").alias("__r0"), F.min("__d").alias("__d0"))
    cond = None
    for i, k in enumerate(keys):
        e = F.col(k).eqNullSafe(F.col(f"__s{i}"))
        cond = e if cond is None else cond & e
    mn = F.col("__r") - F.col("__r0") + 1
    mx = mn + F.col("__peers") - 1
    ranks = g.join(starts, cond).select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(allc)], mn.alias(f"{out_prefix}min"), mx.alias(f"{out_prefix}max"),
        ((mn + mx) / 2.0).alias(f"{out_prefix}average"), (F.col("__d") - F.col("__d0") + 1).alias(f"{out_prefix}dense"))
    jc = None
    for i, c in enumerate(allc):
        e = F.col(c).eqNullSafe(F.col(f"__k{i}"))
        jc = e if jc is None else jc & e
    return df.join(ranks, jc).drop(*[f"__k{i}" for i in range(len(allc))])


def running_agg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    prefix: str = "run_",
    partitions: int | None = None,
    extra_sum: str | None = None,
) -> DataFrame:
    """Expanding sum / count / min / max / mean of ``value`` per key in order
    (plus ``<prefix>xsum``, the running sum of ``extra_sum``, in the same pass),
    without a per-key task.

    Rows are range-partitioned on (keys, order), so one key's rows may span
    many partitions. Inside a partition a window runs over (partition, key);
    each (partition, key) total is a small row, and a window over those totals
    (at most one row per partition for any key) gives the carry-in from
    earlier partitions. Ties in ``order`` get an arbitrary but consistent
    sequence, as with a ROWS frame.
    """
    keys, order = list(keys), list(order)
    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c).asc_nulls_first() for c in keys + order]
    v = F.col(value)
    r = _materialize(df.repartitionByRange(nparts, *sort_cols).withColumn("__pid", F.spark_partition_id()))
    w = Window.partitionBy("__pid", *keys).orderBy(*sort_cols).rowsBetween(Window.unboundedPreceding, 0)
    xv = F.col(extra_sum) if extra_sum else F.lit(0.0)
    local = r.withColumns({"__s": F.sum(v).over(w), "__c": F.count(v).over(w), "__mn": F.min(v).over(w), "__mx": F.max(v).over(w),
                           "__xs": F.sum(xv).over(w)})
    tot = r.groupBy("__pid", *keys).agg(F.sum(v).alias("__ts"), F.count(v).alias("__tc"), F.min(v).alias("__tmn"), F.max(v).alias("__tmx"),
                                       F.sum(xv).alias("__txs"))
    wp = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(
        F.col("__pid").alias("__cp"), *[F.col(k).alias(f"__ck{i}") for i, k in enumerate(keys)],
        F.sum("__ts").over(wp).alias("__os"), F.sum("__tc").over(wp).alias("__oc"),
        F.min("__tmn").over(wp).alias("__omn"), F.max("__tmx").over(wp).alias("__omx"), F.sum("__txs").over(wp).alias("__oxs"))
    cond = F.col("__pid") == F.col("__cp")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__ck{i}"))
    j = local.join(carry, cond)
    s = F.coalesce(F.col("__os"), F.lit(0)) + F.col("__s")
    c = F.coalesce(F.col("__oc"), F.lit(0)) + F.col("__c")
    return j.select(
        *df.columns, s.alias(f"{prefix}sum"), c.alias(f"{prefix}count"),
        F.least(F.coalesce("__omn", "__mn"), F.col("__mn")).alias(f"{prefix}min"),
        F.greatest(F.coalesce("__omx", "__mx"), F.col("__mx")).alias(f"{prefix}max"),
        (s / c).alias(f"{prefix}mean"), (F.coalesce(F.col("__oxs"), F.lit(0)) + F.col("__xs")).alias(f"{prefix}xsum"))


def sort_total(df: DataFrame, *cols: Column) -> DataFrame:
    """ORDER BY: Spark samples the key range and range-partitions (total order)."""
    return df.orderBy(*cols)


def top_k(df: DataFrame, k: int, *cols: Column) -> DataFrame:
    """ORDER + LIMIT planned as TakeOrderedAndProject (per-task top-k heaps)."""
    return df.orderBy(*cols).limit(k)
