"""Join operators: equi / outer / replicated / skewed / merge / bloom / range /
as-of / semi-anti / compare.

Everything is a DataFrame join that Catalyst plans. Where a strategy is
forced (broadcast), the small side's size is checked first and the join falls
back to a shuffle join beyond the bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dataloom.session import fixed

# Size below which a side may be shipped to every executor, by the optimizer's
# estimate of its bytes. AQE can still broadcast on its own from runtime sizes.
BROADCAST_MAX_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes of ``df``: an upper bound from file sizes and column widths; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the plan's own statistics put ``df`` at no more than ``max_bytes``."""
    return plan_bytes(df) <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when it fits, else ``df`` unchanged (the join shuffles, or AQE finds it small)."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def _cond(left: DataFrame, right: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in zip(lkeys, rkeys)])


def join(
    left: DataFrame,
    right: DataFrame,
    lkeys: Sequence[str],
    rkeys: Sequence[str] | None = None,
    how: str = "inner",
    strategy: str = "hash",
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """JOIN a BY lkeys, b BY rkeys [LEFT|RIGHT|FULL] USING strategy.

    Null keys never match (plain ``==``). strategy: ``hash`` (planner's
    choice), ``replicated`` (broadcast the right side if it fits, else shuffle),
    ``merge`` (sort-merge hint), ``skewed`` (AQE skew split plus salting of
    hot keys, see :func:`salted_join`), ``bloom`` (see :func:`bloom_join`).
    """
    rkeys = list(rkeys or lkeys)
    if strategy == "replicated":
        if how not in ("inner", "left", "left_outer"):
            raise ValueError("replicated join supports inner and left outer")
        right = checked_broadcast(right, max_broadcast_bytes)
    elif strategy == "merge":
        right = right.hint("merge")
    elif strategy == "skewed":
        return salted_join(left, right, list(lkeys), rkeys, how=how)
    elif strategy == "bloom":
        return bloom_join(left, right, list(lkeys), rkeys, how=how)
    elif strategy != "hash":
        raise ValueError(f"unknown strategy {strategy}")
    return left.join(right, _cond(left, right, lkeys, rkeys), how)


def join_many(dfs: Sequence[DataFrame], keys: Sequence[Sequence[str]], how: str = "inner") -> DataFrame:
    """n-way equi join: a BY k1, b BY k2, c BY k3 ... chained left to right."""
    out = dfs[0]
    for df, k in zip(dfs[1:], keys[1:]):
        out = out.join(df, _cond(out, df, keys[0], k), how)
    return out


def salted_join(
    big: DataFrame,
    other: DataFrame,
    lkeys: list[str],
    rkeys: list[str],
    how: str = "inner",
    salts: int = 16,
    hot_fraction: float = 0.001,
) -> DataFrame:
    """Skewed join: hot keys of ``big`` are spread over ``salts`` tasks.

    Hot keys are found by exact counting (one aggregate, partial on the map
    side), not by sampling; at most ``1 / hot_fraction`` keys can be hot, so
    their list is small. Rows of hot keys are salted by a hash of the row, which
    a retried task reproduces; the other side's matching rows are replicated
    ``salts`` times for hot keys only. Null keys match nothing and are spread
    over the salts too. In right and full joins the rows of ``other`` without a
    match are found by an anti join on the plain key, so a replicated row is
    never counted as unmatched.
    """
    how = {"leftouter": "left", "rightouter": "right", "outer": "full", "fullouter": "full", "semi": "left_semi", "leftsemi": "left_semi",
           "anti": "left_anti", "leftanti": "left_anti"}.get(how.replace("_", ""), how)
    if how in ("right", "full"):
        kept = salted_join(big, other, lkeys, rkeys, "left" if how == "full" else "inner", salts, hot_fraction)
        alone = other.join(big.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(lkeys)]),
                           reduce(lambda a, b: a & b, [other[r] == F.col(f"__b{i}") for i, r in enumerate(rkeys)]), "left_anti")
        names = [F.lit(None).cast(f.dataType).alias(f.name) for f in big.schema.fields] + [alone[c] for c in alone.columns]
        return kept.union(alone.select(*names))
    counts = fixed(big.groupBy(*lkeys).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where(F.col("count") >= max(1, int(total * hot_fraction))).select(*lkeys, F.lit(True).alias("__hot"))
    hot = F.broadcast(hot)  # at most 1 / hot_fraction rows
    rhot = hot.select(*[F.col(lk).alias(rk) for lk, rk in zip(lkeys, rkeys)], "__hot")
    hashable = [f.name for f in big.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(salts))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in lkeys])
    b = big.join(hot, lkeys, "left").withColumn("__salt", F.when(F.col("__hot") | no_key, salt).otherwise(F.lit(0))).drop("__hot")
    b = b.select(*big.columns, "__salt")
    o = (
        other.join(rhot, rkeys, "left")
        .withColumn(
            "__salt",
            F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
        )
        .drop("__hot")
    ).select(*other.columns, "__salt")
    cond = _cond(b, o, lkeys, rkeys) & (b["__salt"] == o["__salt"])
    out = b.join(o, cond, how)
    return out.drop("__salt") if how in ("left_semi", "left_anti") else out.drop(b["__salt"]).drop(o["__salt"])


def bloom_join(
    left: DataFrame,
    right: DataFrame,
    lkeys: list[str],
    rkeys: list[str],
    how: str = "inner",
    bits: int | None = None,
) -> DataFrame:
    """Bloom-style join: a bitmap of hashed right keys filters ``left`` before
    the shuffle; the exact join follows, so no false positive survives.

    The bitmap is built with ``bitmap_construct_agg`` over hash buckets, an
    aggregate of ``bits`` / 8 bytes that merges partially on the map side. By
    default it has about 16 bits per right row, from 2^20 up to 2^27 bits
    (16 MB); more right rows than it can tell apart (2^26) are joined unfiltered.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("bloom join filters the probe side: inner or left_semi")
    if bits is None:
        n = right.select(*rkeys).count()
        if n > 1 << 26:
            return left.join(right, _cond(left, right, lkeys, rkeys), how)
        bits = min(1 << 27, max(1 << 20, 1 << (16 * max(1, n) - 1).bit_length()))
    lh = F.pmod(F.xxhash64(*[F.col(k) for k in lkeys]), F.lit(bits))
    rh = F.pmod(F.xxhash64(*[F.col(k) for k in rkeys]), F.lit(bits))
    # bitmap functions work on 32768-bit chunks: bucket id + bit position
    rbits = (
        right.select(rh.alias("__h"))
        .select(F.expr("bitmap_bucket_number(__h + 1)").alias("__b"), F.expr("bitmap_bit_position(__h + 1)").alias("__p"))
        .groupBy("__b").agg(F.expr("bitmap_construct_agg(__p)").alias("__bm"))
    )
    probe = (
        left.withColumn("__h", lh)
        .withColumn("__b", F.expr("bitmap_bucket_number(__h + 1)"))
        .withColumn("__p", F.expr("bitmap_bit_position(__h + 1)"))
    )
    # at most bits / 32768 bitmap rows of 4 KB each: a proven broadcast bound.
    # Bit test: the byte holding bit __p, shifted.
    filtered = probe.join(F.broadcast(rbits), "__b", "inner").filter(
        F.expr("(shiftright(cast(conv(hex(substring(__bm, cast(floor(__p / 8) as int) + 1, 1)), 16, 10) as int), cast(__p % 8 as int)) & 1) = 1")
    ).drop("__h", "__b", "__p", "__bm")
    return filtered.join(right, _cond(filtered, right, lkeys, rkeys), how)


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point_col: str,
    lo_col: str,
    hi_col: str,
    bucket: float,
    how: str = "inner",
    task_pairs: int = 1 << 26,
) -> DataFrame:
    """Join rows whose ``point_col`` lies in ``[lo_col, hi_col)`` of a range.

    Ranges are exploded over the fixed-width buckets they touch, points get
    their one bucket, the equi join runs on the bucket and the exact interval
    test is a residual filter. Work per range grows with its width / bucket,
    not with the other side: no nested-loop join.

    Both sides may be small and their pairs many, so tasks follow the pairs: the
    candidates of every bucket are counted first (points x ranges), there are up
    to 16 tasks for each ``task_pairs`` of them, and a bucket of more is cut into a grid of
    as many pieces: each side is dealt over one edge and copied along the other. The
    grid is as long as it takes for both sides to have about as many copies, so their
    number grows with the root of the pairs; in a left join, points are not copied.
    """
    r = ranges.withColumn(
        "__bk",
        F.explode(
            F.sequence(
                F.floor(F.col(lo_col) / F.lit(bucket)).cast("long"),
                F.floor(F.col(hi_col) / F.lit(bucket)).cast("long"),
            )
        ),
    )
    p = points.withColumn("__bk", F.floor(F.col(point_col) / F.lit(bucket)).cast("long"))
    if how not in ("inner", "left", "left_outer", "leftouter"):  # copied ranges would count more than once as unmatched
        cond = (p["__bk"] == r["__bk"]) & (p[point_col] >= r[lo_col]) & (p[point_col] < r[hi_col])
        return p.join(r, cond, how).drop(p["__bk"]).drop(r["__bk"])
    sizes = p.groupBy("__bk").agg(F.count("*").alias("__np")).join(r.groupBy("__bk").agg(F.count("*").alias("__nr")), "__bk")
    sizes = sizes.withColumn("__pairs", F.col("__np").cast("double") * F.col("__nr"))
    k = F.ceil(F.col("__pairs") / task_pairs)
    # pieces along the points: k x np : nr of them, squared, would make the copies of both sides equal
    along = F.round(F.sqrt(k * F.col("__np") / F.col("__nr"))) if how == "inner" else k
    sizes = sizes.withColumn("__kp", F.greatest(F.lit(1), F.least(along, k, F.col("__np"))).cast("int"))
    sizes = sizes.withColumn("__kr", F.least(F.ceil(k / F.col("__kp")), F.col("__nr")).cast("int") if how == "inner" else F.lit(1))
    sizes = fixed(sizes.select("__bk", "__pairs", "__kp", "__kr"), "range-buckets")
    pairs, pieces = sizes.agg(F.sum("__pairs"), F.sum(F.col("__kp").cast("long") * F.col("__kr"))).first()
    n = max(1, min(math.ceil(16 * (pairs or 0) / task_pairs), 4 * (pieces or 0)))
    cut = sizes.where("__kp * __kr > 1").select("__bk", "__kp", "__kr")

    def dealt(df: DataFrame, columns: list[str], own: str, other: str) -> DataFrame:
        edge = lambda c: F.coalesce(F.col(c), F.lit(1))
        df = df.withColumn("__u", F.rand(0)).join(cut, "__bk", "left").withColumn("__own", F.floor(F.col("__u") * edge(own)).cast("int"))
        df = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), edge(other) - 1)))
        piece = F.col("__own") * edge(other) + F.col("__copy") if own == "__kp" else F.col("__copy") * edge(own) + F.col("__own")
        return df.select(*columns, "__bk", piece.alias("__piece")).repartition(n, "__bk", "__piece")

    p, r = dealt(p, points.columns, "__kp", "__kr"), dealt(r, ranges.columns, "__kr", "__kp")
    cond = (p["__bk"] == r["__bk"]) & (p["__piece"] == r["__piece"]) & (p[point_col] >= r[lo_col]) & (p[point_col] < r[hi_col])
    out = p.join(r, cond, how)
    return out.drop(p["__bk"]).drop(r["__bk"]).drop(p["__piece"]).drop(r["__piece"])


def _num(c: Column, dtype) -> Column:
    """Ordering value of the ``on`` column as a number (microseconds for times)."""
    from pyspark.sql import types as T

    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double") / 1e6
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double") * 86400.0
    return c.cast("double")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    tolerance: float | None = None,
    allow_exact_matches: bool = True,
    direction: str = "backward",
    right_prefix: str = "",
) -> DataFrame:
    """merge_asof: each left row gets the nearest right row by ``on`` within ``by``.

    Both sides are unioned and the last (backward) or next (forward) right row
    is carried along the ``on`` order with ``last/first(..., ignorenulls)``: one
    shuffle, no pair blow-up. ``tolerance`` (in seconds for time columns) is a
    post-filter AND the partitioning unit: with it, window partitions are
    (by, bucket of width tolerance) and each right row is copied into the
    neighbouring bucket, so a hot ``by`` key is split over many tasks while the
    answer stays exact. ``nearest`` takes the closer of the two directions.
    """
    if direction == "nearest":
        rcols = [c for c in right.columns if c not in set(by) | {on}]
        # the left rows are matched 1:1 in both results: a row id, fixed once by
        # a reliable checkpoint so both directions see the same ids
        from dataloom.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(left.sparkSession)
        base = left.withColumn("__lid", F.monotonically_increasing_id()).checkpoint(eager=True)
        b = asof_join(base, right, on, by, tolerance, allow_exact_matches, "backward", "__b_")
        f = asof_join(base, right, on, by, tolerance, allow_exact_matches, "forward", "__f_")
        j = b.join(f.select("__lid", *[f"__f_{c}" for c in rcols], "__f___on"), "__lid")
        db = F.abs(_num(F.col(on), left.schema[on].dataType) - F.col("__b___on"))
        dfw = F.abs(F.col("__f___on") - _num(F.col(on), left.schema[on].dataType))
        take_f = F.col("__b___on").isNull() | (F.col("__f___on").isNotNull() & (dfw < db))
        return j.select(
            *left.columns,
            *[F.when(take_f, F.col(f"__f_{c}")).otherwise(F.col(f"__b_{c}")).alias(f"{right_prefix}{c}") for c in rcols],
        )
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    backward = direction == "backward"
    by = list(by)
    rcols = [c for c in right.columns if c not in set(by) | {on}]
    ltype = left.schema[on].dataType
    lnum = _num(F.col(on), ltype)
    rnum = _num(F.col(on), right.schema[on].dataType)
    part = list(by)
    L = left.select(*[F.col(c) for c in left.columns], lnum.alias("__t"), F.lit(1).alias("__side"),
                    F.lit(None).cast("struct<x:int>").alias("__rec_placeholder"))
    L = L.drop("__rec_placeholder")
    rec = F.struct(*[F.col(c).alias(f"__r_{c}") for c in rcols], rnum.alias("__r_on"))
    R = right.select(*[F.col(b_) for b_ in by], rnum.alias("__t"), rec.alias("__rec"), F.lit(0).alias("__side"))
    if tolerance is not None:
        width = float(tolerance)
        L = L.withColumn("__bk", F.floor(F.col("__t") / width))
        # a right row can serve left rows of its own bucket and of the next
        # (backward) or previous (forward) bucket
        shift = 1 if backward else -1
        R = R.withColumn("__bk", F.explode(F.array(F.floor(F.col("__t") / width), F.floor(F.col("__t") / width) + shift)))
        part = part + ["__bk"]
    lcols_all = L.columns
    # null keys match nothing: such left rows stay out of the windows
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*by, on]])
    unmatched = L.filter(~known)
    L, R = L.filter(known), R.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*by, "__t"]]))
    u = L.withColumn("__rec", F.lit(None).cast(R.schema["__rec"].dataType)).unionByName(R, allowMissingColumns=True)
    # right rows of one key and time go by their own columns, so the record taken does not depend on where rows lie
    u = u.withColumn("__tie", F.to_json("__rec"))
    # exact matches: right rows sort before (backward) / after (forward) left rows
    # of the same ``on`` value when allowed
    side_first = allow_exact_matches == backward
    side_order = F.col("__side").asc() if side_first else F.col("__side").desc()
    from dataloom.operators import seqwin as SW

    if tolerance is None:
        # unbounded look-back: the match is a forward (backward) fill of the
        # right record over the merged sequence, done by positions and joins, so
        # no key needs a window task of its own
        u2 = u.withColumn("__sord", F.col("__side") if side_first else -F.col("__side"))
        filled = SW.fill_directional(u2, ["__rec"], ["__t", "__sord", "__tie"], part, forward=backward)
        out = filled.withColumnRenamed("__rec", "__m").drop("__sord").filter(F.col("__side") == 1)
    else:
        if backward:
            w = Window.partitionBy(*part).orderBy(F.col("__t").asc(), side_order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
            m = F.last("__rec", ignorenulls=True).over(w)
        else:
            w = Window.partitionBy(*part).orderBy(F.col("__t").asc(), side_order, "__tie").rowsBetween(0, Window.unboundedFollowing)
            m = F.first("__rec", ignorenulls=True).over(w)
        out = u.withColumn("__m", m).filter(F.col("__side") == 1)
    if not allow_exact_matches:
        out = out.withColumn("__m", F.when(F.col("__m.__r_on") == F.col("__t"), F.lit(None)).otherwise(F.col("__m")))
    if tolerance is not None:
        out = out.withColumn("__m", F.when(F.abs(F.col("__t") - F.col("__m.__r_on")) <= F.lit(float(tolerance)), F.col("__m")))
    keep = [c for c in lcols_all if not c.startswith("__") or c == "__lid"]
    out = out.select(*keep, "__t", "__m").unionByName(unmatched.select(*keep, "__t", F.lit(None).cast(out.schema["__m"].dataType).alias("__m")))
    extra = [F.col("__m.__r_on").alias(f"{right_prefix}__on")] if right_prefix.startswith("__") else []
    return out.select(*keep, *[F.col(f"__m.__r_{c}").alias(f"{right_prefix}{c}") for c in rcols], *extra)


def semi(left: DataFrame, right: DataFrame, lkeys, rkeys=None) -> DataFrame:
    """Rows of ``left`` with at least one match (EXISTS)."""
    return left.join(right, _cond(left, right, lkeys, rkeys or lkeys), "left_semi")


def anti(left: DataFrame, right: DataFrame, lkeys, rkeys=None) -> DataFrame:
    """Rows of ``left`` without a match (NOT EXISTS); a null key never matches."""
    return left.join(right, _cond(left, right, lkeys, rkeys or lkeys), "left_anti")


def compare_frames(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Align two frames on ``keys`` (full outer) and report per-column changes.

    Output: keys, ``status`` (left_only / right_only / changed / same) and one
    ``<col>_self`` / ``<col>_other`` pair for each differing value column.
    """
    vals = [c for c in a.columns if c not in keys and c in b.columns]
    la = a.select(*keys, *[F.col(c).alias(f"{c}_self") for c in vals], F.lit(True).alias("__l"))
    rb = b.select(*keys, *[F.col(c).alias(f"{c}_other") for c in vals], F.lit(True).alias("__r"))
    j = la.join(rb, list(keys), "full")
    diff = reduce(lambda x, y: x | y, [~F.col(f"{c}_self").eqNullSafe(F.col(f"{c}_other")) for c in vals], F.lit(False))
    status = (
        F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only")
        .when(diff, "changed").otherwise("same")
    )
    return j.withColumn("status", status).drop("__l", "__r")
