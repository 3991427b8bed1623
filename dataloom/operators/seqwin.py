"""ROWS-frame window functions without a per-key task.

``Window.partitionBy(key)`` sends all rows of a key to one task; a key with a
third of the data makes that task a third of the job. :func:`over` cuts the rows into
ranges of (key, order) instead, so a key's rows may span many tasks:

1. each range is given the few rows that stand before and behind it (as many
   as the frames reach), and Spark's own window functions run inside the ranges;
2. running aggregates and positions start from what the earlier ranges hold of
   the key: only the first and the last key of a range can go on in another,
   so the totals carried are at most two small rows a range.

:func:`with_position` and :func:`frame` give positions and frames as an aggregation by
(key, position), for frames whose members are fetched by joins (fills, sessions).
Ties in the order columns get an arbitrary but consistent sequence, as
in a ROWS frame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dataloom.operators.order import _materialize, running_agg
from dataloom.session import fixed

#: how the running value of a range goes on from that of the ranges before it
_JOINED = {"sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b), "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
           "min": lambda a, b: F.least(a, b), "max": lambda a, b: F.greatest(a, b)}
_AGGREGATE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def over(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    made: Callable[[WindowSpec], dict[str, Column]] | None = None,
    before: int = 0,
    behind: int = 0,
    running: Mapping[str, tuple[str, str]] | None = None,
    whole: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The rows of ``df`` with window columns per ``keys`` in ``order`` (ascending, nulls first), no key in one task.

    ``made(w)`` gives columns over the window ``w``; they may reach ``before``
    rows back and ``behind`` rows on (``w.rowsBetween(-before, behind)``, lag, lead).
    ``running`` maps a name to (sum | count | min | max, column): the aggregate
    from the key's first row to this one; ``whole`` the same over all the key's rows.
    A count of "*" gives positions and sizes. Null keys are a group. An empty table gives no rows.
    """
    keys, order = list(keys), list(order)
    running, whole = dict(running or {}), dict(whole or {})
    up = [F.col(c).asc_nulls_first() for c in keys + order]
    down = [F.col(c).desc_nulls_last() for c in keys + order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _materialize(df.repartitionByRange(n, *up).withColumn("__pid", F.spark_partition_id()))
    ranges = Window.partitionBy("__pid")

    def ends(sort: list[Column], k: int) -> DataFrame:
        """The first rows of every range in this order; a task sends no more than ``k``."""
        return fixed(rows.withColumn("__k", F.row_number().over(ranges.orderBy(*sort))).where(F.col("__k") <= k), "range-ends")

    def lent(side: DataFrame, k: int, backwards: bool) -> DataFrame:
        """The ``k`` rows next to each range, from the ranges beside it (from further ones, where these are short)."""
        held = {r["__pid"]: r["n"] for r in side.groupBy("__pid").agg(F.count("*").alias("n")).collect()}  # a number a range
        pids = sorted(held, reverse=backwards)
        wanted = []
        for i, p in enumerate(pids):
            need, j = k, i + 1
            while need > 0 and j < len(pids):
                take = min(need, held[pids[j]])
                wanted += [(p, pids[j], x) for x in range(1, take + 1)]
                need, j = need - take, j + 1
        which = F.broadcast(df.sparkSession.createDataFrame(wanted, "__to int, __of int, __at int"))  # at most k rows a range
        return side.join(which, (F.col("__pid") == F.col("__of")) & (F.col("__k") == F.col("__at"))).select(*df.columns, F.col("__to").alias("__pid"))

    last, first = ends(down, max(before, 1)), ends(up, max(behind, 1))
    out = rows.withColumn("__lent", F.lit(False))
    for side, k, backwards in ((last, before, True), (first, behind, False)):
        if k:
            out = out.unionByName(lent(side, k, backwards).withColumn("__lent", F.lit(True)))
    w = Window.partitionBy("__pid", *keys).orderBy(*up)
    value = lambda c: F.when(~F.col("__lent"), F.lit(1) if c == "*" else F.col(c))
    columns = {f"__run_{name}": _AGGREGATE[kind](value(c)).over(w.rowsBetween(Window.unboundedPreceding, 0)) for name, (kind, c) in running.items()}
    columns |= {f"__all_{name}": _AGGREGATE[kind](value(c)).over(Window.partitionBy("__pid", *keys)) for name, (kind, c) in whole.items()}
    made_columns = made(w) if made else {}
    out = out.withColumns(made_columns | columns).where(~F.col("__lent"))
    if running or whole:
        named = [f"__key{i}" for i in range(len(keys))]
        edge = first.where("__k = 1").unionByName(last.where("__k = 1")).select(F.col("__pid").alias("__p"), *[F.col(k).alias(c) for k, c in zip(keys, named)])
        edge = F.broadcast(edge.distinct())  # at most two rows a range
        same = F.col("__pid") == F.col("__p")
        for k, c in zip(keys, named):
            same = same & F.col(k).eqNullSafe(F.col(c))
        both = {**{f"r{i}": x for i, x in enumerate(running.values())}, **{f"w{i}": x for i, x in enumerate(whole.values())}}
        total = rows.join(edge, same).groupBy("__p", *named).agg(*[
            _AGGREGATE[kind](F.lit(1) if c == "*" else F.col(c)).alias(x) for x, (kind, c) in both.items()])
        earlier = Window.partitionBy(*named).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
        carried = fixed(total.select("__p", *named, *[
            (_AGGREGATE["sum" if kind == "count" else kind](x).over(earlier if x[0] == "r" else Window.partitionBy(*named))).alias(f"__c{x}")
            for x, (kind, _) in both.items()]), "carried")
        out = out.join(F.broadcast(carried), same, "left")
        for i, (name, (kind, _)) in enumerate(running.items()):
            out = out.withColumn(f"__run_{name}", _JOINED[kind](F.col(f"__cr{i}"), F.col(f"__run_{name}")))
        for i, name in enumerate(whole):
            # of a key that goes on in other ranges the carried value is that of all of them
            out = out.withColumn(f"__all_{name}", F.coalesce(f"__cw{i}", f"__all_{name}"))
    return out.select(*df.columns, *made_columns, *[F.col(f"__run_{x}").alias(x) for x in running], *[F.col(f"__all_{x}").alias(x) for x in whole])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], running_sum: str | None = None,
                  running_name: str = "running") -> DataFrame:
    """Add ``__i`` (1-based position within the key in order) and ``__n`` (key
    size); optionally the running sum of ``running_sum`` from the same pass."""
    keys = list(keys)
    one = df.withColumn("__one", F.lit(1))
    r = running_agg(one, keys, order, "__one", prefix="__p_", extra_sum=running_sum)
    extra = [F.col("__p_xsum").alias(running_name)] if running_sum else []
    r = r.select(*df.columns, *extra, F.col("__p_count").alias("__i"))
    sizes = r.groupBy(*[F.col(k).alias(f"__sk{i}") for i, k in enumerate(keys)]).agg(F.max("__i").alias("__n"))
    cond = None
    for i, k in enumerate(keys):
        e = F.col(k).eqNullSafe(F.col(f"__sk{i}"))
        cond = e if cond is None else cond & e
    return r.join(sizes, cond).drop(*[f"__sk{i}" for i in range(len(keys))])


def frame(
    pos: DataFrame,
    keys: Sequence[str],
    lo: int,
    hi: int,
    aggs: dict[str, callable],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregate each row's ROWS frame [i + lo, i + hi] (bounded) within its key.

    ``pos`` comes from :func:`with_position`. ``aggs`` maps an output name to a
    function ``f(x) -> Column`` where ``x(col)`` is the column value of a frame
    member (null for non-members) and ``x.j`` the member's position; the
    function must be an aggregate over the frame members. The original row's
    columns are kept. ``values`` names the columns the aggregates read: only
    those travel with the frame copies; the full row travels once.
    """
    if lo > hi:
        raise ValueError("empty frame")
    keys = list(keys)
    cols = [c for c in pos.columns if c not in ("__i", "__n")]
    # targets of row j: positions i with i + lo <= j <= i + hi, i.e. i in [j - hi, j - lo]; plus itself
    offs = sorted(set(range(-hi, -lo + 1)) | {0})
    vals = list(values) if values is not None else cols
    emitted = pos.select(
        *keys, "__i", "__n", F.struct(*[F.col(c) for c in cols]).alias("__full"), F.struct(*[F.col(c) for c in vals]).alias("__v"),
        F.explode(F.array(*[F.lit(o) for o in offs])).alias("__o"))
    emitted = emitted.select(*keys, "__n", F.when(F.col("__o") == 0, F.col("__full")).alias("__row"), "__v",
                             F.col("__i").alias("__j"), (F.col("__i") + F.col("__o")).alias("__t"))
    emitted = emitted.filter((F.col("__t") >= 1) & (F.col("__t") <= F.col("__n")))
    member = (F.col("__j") >= F.col("__t") + lo) & (F.col("__j") <= F.col("__t") + hi)

    class _X:
        j = F.when(member, F.col("__j"))

        def __call__(self, c: str) -> Column:
            return F.when(member, F.col(f"__v.{c}"))

    x = _X()
    self_row = F.first(F.when(F.col("__j") == F.col("__t"), F.col("__row")), ignorenulls=True).alias("__self")
    g = emitted.groupBy(*keys, "__t").agg(self_row, *[f(x).alias(name) for name, f in aggs.items()])
    return g.select(*[F.col(f"__self.{c}").alias(c) for c in cols], *aggs.keys())


def shift_value(k: int, col: str, default=None):
    """Aggregate for ``frame``: value of the row k positions later (k < 0:
    earlier); ``default`` when that position is outside the key."""

    def f(x):
        hit = F.first(F.when(x.j == F.col("__t") + k, F.struct(x(col).alias("v"))), ignorenulls=True)
        return F.when(hit.isNull(), F.lit(default)).otherwise(hit["v"])

    return f


def first_in_frame(col: str):
    return lambda x: F.min_by(x(col), x.j)


def last_in_frame(col: str):
    return lambda x: F.max_by(x(col), x.j)


def nth_in_frame(n: int, col: str):
    """n-th member by position; members are at most the frame width, so the
    sorted member list is bounded."""
    return lambda x: F.try_element_at(
        F.array_sort(F.collect_list(F.when(x.j.isNotNull(), F.struct(x.j.alias("j"), x(col).alias("v"))))), F.lit(n))["v"]


def fill_directional(df: DataFrame, cols: Sequence[str], order: Sequence[str], keys: Sequence[str] = (), forward: bool = True) -> DataFrame:
    """ffill / bfill per key without a per-key task.

    For each column, the position of the last (next) non-null value is a
    running max (reverse running min) of "position if not null", computed by
    :func:`running_agg`; the value is then fetched by an equi-join on
    (key, position). Keys may be null (a group of their own).
    """
    keys = list(keys)
    pos = with_position(df, keys, order)
    if not keys:
        pos = pos.withColumn("__all", F.lit(1))
        keys = ["__all"]
    out = pos.withColumn("__ri", F.col("__n") - F.col("__i"))
    base_cols = out.columns
    for c in cols:
        p = out.withColumn("__p", F.when(F.col(c).isNotNull(), F.col("__i")))
        run = running_agg(p, keys, ["__i"] if forward else ["__ri"], "__p", prefix="__f_")
        src = F.col("__f_max") if forward else F.col("__f_min")
        run = run.select(*base_cols, src.alias("__src"))
        vals = pos.filter(F.col(c).isNotNull()).select(
            *[F.col(k).alias(f"__vk{i}") for i, k in enumerate(keys)], F.col("__i").alias("__vi"), F.col(c).alias("__v"))
        cond = F.col("__src") == F.col("__vi")
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__vk{i}"))
        out = run.join(vals, cond, "left").select(*[x for x in base_cols if x != c], F.col("__v").alias(c)).select(*base_cols)
    return out.drop("__i", "__n", "__ri", *(["__all"] if "__all" in out.columns else []))


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Gap-closed sessions per key without a per-key task: a new session
    starts when the gap to the previous event of the key reaches
    ``gap_seconds``; the session id is the running count of starts (carried
    running sums), and sessions are aggregated by (key, session id)."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    base = df.select(key, ts).withColumn("__tm", t)
    pos = with_position(base, [key], ["__tm"])
    prev = frame(pos, [key], -1, 0, {"__prev": shift_value(-1, "__tm")}, values=["__tm"])
    flagged = prev.withColumn("__new", F.when(F.col("__prev").isNull() | (F.col("__tm") - F.col("__prev") >= gap_seconds * 1_000_000), 1)
                              .otherwise(0))
    ids = running_agg(flagged, [key], ["__tm"], "__new", prefix="__sid_")
    return ids.groupBy(key, F.col("__sid_sum").alias("__sid")).agg(
        F.min(ts).alias("session_start"), (F.max(ts) + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count("*").alias("n")).drop("__sid")
