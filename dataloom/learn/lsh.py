"""Similarity join under a distance by locality-sensitive hashing.

Rows are hashed into several tables; rows of one bucket are compared. A bucket
is cut into blocks of bounded size and every pair of blocks is one group of a
task, so a bucket of any size is spread out. A pair counts in the first
table whose bucket both rows share, is compared exactly, and never leaves its task
unless it is close enough. Where the buckets hold more pairs than there are
at all, all rows are one bucket and each pair is compared once. Equal rows are one
class, compared once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.session import fixed, ship_package

_PRIME = np.int64(2147483647)
#: rows of the two sides that are compared at a time; different items up to which a block's sets are rows of a matrix
_TILE, _ITEMS = (512, 2048), 1024


def euclid_hashes(length: float, tables: int, width: int, seed: int) -> Callable[[pa.Array], np.ndarray]:
    """Buckets of random projections: ``width`` of them, cut into steps of ``length``, name a bucket of a table."""

    def run(column: pa.Array) -> np.ndarray:
        sizes = column.value_lengths().to_numpy()
        if len(sizes) and sizes.min() != sizes.max():
            raise ValueError("all vectors must be of one length")
        x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(sizes), -1)
        rng = np.random.default_rng(seed)
        along = rng.normal(size=(x.shape[1], tables * width))
        along /= np.maximum(np.linalg.norm(along, axis=0), 1e-300)
        step = np.floor(x @ along / length + rng.random(tables * width)).astype(np.int64).reshape(len(x), tables, width)
        return _mixed(step)

    return run


def jaccard_hashes(tables: int, width: int, seed: int) -> Callable[[pa.Array], np.ndarray]:
    """Buckets of least hashes of a set of whole numbers, ``width`` of them to a table."""

    def run(column: pa.Array) -> np.ndarray:
        rng = np.random.default_rng(seed)
        a, b = rng.integers(1, _PRIME, tables * width), rng.integers(0, _PRIME, tables * width)
        sizes = column.value_lengths().to_numpy()
        item = np.abs(column.flatten().to_numpy().astype(np.int64)) % _PRIME
        out = np.zeros((len(sizes), tables * width), np.int64)
        begin = (np.cumsum(sizes) - sizes)[sizes > 0]
        for k in range(tables * width):
            h = (item * a[k] + b[k]) % _PRIME  # below 2^62
            if len(begin):
                out[sizes > 0, k] = np.minimum.reduceat(h, begin)
        return _mixed(out.reshape(len(sizes), tables, width))

    return run


def _mixed(parts: np.ndarray) -> np.ndarray:
    """One number for the parts of a bucket's name."""
    out = np.zeros(parts.shape[:2], np.uint64)
    for k in range(parts.shape[2]):
        out = (out ^ parts[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def euclid(a: list, b: list) -> np.ndarray:
    """Distances of all vectors of two blocks."""
    x, y = np.asarray(a, float), np.asarray(b, float)
    near = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T
    r, c = np.nonzero(near < 1e-6 * np.maximum((x * x).sum(1)[:, None], 1e-300))  # little is left of the digits there
    near[r, c] = ((x[r] - y[c]) ** 2).sum(1)
    return np.sqrt(np.maximum(near, 0))


def jaccard(a: list, b: list, most: int = 4096) -> np.ndarray:
    """Distances of all sets of two blocks, over ``most`` different items at a time."""
    both = [np.unique(np.array(x, np.int64)) for x in [*a, *b]]
    flat = np.concatenate([*both, np.empty(0, np.int64)])
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    items, code = np.unique(flat, return_inverse=True)
    common = np.zeros((len(a), len(b)))
    for at in range(0, len(items), most):
        pick = (code >= at) & (code < at + most)
        m = np.zeros((len(both), min(most, len(items) - at)), np.float32)
        m[row[pick], code[pick] - at] = 1
        common += m[: len(a)] @ m[len(a):].T
    size = np.array([len(x) for x in both], float)
    union = size[: len(a), None] + size[len(a):] - common
    return np.where(union > 0, 1 - common / np.maximum(union, 1), 0.0)


def _tiles(n: int, m: int, same: bool, tile: tuple[int, int] = _TILE) -> Iterator[tuple[slice, slice]]:
    """Places of the rows to compare; of one block with itself only those that reach above the diagonal."""
    for i in range(0, n, tile[0]):
        for j in range(0, m, tile[1]):
            if not same or j + tile[1] > i + 1:
                yield slice(i, min(n, i + tile[0])), slice(j, min(m, j + tile[1]))


def _above(r: slice, c: slice) -> np.ndarray:
    return np.arange(c.start, c.stop) > np.arange(r.start, r.stop)[:, None]


def _few(good: np.ndarray, limit: int = 8) -> bool:
    return limit * np.count_nonzero(good) < good.size


def _near(distance: Callable[[list, list], np.ndarray], tile: tuple[int, int] = _TILE, ready: Callable = pa.Array.to_pylist) -> Callable[..., Iterator[tuple]]:
    """The near pairs of two blocks, tile by tile: (rows of a, rows of b, matrix of the near ones or their places, distances of places).

    Of one block with itself each pair is met once."""

    def run(a: pa.Array, b: pa.Array, most: float, same: bool) -> Iterator[tuple]:
        x, y = ready(a), ready(b)
        for r, c in _tiles(len(x), len(y), same, tile):
            d = distance(x[r], y[c])
            good = d <= most
            if same and c.start < r.stop:
                good &= _above(r, c)
            yield r, c, np.nonzero(good) if _few(good) else good, lambda i, j, d=d: d[i, j]

    return run


_near_vectors = _near(euclid, ready=lambda c: c.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(c), -1))


def _near_sets(a: pa.Array, b: pa.Array, most: float, same: bool) -> Iterator[tuple]:
    """As ``_near`` of ``jaccard``. Sets of few different items are rows of a matrix with their sizes beside them, so
    that one product tells which pairs are near; sets go by size, and tiles of too unequal ones are left out."""
    items, code = np.unique(np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in (a, b)]), return_inverse=True)
    share = 1 - most
    if len(items) > _ITEMS or share <= 0:
        yield from _near(jaccard, (512, 512))(a, b, most, same)
        return
    m = np.zeros((len(a) + len(b), len(items) + 2), np.float32)
    m[np.repeat(np.arange(len(m)), np.concatenate([c.value_lengths().to_numpy() for c in (a, b)])), code] = 1
    sizes = m.sum(axis=1)
    at = [np.argsort(s, kind="stable") for s in (sizes[: len(a)], sizes[len(a):])]
    x, y, big, wide = m[: len(a)][at[0]], m[len(a):][at[1]], sizes[: len(a)][at[0]], sizes[len(a):][at[1]]
    # common >= share * union  <=>  common - needed * size_a - needed * size_b >= 0
    needed = np.float32(share / (1 + share))
    x[:, -2], x[:, -1], y[:, -2], y[:, -1] = -needed * big, 1, 1, -needed * wide
    for r, c in _tiles(len(x), len(y), same):
        if big[r][-1] < share * wide[c][0] - 1e-6 or wide[c][-1] < share * big[r][0] - 1e-6:
            continue
        over = (x[r] @ y[c].T).ravel()
        place = np.flatnonzero(over >= -1e-2)  # a hundredth of an item: more than the product is off
        i, j = np.divmod(place, c.stop - c.start)
        if same and c.start < r.stop:
            up = c.start + j > r.start + i
            place, i, j = place[up], i[up], j[up]
        both = big[r][i] + wide[c][j]
        common = np.rint(over[place] + needed * both).astype(float)
        d = np.where(both > 0, 1 - common / np.maximum(both - common, 1), 0.0)
        good = d <= most
        yield at[0][r], at[1][c], (i[good], j[good]), lambda _i, _j, d=d[good]: d


def similar(df: DataFrame, id_col: str, value_col: str, hashes: Callable[[pa.Array], np.ndarray], distance: Callable[[list, list], np.ndarray],
            most: float, tables: int, block: int = 1 << 14, counts: bool = False, task_pairs: int = 1 << 28) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of the rows at most ``most`` apart.

    members: id, class (the least id of equal values). pairs: a, b (classes,
    a < b), distance. Pairs within a class have distance 0 and are not listed. Exact for every pair that
    shares a bucket of some table; others are not found. Null values and ids take no part.

    With ``counts``, in place of the pairs: class, m, whose sums over a class are the numbers of rows of
    the classes that it is paired with. They are summed up where the pairs are found, so what leaves a task
    is as many rows as came, however many pairs there are.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = fixed(df.select(F.col(id_col).alias("id"), F.col(value_col).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()), "values")
    kind, value = (rows.schema[c].dataType.simpleString() for c in ("id", "v"))
    classes = fixed(rows.groupBy("v").agg(F.min("id").alias("class"), F.count("*").alias("n")), "classes")
    members = fixed(rows.join(classes, rows.v == classes.v).select("id", "class"), "members")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = hashes(b.column(1)) if b.num_rows else np.empty((0, tables), np.int64)
            ends = pa.array(np.arange(0, h.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(h.ravel()))], ["class", "v", "n", "h"])

    named = fixed(classes.select("class", "v", "n").mapInArrow(hashed, f"class {kind}, v {value}, n long, h array<long>"), "buckets")
    cells = named.select("class", F.posexplode("h").alias("t", "bucket"))
    sizes = fixed(cells.groupBy("t", "bucket").agg(F.count("*").alias("rows")).where("rows > 1"), "bucket-sizes")
    candidates = sizes.agg(F.sum(F.col("rows").cast("double") * F.col("rows"))).first()[0] or 0.0
    total = named.count()
    whole = candidates > float(total) ** 2
    if whole:  # one bucket, and a pair counts if its rows share a bucket of any table
        candidates = float(total) ** 2
        placed = named.select("class", "v", "n", "h", F.lit(0).alias("t"), F.lit(0).cast("long").alias("bucket"), F.lit(total).alias("rows"))
    else:  # of its hashes a row takes those of the tables before along
        placed = named.select("class", "v", "n", "h", F.posexplode("h").alias("t", "bucket")).join(sizes, ["t", "bucket"]).withColumn("h", F.slice("h", F.lit(1), F.col("t")))
    placed = placed.withColumn("blocks", F.ceil(F.col("rows") / block).cast("int"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    # a block meets itself and every other block of its bucket once
    dealt = placed.withColumn("own", own).select(
        "t", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "class", "v", "n", "h").select(
        "t", "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "class", "v", "n", "h")
    near = {euclid: _near_vectors, jaccard: _near_sets}.get(distance) or _near(distance)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        types = None

        def out() -> pa.RecordBatch:
            cols = [np.concatenate(x) for x in zip(*found)] if found else [[] for _ in types]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, types)], ["class", "m"] if counts else ["a", "b", "distance"])

        def met(hl: np.ndarray, hr: np.ndarray, good: np.ndarray | tuple) -> np.ndarray:
            """Which of the near pairs stay: those that did not meet in an earlier table (of one bucket for all: that meet in any)."""
            shared = np.zeros(len(good[0]) if isinstance(good, tuple) else good.shape, bool)
            for x, y in zip(hl, hr):
                shared |= x[good[0]] == y[good[1]] if isinstance(good, tuple) else x[:, None] == y
            return shared == whole

        def group(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = pa.Table.from_batches(parts).combine_chunks()
            col = lambda t, c: t[c].chunk(0) if t[c].num_chunks else pa.array([], t[c].type)
            place = col(held, "own").to_numpy()
            p, q = held["p"][0].as_py(), held["q"][0].as_py()
            left = held.filter(pa.array(place == p)).combine_chunks() if p != q else held
            right = held.filter(pa.array(place == q)).combine_chunks() if p != q else held
            if not left.num_rows or not right.num_rows or (p == q and held.num_rows < 2):
                return
            cl, cr = (col(x, "class").to_numpy(zero_copy_only=False) for x in (left, right))
            nl, nr = (col(x, "n").to_numpy().astype(float) for x in (left, right))
            hl, hr = (np.ascontiguousarray(col(x, "h").flatten().to_numpy().reshape(x.num_rows, -1).T) for x in (left, right))  # by table
            ml, mr = np.zeros(len(cl)), np.zeros(len(cr))
            for r, c, good, apart in near(col(left, "v"), col(right, "v"), most, p == q):
                stay = met(hl[:, r], hr[:, c], good)
                if counts and not isinstance(good, tuple):
                    stay &= good
                    ml[r] += stay @ nr[c]
                    mr[c] += nl[r] @ stay
                    continue
                i, j = good if isinstance(good, tuple) else np.nonzero(good)
                stay = stay if stay.ndim == 1 else stay[i, j]
                if counts:
                    ml[r] += np.bincount(i[stay], nr[c][j[stay]], len(nl[r]))
                    mr[c] += np.bincount(j[stay], nl[r][i[stay]], len(nr[c]))
                    continue
                a, b, d = cl[r][i[stay]], cr[c][j[stay]], apart(i, j)[stay]
                found.append((np.minimum(a, b), np.maximum(a, b), d))
                if sum(len(x[0]) for x in found) > 1 << 18:
                    yield out()
            if counts:
                for x, m in ((cl, ml), (cr, mr)):
                    found.append((x[m > 0], m[m > 0].astype(np.int64)))

        name, held = None, []
        for batch in batches:
            id_type = batch.schema.field("class").type
            types = [id_type, pa.int64()] if counts else [id_type, id_type, pa.float64()]
            keys = [batch.column(c).to_numpy() for c in key]
            new = np.zeros(max(batch.num_rows - 1, 0), bool)
            for k in keys:
                new |= k[1:] != k[:-1]
            cuts = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for at, to in zip(cuts, cuts[1:]):
                if at == to:
                    continue
                of = tuple(int(k[at]) for k in keys)
                if of != name and held:
                    yield from group(held)
                    held = []
                name = of
                held.append(batch.slice(at, to - at))
            if found:
                yield out()
        if held:
            yield from group(held)
        if found:
            yield out()

    key = ["t", "bucket", "p", "q"]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(candidates / task_pairs))  # tasks follow the pairs
    pairs = dealt.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(compared, f"class {kind}, m long" if counts else f"a {kind}, b {kind}, distance double")
    return members, pairs


def links(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, class, n_links): how many other rows each row is linked with, equal ones included. ``pairs``: pairs or counts of ``similar``."""
    sizes = fixed(members.groupBy("class").agg(F.count("*").alias("n")), "class-sizes")
    if "m" in pairs.columns:
        linked = pairs.groupBy("class").agg(F.sum("m").alias("m"))
    else:  # both ends from one row: the pairs are compared once
        ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("class"), F.col("b").alias("other")), F.struct(F.col("b").alias("class"), F.col("a").alias("other")))).alias("e")).select("e.*")
        linked = ends.join(sizes.withColumnRenamed("class", "other"), "other").groupBy("class").agg(F.sum("n").alias("m"))
    per = sizes.join(linked, "class", "left").select("class", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))
    return members.join(fixed(per, "links"), "class").select("id", "class", "n_links")
