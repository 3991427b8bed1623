"""Matrices in three distributed forms: rows, coordinate entries, square blocks.

Rows are a column of arrays, entries are ``(i, j, v)``, blocks are ``(bi, bj,
rows, cols, data)`` with row-major data. What reaches the driver has the size
of the number of *columns* (n x n), never of the rows; ``most_columns`` bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from dataloom.session import fixed, ship_package

MOST_COLUMNS = 4096
#: numbers of block products that a task holds before it gives them out (32 MB)
HELD_NUMBERS = 1 << 22


def stacked(column: pa.Array, n: int) -> np.ndarray:
    """The rows of a list column as a matrix; a row of any other length is an error."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != n * len(column):
        raise ValueError(f"every row must hold {n} numbers")
    return flat.reshape(-1, n)


def _rows(df: DataFrame, col: str) -> tuple[DataFrame, int]:
    """Rows that are not null, and their length."""
    ship_package(df.sparkSession)
    rows = df.where(F.col(col).isNotNull())
    first = rows.select(F.size(col)).first()
    n = first[0] if first else 0
    if n > MOST_COLUMNS:
        raise ValueError(f"{n} columns; the {n} x {n} factor is held by every task, at most {MOST_COLUMNS} are allowed")
    return rows, n


def _sealed(r: np.ndarray) -> np.ndarray:
    """The factor with a diagonal that is not negative, which makes it unique."""
    sign = np.where(np.diag(r) < 0, -1.0, 1.0)
    return r * sign[:, None]


def _triangle(rows: np.ndarray) -> np.ndarray:
    n = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((n - len(r), n))]) if len(r) < n else r


def qr_r(df: DataFrame, col: str, fan_in: int = 16) -> np.ndarray:
    """The n x n factor R of A = QR by a tree: each task folds its rows into one factor, ``fan_in`` factors are combined at a time."""
    rows, n = _rows(df, col)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, n))
        for b in batches:
            if b.num_rows:
                r = _triangle(np.vstack([r, stacked(b.column(0), n)]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["r"])

    def merged(key: tuple, t: pa.Table) -> pa.Table:
        r = _triangle(stacked(t["r"].combine_chunks(), n * n).reshape(-1, n))
        return pa.table({"r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    factors = fixed(rows.select(F.col(col).cast("array<double>")).mapInArrow(local, "r array<double>"), "factors")
    while (count := factors.count()) > fan_in:
        dealt = factors.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(-(-count // fan_in))))
        factors = fixed(dealt.groupBy("g").applyInArrow(merged, "r array<double>"), "factors")
    left = [np.array(x.r).reshape(n, n) for x in factors.collect()]  # at most fan_in factors
    return _sealed(_triangle(np.vstack(left))) if left else np.zeros((0, 0))


def times(df: DataFrame, col: str, matrix: np.ndarray, out: str) -> DataFrame:
    """``df`` with the rows multiplied by a small matrix from the right."""
    ship_package(df.sparkSession)
    n = matrix.shape[0]
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = stacked(b.column(b.schema.get_field_index(col)), n) @ shared.value
            ends = pa.array(np.arange(0, made.size + 1, max(made.shape[1], 1), dtype=np.int32)[: len(made) + 1])
            yield b.append_column(out, pa.ListArray.from_arrays(ends, pa.array(made.ravel())))

    return df.mapInArrow(run, StructType(list(df.schema.fields)).add(out, ArrayType(DoubleType())))


def qr(df: DataFrame, col: str, out: str = "q", least: float = 1e-12) -> tuple[DataFrame, np.ndarray]:
    """(the rows with their row of Q, R) of a tall and narrow matrix: A = QR, Q'Q = I, R with a positive diagonal.

    Null rows are left out. The rows of Q are those of A times the inverse of
    R; what rounding takes from their orthogonality is put back by a second
    tree over them. A matrix whose columns depend on each other (a diagonal
    entry of R below ``least`` of the largest) is an error, as R has no inverse.
    """
    rows, n = _rows(df, col)
    first = qr_r(rows, col)
    diagonal = np.abs(np.diag(first))
    if not len(diagonal) or diagonal.min() <= least * diagonal.max():
        raise ValueError("R has no inverse: the columns depend on each other")
    rough = times(rows.withColumn(col, F.col(col).cast("array<double>")), col, np.linalg.inv(first), out)
    second = qr_r(rough, out)
    return times(rows.withColumn(col, F.col(col).cast("array<double>")), col, np.linalg.inv(second @ first), out), second @ first


def svd(df: DataFrame, col: str, k: int, out: str | None = "u", least: float = 1e-9) -> tuple[DataFrame | None, np.ndarray, np.ndarray]:
    """(rows with their row of U, singular values, V) of the ``k`` largest singular values, from the factor R.

    Fewer than ``k`` come back where values fall below ``least`` of the largest. ``out=None``: no U.
    """
    rows, _ = _rows(df, col)
    _, s, vt = np.linalg.svd(qr_r(rows, col))
    keep = min(k, int((s > least * s[0]).sum())) if len(s) else 0
    s, v = s[:keep], vt[:keep].T
    # the largest part of every direction is positive, so signs do not depend on the rounding
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(keep)])
    if out is None or not keep:
        return None, s, v
    return times(rows.withColumn(col, F.col(col).cast("array<double>")), col, v / s, out), s, v


def gram(df: DataFrame, col: str, means: list[float] | None = None) -> DataFrame:
    """(i, j, v): the n x n sums of products of all rows, less ``means``; added up in each task before they are shuffled."""
    rows, n = _rows(df, col)
    centre = np.zeros(n) if means is None else np.array(means, np.float64)
    i, j = (pa.array(x.ravel().astype(np.int32)) for x in np.indices((n, n)))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for b in batches:
            x = stacked(b.column(0), n) - centre
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([i, j, pa.array(total.ravel())], ["i", "j", "v"])

    parts = rows.select(F.col(col).cast("array<double>")).mapInArrow(local, "i int, j int, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def entries(matrix: np.ndarray, df: DataFrame) -> DataFrame:
    """(i, j, v) of a small matrix, as one row that Spark takes apart."""
    spark = df.sparkSession
    whole = spark.createDataFrame([(matrix.tolist(),)], "m array<array<double>>")
    return whole.select(F.posexplode("m").alias("i", "row")).select("i", F.posexplode("row").alias("j", "v"))


def _numbers(column: pa.Array):
    """Row k of a list column as a view of its numbers: no Python object for each of them."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return lambda k: flat[ends[k]: ends[k + 1]]


def _lists(data: list[np.ndarray]) -> pa.Array:
    """Arrays of numbers as a list column."""
    ends = np.cumsum([0, *map(len, data)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(data) if data else np.zeros(0)))


def _as_blocks(made: dict) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([*(pa.array(k, t) for k, t in zip(zip(*made), kinds)), _lists(list(made.values()))], ["bi", "bj", "rows", "cols", "data"])


def transpose(df: DataFrame) -> DataFrame:
    """Entries or blocks transposed: indices change places, and so do the numbers of a block."""
    if "data" not in df.columns:
        return df.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _numbers(b.column("data"))
            data = [x(k).reshape(r, c).T.ravel() for k, (r, c) in enumerate(zip(b.column("rows").to_pylist(), b.column("cols").to_pylist()))]
            yield pa.RecordBatch.from_arrays([b.column("bj"), b.column("bi"), b.column("cols"), b.column("rows"), _lists(data)], ["bi", "bj", "rows", "cols", "data"])

    return df.select("bi", "bj", "rows", "cols", "data").mapInArrow(run, "bi long, bj long, rows int, cols int, data array<double>")


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries of the product of two matrices of entries: a join on the inner index and a sum of products."""
    left, right = a.select("i", F.col("j").alias("k"), F.col("v").alias("x")), b.select(F.col("i").alias("k"), "j", F.col("v").alias("y"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))


def to_blocks(df: DataFrame, size: int) -> DataFrame:
    """Entries gathered into blocks of ``size`` x ``size`` (every block that holds an entry; equal indices add up)."""
    cell = df.groupBy("i", "j").agg(F.sum("v").alias("v")).select(
        F.floor(F.col("i") / size).cast("long").alias("bi"), F.floor(F.col("j") / size).cast("long").alias("bj"),
        (F.pmod("i", F.lit(size)) * size + F.pmod("j", F.lit(size))).cast("int").alias("at"), F.col("v").cast("double").alias("v"))
    got = cell.groupBy("bi", "bj").agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("m"))  # at most size^2 entries
    full = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0.0)))
    return got.select("bi", "bj", F.lit(size).alias("rows"), F.lit(size).alias("cols"), full.alias("data"))


def from_blocks(df: DataFrame) -> DataFrame:
    """The entries of blocks that are not zero. All blocks but the outermost must be of one size."""
    at = df.select("bi", "bj", "rows", "cols", F.posexplode("data").alias("at", "v")).where("v <> 0")
    return at.select((F.col("bi") * F.col("rows") + F.floor(F.col("at") / F.col("cols"))).cast("long").alias("i"),
                     (F.col("bj") * F.col("cols") + F.col("at") % F.col("cols")).cast("long").alias("j"), "v")


def multiply_blocks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Blocks of a product: blocks that share the inner index are joined, multiplied in Arrow batches, and added up place by place.

    Products of one outer index pair are added up in a task before the shuffle where they meet there.
    """
    ship_package(a.sparkSession)
    pair = a.select("bi", F.col("bj").alias("k"), "rows", F.col("cols").alias("inner"), F.col("data").alias("x")).join(
        b.select(F.col("bi").alias("k"), "bj", "cols", F.col("data").alias("y")), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = {}, 0
        for t in batches:
            x, y = _numbers(t.column("x")), _numbers(t.column("y"))
            for k, (bi, bj, r, m, c) in enumerate(zip(*(t.column(n).to_pylist() for n in ("bi", "bj", "rows", "inner", "cols")))):
                done = (x(k).reshape(r, m) @ y(k).reshape(m, c)).ravel()
                if (bi, bj, r, c) in made:
                    made[bi, bj, r, c] += done
                else:
                    made[bi, bj, r, c] = done
                    held += len(done)
                if held >= HELD_NUMBERS:
                    yield _as_blocks(made)
                    made, held = {}, 0
        if made:
            yield _as_blocks(made)

    parts = pair.select("bi", "bj", "rows", "inner", "cols", "x", "y").mapInArrow(run, "bi long, bj long, rows int, cols int, data array<double>")
    cells = parts.select("bi", "bj", "rows", "cols", F.posexplode("data").alias("at", "v"))
    total = cells.groupBy("bi", "bj", "rows", "cols", "at").agg(F.sum("v").alias("v"))
    return total.groupBy("bi", "bj", "rows", "cols").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("data"))


def positive_zero(c: Column) -> Column:
    """A rounded number without the sign of a zero."""
    return c + F.lit(0.0)
