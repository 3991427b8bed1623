"""Helpers shared by the operators: session settings, lineage cuts, bounded Arrow batches."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.session import ensure_checkpoint_dir, scratch_path, ship_package


def prepare(spark: SparkSession) -> None:
    """Ship the package and make sure a shared scratch folder is known.

    Arrow batches are bounded in bytes by Spark (64 MB by default) and here in
    rows, so a run of very long texts does not fill a worker.
    """
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs no earlier stage, and several
    consumers read the same fixed rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The strings of a column, null as empty, one Python string at a time."""
    for x in column:
        yield x.as_py() or ""


def named(column: str) -> F.Column:
    """A column by its whole name, whatever stands in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def spare(columns: list[str], name: str) -> str:
    """``name``, or the next name like it that is none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 3, is 1: rows no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each (start, size), concatenated."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def flips(width: int, errors: int) -> list[int]:
    """All masks of at most ``errors`` set bits in ``width`` bits."""
    return [sum(1 << i for i in c) for k in range(errors + 1) for c in itertools.combinations(range(width), k)]


def local_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same connected components, one per node that is not the smallest of its component."""
    nodes, inv = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inv[: len(u)], inv[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[label[keep]], nodes[keep]
