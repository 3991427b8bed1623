"""Structured Streaming helpers: file sources, available-now runs, sinks,
windowed / session / stateful operators.

Streams here are driven by ``trigger(availableNow=True)``: every file present
at start is processed (in ``maxFilesPerTrigger`` micro-batches), then the query
stops. Checkpoints and sinks live under the shared checkpoint folder, so a
restarted query resumes without loss or duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def data_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, counted in one aggregate: texts by their length, all else by the width of its type.

    The optimizer's estimate goes by the compressed files, which may hold many times their size.
    """
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    sizes = [F.sum(F.octet_length(F.col(c))).alias(f"w{i}") for i, c in enumerate(wide)] + [8 * F.sum(F.greatest(F.size(F.col(c)), F.lit(0))).alias(f"l{i}") for i, c in enumerate(lists)]
    got = df.agg(F.count("*"), *sizes).first()
    return got[0] * 8 * (1 + len(df.columns)) + sum(x or 0 for x in got[1:])


def stage_files(df: DataFrame, path: str, slices: int, order_col: str | None = None, fmt: str = "parquet", file_bytes: int = 128 << 20) -> int:
    """Write ``df`` as ``slices`` arrivals into one folder and return the number of files of an arrival.

    With ``order_col`` the slices are ranges of it, committed one after the
    other, so the file source (which goes by modification time) sees them in
    that order and a watermark never passes rows that are still to come. A
    slice has as many files as the size of its rows asks for.
    """
    files = max(1, math.ceil(data_bytes(df) / slices / file_bytes))
    if order_col is None:
        df.repartition(slices * files).write.mode("append").format(fmt).save(path)
        return files
    at = F.col(order_col)
    if "timestamp" in dict(df.dtypes)[order_col]:
        at = F.unix_micros(at.cast("timestamp"))
    inner = [i / slices for i in range(1, slices)]
    cuts = sorted(set(df.select(at.alias("at")).agg(F.percentile_approx("at", inner, 100_000)).first()[0] or [])) if inner else []
    for i in range(len(cuts) + 1):
        part = df
        if i > 0:
            part = part.where(at > F.lit(cuts[i - 1]))
        if i < len(cuts):
            part = part.where((at <= F.lit(cuts[i])) | at.isNull() if i == 0 else at <= F.lit(cuts[i]))
        part.repartition(files).write.mode("append").format(fmt).save(path)
    return files


def stage_flush(df: DataFrame, path: str, ts: str, after: str) -> None:
    """A last arrival of one row, ``after`` (an interval) behind the latest ``ts``, all other columns null.

    It moves the watermark past every window of the rows before it, so an
    append-mode stream gives these out and drops their state. Its own window stays open.
    """
    last = df.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
    row = last.select(*[(F.col(ts) + F.expr(f"INTERVAL {after}")).cast(f.dataType).alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in df.schema])
    row.coalesce(1).write.mode("append").parquet(path)  # one row


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 2) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


@contextmanager
def state_stores(spark: SparkSession, rows: int | None, store_rows: int = 100_000) -> Iterator[None]:
    """A stream started inside has a state store for every ``store_rows`` of ``rows``, the rows that its state may come from.

    Each batch commits every store of every stateful step, a file even where
    nothing changed, so the commits of a store for each shuffle partition may
    take longer than the rows. The session's shuffle partitions are the most
    (and the number for ``rows`` None); a stream keeps the number it began with.
    """
    key = "spark.sql.shuffle.partitions"
    most = spark.conf.get(key)
    if rows is not None:
        spark.conf.set(key, str(min(int(most), max(1, math.ceil(rows / store_rows)))))
    try:
        yield
    finally:
        spark.conf.set(key, most)


def run_append(sdf: DataFrame, sink: str, checkpoint: str, partition_by: Sequence[str] = (), fmt: str = "parquet", state_rows: int | None = None) -> int:
    """Append mode into a file sink (exactly-once through the sink's log); returns the rows of state left at the end."""
    w = sdf.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with state_stores(sdf.sparkSession, state_rows):
        run = w.start(sink)
    run.awaitTermination()
    last = run.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0


def run_complete(sdf: DataFrame, sink: str, checkpoint: str, state_rows: int | None = None) -> None:
    """Complete mode: each micro-batch carries the whole result table and
    replaces the sink folder (idempotent, so a retried batch is harmless)."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    w = sdf.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(replace)
    with state_stores(sdf.sparkSession, state_rows):
        run = w.start()
    run.awaitTermination()


def run_foreach_batch(sdf: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", state_rows: int | None = None) -> None:
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(fn)
    with state_stores(sdf.sparkSession, state_rows):
        run = w.start()
    run.awaitTermination()


def window_counts(df: DataFrame, ts: str, size: str, slide: str | None, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Tumbling (slide None) or sliding event-time windows, flattened to start / end."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = df.groupBy(w.alias("w"), *keys).agg(*aggs)
    measures = [c for c in g.columns if c not in ("w", *keys)]
    return g.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *keys, *measures)


def distinct_users(df: DataFrame, ts: str, size: str, user: str = "user_id") -> DataFrame:
    """(window_start, value): different users per window, exact, on a stream or a table.

    Counted in two chained aggregates, (window, user) and then window, since a
    stream allows no distinct count; both states close with the watermark.
    """
    per_user = df.groupBy(F.window(ts, size).alias("w"), user).agg(F.count("*").alias("n"))
    out = per_user.groupBy(F.window(F.window_time("w"), size).alias("w")).agg(F.count("*").alias("value"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("value").cast("double").alias("value"))


def running_totals(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """applyInPandasWithState body: per-key running count and sum of ``value``."""
    n, s = state.get if state.exists else (0, 0.0)
    for pdf in pdfs:
        n += len(pdf)
        s += float(pdf["value"].sum())
    state.update((n, s))
    yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [s]})


def stateful_running_totals(sdf: DataFrame) -> DataFrame:
    return sdf.groupBy("user_id").applyInPandasWithState(
        running_totals, "user_id long, n long, total double", "n long, s double", "update", GroupStateTimeout.NoTimeout)


def save_state(spark: SparkSession, path: str, batch_id: int, rows: list, schema: str) -> None:
    """Model state after a micro-batch, written under its batch id (a retried
    batch overwrites the same folder: idempotent). The state is small (k
    centres, a weight vector), never data-sized."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def load_state(spark: SparkSession, path: str, before: int | None = None):
    """Rows of the latest saved state (optionally of a batch before ``before``), or None."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing saved yet
            return None
        raise
    if before is not None:
        df = df.filter(F.col("batch") < before)
    last = df.agg(F.max("batch")).first()[0]
    if last is None:
        return None
    return df.filter(F.col("batch") == last).drop("batch").collect()
