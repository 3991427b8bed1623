"""Alternating least squares over ratings dealt in blocks.

Each side has its ratings once in a table bucketed by blocks of its own keys.
A half step ships the other side's factors, each once to every block that has
ratings with it, and all sums of an entity are made where its ratings are; sums
of outer products, several times as wide, are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.session import fixed, scratch_path

_LAID = "block int, kind int, part int, ids binary, counts binary, pos binary, r binary, known binary"
_FACTORS = "block int, ids binary, f binary"


def _lay_out(chunk: int):
    """A block's ratings by key, in chunks of whole keys (kind 0), and the keys of the other side it needs, by their block (kind 1).

    ``pos`` is a rating's place in the list of needed keys, which are in order of block and key.
    """

    def run(key, rows):
        block, out = key[0].as_py(), []
        own, other, home = (rows[c].to_numpy() for c in ("own", "other", "home"))
        known = ~rows["r"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        r = np.where(known, rows["r"].to_numpy(), 0.0)
        order = np.lexsort((other, home))
        new = np.diff(other[order], prepend=other[order[0]] - 1) != 0
        need, at = other[order[new]], home[order[new]]
        pos = np.empty(len(own), np.int32)
        pos[order] = np.cumsum(new) - 1
        order = np.argsort(own, kind="stable")
        own, pos, r, known = own[order], pos[order], r[order], known[order]
        first = np.append(np.flatnonzero(np.diff(own, prepend=own[0] - 1)), len(own))
        a = 0
        while a < len(first) - 1:
            b = max(a + 1, int(np.searchsorted(first, first[a] + chunk, side="right")) - 1)
            rated = slice(first[a], first[b])
            out.append((block, 0, len(out), own[first[a:b]].tobytes(), np.diff(first[a:b + 1]).astype(np.int64).tobytes(), pos[rated].tobytes(), r[rated].tobytes(),
                        None if known[rated].all() else known[rated].tobytes()))
            a = b
        for s in np.unique(at):
            out.append((block, 1, int(s), need[at == s].tobytes(), None, None, None, None))
        names = ["block", "kind", "part", "ids", "counts", "pos", "r", "known"]
        types = [pa.int32()] * 3 + [pa.binary()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def _send(rank: int):
    """From one block's factors, those that each block of the other side needs, in the order of its list."""

    def run(key, routes, factors):
        parts = factors.to_pylist()
        ids = np.concatenate([np.frombuffer(p["ids"], np.int64) for p in parts])
        f = np.concatenate([np.frombuffer(p["f"]).reshape(-1, rank) for p in parts])
        order = np.argsort(ids)
        to = routes.to_pylist()
        sent = [f[order[np.searchsorted(ids, np.frombuffer(t["ids"], np.int64), sorter=order)]].tobytes() for t in to]
        return pa.table({"block": pa.array([t["to"] for t in to], pa.int32()), "home": pa.array([key[0].as_py()] * len(to), pa.int32()), "f": pa.array(sent, pa.binary())})

    return run


def _sums(rank: int, lam: float, error: bool):
    """Per block: normal equations of each key, solved; with ``error`` the squared error of both sides' factors instead of these."""

    def run(key, laid, sent):
        got = sorted(sent.to_pylist(), key=lambda s: s["home"])
        others = np.concatenate([np.frombuffer(s["f"]).reshape(-1, rank) for s in got])
        out, squares, told, n = [], 0.0, 0, 0
        for c in laid.to_pylist():
            counts = np.frombuffer(c["counts"], np.int64)
            start = np.cumsum(counts) - counts
            f, r = others[np.frombuffer(c["pos"], np.int32)], np.frombuffer(c["r"])
            a = np.empty((len(counts), rank, rank))
            for x in range(rank):
                for y in range(x + 1):
                    a[:, x, y] = a[:, y, x] = np.add.reduceat(f[:, x] * f[:, y], start)
            b = np.stack([np.add.reduceat(r * f[:, x], start) for x in range(rank)], axis=1)
            solved = np.linalg.solve(a + lam * np.eye(rank), b[:, :, None])[:, :, 0]
            if error:
                known = np.ones(len(r), bool) if c["known"] is None else np.frombuffer(c["known"], bool)
                off = (np.repeat(solved, counts, axis=0) * f).sum(axis=1) - r
                squares, told, n = squares + float((off[known] ** 2).sum()), told + int(known.sum()), n + len(r)
            else:
                out.append((c["ids"], solved.tobytes()))
        if error:
            return pa.table({"squares": [squares], "told": [told], "n": [n]})
        return pa.table({"block": pa.array([key[0].as_py()] * len(out), pa.int32()), "ids": pa.array([x for x, _ in out], pa.binary()), "f": pa.array([x for _, x in out], pa.binary())})

    return run


def _unpack(batches):
    for b in batches:
        ids = [np.frombuffer(x, np.int64) for x in b.column("ids").to_pylist()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(np.repeat(b.column("block").to_numpy(), [len(x) for x in ids]), pa.int32()), "id": np.concatenate(ids) if ids else np.zeros(0, np.int64)})


def _pack(key, rows):
    f = np.stack([rows[c].to_numpy() for c in rows.column_names if c.startswith("f")], axis=1)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([rows["id"].to_numpy().tobytes()], pa.binary()), "f": pa.array([f.tobytes()], pa.binary())})


def als_error(lines: DataFrame, rank: int = 4, lam: float = 0.1, iterations: int = 5, block_ratings: int = 3_000_000, chunk: int = 1 << 20) -> DataFrame:
    """rmse and number n of the ratings avg(r) per (u, i) of ``lines``(u, i, r) after ``iterations`` of both half steps.

    Lines without u or i are no ratings. A rating without r (null) counts in n and in
    the squares of factors only. Item factors begin with hashes of the item.
    """
    spark = lines.sparkSession
    kind = lines.schema["i"].dataType
    lines = lines.where("u IS NOT NULL AND i IS NOT NULL")
    total = lines.count()
    n = max(1, min(spark.sparkContext.defaultParallelism, -(-total // 250_000)), -(-total // block_ratings))
    # block numbers that the hash of a shuffle or bucket deals one to each
    dealt = spark.range(32 * n + 64).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("to")).agg(F.min("k").alias("k")).orderBy("to")
    numbers = F.array(*[F.lit(r["k"]) for r in dealt.collect()])
    block = lambda c: F.get(numbers, F.pmod(F.xxhash64(F.col(c).cast("long")), F.size(numbers)).cast("int"))
    made = []

    def bucketed(df, name):
        path = scratch_path(spark, name)
        made.append(f"{name}_{path.rsplit('-', 1)[-1]}")
        df.write.bucketBy(n, "block").option("path", path).saveAsTable(made[-1])
        return spark.table(made[-1])

    ratings = bucketed(lines.withColumn("block", block("u")).repartition(n, "block").groupBy("block", "u", "i").agg(F.avg("r").alias("r")), "ratings")
    laid = {}
    for own, other in (("u", "i"), ("i", "u")):
        rows = ratings.select(block(own).alias("block") if own == "i" else "block", F.col(own).cast("long").alias("own"), F.col(other).cast("long").alias("other"),
                              F.col("block").alias("home") if own == "i" else block(other).alias("home"), "r")
        laid[own] = bucketed((rows.repartition(n, "block") if own == "i" else rows).groupBy("block").applyInArrow(_lay_out(chunk), _LAID), f"laid_{own}")
    routes = {own: bucketed(laid[other].where("kind = 1").select(F.col("part").alias("block"), F.col("block").alias("to"), "ids").repartition(n, "block"), f"routes_{own}")
              for own, other in (("u", "i"), ("i", "u"))}
    init = [(F.abs(F.hash(F.col("id").cast(kind), F.lit(j))) % 1000 / 1000.0).alias(f"f{j}") for j in range(rank)]
    factors = laid["i"].where("kind = 0").select("block", "ids").mapInArrow(_unpack, "block int, id long").select("block", "id", *init).groupBy("block").applyInArrow(_pack, _FACTORS)
    for step in range(2 * iterations):
        own, other = ("u", "i") if step % 2 == 0 else ("i", "u")
        sent = routes[other].groupBy("block").cogroup(factors.groupBy("block")).applyInArrow(_send(rank), "block int, home int, f binary")
        sides = laid[own].where("kind = 0").groupBy("block").cogroup(sent.groupBy("block"))
        if step < 2 * iterations - 1:
            factors = fixed(sides.applyInArrow(_sums(rank, lam, False), _FACTORS), "factors")
        else:
            error = fixed(sides.applyInArrow(_sums(rank, lam, True), "squares double, told long, n long"), "errors")
    for name in made:
        spark.sql(f"DROP TABLE {name}")
    return error.agg(F.sqrt(F.try_divide(F.sum("squares"), F.sum("told"))).alias("rmse"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"))
