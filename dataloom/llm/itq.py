"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

1. A rotation is learned on a bounded sample (``sample_rows``): centre, project
   on the principal axes, then alternate between signs and the orthogonal
   rotation closest to them until the binary codes are balanced.
2. Every vector gets its code. Codes are cut into substrings, one Hamming table
   each; a table is searched within ``radius`` bits, chosen with the substring
   length so that codes up to ``code_errors`` bits apart meet in a table for sure.
3. Candidates are reranked: a link is a cosine of the original vectors, in
   double precision, of at least the threshold.

Vectors with equal label and components are one class before any table is
built, so thousands of copies cost one vector. A bucket larger than ``block``
is cut into blocks and its rows meet block pair by block pair, so a bucket is
never one task. A pair is counted in the first table that brings it together;
links are added up per class and reduced to a forest before they leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import flips, local_forest, materialize, prepare
from dataloom.llm.components import components


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 50, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dim x bits) whose signs are the code."""
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:bits].T
    v = (x - mean) @ axes
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (left @ right).T
    return mean, axes @ r


def _codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    on = (x - mean) @ projection >= 0
    padded = np.zeros((len(x), 64), bool)
    padded[:, : on.shape[1]] = on
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, code_errors: int = 7, sample_rows: int = 8192, block: int = 512) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null and their cosine reaches
    ``threshold``. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing: zero links, a component of their
    own. Vectors of different lengths do not link. Repeated rows are copies:
    they link with each other. An empty table gives no rows.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"), F.col(label_col).alias("label"))
    finite = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("x", lambda c: c != 0), F.lit(False))
    plain = F.transform("x", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))  # no -0.0 in the key of a class
    rows = rows.select("vec_id", "label", F.when(usable, plain).alias("x"))
    classes = rows.where("x is not null").groupBy("label", "x").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    classes = materialize(classes.withColumn("node", F.xxhash64("label", "x")), "vector-classes")
    sizes = {r["dim"]: (r["n"], r["most"]) for r in classes.groupBy(F.size("x").alias("dim"), "label").agg(F.count("*").alias("n"))
             .groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()}
    plans = {}
    for dim, (n, most) in sizes.items():
        # about twice the sample by hash, then its first rows: no task or driver sees more
        drawn = classes.where((F.size("x") == dim) & (F.pmod(F.xxhash64("node"), F.lit(n)) < 2 * sample_rows))
        sample = drawn.orderBy(F.xxhash64("node")).limit(sample_rows).select("x").toPandas()["x"]
        bits = min(dim, 64)
        length = min(bits, max(8, math.ceil(math.log2(max(1, most / 64)))))
        tables = max(1, bits // length)
        cuts = np.linspace(0, bits, tables + 1).astype(int)
        masks = [np.uint64(((1 << int(b - a)) - 1) << int(a)) for a, b in zip(cuts[:-1], cuts[1:])]
        # a table is searched within the radius that code_errors over all tables leave to one of them
        radius = code_errors // tables
        probes = [[np.uint64(m << int(a)) for m in flips(int(b - a), radius)] for a, b in zip(cuts[:-1], cuts[1:])]
        plans[dim] = (*learn_rotation(_unit(np.stack(sample.to_numpy())), bits), masks, probes, radius)

    def buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, g in f.groupby(f["x"].map(len)):
                mean, projection, masks, probes, _ = plans[int(dim)]
                code = _codes(_unit(np.stack(g["x"].to_numpy())), mean, projection)
                base = pd.DataFrame({"label": g["label"].to_numpy(), "dim": int(dim), "node": g["node"].to_numpy(), "code": code.view(np.int64)})
                for t, mask in enumerate(masks):
                    home = code & mask
                    for m in probes[t]:
                        at = home ^ m
                        use = at <= home  # two buckets meet in the smaller one
                        yield base[use].assign(t=t, bucket=at[use].view(np.int64), home=bool(m == 0))

    coded = classes.select("label", "x", "node").mapInPandas(
        buckets, f"label {classes.schema['label'].dataType.simpleString()}, dim int, node long, code long, t int, bucket long, home boolean")
    coded = materialize(coded, "hamming-tables")
    place = ["label", "dim", "t", "bucket"]
    counts = coded.groupBy(*place).agg(F.count("*").alias("n"), F.max("home").alias("any_home")).where("n > 1 and any_home")
    parts = F.ceil(F.col("n") / block).cast("int")
    met = coded.join(counts, place).withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    p, q = F.least("own", "other"), F.greatest("own", "other")
    met = met.withColumn("other", other).select(
        F.xxhash64(*place, p, q).alias("group"), F.xxhash64("label").alias("label"), "t", "dim", "node", "code", "home", "own", (p == q).alias("inner"))
    met = met.join(classes.select("node", "x", "copies"), "node")
    columns = ["group", "label", "t", "dim", "node", "code", "home", "own", "inner", "copies", "x"]

    def links_of(f: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per row of a group its links, and the linked pairs."""
        first = np.lexsort((f["node"], ~f["home"]))  # rows at home in the bucket, then those within the radius
        f = {k: v[first] for k, v in f.items()}
        x = x[first]
        own, home, node, label = f["own"], f["home"], f["node"], f["label"]
        code, copies = f["code"].view(np.uint64), f["copies"]
        _, _, masks, _, radius = plans[int(f["dim"][0])]
        links = np.zeros(len(node), np.int64)
        us, vs = [], []
        step = 512
        for a in range(0, len(node), step):
            for b in range(a, len(node), step):
                i, j = np.nonzero(x[a:a + step] @ x[b:b + step].T >= threshold - 1e-9)
                i, j = i + a, j + b
                keep = (i < j) & home[i] & (label[i] == label[j]) & (f["inner"][0] | (own[i] != own[j]))
                i, j = i[keep], j[keep]
                diff = code[i] ^ code[j]
                for m in masks[: int(f["t"][0])]:  # an earlier table has it
                    fresh = np.bitwise_count(diff & m) > radius
                    i, j, diff = i[fresh], j[fresh], diff[fresh]
                exact = (x[i] * x[j]).sum(axis=1) >= threshold
                i, j = i[exact], j[exact]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                us.append(node[i])
                vs.append(node[j])
        return node, links, np.concatenate(us), np.concatenate(vs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by group; a group holds two blocks at most."""

        def groups(t: pa.Table) -> Iterator[pa.RecordBatch]:
            f = {c: t[c].to_numpy() for c in columns[:-1]}
            flat = t["x"].combine_chunks()
            flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
            values, at = flat.flatten().to_numpy(), np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy())])
            cuts = np.concatenate([[0], np.flatnonzero(f["group"][1:] != f["group"][:-1]) + 1, [t.num_rows]])
            nodes, links, us, vs = [], [], [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo < 2:
                    continue
                x = values[at[lo]:at[hi]].reshape(hi - lo, -1)
                node, n, u, v = links_of({c: a[lo:hi] for c, a in f.items()}, _unit(x))
                if len(u):
                    some = np.flatnonzero(n)
                    nodes.append(node[some])
                    links.append(n[some])
                    u, v = local_forest(u, v)
                    us.append(u)
                    vs.append(v)
            if nodes:
                n, u = np.concatenate(nodes), np.concatenate(us)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([n, u])), pa.concat_arrays([pa.nulls(len(n), pa.int64()), pa.array(np.concatenate(vs))]),
                     pa.array(np.concatenate([*links, np.zeros(len(u), np.int64)]))], ["node", "peer", "links"])

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            group = t["group"].to_numpy()
            other_groups = np.flatnonzero(group != group[-1]) if len(group) else []
            cut = int(other_groups[-1]) + 1 if len(other_groups) else 0
            yield from groups(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield from groups(held)

    met = met.select(*columns).repartition("group").sortWithinPartitions("group")
    found = met.mapInArrow(compare, "node long, peer long, links long")
    found = materialize(found, "vector-links")
    links = found.where("peer is null").groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.where("peer is not null"), "node", "peer")
    named = grouped.join(classes.select("node", "first"), "node")
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    grouped = named.join(lowest, "root").select("node", "component")
    known = classes.join(links, "node", "left").join(grouped, "node", "left").select(
        "label", "x", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "first").alias("component"))
    known = known.withColumnsRenamed({"label": "k_label", "x": "k_x"})
    out = rows.join(known, (rows.label == known.k_label) & (rows.x == known.k_x), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
