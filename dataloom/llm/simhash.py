"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the paths of a binary trie. Two tries are joined with
themselves: one over the bits as they are, one with the two 32-bit halves
exchanged. Of two fingerprints at most ``max_bits`` apart, one half differs in
at most ``max_bits // 2`` bits, so a traversal may spend only that much of the
error budget in the first 32 levels and is pruned early; the rest of the budget
opens below.

The top of each trie is cut into shards of bounded size (8-bit steps, deeper
where it is crowded). A fingerprint travels to its own shard and to the shards
that hold its one-bit (``max_bits // 2``-bit) neighbours; each pair of shards is
one group, in which node pairs are walked level by level with numpy. Work and
shuffle grow with n log n, and since fingerprints are distinct a node has at
most as many partners as the Hamming ball has points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import flips, local_forest, materialize, prepare, ranges, texts
from dataloom.llm.components import components

HALF = 32


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of word shingles; fewer words than a shingle: the whole sequence; none: zero."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.array([digest(g, seed) for g in grams], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(doc_id long, row_key long, fp long, fingerprint string) for every row; null text counts as empty.

    ``row_key`` is a hash of the id and the text, which tells rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.encode(), shingle) for t in texts(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(fp.view(np.int64)), pa.array([f"{int(x):016x}" for x in fp], pa.string())],
                ["doc_id", "row_key", "fp", "fingerprint"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), row_key(id_col, text_col).alias("row_key"))
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long, fingerprint string")


def row_key(id_col: str, text_col: str) -> F.Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _swap(x: np.ndarray) -> np.ndarray:
    return (x << np.uint64(HALF)) | (x >> np.uint64(HALF))


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, max_bits: int, dense: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted distinct uint64 paths within the budgets; ``b`` None joins ``a`` with itself.

    All of ``a`` share their first ``depth`` bits, and so do all of ``b``. Node
    pairs are intervals of the sorted paths; each level splits both nodes at
    the next bit, adds an error where the branches differ, and drops pairs over
    the budget (``max_bits // 2`` within the first 32 bits). Pairs of at most
    ``dense`` leaves are compared directly.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    top = np.uint64(64 - depth)
    err0 = 0 if own or depth == 0 else int(np.bitwise_count((a[0] >> top) ^ (b[0] >> top)))
    first = max_bits // 2
    al, ah, bl, bh = (np.array([x]) for x in (0, len(a), 0, len(b)))
    err = np.array([err0])
    outs_a, outs_b = [], []
    while True:
        same = (al == bl) & own
        ok = (err <= (first if depth <= HALF else max_bits)) & (ah > al) & (bh > bl) & ~(same & (ah - al < 2))
        al, ah, bl, bh, err = (x[ok] for x in (al, ah, bl, bh, err))
        if not len(al):
            break
        small = ((ah - al) * (bh - bl) <= dense) | (depth == 64)
        if small.any():
            na, nb = (ah - al)[small], (bh - bl)[small]
            i = np.repeat(ranges(al[small], na), np.repeat(nb, na))
            j = ranges(np.repeat(bl[small], na), np.repeat(nb, na))
            keep = (i < j) if own else np.ones(len(i), bool)
            x = a[i] ^ b[j]
            keep &= (np.bitwise_count(x) <= max_bits) & (np.bitwise_count(x >> np.uint64(HALF)) <= first)
            outs_a.append(i[keep])
            outs_b.append(j[keep])
            al, ah, bl, bh, err = (y[~small] for y in (al, ah, bl, bh, err))
            if not len(al):
                break
        shift = np.uint64(63 - depth)
        one = np.uint64(1)
        sa = np.clip(np.searchsorted(a, ((a[al] >> shift) | one) << shift), al, ah)
        sb = np.clip(np.searchsorted(b, ((b[bl] >> shift) | one) << shift), bl, bh)
        same = (al == bl) & own
        depth += 1
        x = ~same  # (0,0) (1,1) (0,1) and, for two different nodes, (1,0)
        al, ah, bl, bh, err = (
            np.concatenate(p) for p in (
                (al, sa, al, sa[x]), (sa, ah, sa, ah[x]), (bl, sb, sb, bl[x]), (sb, bh, bh, sb[x]),
                (err, err, err + 1, err[x] + 1)))
    if not outs_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(outs_a), np.concatenate(outs_b)


def _leaves(keys: DataFrame, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and depth of each shard: nodes of 8, 16, 24 or 32 bits, split while they hold more than ``cap``.

    At most total / cap nodes of a level are split into 256, so with cap at
    least total / 1024 the driver sees at most 4 x 262,144 counts.
    """
    crowded, leaves = None, []
    for depth in (8, 16, 24, 32):
        path = F.shiftrightunsigned("key", 64 - depth)
        at = keys
        if crowded is not None:
            parents = keys.sparkSession.createDataFrame([(int(p),) for p in crowded], "parent long")
            at = keys.withColumn("parent", F.shiftrightunsigned("key", 72 - depth)).join(F.broadcast(parents), "parent", "left_semi")
        found = {int(r[0]): r[1] for r in at.groupBy(path.alias("p")).count().collect()}
        nodes = range(256) if crowded is None else [p * 256 + i for p in crowded for i in range(256)]
        crowded = [p for p in nodes if found.get(p, 0) > cap and depth < HALF]
        split = set(crowded)
        leaves += [(p << (64 - depth), depth) for p in nodes if p not in split]
        if not crowded:
            break
    leaves.sort()
    return np.array([x for x, _ in leaves], np.uint64), np.array([d for _, d in leaves], np.int64)


def trie_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u long, v long): links between the distinct ``fp`` values at most ``max_bits`` bits apart.

    Every group reduces its links to a spanning forest before it emits them, so
    the rows returned have the same components as all links and stay linear.
    """
    total = fps.count()
    cap = max(2048, total // 1024)
    masks = np.array([m << HALF for m in flips(HALF, max_bits // 2)], np.uint64)
    both = F.shiftleft("fp", HALF).bitwiseOR(F.shiftrightunsigned("fp", HALF))
    plans = [_leaves(fps.select(F.col("fp").alias("key")), cap), _leaves(fps.select(both.alias("key")), cap)]

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy().view(np.uint64)
            for t, (starts, depths) in enumerate(plans):
                key = _swap(fp) if t else fp
                home = np.searchsorted(starts, key, "right") - 1
                near = np.searchsorted(starts, key[:, None] ^ masks[None, :], "right") - 1
                near.sort(axis=1)
                first = np.ones_like(near, bool)
                first[:, 1:] = near[:, 1:] != near[:, :-1]
                row, col = np.nonzero(first)
                n, h = near[row, col], home[row]
                yield pd.DataFrame({"t": t, "a": np.minimum(n, h), "b": np.maximum(n, h), "in_a": h <= n,
                                    "fp": f["fp"].to_numpy()[row]})

    def join(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        t, la, lb = key
        path = f["fp"].to_numpy().view(np.uint64)
        path = _swap(path) if t else path
        depth = int(min(plans[t][1][la], plans[t][1][lb]))
        left = f["in_a"].to_numpy()
        a = np.sort(path[left] if la != lb else path)
        b = None if la == lb else np.sort(path[~left])
        i, j = trie_pairs(a, b, depth, max_bits)
        u, v = a[i], (a if b is None else b)[j]
        if t:  # found in the first trie already
            keep = np.bitwise_count((u ^ v) & np.uint64(0xFFFFFFFF)) > max_bits // 2
            u, v = _swap(u[keep]), _swap(v[keep])
        u, v = local_forest(u.view(np.int64), v.view(np.int64))
        return pd.DataFrame({"u": u, "v": v})

    routed = fps.mapInPandas(route, "t int, a long, b long, in_a boolean, fp long")
    return routed.groupBy("t", "a", "b").applyInPandas(join, "u long, v long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id (smallest id reachable, itself included),
    row_key (a hash of id and text) and component_fp (one fingerprint of the component).

    Null text is empty text; texts without words have fingerprint zero and are
    linked like any other. Repeated rows stay repeated rows of one component.
    Rows whose id is null keep a null id and never name a component that has
    another id. An empty table gives no rows. Only the id and text columns are
    read, whatever else the table holds.
    """
    prepare(df.sparkSession)
    rows = materialize(fingerprints(df, id_col, text_col, shingle), "simhash")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    linked = components(trie_links(classes.select("fp"), max_bits), "u", "v")
    linked = linked.join(classes, linked.node == classes.fp).select("fp", "root", "first")
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    grouped = linked.join(lowest, "root").select("fp", "component_id", "root")
    named = classes.join(grouped, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("root", "fp").alias("component_fp"))
    named = materialize(named, "simhash-components")  # so that both sides are dealt anew and a hot fingerprint can be split
    return rows.join(named, "fp").select("doc_id", "fingerprint", "component_id", "row_key", "component_fp")
