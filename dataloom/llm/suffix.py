"""Repeated passages by prefix-partitioned suffix trees, cut at the depth that matters.

A passage repeats when two suffixes of the corpus share their first ``window``
words, that is, when the suffix tree has a node of that depth with two leaves.
Only such nodes are looked for, so the trees are cut there, and a suffix is
represented by the hash of its path to that depth.

* Suffixes are split into groups by a prefix: the run of words of least hash
  that starts inside the window (its *anchor*). Equal windows have equal
  anchors at equal places, so a group holds whole subtrees. The first prefixes
  are 8 words long; about one position in fourteen is an anchor, and suffixes
  whose anchor stands nowhere else are leaves and are never moved.
* A group of at most ``group_rows`` rows fits a task: its paths are sorted in a
  partition, and neighbours that agree to the full depth are the leaves of one
  deep node.
* A larger group's prefix is lengthened: its suffixes are split anew by anchors
  of 16 words, where these crowd again by those of 32, and what is crowded
  still by the whole path, whose counts are added up in each task before they
  are shuffled. A line that all texts share is thus told apart by what stands around
  it, and a passage that all share never meets in one task. Every step has at
  most one row per window, so the work stays linear in the words.

Counts cover all documents; nothing is sampled or cut. Paths are 64-bit hashes
of word sequences, compared only where the 64-bit hashes of their prefixes agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dataloom.llm.common import materialize, named, prepare

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x, np.uint64)])) for x in (_BASE, _INVERSE))
        return self.up, self.down


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any run of words follows, and the inverse powers."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    up, down = _POWERS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(h * up[: len(words)], out=sums[1:])
    return sums, down


def _runs(sums: np.ndarray, down: np.ndarray, size: int) -> np.ndarray:
    n = len(sums) - size
    return (sums[size:] - sums[:n]) * down[:n]


def _least(grams: np.ndarray, span: int) -> np.ndarray:
    """For each window the place of the least of its ``span`` grams (the first, if equal)."""
    return np.lib.stride_tricks.sliding_window_view(_mix(grams), span).argmin(axis=1) + np.arange(len(grams) - span + 1)


def _anchors(sums: np.ndarray, down: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor positions, first window start and number of windows of each, prefix hashes."""
    grams = _runs(sums, down, gram)
    least = _least(grams, window - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    at = least[first]
    return at, first, np.diff(np.concatenate([first, [len(least)]])), grams[at]


def _longer(sums: np.ndarray, down: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place and the hash of its anchor of ``gram`` words."""
    grams = _runs(sums, down, gram)
    least = _least(grams, window - gram + 1)
    return least, grams[least]


def _words(x: pa.Scalar) -> list[bytes]:
    return (x.as_py() or "").encode().split()


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   gram: int = 8, group_rows: int = 1000, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, text (kept words joined by one space), rest.

    A word goes if a run of ``window`` words that covers it also starts anywhere
    else, judged on the input. ``text`` is the untouched input where nothing
    goes. ``rest`` is a struct of the ``carry`` columns. Null text has no words
    and comes back null with zero counts; texts shorter than the window lose
    nothing; a repeated row is one more copy, so both lose their windows; rows
    with equal or null ids are still separate documents. An empty table gives
    no rows. Columns not named are not read.
    """
    prepare(df.sparkSession)
    rest = F.struct(*[named(c) for c in carry]) if carry else F.lit(None).cast("string")
    docs = df.select(named(id_col).alias("did"), named(text_col).cast("string").alias("text"), rest.alias("rest"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    spec = "did {0}, th long".format(docs.schema["did"].dataType.simpleString())
    second, third = min(2 * gram, window), min(4 * gram, window)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ats, rows = [], [], []
            for i, x in enumerate(b.column("text")):
                words = _words(x)
                if len(words) >= window:
                    at, _, _, key = _anchors(*_hashes(words), window, gram)
                    keys.append(key.view(np.int64))
                    ats.append(at.astype(np.int32))
                    rows.append(np.full(len(at), i))
            if keys:
                who = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column("did").take(who), b.column("th").take(who), pa.array(np.concatenate(keys)), pa.array(np.concatenate(ats))],
                    ["did", "th", "key", "at"])

    found = materialize(docs.select("did", "th", "text").mapInArrow(anchors, spec + ", key long, at int"), "anchors")
    # counts are written, so that joins deal both sides anew and a common prefix can be split
    twice = materialize(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-anchors")
    marked = found.join(twice, "key").groupBy("did", "th").agg(
        F.collect_list(F.struct("at", (F.col("n") > group_rows).alias("crowded"))).alias("marks"))
    marked = materialize(marked, "anchors-of-documents")

    def same(other: DataFrame) -> F.Column:
        return docs["did"].eqNullSafe(other["did"]) & (docs["th"] == other["th"])

    def lists(values: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, np.int64)]), pa.int64()))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of suffixes with one anchor that stands elsewhere too: its hash, the first start, and the paths of all.

        Where the anchor is crowded: the same by anchors of the second length, with the hashes of the third.
        """
        for b in batches:
            who, crowded, keys, starts, paths, finer = [], [], [], [], [], []
            for i, (x, marks) in enumerate(zip(b.column("text"), b.column("marks").to_pylist())):
                sums, down = _hashes(_words(x))
                at, first, size, key = _anchors(sums, down, window, gram)
                path = _mix(_runs(sums, down, window)).view(np.int64)
                full = {m["at"] for m in marks if m["crowded"]}
                more = [_longer(sums, down, window, g) for g in (second, third)] if full else None
                for k in np.searchsorted(at, sorted({m["at"] for m in marks})).tolist():
                    lo, hi = int(first[k]), int(first[k] + size[k])
                    if int(at[k]) not in full:
                        who.append(i)
                        crowded.append(False)
                        keys.append(int(key[k].view(np.int64)))
                        starts.append(lo)
                        paths.append(path[lo:hi])
                        finer.append(path[:0])
                        continue
                    place = more[0][0][lo:hi]
                    cuts = [lo, *(np.flatnonzero(place[1:] != place[:-1]) + lo + 1).tolist(), hi]
                    for c, d in zip(cuts, cuts[1:]):
                        who.append(i)
                        crowded.append(True)
                        keys.append(int(more[0][1][c].view(np.int64)))
                        starts.append(c)
                        paths.append(path[c:d])
                        finer.append(more[1][1][c:d].view(np.int64))
            if who:
                w = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [b.column("did").take(w), b.column("th").take(w), pa.array(crowded), pa.array(keys, pa.int64()), pa.array(starts, pa.int32()),
                     lists(paths), lists(finer)], ["did", "th", "crowded", "key", "start", "path", "finer"])

    def intervals(t: pa.Table, row: np.ndarray, hit: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Runs of neighbouring repeated windows of a row, each as one range of words."""
        at = np.flatnonzero(hit)
        if not len(at):
            return
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])])
        head = at[new]
        tail = at[np.concatenate([new[1:], [True]])]
        offset = np.concatenate([[0], np.cumsum(sizes)])[row[head]]
        start = t["start"].to_numpy()[row[head]]
        out = t.select(["did", "th"]).take(pa.array(row[head])).combine_chunks()
        lo, hi = start + (head - offset), start + (tail - offset) + window
        out = out.append_column("lo", pa.array(lo.astype(np.int32))).append_column("hi", pa.array(hi.astype(np.int32)))
        yield from out.to_batches()

    def unpack(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All values of a list column, the row of each, and the rows' sizes."""
        flat = column.combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        sizes = flat.value_lengths().to_numpy()
        return flat.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes), sizes

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Deep nodes with two leaves in each prefix's tree; rows arrive sorted by prefix."""

        def nodes(t: pa.Table) -> Iterator[pa.RecordBatch]:
            if not t.num_rows:
                return
            key = t["key"].to_numpy()
            path, row, sizes = unpack(t["path"])
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))[row]
            order = np.lexsort((path, group))
            equal = (path[order][1:] == path[order][:-1]) & (group[order][1:] == group[order][:-1])
            hit = np.zeros(len(path), bool)
            hit[order[1:]] |= equal
            hit[order[:-1]] |= equal
            yield from intervals(t, row, hit, sizes)

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            key = t["key"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if len(key) and (key != key[-1]).any() else 0
            yield from nodes(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield from nodes(held)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The suffixes of each row anew, by the hashes of the next length."""
        for b in batches:
            t = pa.Table.from_batches([b])
            path, row, sizes = unpack(t["path"])
            if not len(path):
                continue
            finer = unpack(t["finer"])[0]
            head = np.flatnonzero(np.concatenate([[True], (finer[1:] != finer[:-1]) | (row[1:] != row[:-1])]))
            offset = np.concatenate([[0], np.cumsum(sizes)])[row[head]]
            out = t.select(["did", "th"]).take(pa.array(row[head])).combine_chunks()
            out = out.append_column("key", pa.array(finer[head])).append_column(
                "start", pa.array((t["start"].to_numpy()[row[head]] + head - offset).astype(np.int32)))
            ends = np.concatenate([head, [len(path)]]).astype(np.int32)
            yield from out.append_column("path", pa.ListArray.from_arrays(pa.array(ends), pa.array(path))).to_batches()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each prefix has each path, and the place of one such window, over up to a million windows at a time."""

        def added(t: pa.Table) -> Iterator[pa.RecordBatch]:
            path, row, sizes = unpack(t["path"])
            key = t["key"].to_numpy()[row]
            order = np.lexsort((path, key))
            new = (key[order][1:] != key[order][:-1]) | (path[order][1:] != path[order][:-1])
            first = np.flatnonzero(np.concatenate([[True], new]))
            at = order[first]
            lo = t["start"].to_numpy()[row[at]] + at - np.concatenate([[0], np.cumsum(sizes)])[row[at]]
            out = t.select(["did", "th", "key"]).take(pa.array(row[at])).combine_chunks()
            out = out.append_column("node", pa.array(path[at])).append_column("n", pa.array(np.diff(np.concatenate([first, [len(order)]]))))
            yield from out.append_column("lo", pa.array(lo.astype(np.int32))).to_batches()

        held: list[pa.RecordBatch] = []
        windows = 0
        for b in batches:
            held.append(b)
            windows += len(b.column("path").flatten())
            if windows >= 1_000_000:
                yield from added(pa.Table.from_batches(held))
                held, windows = [], 0
        if windows:
            yield from added(pa.Table.from_batches(held))

    def whole_paths(rows: DataFrame) -> DataFrame:
        """Runs of windows whose prefix is crowded at every length, and those of them (``hi`` null) whose path stands nowhere else.

        Nearly all of such windows are repeated, so the others are told: a path
        counted once brings the place of its only window along, and no row has to be looked up.
        A task adds up its windows before they are shuffled.
        """
        runs = rows.select("did", "th", F.col("start").alias("lo"), (F.col("start") + F.size("path") - 1 + window).cast("int").alias("hi"))
        counted = rows.select("did", "th", "key", "start", "path").mapInArrow(combine, spec + ", key long, node long, n long, lo int")
        alone = counted.groupBy("key", "node").agg(F.sum("n").alias("n"), F.first("did").alias("did"), F.first("th").alias("th"),
                                                   F.first("lo").alias("lo")).where("n = 1")
        return runs.unionByName(alone.select("did", "th", "lo", F.lit(None).cast("int").alias("hi")))

    joined = docs.join(marked, same(marked)).select(docs["did"], docs["th"], "text", "marks")
    kind = ", key long, start int, path array<long>"
    every = materialize(joined.mapInArrow(suffixes, spec + ", crowded boolean" + kind + ", finer array<long>"), "suffixes")

    def trees(rows: DataFrame) -> DataFrame:
        return rows.select("did", "th", "key", "start", "path").repartition("key").sortWithinPartitions("key").mapInArrow(
            subtrees, spec + ", lo int, hi int")

    repeats = trees(every.where("NOT crowded"))
    crowd = every.where("crowded")
    for length in (second, third):
        many = materialize(crowd.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-anchors")
        if many.isEmpty():
            crowd = None
            break
        told = crowd.join(many, "key")
        repeats = repeats.unionByName(trees(told.where(F.col("n") <= group_rows)))
        crowd = told.where(F.col("n") > group_rows)
        if length == second:
            crowd = materialize(crowd.select("did", "th", "start", "path", "finer").mapInArrow(split, spec + kind), "suffixes")
    if crowd is not None:
        repeats = repeats.unionByName(whole_paths(crowd))
    repeats = repeats.groupBy("did", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for x, cuts in zip(b.column("text"), b.column("cuts")):
                words = _words(x)
                total.append(len(words))
                if not cuts.is_valid:
                    gone.append(0)
                    kept.append(x.as_py())
                    continue
                spans = cuts.values
                lo, hi = spans.field("lo").to_numpy(), spans.field("hi").fill_null(-1).to_numpy()
                runs = hi >= 0
                step = np.zeros(len(words) + 1, np.int64)  # over windows, then over words
                np.add.at(step, lo[runs], 1)
                np.add.at(step, hi[runs] - window + 1, -1)
                step = np.cumsum(step)
                step[lo[~runs]] = 0
                hit = np.flatnonzero(step)
                step = np.zeros(len(words) + 1, np.int64)
                step[hit] += 1
                step[hit + window] -= 1
                keep = np.cumsum(step)[:-1] == 0
                gone.append(int(len(words) - keep.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(keep)).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("did"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), b.column("rest")],
                ["doc_id", "n_words", "n_removed", "text", "rest"])

    out = docs.join(repeats, same(repeats), "left").select(docs["did"], "text", "cuts", "rest")
    made = StructType([StructField("doc_id", docs.schema["did"].dataType)]).add("n_words", "long").add("n_removed", "long").add("text", "string")
    return out.mapInArrow(cut, made.add("rest", docs.schema["rest"].dataType))


def kept_words(text: str) -> F.Column:
    """The words of a text joined by one space (null: empty)."""
    return F.coalesce(F.array_join(F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""), " "), F.lit(""))
