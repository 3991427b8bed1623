"""Online sum-of-squares packing of documents into windows of tokens.

A level array counts the windows of each fill. A document that arrives is put
into the fill level (or an empty window) after which the sum of the squared
counts of partially filled windows is smallest. A window is *done* at the
full capacity and at any power of two, which need no padding, so these levels
weigh nothing.

Documents are dealt at random over groups of bounded size that are packed side
by side. Windows still partially filled when a group's documents are used up
are closed by cutting: the emptiest give their tokens to fill up the others,
and what is then left over is cut into powers of two. So no window is padded,
and only documents of windows that stayed open are cut besides those longer
than a window.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, prepare, texts
from dataloom.llm.packing import byte_level_encoder, read_vocabulary


def done_levels(capacity: int) -> np.ndarray:
    """Fills that need no padding: nothing, the powers of two and the capacity."""
    done = np.zeros(capacity + 1, bool)
    done[[0, capacity, *(1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity)]] = True
    return done


class Levels:
    """The level array: how many windows have each fill, and which."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.weight = (~done_levels(capacity)).astype(np.int64)
        self.never = np.iinfo(np.int64).max // 2
        #: change of the sum when a window comes to a level, and when one leaves it (never, where there is none)
        self.come = self.weight.copy()
        self.leave = np.full(capacity + 1, self.never)
        self.leave[0] = 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def _set(self, level: int) -> None:
        n, w = len(self.open[level]), int(self.weight[level])
        self.come[level] = w * (2 * n + 1)
        self.leave[level] = w * (1 - 2 * n) if n else self.never

    def place(self, size: int) -> tuple[int, int]:
        """Window and offset of a piece; of equally good levels the fullest."""
        last = self.capacity - size
        change = self.come[size:] + self.leave[: last + 1]
        level = last - int(change[::-1].argmin())
        if level:
            window = self.open[level].pop()
            self._set(level)
        else:
            window, self.made = self.made, self.made + 1
        if level + size < self.capacity:
            self.open[level + size].append(window)
            self._set(level + size)
        return window, level


def close(fills: list[int], capacity: int) -> tuple[int, list[int]]:
    """How many of the windows (fullest first) are filled up, and the sizes of the windows cut from what is left over.

    The windows after the first ones give all their tokens, in order.
    """
    size = np.array(fills, np.int64)
    given = np.concatenate([np.cumsum(size[::-1])[::-1], [0]])  # tokens of windows k and on
    wanted = np.concatenate([[0], np.cumsum(capacity - size)])  # gaps of windows before k
    kept = int(np.flatnonzero(given >= wanted)[-1])
    over = int(given[kept] - wanted[kept])
    bits = [1 << k for k in reversed(range(capacity.bit_length())) if over % capacity >> k & 1]
    return kept, [capacity] * (over // capacity) + bits


def pack_group(sizes: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(item, from, length, window, offset) of all pieces of a group's items, which arrive in this order."""
    levels, where = Levels(capacity), []
    for size in sizes:
        if size == capacity:
            where.append((levels.made, 0))
            levels.made += 1
        else:
            where.append(levels.place(size))
    done = done_levels(capacity)
    left = sorted(((fill, w) for fill, ws in enumerate(levels.open) for w in ws if not done[fill]), key=lambda x: (-x[0], x[1]))
    if not left:
        return [(i, 0, size, w, at) for i, (size, (w, at)) in enumerate(zip(sizes, where))]
    kept, cut = close([fill for fill, _ in left], capacity)
    giving = {w: k for k, (_, w) in enumerate(left[kept:])}
    out = [(i, 0, sizes[i], w, at) for i, (w, at) in enumerate(where) if w not in giving]
    # the places to fill, one after the other, and the tokens given, one after the other
    places = [(w, fill, capacity - fill) for fill, w in left[:kept]] + [(levels.made + k, 0, size) for k, size in enumerate(cut)]
    stream = sorted(((giving[w], at, i) for i, (w, at) in enumerate(where) if w in giving))
    at_place, used = 0, 0
    for _, _, i in stream:
        taken = 0
        while taken < sizes[i]:
            w, begin, room = places[at_place]
            n = min(room - used, sizes[i] - taken)
            out.append((i, taken, n, w, begin + used))
            taken, used = taken + n, used + n
            if used == room:
                at_place, used = at_place + 1, 0
    return out


def pieces(df: DataFrame, vocabulary: str, id_col: str, text_col: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids_crc32, ids): full windows of longer documents, then the rest with its ids."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # the vocabulary file, of fixed size
    width = id_type(vocabulary, end_id)
    end = np.array([end_id], "<u4").tobytes()
    made: dict[str, Callable[[str], bytes]] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = made.get("encode") or made.setdefault("encode", byte_level_encoder(shared.value))
        for b in batches:
            rows: list[tuple] = []
            for i, text in enumerate(texts(b.column(1))):
                data = (encode(text) if text else b"") + end
                n = len(data) // 4
                full = n - n % capacity
                rows += [(i, k, capacity, n, zlib.crc32(data[4 * k: 4 * (k + capacity)]), None) for k in range(0, full, capacity)]
                if n > full:
                    rest = data[4 * full:]
                    rows.append((i, full, n - full, n, zlib.crc32(rest), np.frombuffer(rest, "<u4").astype(width).tobytes()))
            who, *rest = zip(*rows) if rows else ([],) * 6
            kinds = (*(pa.int64(),) * 4, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who, pa.int64())), *(pa.array(x, k) for x, k in zip(rest, kinds))],
                                             ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary")


def id_type(vocabulary: str, end_id: int) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    spec = json.loads(vocabulary)
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if top < 1 << 16 else "<u4"


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         end_id: int = 0, group_pieces: int = 16_384) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the one token ``end_id``. Rows with equal or null
    ids, and repeated rows, are documents of their own. An empty table gives no rows;
    other columns are not read. Every sequence holds ``capacity`` tokens or a power of two of
    them, without gaps from offset 0.
    """
    spark = df.sparkSession
    prepare(spark)
    vocabulary = read_vocabulary(tokenizer_path)
    width = id_type(vocabulary, end_id)
    made = pieces(df, vocabulary, id_col, text_col, end_id, capacity)
    # the number is written with the row: whatever is read again later is dealt the same way
    made = materialize(made.withColumn("n", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(made.count() / group_pieces))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("n")
        size = t["length"].to_numpy()
        row, begin, length, window, offset = np.array(pack_group(size.tolist(), capacity), np.int64).T
        crc = t["ids_crc32"].to_numpy()[row]
        for k in np.flatnonzero(length != size[row]).tolist():
            ids = np.frombuffer(t["ids"][int(row[k])].as_buffer(), width)[begin[k]: begin[k] + length[k]]
            crc[k] = zlib.crc32(ids.astype("<u4").tobytes())
        taken = t.select(["doc_id", "doc_tokens"]).take(pa.array(row))
        return pa.table({"doc_id": taken["doc_id"], "start": t["start"].to_numpy()[row] + begin, "length": length, "ids_crc32": crc,
                         "doc_tokens": taken["doc_tokens"], "sequence_id": key[0].as_py() * (1 << 32) + window, "offset": offset})

    dealt = made.withColumn("g", F.pmod(F.xxhash64("n"), F.lit(groups)).cast("long"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("g").applyInArrow(run, schema)
