"""Sum-of-squares packing of documents into token sequences.

Documents become pieces of at most ``capacity`` tokens. An open sequence has a
residual gap; N(g) counts the open sequences of gap g. Each piece goes where the
sum of N(g)^2 becomes smallest: into a gap that is common and leaves one that is
rare (or none). Offline the pieces of a group are taken by decreasing length.

Pieces are dealt by hash over groups of bounded size that are packed side by
side; the loosely filled sequences of all groups are dissolved and packed once
more in fewer groups, so the ends of the groups cost next to nothing.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, prepare, texts

_CACHE_WORDS = 400_000


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: itself, or the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_encoder(vocabulary: str) -> Callable[[str], bytes]:
    """Ids (little-endian unsigned 32-bit) of a text under a byte-level BPE file of ``tokenizers``, given as JSON.

    White space is a border of the file's word pattern, so a text whose blanks
    stand alone falls into chunks that encode independently of each other;
    their ids are kept in a bounded cache. Other texts, and texts with special
    tokens, go through the tokenizer whole.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary)
    spec = json.loads(vocabulary)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    special = [t["content"] for t in spec["added_tokens"]]
    as_byte = _byte_of_symbol()
    merged = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in merges]
    ids = [vocab[m] for m in merged]
    plain = (spec["normalizer"] is None and spec["pre_tokenizer"].get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex")
             and not spec["pre_tokenizer"].get("add_prefix_space") and ids == sorted(set(ids)))

    def encode_whole(text: str) -> bytes:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    if not plain:
        return encode_whole
    import public_tokenizers

    ranks = {bytes(as_byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    merger = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    merge, merge_word = merger.encode_ordinary, merger._encode_single_piece

    class Chunks(dict):
        """Ids of a chunk by its text."""

        def __missing__(self, chunk: str) -> bytes:
            if len(self) >= _CACHE_WORDS:
                self.clear()
            ids = merge_word(chunk) if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()) else merge(chunk)
            got = self[chunk] = array("I", ids).tobytes()
            return got

    ids_of = Chunks().__getitem__
    other_space, joined_stop = re.compile(r"[^\S \n]"), re.compile(r"[\W_][.,]")

    def encode(text: str) -> bytes:
        single = text.count(" ") + text.count("\n") == len(text.split()) - 1 and text[0] not in " \n.,"
        if not single or other_space.search(text) or any(s in text for s in special) or "\0" in text:
            return encode_whole(text)
        # a lone blank, and a stop after a letter or number, begin a new word of the file's pattern
        marked = text.replace(" ", "\0 ").replace("\n", "\0\n")
        if not joined_stop.search(text):
            marked = marked.replace(",", "\0,").replace(".", "\0.")
        return b"".join(map(ids_of, marked.split("\0")))

    return encode


def pieces(df: DataFrame, vocabulary: str, id_col: str, text_col: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and then ``end_id``; only longer ones are cut.

    The cut leaves full pieces at the end, so the first piece may be shorter.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # the vocabulary file, of fixed size
    end = np.array([end_id], "<u4").tobytes()
    made: dict[str, Callable[[str], bytes]] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = made.get("encode") or made.setdefault("encode", byte_level_encoder(shared.value))
        for b in batches:
            rows: list[tuple] = []
            for i, text in enumerate(texts(b.column(1))):
                data = encode(text) + end
                n = len(data) // 4
                start, length = 0, n % capacity or capacity
                piece = 0
                while start < n:
                    rows.append((i, piece, start, length, zlib.crc32(data[4 * start: 4 * (start + length)])))
                    start, piece, length = start + length, piece + 1, capacity
            who, *rest = zip(*rows) if rows else ([], [], [], [], [])
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(who, pa.int64())), *(pa.array(x, k) for x, k in zip(rest, kinds))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the given order."""
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        # change of the sum: gap g loses a bin, gap g - size gains one (a full bin has no gap)
        gain = 2 * count[: capacity + 1 - size] + 1
        gain[0] = 0
        change = np.where(count[size:] > 0, gain - 2 * count[size:] + 1, never)
        gap = int(change.argmin())
        new = gain[capacity - size]
        if change[gap] <= new:
            gap += size
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            b, made, gap = made, made + 1, capacity
        bins[k], offsets[k] = b, capacity - gap
        if gap > size:
            open_bins[gap - size].append(b)
            count[gap - size] += 1
    return bins, offsets


def _pack(rows: DataFrame, groups: int, capacity: int, tag: int) -> DataFrame:
    """Rows with (seq, at, fill); ``seq`` is unique over groups and tags."""

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        size = f["length"].to_numpy()
        b, at = sum_of_squares(size, capacity)
        fill = np.bincount(b, weights=size).astype(np.int64)
        return f.drop(columns="g").assign(seq=(key[0] * 2 + tag) * (1 << 32) + b, at=at, fill=fill[b])

    dealt = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(tag)), F.lit(groups)).cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, seq long, at long, fill long"
    return dealt.groupBy("g").applyInPandas(run, schema)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int = 0, group_pieces: int = 4096, tight: float = 0.995) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the one token ``end_id``. Rows with equal or null
    ids are packed as separate documents. An empty table gives no rows. Offsets
    in a sequence follow each other without gaps from 0.
    """
    prepare(df.sparkSession)
    cut = materialize(pieces(df, read_vocabulary(tokenizer_path), id_col, text_col, end_id, capacity), "pieces")
    n = cut.count()
    packed = materialize(_pack(cut, max(1, math.ceil(n / group_pieces)), capacity, 0), "packed")
    again = packed.where(F.col("fill") < tight * capacity).drop("seq", "at", "fill")
    m = again.count()
    second = _pack(again, max(1, math.ceil(m / group_pieces)), capacity, 1) if m else packed.limit(0)
    done = packed.where(F.col("fill") >= tight * capacity).unionByName(second)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), F.col("at").alias("offset"))
