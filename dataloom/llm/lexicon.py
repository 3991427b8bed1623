"""Word-level BPE through a minimal acyclic transducer of frequent words.

The frequent words of the corpus are compiled, with their token ids, into the
smallest acyclic automaton that accepts them: common prefixes and common
suffixes are shared, and each arc carries a number such that the numbers along
a word's path add up to the word's place in the table of outputs. The automaton
is one file that every worker maps into memory. A word that is not in it is
merged exactly, by the merge ranks of the vocabulary.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import struct
import tempfile
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, prepare, texts
from dataloom.llm.packing import read_vocabulary

_CACHE_WORDS = 300_000


def compile_words(outputs: dict[bytes, bytes]) -> bytes:
    """The transducer of the words with their outputs, as the bytes of its file."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    sizes: list[int] = []  # words accepted from each state on

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            sizes.append(int(node[0]) + sum(sizes[t] for _, t in node[1]))
        return register[key]

    path: list[list] = [[False, []]]
    previous = b""
    ordered = sorted(outputs)
    for word in ordered:
        common = len(os.path.commonprefix([previous, word]))
        while len(path) > common + 1:
            done = settle(path.pop())
            path[-1][1].append((previous[len(path) - 1], done))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        done = settle(path.pop())
        path[-1][1].append((previous[len(path) - 1], done))
    root = settle(path.pop())
    first, labels, targets, numbers = [0], bytearray(), [], []
    for final, arcs in states:
        n = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            numbers.append(n)
            n += sizes[target]
        first.append(len(labels))
    ends = np.cumsum([0] + [len(outputs[w]) for w in ordered])
    parts = [bytes(labels), np.array(first, "<i4").tobytes(), np.array(targets, "<i4").tobytes(), np.array(numbers, "<i4").tobytes(),
             bytes(f for f, _ in states), ends.astype("<i4").tobytes(), b"".join(outputs[w] for w in ordered)]
    return struct.pack("<8i", root, *map(len, parts)) + b"".join(p + bytes(-len(p) % 4) for p in parts)


class Transducer:
    """A compiled automaton, mapped into memory."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *lengths = struct.unpack_from("<8i", self.data)
        at, views = 32, []
        for n in lengths:
            views.append((at, at + n))
            at += n + -n % 4
        view = memoryview(self.data)
        self.labels = views[0][0]
        self.first, self.targets, self.numbers = (view[a:b].cast("i") for a, b in views[1:4])
        self.final = view[slice(*views[4])]
        self.ends = view[slice(*views[5])].cast("i")
        self.outputs = view[slice(*views[6])]

    def find(self, word: bytes) -> bytes | None:
        state, number = self.root, 0
        first, base, look = self.first, self.labels, self.data.find
        for i in range(len(word)):
            arc = look(word[i:i + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            number += self.numbers[arc]
            state = self.targets[arc]
        if not self.final[state]:
            return None
        return bytes(self.outputs[self.ends[number]:self.ends[number + 1]])


def _merger(vocab: dict[str, int], merges: list, suffix: str, whole) -> Callable[[str], bytes]:
    """Exact merging of one word: ids, little-endian unsigned 32-bit.

    Words over Latin letters take a merge kernel over bytes. It knows no
    word-end symbol, so a word's last byte is written as another byte that no
    such word holds; letters, continuation bytes and both their last forms fit
    into 256 values. All other words go through the tokenizer.
    """
    import tiktoken

    from dataloom.llm.packing import _byte_of_symbol

    as_byte = _byte_of_symbol()
    inner = [*range(97, 123), *range(0x80, 0xC0), 0xC2, 0xC3, 0xC4, 0xC5]
    last = [*range(97, 123), *range(0x80, 0xC0)]
    to_inner = {b: i for i, b in enumerate(inner)}
    to_last = {b: len(inner) + i for i, b in enumerate(last)}
    ranks: dict[bytes, int] = {}
    for token, i in vocab.items():
        body, ends = (token[: -len(suffix)], True) if token.endswith(suffix) else (token, False)
        raw = [as_byte.get(c) for c in body]
        if raw and None not in raw and all(b in to_inner for b in raw[:-1]) and raw[-1] in (to_last if ends else to_inner):
            ranks[bytes([to_inner[b] for b in raw[:-1]] + [(to_last if ends else to_inner)[raw[-1]]])] = i
    merged = [vocab[m.replace(" ", "", 1) if isinstance(m, str) else "".join(m)] for m in merges]
    usable = merged == sorted(set(merged)) and all(bytes([i]) in ranks for i in range(len(inner) + len(last)))
    spare = [i for i in range(256) if bytes([i]) not in ranks]
    ranks |= {bytes([i]): 1 << 30 | i for i in spare}  # the kernel wants every byte; these never occur
    table = bytes(to_inner.get(i, 255) for i in range(256))
    end_table = bytes(to_last.get(i, 255) for i in range(256))
    kernel = tiktoken.Encoding("word", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def merge(word: str) -> bytes:
        raw = word.encode()
        if usable:
            piece = raw[:-1].translate(table) + raw[-1:].translate(end_table)
            if 255 not in piece:
                return array("I", kernel(piece)).tobytes()
        return np.array(whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    return merge


@lru_cache(maxsize=1)
def unassigned() -> list[tuple[int, int]]:
    """Ranges of code points below U+10000 that have no category here: libraries of another Unicode version may know them as letters."""
    out: list[tuple[int, int]] = []
    for c in range(0x10000):
        if unicodedata.category(chr(c)) == "Cn":
            if out and out[-1][1] == c - 1:
                out[-1] = (out[-1][0], c)
            else:
                out.append((c, c))
    return out


class WordEncoder:
    """ids of a text under a ``tokenizers`` file of the kind that lower-cases, drops white space and marks word ends."""

    def __init__(self, vocabulary: str, transducer: Transducer | None) -> None:
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(vocabulary)
        self.whole.no_padding()
        self.whole.no_truncation()
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.normal = self.whole.normalizer.normalize_str
        self.merge = _merger(model["vocab"], model["merges"], model["end_of_word_suffix"], self.whole)
        self.transducer = transducer
        self.cache: dict[str, bytes] = {}
        self.odd_space = re.compile(r"[\x1c-\x1f]")  # separators that Python takes for spaces
        self.unassigned = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(z))}" for a, z in unassigned()) + "]")
        self.high = re.compile("[\U00010000-\U0010ffff]")
        # beyond Latin (and for the dotted I) normalising may end a letter in a mark, which then joins the stop
        self.joined_stop = re.compile(r"[.,][^\w\s]|[^\w\s][.,]|_[.,]|[.,]_|[\u0130\u0250-\U0010ffff]")

    def odd(self, text: str) -> bool:
        """Whether a text goes through the tokenizer whole: it holds odd separators, or code points whose kind depends on the version of Unicode."""
        if self.odd_space.search(text):
            return True
        if text.isascii():
            return False
        return bool(self.unassigned.search(text)) or any(unicodedata.category(c) == "Cn" for c in set(self.high.findall(text)))

    def chunk(self, chunk: str) -> bytes:
        """ids of a run without white space."""
        plain = chunk.lower() if chunk.isascii() else self.normal(chunk)
        words = [plain] if plain.isalpha() else self.pattern.findall(plain)
        out = b""
        for w in words:
            got = self.transducer.find(w.encode()) if self.transducer else None
            out += self.merge(w) if got is None else got
        return out

    def encode(self, text: str) -> bytes:
        if self.odd(text) or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not self.joined_stop.search(text):  # stops that stand by themselves are words by themselves
            text = text.replace(",", " , ").replace(".", " . ")
        cache, parts = self.cache, []
        for c in text.split():
            ids = cache.get(c)
            if ids is None:
                if len(cache) >= _CACHE_WORDS:
                    cache.clear()
                ids = cache[c] = self.chunk(c)
            parts.append(ids)
        return b"".join(parts)


def frequent_words(df: DataFrame, text_col: str, words: int, times: int = 8) -> list[str]:
    """The most frequent of the words that some batch of texts holds at least ``times``; at most ``words`` of them.

    All texts are counted, and no more than ``words`` words reach the driver:
    those of at least the least power of two that leaves so few. The choice
    decides only which words are looked up instead of merged, never an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count: Counter[str] = Counter()
            for t in texts(b.column(0)):
                count.update(t.lower().replace(",", " ").replace(".", " ").split())
            often = {w: n for w, n in count.items() if n >= times and len(w) <= 64}
            yield pa.RecordBatch.from_pydict({"word": pa.array(often.keys(), pa.string()), "n": pa.array(often.values(), pa.int64())})

    counted = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    counted = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")).withColumn("size", F.floor(F.log2("n"))), "frequent-words")
    left, least = words, None
    for r in sorted(counted.groupBy("size").count().collect(), reverse=True):  # one row per power of two
        left -= r["count"]
        if left < 0:
            break
        least = r["size"]
    return [] if least is None else [r["word"] for r in counted.where(F.col("size") >= least).select("word").collect()]


def encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 20_000) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids as little-endian unsigned 32-bit integers, one row per input row.

    Null and empty texts have no ids. Repeated rows stay; a null id stays null.
    An empty table gives no rows.
    """
    spark = df.sparkSession
    prepare(spark)
    vocabulary = read_vocabulary(tokenizer_path)
    by_merging = WordEncoder(vocabulary, None)
    alike = {}
    for w in frequent_words(df, text_col, lexicon_words):
        for part in by_merging.pattern.findall(by_merging.normal(w)):
            alike[part.encode()] = by_merging.merge(part)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(local, "wb") as f:
        f.write(compile_words(alike))
    spark.sparkContext.addFile(local)  # Spark ships the file to every executor
    shared = spark.sparkContext.broadcast(vocabulary)  # the vocabulary file, of fixed size
    made: dict[str, WordEncoder] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in made:
            made["encoder"] = WordEncoder(shared.value, Transducer(SparkFiles.get(name)))
        for b in batches:
            ids = [made["encoder"].encode(t) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the tokens of the ids joined by blanks, special tokens included; null ids: empty."""
    spark = encoded.sparkSession
    prepare(spark)
    spec = json.loads(read_vocabulary(tokenizer_path))
    if spec.get("decoder"):
        raise ValueError("this vocabulary has a decoder of its own")
    by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    shared = spark.sparkContext.broadcast({i: t.encode() for i, t in by_id.items()})  # one entry per token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for b in batches:
            out = []
            for x in b.column(ids_col):
                ids = array("I")
                ids.frombytes(x.as_py() or b"")
                out.append(b" ".join(map(token, ids)).decode())
            yield b.append_column("decoded", pa.array(out, pa.string()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, fields + ", decoded string")
