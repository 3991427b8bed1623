"""Toxic spans by a linear-chain conditional random field.

Documents are labelled, tokens are not, so token labels are derived first: a
word is a toxic term if it stands in far more contexts (its two neighbours) in
toxic documents than in clean ones. Contexts instead of occurrences keep the
words of a document that was copied many times from looking like evidence.

The field has two states (ordinary, toxic) and sees the evidence class of a
token's word and of its neighbours. It is trained by gradient ascent on the
labelled tokens of sentences of a bounded sample of labelled documents.
Forward-backward marginals of every sentence that holds a listed word are added
up per document; a logistic curve over them, fitted on the same sample, is the
document's score, and tokens more likely toxic than not are its offsets.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataloom.llm.common import held_out, materialize, prepare, texts

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
CLASSES = 8


@dataclass
class Model:
    evidence: dict[str, int]  # class of each listed word, 1 .. CLASSES - 1
    unary: np.ndarray  # bias, then class of the word, of the one before, of the one after
    arcs: np.ndarray  # [from, to]
    curve: np.ndarray  # intercept, sum of marginals, largest marginal, toxic share of the tokens


def _features(classes: np.ndarray) -> np.ndarray:
    """Indices of the active weights: (..., 4)."""
    before = np.concatenate([np.zeros_like(classes[:, :1]), classes[:, :-1]], axis=1)
    after = np.concatenate([classes[:, 1:], np.zeros_like(classes[:, :1])], axis=1)
    return np.stack([np.zeros_like(classes), 1 + classes, 1 + CLASSES + before, 1 + 2 * CLASSES + after], axis=-1)


def marginals(classes: np.ndarray, lengths: np.ndarray, unary: np.ndarray, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) per token, expected arcs per sentence, and the log partition; rows are padded sentences."""
    n, width = classes.shape
    emit = np.zeros((n, width, 2))
    emit[:, :, 1] = unary[_features(classes)].sum(axis=-1)
    alpha = np.empty((n, width, 2))
    alpha[:, 0] = emit[:, 0]
    for t in range(1, width):
        alpha[:, t] = emit[:, t] + np.logaddexp(alpha[:, t - 1, :1] + arcs[0], alpha[:, t - 1, 1:] + arcs[1])
    beta = np.zeros((n, width, 2))
    for t in range(width - 2, -1, -1):
        step = emit[:, t + 1] + beta[:, t + 1]
        new = np.logaddexp(arcs[:, 0] + step[:, :1], arcs[:, 1] + step[:, 1:])
        beta[:, t] = np.where((t + 1 < lengths)[:, None], new, 0.0)
    last = alpha[np.arange(n), lengths - 1]
    logz = np.logaddexp(last[:, 0], last[:, 1])
    inside = np.arange(width) < lengths[:, None]
    p = np.where(inside, np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - logz[:, None], 0.0)), 0.0)
    pair = alpha[:, :-1, :, None] + arcs + (emit + beta)[:, 1:, None, :] - logz[:, None, None, None]
    pair = np.where(inside[:, 1:, None, None], np.exp(np.minimum(pair, 0.0)), 0.0)
    return p, pair.sum(axis=1), logz


def _padded(sentences: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sentences])
    out = np.zeros((len(sentences), int(lengths.max())), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate(sentences)
    return out, lengths


def train_field(sentences: list[list[int]], labels: list[list[int]], rounds: int = 60, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of largest penalised likelihood, by Adam over groups of sentences of like length."""
    order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
    groups = []
    for a in range(0, len(order), 512):
        c, n = _padded([sentences[i] for i in order[a:a + 512]])
        y, _ = _padded([labels[i] for i in order[a:a + 512]])
        groups.append((c, n, y))
    tokens = sum(map(len, sentences))
    w = np.zeros(1 + 3 * CLASSES + 4)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        grad = -l2 * w
        for c, n, y in groups:
            p, pair, _ = marginals(c, n, w[:-4], w[-4:].reshape(2, 2))
            inside = np.arange(c.shape[1]) < n[:, None]
            rest = np.where(inside, y - p, 0.0)
            f = _features(c)
            grad[:-4] += np.bincount(f.ravel(), weights=np.repeat(rest.ravel(), 4), minlength=len(w) - 4) / tokens
            seen = np.bincount((2 * y[:, :-1] + y[:, 1:])[inside[:, 1:]], minlength=4)
            grad[-4:] += (seen - pair.sum(axis=0).ravel()) / tokens
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        w += 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return w[:-4], w[-4:].reshape(2, 2)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 0.05) -> np.ndarray:
    """Penalised logistic regression by Newton steps; x has a column of ones first."""
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (y - p)) - l2 * b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _suspect(text: str, evidence: dict[str, int]) -> tuple[list[list[int]], list[list[tuple[int, int]]], int]:
    """Sentences that hold a listed word: classes and offsets of their tokens; and the number of tokens of the text."""
    lowered = text.lower()
    words = _WORD.findall(lowered)
    if evidence.keys().isdisjoint(words):
        return [], [], len(words)
    if len(lowered) != len(text):  # offsets are those of the text itself
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    classes, places = [], []
    for s in _SENTENCE.finditer(lowered):
        found = [(m.start(), m.end(), evidence.get(m.group(), 0)) for m in _WORD.finditer(lowered, s.start(), s.end())]
        if any(c for _, _, c in found):
            classes.append([c for _, _, c in found])
            places.append([(a, b) for a, b, _ in found])
    return classes, places, len(words)


def _judge(batch: list[str], evidence: dict[str, int], unary: np.ndarray, arcs: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
    """Per text the features of the curve, and its spans."""
    x = np.zeros((len(batch), 4))
    x[:, 0] = 1.0
    spans: list[list[dict]] = [[] for _ in batch]
    sentences, places, owner = [], [], []
    tokens = np.ones(len(batch))
    for i, t in enumerate(batch):
        c, p, n = _suspect(t, evidence)
        tokens[i] = max(1, n)
        sentences += c
        places += p
        owner += [i] * len(c)
    total, most = np.zeros(len(batch)), np.zeros(len(batch))
    order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
    a = 0
    while a < len(order):  # sentences of like length, bounded in tokens
        z = a + 1
        while z < len(order) and z - a < 512 and (z - a + 1) * len(sentences[order[z]]) <= 200_000:
            z += 1
        pick = order[a:z]
        c, n = _padded([sentences[i] for i in pick])
        p = marginals(c, n, unary, arcs)[0]
        for row, i in enumerate(pick):
            own = p[row, : n[row]]
            total[owner[i]] += own.sum()
            most[owner[i]] = max(most[owner[i]], own.max())
            spans[owner[i]] += [{"start": places[i][k][0], "end": places[i][k][1], "p": float(own[k])} for k in np.flatnonzero(own >= 0.5)]
        a = z
    x[:, 1], x[:, 2], x[:, 3] = np.log1p(total), most, np.sqrt(total / tokens)
    for s in spans:
        s.sort(key=lambda d: d["start"])
    return x, spans


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_docs: int = 3000, clean_docs: int = 9000, sentences: int = 6000, longest: int = 120) -> Model | None:
    """The model of the labelled rows that are not held out; None without both labels.

    Learned on a bounded sample: at most ``toxic_docs`` and ``clean_docs``
    documents (least hash of the id first) and ``sentences`` sentences; those
    of more than ``longest`` tokens are cut into several, none of whose tokens
    is left out. A document labelled twice is toxic if any label is.
    """
    spark = df.sparkSession
    prepare(spark)
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label_col).cast("int")).alias("toxic")).where(~held_out("doc_id"))
    known = materialize(known, "labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    order = F.xxhash64("doc_id")
    # about twice each sample by hash, then its first rows: no task sees more
    some = [known.where((F.col("toxic") == y) & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(sizes[y])) < 2 * n)).orderBy(order, "doc_id").limit(n)
            for y, n in ((1, toxic_docs), (0, clean_docs))]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # bounded by the two limits
    sample = materialize(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "doc_id")
                         .select("text", "toxic"), "toxic-sample")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[tuple] = set()
            for text, toxic in zip(texts(b.column(0)), b.column(1).to_pylist()):
                words = ["", *_WORD.findall(text.lower()), ""]
                seen.update((w, a + " " + c, toxic) for a, w, c in zip(words, words[1:], words[2:]))
            cols = zip(*seen) if seen else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.string(), pa.int32()))], ["word", "around", "toxic"])

    by_context = sample.mapInArrow(contexts, "word string, around string, toxic int").groupBy("word", F.xxhash64("around")).agg(F.max("toxic").alias("toxic"))
    per_word = by_context.groupBy("word").agg(F.sum("toxic").cast("double").alias("t"), F.sum(1 - F.col("toxic")).cast("double").alias("c"))
    per_word = materialize(per_word, "toxic-words")
    totals = per_word.agg(F.sum("t"), F.sum("c")).first()
    t_all, c_all = max(1.0, totals[0]), max(1.0, totals[1])
    ratio = ((F.col("t") + 0.5) / (t_all + 1)) / ((F.col("c") + 0.5) / (c_all + 1))
    share = t_all / (t_all + c_all)
    both = F.col("t") + F.col("c")
    gain = 2 * (F.when(F.col("t") > 0, F.col("t") * F.log(F.col("t") / (both * share))).otherwise(0.0)
                + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * (1 - share)))).otherwise(0.0))
    listed = per_word.select("word", ratio.alias("ratio"), gain.alias("gain")).where("ratio >= 3 and gain >= 12").collect()
    # class 1 .. 7 by the strength of the evidence; 5 and up name the toxic terms
    evidence = {r["word"]: int(np.clip(np.log2(max(r["gain"], 12) / 12) + 1 + (r["ratio"] >= 10), 1, CLASSES - 1)) for r in listed}
    terms = {r["word"] for r in listed if r["gain"] >= 25 and r["ratio"] >= 6}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cs, ys = [], []
            for text, toxic in zip(texts(b.column(0)), b.column(1).to_pylist()):
                lowered = text.lower()
                for s in _SENTENCE.findall(lowered):
                    whole = _WORD.findall(s)
                    for at in range(0, len(whole), longest):  # a longer sentence is several sequences
                        words = whole[at:at + longest]
                        c = [evidence.get(w, 0) for w in words]
                        if any(c):
                            cs.append(c)
                            ys.append([int(bool(toxic) and w in terms) for w in words])
            yield pa.RecordBatch.from_arrays([pa.array(cs, pa.list_(pa.int64())), pa.array(ys, pa.list_(pa.int64()))], ["c", "y"])

    seqs = sample.mapInArrow(cut, "c array<long>, y array<long>").distinct().orderBy(F.xxhash64("c", "y"), "c", "y").limit(sentences).collect()
    unary, arcs = train_field([r["c"] for r in seqs], [r["y"] for r in seqs]) if seqs else (np.zeros(1 + 3 * CLASSES), np.zeros((2, 2)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _ = _judge(list(texts(b.column(0))), evidence, unary, arcs)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(4)), b.column(1)], ["a", "b", "c", "d", "toxic"])

    rows = sample.mapInArrow(measure, "a double, b double, c double, d double, toxic int").toPandas()  # bounded like the sample
    y = rows["toxic"].to_numpy(float)
    used = Counter(y)
    weight = np.where(y == 1, sizes[1] / max(1, used[1.0]), sizes[0] / max(1, used[0.0]))
    curve = fit_curve(rows[["a", "b", "c", "d"]].to_numpy(), y, weight / weight.mean())
    return Model(evidence, unary, arcs, curve)


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, spans (start, end in code points, end exclusive; marginal p).

    Whole texts are read. Null and empty texts score like any text without a
    listed word; without a model every score is 0. Repeated rows stay; an empty
    table gives no rows.
    """
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        for b in batches:
            if model is None:
                result, spans = np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
            else:
                x, spans = _judge(list(texts(b.column(1))), model.evidence, model.unary, model.arcs)
                result = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(result), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start: long, end: long, p: double>>")
