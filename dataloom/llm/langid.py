"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent character n-grams (1 to
``max_n`` letters, words padded by one blank), most frequent first. A text is
given the language whose profile is nearest by the out-of-place distance: for
each n-gram of the text's own profile, how far its rank is from its rank in the
language's, and the profile length where the language lacks it.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from dataloom.llm.common import held_out, named, prepare, texts

_PAD = 32  # a blank: before every letter in code order


@cache
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(text: str, max_n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter n-grams of a text, in code order; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    chars = np.concatenate([[_PAD], np.where(letter, points, _PAD), [_PAD]])
    start = np.concatenate([[True], (chars[1:] != _PAD) | (chars[:-1] != _PAD)])
    chars = chars[start]  # one blank between words
    found = []
    for n in range(1, max_n + 1):
        if len(chars) < n:
            break
        grams = np.zeros(len(chars) - n + 1, np.int64)
        inside = np.ones(len(grams), bool)
        for i in range(n):
            c = chars[i:len(chars) - n + 1 + i]
            grams = (grams << 21) | c
            if n == 1 or 0 < i < n - 1:
                inside &= c != _PAD
        found.append(grams[inside])
    return np.unique(np.concatenate(found), return_counts=True)


def _top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Codes by falling count, equal counts in code order."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = 400, max_n: int = 3) -> dict[str, np.ndarray]:
    """The profile of each non-null value of ``lang_col``, counted over all rows given.

    At most ``size`` n-grams per language reach the driver.
    """
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                parts.setdefault(lang, []).append(ngrams(text, max_n))
            for lang, p in parts.items():
                codes, inv = np.unique(np.concatenate([c for c, _ in p]), return_inverse=True)
                counts = np.bincount(inv, weights=np.concatenate([n for _, n in p]), minlength=len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).collect()
    profiles: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.array(grams, np.int64) for lang, grams in profiles.items()}


def identify(df: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", size: int = 400, max_n: int = 3,
             out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with lang_pred and score (1: every n-gram in place, 0: none known), or the names in ``out``.

    ``und`` with score 0 for null texts, texts without a letter, or without any
    profile to compare. Equal distances go to the first language in order.
    All other columns pass through; columns named like the two new ones are
    replaced. Repeated rows stay, an empty table gives no rows.
    """
    prepare(df.sparkSession)
    langs = sorted(profiles)
    known = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.empty(0, np.int64)
    ranks = np.full((len(known) + 1, len(langs)), -1, np.int64)
    for j, x in enumerate(langs):
        ranks[np.searchsorted(known, profiles[x]), j] = np.arange(len(profiles[x]))

    def judge(text: str) -> tuple[str, float]:
        codes, counts = ngrams(text, max_n)
        if not len(codes) or not langs:
            return "und", 0.0
        own = _top(codes, counts, size)
        at = np.searchsorted(known, own)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
        place = ranks[at]
        apart = np.where(place < 0, size, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return langs[best], float(1.0 - apart[best] / (size * len(own)))

    keep = [c for c in df.columns if c.lower() not in {x.lower() for x in out}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = zip(*(judge(t) for t in texts(b.column(1)))) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["rest", "lang", "score"])

    rows = df.select(F.struct(*[named(c) for c in keep]).alias("rest"), named(text_col).cast("string").alias("text"))
    made = StructType([StructField("rest", rows.schema["rest"].dataType), StructField("lang", StringType()), StructField("score", DoubleType())])
    judged = rows.mapInArrow(run, made)
    return judged.select(*[F.col("rest").getField(c).alias(c) for c in keep], F.col("lang").alias(out[0]), F.col("score").alias(out[1]))


def learn_from_training_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Profiles of the rows that are not held out."""
    return learn_profiles(df.where(~held_out(id_col)), text_col, lang_col)
