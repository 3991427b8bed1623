"""The pipeline against a brute-force version, and every registered query on the smallest tables."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_pii, words
from tokenizers import Tokenizer

from dataloom.llm import langid, simhash
from dataloom.llm.queries import ORACLES, QUERIES
from dataloom.plans.oracle import compare, duck

SF = "/root/testdata/sf0.001"


def corpus(rng):
    passage = words(rng, 50)
    texts = [f"{words(rng, rng.randint(5, 150))} {passage if k % 5 == 0 else ''} {words(rng, 30)}" for k in range(40)]
    texts += [f"write to a{k}@example.com or +1 (555) 555-01{k:02d} now {words(rng, 25)}" for k in range(10)]
    texts += [texts[3], texts[3], texts[4].replace(texts[4].split()[2], "other", 1), None, "", "12 34 !!", "§ 5", "é", words(rng, 3000)]
    return texts


def brute(texts, ids):
    """Pieces (doc_id, piece, start, length, crc) of what is left after each step."""
    kept = {i: t for i, t in zip(ids, texts) if t and any(c.isalpha() for c in t)}
    fps = {i: simhash.fingerprint(t.encode()) for i, t in kept.items()}
    root = brute_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    kept = {i: t for i, t in kept.items() if root[i] == i}
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in kept.items()}
    count = Counter(tuple(w[s:s + 35]) for w in split.values() for s in range(len(w) - 34))
    for i, w in split.items():
        gone = {p for s in range(len(w) - 34) if count[tuple(w[s:s + 35])] > 1 for p in range(s, s + 35)}
        if gone:
            kept[i] = " ".join(x for p, x in enumerate(w) if p not in gone)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = set()
    for i, t in kept.items():
        at, out = 0, ""
        for kind, a, b in sorted(brute_pii(t), key=lambda x: (x[1], -x[2])):
            if a >= at:
                out += t[at:a] + f"<{kind.upper()}>"
            at = max(at, b)
        x = whole.encode(out + t[at:], add_special_tokens=False).ids + [0]
        start, size, piece = 0, len(x) % 2048 or 2048, 0
        while start < len(x):
            pieces.add((i, piece, start, size, zlib.crc32(np.array(x[start:start + size], "<u4").tobytes())))
            start, piece, size = start + size, piece + 1, 2048
    return pieces


def test_pipeline_matches_brute_force(spark, tmp_path):
    rng = random.Random(12)
    texts = corpus(rng)
    rows = [(i, t, "en", "s", len(t or ""), [i], "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rest array<long>, score string")
    df = df.unionByName(df.where("doc_id = 7"))  # a row that stands twice
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert len(pieces) == len(set(pieces)) and set(pieces) == brute(texts, range(len(texts)))
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        assert [o for o, _ in sorted(s)] == [sum(n for _, n in sorted(s)[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 2048


def test_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"term": F.lit(1), "th": F.lit("x"), "rest": F.lit(2.5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_clean_documents_pass_the_language_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.language_id(spark, docs, SF).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        res = compare(df, ORACLES[name], duck(SF))
        assert res["ok"], res
    else:
        table = "embeddings" if name.startswith(("op1_", "op2_")) else "conversations" if name.startswith("op11_") else "documents"
        rows = spark.read.parquet(os.path.join(SF, f"{table}.parquet"))
        n = rows.select("conv_id").distinct().count() if table == "conversations" else rows.count()
        assert df.count() >= (1 if name.startswith("op2_") else n)


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op10_rank_order_langid"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()
    assert langid.learn_from_training_rows(docs.limit(0)) == {}
