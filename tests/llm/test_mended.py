"""Clashing column names, every code point, texts of many spans, long training sentences."""

from __future__ import annotations

import random
import time
import unicodedata
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import BYTE_BPE, WORD_BPE, brute_pii, docs_frame, words
from tokenizers import Tokenizer

from dataloom.llm import fim, lexicon, packing, sanitise, toxic
from dataloom.llm.common import named


def test_stages_keep_every_column_and_its_values(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 60), "en", "mine", "mine too", "kept", f"dot {i}", "tick", i * 1.5, ("in", i)) for i in range(30)]
    spec = ("doc_id long, text string, lang string, score string, lang_pred string, `kept row` string, `a.b` string, `t``k` string, "
            "`text of it` double, nested struct<`x.y`: string, z: long>")
    docs = spark.createDataFrame(rows, spec)
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        got = out.collect()
        assert len(got) == 30, name
        for r in got:
            for c in docs.columns:
                assert c == "text" or r[c] == before[r.doc_id][c], (name, c)
    made = fim.transform(docs, carry=["a.b", "t`k", "nested"]).select(F.col("rest").getField("a.b").alias("v"), "rest").collect()
    assert {r.v for r in made} == {f"dot {i}" for i in range(30)} and docs.select(named("t`k")).count() == 30


def test_every_code_point_has_the_ids_of_the_library():
    word, byte = Tokenizer.from_file(WORD_BPE), Tokenizer.from_file(BYTE_BPE)
    vocabulary = packing.read_vocabulary(WORD_BPE)
    own, plain = lexicon.WordEncoder(vocabulary, None), packing.byte_level_encoder(packing.read_vocabulary(BYTE_BPE))
    known, unknown = [], []
    for c in range(1, 0x110000):
        kind = unicodedata.category(chr(c))
        if kind not in ("Cs", "Co"):
            (unknown if kind == "Cn" else known).append(chr(c))
    wrong = []
    for chars, size in ((known, 64), ([c for c in unknown if ord(c) < 0x20000], 1024)):
        for at in range(0, len(chars), size):
            part = chars[at: at + size]
            text = " ".join(f"a{c}b {c} x.{c}" for c in part)
            if own.encode(text) != np.array(word.encode(text, add_special_tokens=False).ids, "<u4").tobytes():
                wrong.append(part)
            if plain(text) != np.array(byte.encode(text, add_special_tokens=False).ids, "<u4").tobytes():
                wrong.append(part)
    assert not wrong
    assert all(own.odd(c) for c in unknown) and not any(own.odd(c) for c in known if not "\x1c" <= c <= "\x1f")


def test_a_text_of_many_addresses(spark):
    rng = random.Random(2)
    many = " ".join(f"é{words(rng, 2)} u{k}@example.com," for k in range(40_000))
    few = " ".join(f"u{k}@example.com +1 555 010 {k:04d}" for k in range(700))
    texts = [many, few, "no@one.org", ""]
    docs = docs_frame(spark, texts)
    sanitise.clean(sanitise.find(docs.where("doc_id > 0"))).collect()  # compiled
    begin = time.time()
    rows = sanitise.clean(sanitise.find(docs)).select("doc_id", "text", sanitise.joined(sanitise.KINDS).alias("base")).collect()
    assert time.time() - begin < 30
    for r in rows:
        spans = brute_pii(texts[r.doc_id])
        assert r.base == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        out, at = "", 0
        for k, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
            if a >= at:
                out += texts[r.doc_id][at:a] + f"<{k.upper()}>"
            at = max(at, b)
        assert r.text == out + texts[r.doc_id][at:]


@pytest.mark.parametrize("longest", [9, 120])
def test_long_training_sentences_keep_their_tokens(spark, monkeypatch, longest):
    """The tokens of all training sequences, one sentence without a mark among them."""
    rng = random.Random(3)
    texts = [f"{words(rng, 20)} vilest {words(rng, 1)} slurry {words(rng, 10)}" for _ in range(60)] + [words(rng, 30) for _ in range(120)]
    own = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)  # not held out
    texts[own] = " ".join(f"{words(rng, rng.randint(1, 7))} vilest" for _ in range(100))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(len(texts))], "doc_id long, toxic int")
    seen = []
    real = toxic.train_field
    monkeypatch.setattr(toxic, "train_field", lambda cs, ys: seen.append((cs, ys)) or real(cs, ys))
    assert toxic.learn(df, labels, longest=longest) is not None
    (cs, ys), = seen
    assert max(map(len, cs)) <= longest and [len(c) for c in cs] == [len(y) for y in ys]
    if longest == 120:  # shorter pieces are alike and count once
        assert sum(map(sum, ys)) >= 100
