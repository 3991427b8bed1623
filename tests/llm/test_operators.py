"""The operators against brute force on small fixtures, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dataloom.llm import common, components, itq, langid, lexicon, packing, sanitise, simhash, suffix, topk, toxic, warczip

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "a a a", "\n\t\x0b x \x1c y\u0085z", "é é İ. Σ, ß ﬁ", "<|endoftext|> a<|startoftext|>", "x" * 5000,
       "w " * 3000, "1 2 3 " * 800, "日本語 テキスト", "it's 12'S we'LL", "a  b   c .. ,, _.", "A,B.C, d. e"]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def docs_frame(spark, texts, more="lang string"):
    """Documents with columns whose names clash with those the operators make."""
    rows = [(i, t, "en", i * 2, f"k{i}", [i]) for i, t in enumerate(texts)]
    return frame(spark, rows, "doc_id long, text string, lang string, fp long, score string, term array<int>")


def words(rng, n, size=40):
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "lmnop"][:size]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


# components

def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(1, 40)] + [(500, 500), (2, 300), (300, 301)]
    got = {r.node: r.root for r in components.components(frame(spark, links, "u long, v long"), "u", "v").collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == brute_components(linked, [x for x in links if x[0] != x[1]])
    assert components.components(frame(spark, [], "u long, v long"), "u", "v").count() == 0


def test_local_forest_keeps_components():
    rng = np.random.default_rng(1)
    u, v = rng.integers(0, 60, 45), rng.integers(0, 60, 45)
    a, b = common.local_forest(u, v)
    nodes = set(u) | set(v)
    assert brute_components(nodes, zip(a, b)) == brute_components(nodes, zip(u, v))
    assert len(a) < len(nodes)


# op 1

def vectors(rng, groups=6, dim=24):
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for k in range(rng.integers(1, 12)):
            x = centre + rng.normal(size=dim) * rng.choice([0.0, 0.02, 0.1, 0.16])
            rows.append((x.tolist(), int(g % 3)))
    rows += [(rng.normal(size=dim).tolist(), int(rng.integers(3))) for _ in range(150)]
    rows += [rows[0], rows[0], (None, 1), ([0.0] * dim, 1), ([float("nan")] * dim, 1), ([float("inf")] + [1.0] * (dim - 1), 1),
             ([None] + [1.0] * (dim - 1), 1), ([], 1), (rows[0][0], None), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e300] * dim, 2), ([2e300] * dim, 2)]
    return [(i, x, y, "clash") for i, (x, y) in enumerate(rows)]


def test_vector_links_match_all_pairs(spark):
    rows = vectors(np.random.default_rng(5))
    df = frame(spark, rows, "vec_id long, embedding array<double>, label int, node string")
    usable = {i: np.array(x) / np.abs(x).max() for i, x, y, _ in rows if y is not None and x and None not in x and np.isfinite(x).all() and any(x)}
    unit = {i: x / np.linalg.norm(x) for i, x in usable.items()}
    label = {i: y for i, _, y, _ in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    degree = Counter(x for p in links for x in p)
    root = brute_components([r[0] for r in rows], links)
    for block in (512, 4):  # also with every bucket cut into blocks
        got = itq.near_duplicates(df, block=block).collect()
        assert len(got) == len(rows)
        found = sum(r.n_links for r in got)
        assert all(r.n_links <= degree[r.vec_id] for r in got)
        assert found >= 0.95 * sum(degree.values()) and len(links) > 60
        if found == sum(degree.values()):
            assert {r.vec_id: r.component_id for r in got} == root
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert itq.near_duplicates(df.limit(0)).count() == 0


# op 2

def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).tolist(), "x") for i in range(230)]
    rows += [(300 + i, rows[i % 3][1], "x") for i in range(20)]  # ties
    rows += [(400, None, "x"), (401, [float("nan")] * 12, "x"), (402, [None] * 12, "x"), (500, [1.0, 2.0], "x"), (501, [3.0, 1.0], "x"), (7, rows[7][1], "x")]
    df = frame(spark, rows, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=10, query_block=2, vector_block=37).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    fine = {i: np.floor(1024 * np.array(x)).astype(int) for i, x, _ in rows if x and None not in x and np.isfinite(x).all()}
    expected = {}
    for q in (i for i in fine if i % 100 == 0):
        scores = sorted((-int(fine[q] @ v), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))[:10]
        expected[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert {q: sorted(x) for q, x in got.items()} == expected
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# op 3

def test_byte_ids_are_those_of_the_tokenizer():
    whole, encode = Tokenizer.from_file(BYTE_BPE), packing.byte_level_encoder(packing.read_vocabulary(BYTE_BPE))
    rng = random.Random(1)
    tries = [t or "" for t in ODD] + ["".join(rng.choice("ab é\n\t  '’s日٣½²x1<|endoftext|>.,\r\x0b\x1c　́İ") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    for t in tries:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(3)
    texts = ODD + [words(rng, rng.randint(1, 900)) for _ in range(150)]
    df = docs_frame(spark, texts)
    df = df.unionByName(df.limit(1))
    whole = Tokenizer.from_file(BYTE_BPE)
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    rows = packing.pack(df, BYTE_BPE, capacity=256, group_pieces=64).collect()
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, x in ids.items():
        first = len(x) % 256 or 256
        cuts = [0, *range(first, len(x) + 1, 256)]
        expected = [(k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(set(pieces[i])) == expected
    assert len(rows) == sum(-(-len(x) // 256) for x in ids.values()) + 1  # one row stands twice
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.06 * total / 256 + 2
    assert packing.pack(df.limit(0), BYTE_BPE).count() == 0


def test_sum_of_squares_places_where_the_sum_is_least():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 13, 200)
    bins, offsets = packing.sum_of_squares(sizes, 12)
    fill: dict = {}
    for size, b, at in zip(sizes, bins, offsets):
        def cost(place):
            gaps = Counter(12 - f for k, f in (fill | {place: fill.get(place, 0) + size}).items() if f < 12)
            return sum(n * n for n in gaps.values())
        options = [k for k, f in fill.items() if f + size <= 12] + [len(fill)]
        assert cost(b) == min(cost(k) for k in options) and at == fill.get(b, 0)
        fill[b] = at + size


# op 4

def test_simhash_components_match_all_pairs(spark):
    rng = random.Random(7)
    base = [words(rng, rng.randint(40, 200)) for _ in range(25)]
    texts = list(ODD)
    for t in base:
        for _ in range(rng.randint(1, 6)):
            w = t.split()
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
    df = docs_frame(spark, texts)
    df = df.unionByName(df.where("doc_id = 20"))

    def print_of(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        import xxhash
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = {i: print_of(t) for i, t in enumerate(texts)}
    root = brute_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(texts) + 1
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", root[i]) for i in fps}
    assert len(set(root.values())) < len(texts) - 20
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 4])
def test_trie_join_matches_all_pairs(bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 2**64, 40, dtype=np.uint64)
    x = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for s in seeds for _ in range(8)]
    a = np.unique(np.array(x, np.uint64))
    i, j = simhash.trie_pairs(a, None, 0, bits, dense=4)
    got = {(int(a[p]), int(a[q])) for p, q in zip(i, j)}
    swapped = np.sort(simhash._swap(a))
    i, j = simhash.trie_pairs(swapped, None, 0, bits, dense=4)
    back = simhash._swap(swapped)
    got |= {tuple(sorted((int(back[p]), int(back[q])))) for p, q in zip(i, j)}
    assert got == {(int(p), int(q)) for n, p in enumerate(a) for q in a[n + 1:] if int(p ^ q).bit_count() <= bits}


def test_trie_shards_match_all_pairs(spark):
    rng = np.random.default_rng(9)
    crowd = [(0xABCD << 48) | int(v) for v in rng.integers(0, 2**20, 5000)]  # one crowded prefix
    x = np.unique(np.array(crowd + [c ^ (1 << 60) for c in crowd[:50]] + rng.integers(0, 2**64, 500, dtype=np.uint64).tolist(), np.uint64))
    df = frame(spark, [(int(v),) for v in x.view(np.int64)], "fp long")
    got = brute_components(x.view(np.int64).tolist(), [(r.u, r.v) for r in simhash.trie_links(df).collect()])
    links = []
    for n in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(x[n + 1:] ^ x[n]) <= 3) + n + 1
        links += [(int(x.view(np.int64)[n]), int(x.view(np.int64)[m])) for m in near]
    label = {v: v for v in got}

    def find(v):
        while label[v] != v:
            label[v] = label[label[v]]
            v = label[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    assert got == {v: find(v) for v in got}


# op 5

def test_transducer_accepts_its_words_only(tmp_path):
    rng = random.Random(2)
    outputs = {words(rng, 1).encode() + rng.choice([b"", b"ing", b"tion"]): np.array([k, k + 1], "<u4").tobytes() for k in range(400)}
    outputs["é".encode()] = b""
    path = tmp_path / "words"
    path.write_bytes(lexicon.compile_words(outputs))
    made = lexicon.Transducer(str(path))
    assert all(made.find(w) == ids for w, ids in outputs.items())
    assert made.find(b"") is None and made.find(b"a") is None and made.find(b"zz") is None
    assert len(made.targets) < sum(map(len, outputs))  # prefixes and suffixes are shared


def test_word_bpe_round_trip(spark):
    rng = random.Random(5)
    alphabet = "ab é\n\t  '’sS日٣½²x1<|endoftext|>.,_\r\x0b\x1c　́İΣ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [words(rng, 200) for _ in range(30)]
    df = docs_frame(spark, texts)
    out = lexicon.decode(lexicon.encode(df, WORD_BPE), WORD_BPE).collect()
    whole = Tokenizer.from_file(WORD_BPE)
    assert len(out) == len(texts)
    for r in out:
        ids = whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids), texts[r.doc_id]
        assert r.decoded == whole.decode(ids, skip_special_tokens=False)
    assert lexicon.encode(df.limit(0), WORD_BPE).count() == 0


# op 6

@pytest.mark.parametrize("group_rows", [1000, 2, 9])
def test_repeated_windows_are_cut(spark, group_rows):
    rng = random.Random(11)
    passage, common_line = words(rng, 60), words(rng, 40)
    texts = list(ODD)
    for k in range(40):
        body = words(rng, rng.randint(0, 120), 12)
        texts.append(" ".join([body, passage if k % 3 == 0 else "", common_line if k % 2 else "", words(rng, 20)]))
    texts += [texts[20], texts[21], words(rng, 34), words(rng, 35)]
    df = docs_frame(spark, texts)
    df = df.unionByName(df.where("doc_id = 25"))
    split = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for i, t in enumerate(texts)}
    count = Counter(tuple(w[s:s + 35]) for i, w in split.items() for s in range(len(w) - 34) for _ in range(2 if i == 25 else 1))
    got = suffix.remove_repeats(df, group_rows=group_rows, carry=["lang"])
    rows = got.withColumn("kept", suffix.kept_words("text")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        w = split[r.doc_id]
        gone = set()
        for s in range(len(w) - 34):
            if count[tuple(w[s:s + 35])] > 1:
                gone |= set(range(s, s + 35))
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept == " ".join(x for i, x in enumerate(w) if i not in gone) and r.rest.lang == "en"
        assert gone or r.text == texts[r.doc_id]
    assert sum(r.n_removed for r in rows) > 1000
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_a_common_line_between_other_words(spark):
    """An anchor that every text holds: prefixes are lengthened, and only what repeats to the full depth goes."""
    rng = random.Random(4)
    line = "one line of eight words for all texts"
    passage, long_line = words(rng, 45), words(rng, 33)
    many = [f"w{k}" for k in range(5000)]
    body = lambda n: " ".join(rng.choice(many) for _ in range(n))
    texts = [f"{body(30)} {line} {body(30)}" for _ in range(300)]
    texts += [f"{body(9)} {line} {passage} {body(9)}" for _ in range(60)] + [f"{body(9)} {long_line} {body(9)}" for _ in range(60)]
    texts += [f"{line} {body(30)}" for _ in range(40)] + [texts[0], f"{texts[1]} {body(3)}"]
    df = docs_frame(spark, texts)
    split = [t.split() for t in texts]
    count = Counter(tuple(w[s:s + 35]) for w in split for s in range(len(w) - 34))
    for group_rows in (20, 100):
        got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(df, group_rows=group_rows).collect()}
        for i, w in enumerate(split):
            assert got[i] == len({p for s in range(len(w) - 34) if count[tuple(w[s:s + 35])] > 1 for p in range(s, s + 35)}), i


# op 7

def test_zip_directories():
    members = [("a.txt", b"hello"), ("dir/b", b"x" * 3000), ("empty", b"")]
    for zip64 in (False, True):
        for comment in (b"", b"\n", b"PK\x05\x06 no end"):
            data = warczip.zip_package(members, comment, zip64)
            if b"PK" not in comment:  # zipfile takes a signature in the comment for the directory
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
            found = warczip.stored_members(lambda a, n, d=data: d[a:a + n], len(data))
            assert {k: data[a:a + n] for k, (a, n) in found.items()} == dict(members)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("deflated", b"x" * 100)
        z.writestr(zipfile.ZipInfo("stored"), b"y" * 100)
    data = packed.getvalue()
    assert list(warczip.stored_members(lambda a, n: data[a:a + n], len(data))) == ["stored"]
    with pytest.raises(ValueError):
        warczip.stored_members(lambda a, n: b"no archive"[a:a + n], 10)


def test_warc_round_trip(spark):
    same, long = "<p>" + "x" * 200, "é" * 40_000
    pages = [(3, "http://a/ b", same), (1, None, same), (2, "u\r\nX: y", "é" * 60), (None, "a", same), (5, "b", None), (6, "b", ""), (7, "c", "x" * 99),
             (8, "c", "x" * 99), (9, "c", long), (1, None, same), (10, "", long + "z"), (11, "r", "a\r\n\r\nb" * 40)]
    df = frame(spark, [(*p, "clash") for p in pages], "page_id long, url string, html string, digest string")
    rows = warczip.round_trip(df, archive_bytes=50_000).collect()
    first: dict = {}
    for i, _, h in pages:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    expected = []
    for i, _, h in pages:
        body = (h or "").encode()
        to = first.get(h) if len(body) >= 100 and first.get(h) != i else None
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=key) == sorted(expected, key=key)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in rows if r.record_type == "response")
    assert warczip.round_trip(df.limit(0)).count() == 0


def test_warc_from_whole_packages(spark):
    import pyarrow as pa

    record = __import__("gzip").compress(warczip.warc_record("4", "u", b"body", 4, hashlib.sha256(b"body").hexdigest(), None))
    line = b'{"id": "4", "offset": 0, "length": %d}\n' % len(record)
    data = warczip.zip_package([(warczip.DATA, record), (warczip.INDEX, line)])
    out = list(warczip._whole(iter([pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["content"])])))
    assert out[0].to_pylist()[0]["page_id"] == 4 and out[0].to_pylist()[0]["payload"] == b"body"


# op 8

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    def fits(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return kind == "email" or 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if fits(k, m.group())]


def test_base_spans_are_the_plain_patterns(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("a1.@-+ ()9b_4é\U0001F600%2") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 30000, "1 " * 20000, "a.b@c" + ".d" * 20000, "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 4111 1111 1111 1111 +1 (555) 555-0123",
              "a@b.c_d@e.f x@y.z@q.r", "1" * 30000, "+1" + "(" * 30000, "4111-1111-1111-1111 5500005555555559 +123456789012345 +1234567890123456"]
    found = sanitise.find(docs_frame(spark, texts), carry=["term", "score"])
    rows = found.select("doc_id", sanitise.joined(sanitise.KINDS).alias("base"), "rest").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_pii(texts[r.doc_id] or "")), texts[r.doc_id]
        assert r.rest.term == [r.doc_id]
    assert sanitise.find(docs_frame(spark, texts).limit(0)).count() == 0


def test_revealing_terms_are_generalised(spark):
    rng = random.Random(8)
    texts = [f"{words(rng, 8)} the Quillfeather office answers at quill@example.com for you {words(rng, 8)}" for _ in range(6)]
    texts += [f"{words(rng, 12)} the office for you" for _ in range(60)] + ["the Quillfeather bird"]
    texts += [f"{words(rng, 3)} write to the office at other{k}@example.org for you" for k in range(20)]
    found = sanitise.find(docs_frame(spark, texts))
    rows = {r.doc_id: r for r in sanitise.clean(found).select("doc_id", "text", "term").collect()}
    for i in range(6):
        assert [x.m for x in rows[i].term if x.m == "quillfeather"] == ["quillfeather"]
        assert "Quillfeather" not in rows[i].text and "<TERM>" in rows[i].text and "<EMAIL> for you" in rows[i].text
        assert " the " in rows[i].text
    assert rows[66].text == "the Quillfeather bird"  # no entity near: nothing to reveal
    assert all(not rows[i].term for i in range(67, 87))


def test_revealing_terms_far_from_the_entity(spark):
    """Every occurrence in a document that holds the entity, at any distance; rare and frequent terms by brute force."""
    rng = random.Random(11)
    texts = [f"Farnsworthy {words(rng, 60)} mail zed@example.com or 10.1.2.3 {words(rng, 60 if i % 2 else 0)} FARNSWORTHY İlkay's {words(rng, 40)} Farnsworthy" for i in range(6)]
    texts += [f"{words(rng, 30)} one{k}@example.org" for k in range(30)] + [words(rng, 30) for _ in range(60)] + ["Farnsworthy alone", None]
    df = docs_frame(spark, texts)
    df = df.unionByName(df.where("doc_id = 1"))  # a row that stands twice counts twice
    texts = [t or "" for t in [*texts, texts[1]]]
    total, pattern = len(texts), re.compile(r"[^\W\d_](?:[^\W_]|['_-])*")
    seen = [({w.lower() for w in pattern.findall(t)}, {(k, t[a:b].lower()) for k, a, b in brute_pii(t)}) for t in texts]
    n_term, n_entity = Counter(w for ws, _ in seen for w in ws), Counter(e for _, es in seen for e in es)
    both = Counter((w, e) for ws, es in seen for w in ws for e in es)
    told = {(w, e) for (w, e), n in both.items() if n >= 3 and n_entity[e] < total
            and np.log(n * total / (n_term[w] * n_entity[e])) / np.log(total / n_entity[e]) >= 0.8}
    assert {"farnsworthy", "İlkay's".lower()} <= {w for w, _ in told}
    got = sanitise.find(df).collect()
    assert len(got) == total
    for r in got:
        t, (_, es) = r.text, seen[r.doc_id]
        base = [(a, b) for _, a, b in brute_pii(t)]
        expected = [(m.start(), m.end()) for m in pattern.finditer(t) if any((m.group().lower(), e) in told for e in es)
                    and not any(a < m.end() and m.start() < b for a, b in base)]
        assert [(x.s, x.e) for x in r.term] == expected, t
        assert r.doc_id >= 6 or sum(x.m == "farnsworthy" for x in r.term) == 3


# op 9

def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    unary, arcs = rng.normal(size=1 + 3 * toxic.CLASSES), rng.normal(size=(2, 2))
    sentences = [[0, 3, 0, 5], [2], [1, 1, 7], [0, 0]]
    classes, lengths = toxic._padded(sentences)
    p, pair, logz = toxic.marginals(classes, lengths, unary, arcs)
    for k, s in enumerate(sentences):
        emit = unary[toxic._features(np.array([s]))].sum(-1)[0]
        weight = {}
        for path in np.ndindex(*[2] * len(s)):
            weight[path] = np.exp(sum(e * y for e, y in zip(emit, path)) + sum(arcs[a, b] for a, b in zip(path, path[1:])))
        z = sum(weight.values())
        assert np.isclose(logz[k], np.log(z))
        for t in range(len(s)):
            assert np.isclose(p[k, t], sum(w for y, w in weight.items() if y[t]) / z)
        for a in range(2):
            for b in range(2):
                assert np.isclose(pair[k, a, b], sum(w * sum(y[t:t + 2] == (a, b) for t in range(len(s) - 1)) for y, w in weight.items()) / z)


def test_toxic_documents_are_found(spark):
    rng = random.Random(4)
    bad = ["vileword", "nastyterm", "foulname"]
    rows, labels = [], []
    for i in range(600):
        w = words(rng, rng.randint(5, 60)).split()
        ugly = i % 4 == 0
        for _ in range(rng.randint(2, 5) if ugly else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(ugly)))
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "x" * 50000, None), (1003, "Vileword! 'nastyterm', foulname", "zz"), (0, rows[0][1], "en")]
    labels += [(1000, None), (5, 0), (None, 1)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    model = toxic.learn(docs, frame(spark, labels, "doc_id long, toxic int"))
    out = toxic.score(docs, model).collect()
    assert len(out) == len(rows)
    truth = {i: y for i, y in labels[:600]}
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r for r in out}
    assert by[1003].score >= 0.7 and [(s.start, s.end) for s in by[1003].spans] == [(0, 8), (11, 20), (23, 31)]
    assert by[1000].score == by[1001].score < 0.5 and 0 <= by[1002].score < 0.5
    assert toxic.learn(docs, frame(spark, [(1, 0)], "doc_id long, toxic int")) is None
    assert {r.score for r in toxic.score(docs, None).collect()} == {0.0}


# op 10

def brute_grams(text, n=3):
    ws = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    grams = Counter()
    for w in ws:
        padded = f" {w} "
        for k in range(2, n + 1):
            grams.update(padded[i:i + k] for i in range(len(padded) - k + 1))
        grams.update(w)
    return grams


def test_ngrams_match_plain_counting():
    for t in [x or "" for x in ODD] + ["  The cat, the CAT's hat ", "a", "ab"]:
        codes, counts = langid.ngrams(t)
        plain = Counter({k: v for k, v in brute_grams(t).items()})
        got = {}
        for c, n in zip(codes.tolist(), counts.tolist()):
            s = ""
            while c:
                s, c = chr(c & 0x1FFFFF) + s, c >> 21
            got[s] = n
        assert got == dict(plain), t


def test_languages_are_told_apart(spark):
    rng = random.Random(6)
    sounds = {"aa": ["ka", "ku", "kam", "ta"], "bb": ["sch", "er", "ung", "ein"], "cc": ["eau", "que", "oi", "ê"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[g]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), g)
            for i, g in enumerate(rng.choice(list(sounds)) for _ in range(300))]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 !!", "cc"), (903, rows[0][1], None)]
    docs = frame(spark, [(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double")
    out = langid.identify(docs, langid.learn_from_training_rows(docs)).collect()
    assert len(out) == len(rows)
    truth = {i: g for i, _, g in rows[:300]}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out if r.doc_id in truth]) > 0.99
    by = {r.doc_id: r for r in out}
    assert [(by[i].lang_pred, by[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3 and by[903].lang_pred == rows[0][2]
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}


def test_languages_match_a_plain_rank_order(spark):
    """Profiles, out-of-place distances, ties and scores by plain dictionaries."""
    rng = random.Random(16)
    sounds = {"aa": ["ka", "ku", "kam", "ta"], "bb": ["sch", "er", "ung", "ka"], "cc": ["eau", "que", "oi", "ê"], "dd": ["eau", "que", "oi", "ê"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[g]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))), g)
            for i, g in enumerate(rng.choice([*sounds, None]) or "aa" for _ in range(250))]
    rows = [(i, t, None if i % 11 == 0 else g) for i, t, g in rows] + [(800 + k, t, "aa") for k, t in enumerate(ODD)] + [(None, "ka ku", "bb")]
    docs = frame(spark, rows, "doc_id long, text string, lang string")

    def top(grams):
        return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:400]]

    seen = {}
    for i, t, g in rows:
        if g and t is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1):
            seen.setdefault(g, Counter()).update(brute_grams(t))
    profiles = {g: {x: k for k, x in enumerate(top(c))} for g, c in seen.items()}
    for r in langid.identify(docs, langid.learn_from_training_rows(docs)).collect():
        own = top(Counter(brute_grams(r.text or "")))
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        apart = {g: sum(abs(p[x] - k) if x in p else 400 for k, x in enumerate(own)) for g, p in profiles.items()}
        best = min(apart, key=lambda g: (apart[g], g))
        assert r.lang_pred == best and abs(r.score - (1 - apart[best] / (400 * len(own)))) < 1e-12
