"""Conversation repair, fill-in-middle and online packing against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import BYTE_BPE, ODD, docs_frame, frame, words
from tokenizers import Tokenizer

from dataloom.llm import fim, online, turns

# op 11

BLANKS = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """Rows (conv, turn, role, text) after the known damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(symbols):
    """(cost, ASCII-least audit) of (role initial, must go, cut short), edit by edit."""

    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, state, put):
        found = []
        if i == len(symbols) and state in ("", "a"):
            found.append((0, ""))
        if i < len(symbols):
            initial, gone, short = symbols[i]
            more = 5 if short else 0
            edits = [(2, "D", state)]
            if not gone:
                edits += [(more, "K", step[state, initial])] if (state, initial) in step else []
                edits += [(1 + more, "R", step[state, r]) for r in "ua" if (state, r) in step]
            found += [(c + x[0], e + x[1]) for c, e, q in edits if (x := best(i + 1, q, 0))]
        if put < 3:
            found += [(5 + x[0], "I" + x[1]) for r in "ua" if (state, r) in step and (x := best(i, step[state, r], put + 1))]
        return min(found, default=None)

    return best(0, "", 0)


def brute_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged([x for x in rows if x[0] == conv])),
                      key=lambda r: (r[1] is not None, r[1] or 0, turn_key(r)))
        seen, symbols, count = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, _, role, text in mine:
            last = BLANKS.findall(text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None
            if fault:
                count[fault] += 1
            seen.add((role, text))
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = cheapest(tuple(symbols))
        text, state, at = [], "", iter(mine)
        for e in audit:
            expected = "assistant" if state == "u" else "user"
            role, body = (expected, "") if e == "I" else (lambda r: (r[2], r[3]))(next(at))
            role = expected if e == "R" else role
            if e != "D":
                text.append(f"{role}:{body}")
                state = role[:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in text))
        out[conv] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def turn_key(r):
    conv = " " if r[0] is None else f"={r[0]}"
    return hashlib.sha256(f"{conv}\n{len(r[2])}:{r[2]}{r[3]}".encode()).digest()


def conversations(rng):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uploader"]
    texts = ["Yes.", "no", "Why?", "", " \t\n", None, "é!", "So it is. \n", "日本", "x. ", "\x1c.", "same words here."]
    rows = []
    for conv in [*range(60), None, -5, 10**15]:
        for t in range(rng.randint(1, 9)):
            rows.append((conv, t if rng.random() < 0.9 else rng.choice([None, t + 3, 2]), rng.choice(roles), rng.choice(texts)))
    rows += [(700, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(40)]  # nothing wrong but the damage
    rows += [(701, t, "user", "again.") for t in range(30)] + [(702, 5, "assistant", "one row") for _ in range(25)]
    rows += [(703, t, rng.choice(roles[:6]), f"{t // 3} {rng.choice(texts)}") for t in range(400)]
    rows += [(704, None, rng.choice(roles), f"text {t}.") for t in range(12)]
    rows += [(705, t, "assistant", f"all wrong {t}") for t in range(300)]
    return rows


SPEC = "conv_id long, turn long, role string, text string"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired_rows(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_conversations_match_brute_force(spark):
    rows = conversations(random.Random(5))
    df = frame(spark, rows, SPEC).withColumn("ck", F.lit("a clashing name")).withColumn("conv", F.lit(1))
    assert repaired_rows(turns.repair_conversations(df, turns.damage(df))) == brute_repair(rows)


def test_long_conversations_are_cut_into_fragments(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 40)}{rng.choice(['.', '!', '', '.'])}") for t in range(900)]
    rows += [(2, t, "user" if t % 5 else "assistant", f"{t}.") for t in range(300)] + [(3, 0, "user", "Hm.")]
    df = frame(spark, rows, SPEC)
    want = brute_repair(rows)
    real = turns.repair
    for most in (7, 64):
        monkeypatch.setattr(turns, "repair", lambda r, most=most: real(r, most))
        assert repaired_rows(turns.repair_conversations(df, turns.damage(df))) == want
    with_range = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "41")
        monkeypatch.setattr(turns, "repair", real)
        assert repaired_rows(turns.repair_conversations(df, turns.damage(df))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", with_range)


def test_no_conversations(spark):
    df = frame(spark, [], SPEC)
    assert turns.repair_conversations(df, turns.damage(df)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = frame(spark, [(gone, 0, "user", "Hi.")], SPEC)
    assert repaired_rows(turns.repair_conversations(df, turns.damage(df))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


@pytest.mark.parametrize("seed", range(3))
def test_runs_cost_what_single_turns_cost(seed):
    rng = random.Random(seed)
    kinds = {"s": ("s", False, False), "u": ("u", False, False), "a": ("a", False, False), "-": ("x", False, False),
             "S": ("s", False, True), "U": ("u", False, True), "A": ("a", False, True), "_": ("x", False, True), "x": ("u", True, False)}
    for _ in range(40):
        runs = [(rng.choice(turns.SYMBOLS), rng.choice([1, 1, 2, 3, 17])) for _ in range(rng.randint(0, 5))]
        runs = [r for k, r in enumerate(runs) if not k or r[0] != runs[k - 1][0]]
        cost, audit = cheapest(tuple(kinds[s] for s, n in runs for _ in range(n)))
        assert turns.before_runs(runs, turns.ENDED)[0][turns.START] == cost
        assert turns.unroll(runs, turns.ENDED, turns.START, True)[0] == audit
    long = [("a", 100_000), ("u", 3), ("x", 70_000)]
    assert turns.before_runs(long, turns.ENDED)[0][turns.START] == 50_000 + 1 + 2 + 140_000
    audit, state = turns.unroll(long, turns.ENDED, turns.START, True)
    assert len(audit.replace("I", "")) == 170_003 and state in (turns.START, turns.DONE)


# op 12

def brute_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * i: 8 * i + 8], 16) for i in range(4))
    n = len(text)
    x, y = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m in text for m in fim.MARKS) or c % 100 >= 90:
        return n, "plain", None, None, None, None, text
    p, m, s = text[:x], text[x:y], text[y:]
    sizes = (x, y - x, len(p.encode()), len(m.encode()))
    return (n, "spm", *sizes, f"<S>{s}<P>{p}<M>{m}") if d % 100 < 20 else (n, "psm", *sizes, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_matches_code_point_slices(spark):
    rng = random.Random(7)
    letters = "ab é ß日本😀́\U0010ffff<>PSM/\n"
    texts = ODD + ["<P>", "a<S>b", "<M", "<<P", "<P" * 9, "é" * 7001, "😀" * 500 + "x" * 900] * 4
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = docs_frame(spark, texts).withColumn("a", F.lit("x")).withColumn("output", F.lit(3))
    df = df.unionByName(df.where("doc_id = 9")).unionByName(df.where("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")))
    out = fim.restore(fim.transform(df, carry=["a", "output"])).collect()
    want = {i: brute_fim(i, t) for i, t in enumerate(texts)} | {None: brute_fim(None, texts[30])}
    assert len(out) == len(texts) + 2
    for r in out:
        text = (texts[30] if r.doc_id is None else texts[r.doc_id]) or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.prefix_bytes, r.middle_bytes, r.output) == want[r.doc_id]
        assert r.restored == text and r.rest == ("x", 3)
        assert (r.restored_prefix, r.restored_middle) == (r.prefix_chars, r.middle_chars)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.transform(df.where("false")).count() == 0


def test_sparse_index_converts_every_cut():
    text = "aé日b😀" * 30 + "plain ascii" * 20 + "é"
    data = text.encode()
    index = fim.SparseIndex(np.frombuffer(data, np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:k].encode()) for k in points])
    assert (index.to_byte(points) == at).all() and (index.to_point(at) == points).all()
    inside = np.arange(len(data) + 1)
    assert (index.to_point(inside) == np.searchsorted(at, inside, "right") - 1).all()
    plain = fim.SparseIndex(np.frombuffer(b"abc", np.uint8))
    assert plain.to_byte(np.arange(4)).tolist() == plain.to_point(np.arange(4)).tolist() == [0, 1, 2, 3]


def test_byte_cuts_fall_between_characters(spark):
    df = frame(spark, [(i, "日本😀é" * (i % 7 + 1)) for i in range(60)], "doc_id long, text string")
    for r in fim.restore(fim.transform(df, unit="byte", rate=100)).collect():
        assert r.restored == "日本😀é" * (r.doc_id % 7 + 1) and len(r.restored[:r.prefix_chars].encode()) == r.prefix_bytes


# op 13

def test_online_packing_is_whole_and_not_padded(spark):
    rng = random.Random(8)
    texts = ODD + [words(rng, rng.choice([3, 30, 300, 900])) for _ in range(250)] + ["same text here"] * 200 + [words(rng, 5000), words(rng, 1023)]
    df = docs_frame(spark, texts)
    df = df.unionByName(df.where("doc_id = 20")).unionByName(df.where("doc_id in (21, 22)").withColumn("doc_id", F.lit(None).cast("long")))
    whole = Tokenizer.from_file(BYTE_BPE)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    got = online.pack(df, public_tokenizers.path("byte_bpe_50k.json"), group_pieces=90).collect()
    pieces: dict = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        if r.doc_id is not None:
            part = ids[r.doc_id][r.start: r.start + r.length]
            assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert set(pieces) == {*ids, None}
    for i, x in ids.items():
        spans = sorted((r.start, r.start + r.length) for r in pieces[i])
        covered = [p for a, b in spans for p in range(a, b)]
        assert sorted(covered) == sorted(list(range(len(x))) * (2 if i == 20 else 1))
    assert sum(r.length for r in pieces[None]) == len(ids[21]) + len(ids[22])
    windows: dict = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    assert online.pack(df.where("false"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_levels_take_the_least_sum_of_squares():
    rng = random.Random(9)
    capacity = 40
    done, levels, fill = online.done_levels(capacity), online.Levels(capacity), {}
    assert [k for k in range(41) if done[k]] == [0, 1, 2, 4, 8, 16, 32, 40]

    def squares(fills):
        return sum(fills.count(f) ** 2 for f in set(fills) if not done[f])

    for _ in range(300):
        size = rng.randint(1, capacity - 1)
        before = list(fill.values())
        options = [squares(before + [size])] + [squares([*before[:k], f + size, *before[k + 1:]]) for k, f in enumerate(before) if f + size <= capacity]
        window, offset = levels.place(size)
        assert fill.get(window, 0) == offset
        fill[window] = offset + size
        assert squares(list(fill.values())) == min(options)


def test_open_windows_close_without_padding():
    rng = random.Random(10)
    for _ in range(200):
        fills = sorted((rng.randint(1, 99) for _ in range(rng.randint(1, 12))), reverse=True)
        kept, cut = online.close(fills, 100)
        assert sum(fills) == 100 * kept + sum(cut) and all(c == 100 or c & (c - 1) == 0 for c in cut)
