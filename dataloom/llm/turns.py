"""Conversation structure repair by a run-length dynamic program.

The turns of a conversation become symbols: the initial of the role and the
fault. Edits (keep, rerole, delete, insert) must leave roles that read
``(s?(ua)+)?``, an automaton of four states, so a turn is a 4 x 4 matrix of
least costs between states, and turns that follow each other multiply in the
min-plus algebra.

* Equal neighbouring symbols are one run. A run of length L is advanced through
  the binary powers of its symbol's matrix, which are computed once and kept.
* Costs to go are carried from the end; the choices are then unrolled from the
  front, in blocks, always taking the ASCII-least edit that still reaches the
  least cost. That gives the ASCII-least of the cheapest audits.

Turns are sorted over range partitions and a conversation of any length is cut
into fragments of bounded size. The matrices of fragments that may be a part
only are chained, which gives each the costs behind it and the state before it;
fragments are then unrolled side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from dataloom.llm.common import materialize, prepare
from dataloom.session import ensure_checkpoint_dir

# states: nothing yet, system, user (an answer is due), answered
START, SYSTEM, USER, DONE = range(4)
_NEVER = 1 << 60
#: costs (fixed values)
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
#: state after a further user or assistant turn, None where the pattern does not allow it
_AFTER = {"u": (USER, USER, None, USER), "a": (None, None, DONE, None), "s": (SYSTEM, None, None, None)}
#: the turn that may be inserted in each state
_NEXT = "uuau"
_BLANKS = r"\x20\x09-\x0D"
_SPACES = " \t\n\x0b\x0c\r"
_BLOCK = 256
#: turns a task holds at once
FRAGMENT = 50_000

#: Symbols: role initial s, u, a or - (any other), upper case if cut short; x must be deleted.
SYMBOLS = "sua-SUA_x"


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or a vector."""
    if b.ndim == 1:
        return np.minimum((a + b).min(axis=1), _NEVER)
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _NEVER)


def _inserted() -> np.ndarray:
    """Least cost between states by insertions alone."""
    out = np.full((4, 4), _NEVER)
    for q in range(4):
        state, cost = q, 0
        while out[q, state] > cost:
            out[q, state] = cost
            state, cost = _AFTER[_NEXT[state]][state], cost + INSERT
    return out


_INSERTED = _inserted()
#: cost to go after the last turn: insertions up to a state that may end
ENDED = _times(_INSERTED, np.array([0, _NEVER, _NEVER, 0]))


def choices(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after it) for a turn, without insertions, ASCII-least edit first."""
    yield "D", DELETE, state
    if symbol == "x":
        return
    more = CUT_SHORT if symbol in "SUA_" else 0
    kept = _AFTER.get(symbol.lower(), (None,) * 4)[state]
    if kept is not None:
        yield "K", more, kept
    for role in "ua":
        after = _AFTER[role][state]
        if after is not None:
            yield "R", REROLE + more, after


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> np.ndarray:
    """Least costs over 2^k equal turns, insertions before each of them included."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    step = np.full((4, 4), _NEVER)
    for q in range(4):
        for _, cost, after in choices(symbol, q):
            step[q, after] = min(step[q, after], cost)
    return _times(_INSERTED, step)


def advance(symbol: str, length: int, costs: np.ndarray) -> np.ndarray:
    """Costs to go before a run, from those after it (or the matrix of both)."""
    k = 0
    while length >> k:
        if length >> k & 1:
            costs = _times(power(symbol, k), costs)
        k += 1
    return costs


def before_runs(runs: list[tuple[str, int]], costs: np.ndarray) -> list[np.ndarray]:
    """Costs to go before each run, and after the last."""
    out = [costs]
    for symbol, length in reversed(runs):
        out.append(advance(symbol, length, out[-1]))
    return out[::-1]


def unroll(runs: list[tuple[str, int]], costs: np.ndarray, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits from ``state``, and the state after them.

    ``costs`` are the costs to go after the runs; ``last``: nothing comes after them.
    """
    edits: list[str] = []
    after = before_runs(runs, costs)[1:]
    for (symbol, length), behind in zip(runs, after):
        step, left = power(symbol, 0), length
        while left:
            n = min(left, _BLOCK)
            left -= n
            ahead = [advance(symbol, left, behind)]
            for _ in range(n):
                ahead.append(_times(step, ahead[-1]))
            for k in range(n, 0, -1):
                here, there = ahead[k], ahead[k - 1]
                while True:
                    best = here[state]
                    cut = next(((e, q) for e, c, q in choices(symbol, state) if e == "D" and c + there[q] == best), None)
                    if cut is None:
                        q = _AFTER[_NEXT[state]][state]
                        if here[q] + INSERT == best:
                            edits.append("I")
                            state = q
                            continue
                        cut = next((e, q) for e, c, q in choices(symbol, state) if c + there[q] == best)
                    edits.append(cut[0])
                    state = cut[1]
                    break
    while last and state not in (START, DONE):
        edits.append("I")
        state = _AFTER[_NEXT[state]][state]
    return "".join(edits), state


def key(col: str) -> Column:
    """A conversation's id as text, null told apart from everything else."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(" "))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with known faults: (conv, turn, role, text), null role and text as one space.

    By CRC-32 of ``conv:turn`` (a null is one space), modulo 20: 0 drops the
    row, 1 empties the text, 2 takes its ``.``, ``!`` and ``?`` away, 3 repeats
    the row, 4 makes the role user.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", named(conv), named(turn)).cast("binary")) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.translate(named(text), ".!?", "")).otherwise(named(text))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.when(kind == 4, "user").otherwise(named(role)).alias("role"), body.alias("text"), kind.alias("kind"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("kind != 0").select("conv", "turn", "role", "text", copies.alias("copy")).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``ck`` (conversation), ``id`` (SHA-256 of conversation, role and text)."""
    whole = F.concat(key("conv"), F.lit("\n"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv", key("conv").alias("ck"), "turn", "role", "text", F.unhex(F.sha2(whole.cast("binary"), 256)).alias("id"))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per different (conversation, turn, role, text): how often it stands there, initial, symbol of the first one."""
    spaces = "".join(f"\\u{ord(c):04x}" for c in _SPACES)
    end = F.expr(f"trim(TRAILING '{spaces}' FROM text)")
    one = rows.select("conv", "ck", "turn", "id", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
                      (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("short"))
    same = one.groupBy("ck", "turn", "id").agg(F.count("*").alias("n"), F.first("conv").alias("conv"), F.first("initial").alias("initial"),
                                               F.first("blank").alias("blank"), F.first("short").alias("short"))
    same = materialize(same, "turns")
    seen = same.groupBy(F.col("id").alias("seen_id")).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("places"))
    seen = materialize(seen.where("places > 1"), "seen-again")  # most turns are said once
    joined = same.join(seen, same["id"] == seen["seen_id"], "left")
    again = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-")
    symbol = F.when(F.col("blank") | again, "x").when(~F.col("short"), role).otherwise(F.when(role == "-", "_").otherwise(F.upper(role)))
    return joined.select("ck", "conv", "turn", "id", "n", "initial", "blank", symbol.alias("symbol"))


_FRAGMENT = ("ck string, conv {0}, pid int, number int, audit string, tail string, cost long, blank long, duplicate long, truncated long, illegal long, "
             "first_initial string, last_initial string, low long, high long, turns long, kept_turn array<long>, "
             "kept_id array<binary>, kept_edit array<string>")


def _fragments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, str, list[dict], bool]]:
    """(number, conversation, turns, whether cut) from a partition's rows, sorted by conversation.

    A fragment holds at most ``most`` rows; the first and the last of a partition may be parts as well.
    """
    held: list[dict] = []
    number, going_on = 0, False
    for b in batches:
        for row in b.to_pylist():
            same = bool(held) and row["ck"] == held[-1]["ck"]
            if held and (not same or len(held) >= most):
                yield number, held[0]["ck"], held, same or going_on or not number
                number, held, going_on = number + 1, [], same
            held.append(row)
    if held:
        yield number, held[0]["ck"], held, True


def _runs(rows: list[dict]) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []

    def add(symbol: str, n: int) -> None:
        if n and out and out[-1][0] == symbol:
            out[-1] = (symbol, out[-1][1] + n)
        elif n:
            out.append((symbol, n))

    for r in rows:
        add(r["symbol"], 1)
        add("x", r["n"] - 1)  # the same turn again
    return out


def _chain(ends: list[tuple], exits: dict | None) -> dict[tuple[int, int], tuple[list[int], int, bool]]:
    """(partition, number) -> (costs to go after the fragment, state before it, nothing after it), for conversations in several."""
    of: dict[str, list] = {}
    for pid, number, ck, matrix in sorted(ends, key=lambda x: x[:2]):
        of.setdefault(ck, []).append(((pid, number), np.array(matrix, np.int64).reshape(4, 4)))
    out = {}
    for parts in of.values():
        if len(parts) < 2:
            continue
        costs, before = ENDED, []
        for where, matrix in reversed(parts):
            before.append(costs.tolist())
            costs = _times(matrix, costs)
        state = START
        for (where, _), behind in zip(parts, reversed(before)):
            out[where] = (behind, state, where == parts[-1][0])
            state = exits[where][state] if exits else state
    return out


def repair(rows: DataFrame, most: int = FRAGMENT) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest edits of conversations given as (conv, turn, role, text).

    The first frame has a row per conversation: ck (see ``key``), conv, gaps,
    blank, duplicate, truncated, illegal, cost, audit. The second has the
    edits: ck, tail, turn, id, edit, one row per turn that stays, where
    ``edit`` is the inserted turn before it if any (u, a), then K (kept), U or
    A (made user, assistant), and one row with ``tail`` 1 for the turns
    inserted at the end. Turns go by ``turn``, nulls first, and within one
    value by the SHA-256 of role and text. An empty table gives no rows.
    """
    spark = rows.sparkSession
    prepare(spark)
    ensure_checkpoint_dir(spark)
    symbols = _symbols(_keyed(rows))
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = symbols.repartitionByRange(parts, *order).withColumn("pid", F.spark_partition_id()).sortWithinPartitions(*order)
    placed = placed.checkpoint(eager=True)  # keeps the partitions and the order of their rows

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Min-plus matrices of the fragments that may be a part of a conversation."""
        unit = np.where(np.eye(4, dtype=bool), 0, _NEVER)
        for number, name, turns, cut in _fragments(batches, most):
            if cut:
                matrix = before_runs(_runs(turns), unit)[0].ravel()
                yield pa.RecordBatch.from_arrays([pa.array([turns[0]["pid"]], pa.int32()), pa.array([number], pa.int32()), pa.array([name]),
                                                  pa.array([matrix], pa.list_(pa.int64()))], ["pid", "number", "ck", "matrix"])

    # a few numbers for each partition and for every ``most`` turns of a long conversation reach the driver
    narrow = placed.select("ck", "pid", "symbol", "n")
    ends = [tuple(r) for r in narrow.mapInArrow(edges, "pid int, number int, ck string, matrix array<long>").collect()]
    chain = _chain(ends, None)
    if chain:
        behind = spark.sparkContext.broadcast(chain)

        def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The state after a fragment for each state before it."""
            for number, _, turns, _ in _fragments(batches, most):
                known = behind.value.get((turns[0]["pid"], number))
                if known:
                    after = [unroll(_runs(turns), np.array(known[0]), q, False)[1] for q in range(4)]
                    yield pa.RecordBatch.from_arrays([pa.array([turns[0]["pid"]], pa.int32()), pa.array([number], pa.int32()),
                                                      pa.array([after], pa.list_(pa.int32()))], ["pid", "number", "after"])

        got = narrow.mapInArrow(states, "pid int, number int, after array<int>").collect()
        chain = _chain(ends, {(r["pid"], r["number"]): r["after"] for r in got})
    links = spark.sparkContext.broadcast(chain)
    spec = _FRAGMENT.format(rows.schema["conv"].dataType.simpleString())
    types = to_arrow_schema(_parse_datatype_string(spec))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for number, name, turns, _ in _fragments(batches, most):
            held.append(_edited(name, number, turns, links.value.get((turns[0]["pid"], number), (ENDED, START, True))))
            size += len(turns)
            if size >= 20_000:
                yield pa.RecordBatch.from_pylist(held, types)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, types)

    done = materialize(placed.mapInArrow(edit, spec), "edits")
    merged = done.groupBy("ck").agg(F.sort_array(F.collect_list(F.struct(
        "pid", "number", "conv", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "low", "high", "turns"))).alias("f"))
    follow = F.greatest(F.size("f") - 1, F.lit(0))
    both = lambda f: F.aggregate(F.zip_with(F.slice("f", 1, follow), F.slice("f", 2, follow), f),
                                 F.lit(0).cast("long"), lambda s, x: s + x)
    wrong = both(lambda a, b: F.when(legal(a["last_initial"], b["first_initial"]), 0).otherwise(1).cast("long"))
    same_turn = both(lambda a, b: F.when(a["high"] == b["low"], 1).otherwise(0).cast("long"))
    total = lambda c: F.aggregate(F.col(f"f.{c}"), F.lit(0).cast("long"), lambda s, v: s + v)
    gaps = F.coalesce(F.array_max("f.high") - F.array_min("f.low") + 1 - (total("turns") - same_turn), F.lit(0).cast("long"))
    results = merged.select("ck", F.col("f")[0]["conv"].alias("conv"), gaps.alias("gaps"), total("blank").alias("blank"),
                            total("duplicate").alias("duplicate"), total("truncated").alias("truncated"), (total("illegal") + wrong).alias("illegal"),
                            total("cost").alias("cost"), F.array_join("f.audit", "").alias("audit"))
    stays = done.select("ck", F.lit(0).alias("tail"), F.explode(F.arrays_zip("kept_turn", "kept_id", "kept_edit")).alias("k"))
    stays = stays.select("ck", "tail", F.col("k.kept_turn").alias("turn"), F.col("k.kept_id").alias("id"), F.col("k.kept_edit").alias("edit"))
    tails = done.where("tail != ''").select("ck", F.lit(1).alias("tail"), F.lit(None).cast("long").alias("turn"),
                                            F.lit(None).cast("binary").alias("id"), F.col("tail").alias("edit"))
    return results, stays.unionByName(tails)


def legal(a: Column, b: Column) -> Column:
    return F.concat(a, b).isin("su", "ua", "au")


def _edited(name: str, number: int, turns: list[dict], link: tuple[list[int], int, bool]) -> dict:
    """Faults and edits of a fragment."""
    behind, begin, last = link
    costs, runs = np.array(behind, np.int64), _runs(turns)
    audit, state = unroll(runs, costs, begin, last)
    cost = int(before_runs(runs, costs)[0][begin]) - (0 if last else int(costs[state]))
    out = {"ck": name, "conv": turns[0]["conv"], "pid": turns[0]["pid"], "number": number, "audit": audit, "cost": cost,
           "blank": sum(t["n"] for t in turns if t["blank"]),
           "duplicate": sum(t["n"] - (t["symbol"] != "x") for t in turns if not t["blank"]),
           "truncated": sum(t["symbol"] in "SUA_" for t in turns), "illegal": 0, "first_initial": turns[0]["initial"],
           "last_initial": turns[-1]["initial"], "kept_turn": [], "kept_id": [], "kept_edit": []}
    known = [t["turn"] for t in turns if t["turn"] is not None]
    out |= {"low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known))}
    previous = None
    for t in turns:
        out["illegal"] += (previous is not None and previous + t["initial"] not in ("su", "ua", "au")) + t["n"] - 1
        previous = t["initial"]
    # the edits once more, with the turns they fall on
    at, state, before = iter(_copies(turns)), begin, ""
    for e in audit:
        if e == "I":
            before += _NEXT[state]
            state = _AFTER[_NEXT[state]][state]
            continue
        t = next(at)
        if e == "D":
            continue
        role = t["symbol"].lower() if e == "K" else _NEXT[state]
        out["kept_turn"].append(t["turn"])
        out["kept_id"].append(t["id"])
        out["kept_edit"].append(before + ("K" if e == "K" else role.upper()))
        state, before = _AFTER[role][state], ""
    out["tail"] = before  # an insertion never stands before a deletion, as D comes before I
    return out


def _copies(turns: list[dict]) -> Iterator[dict]:
    for t in turns:
        for _ in range(t["n"]):
            yield t


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The turns that stay and those put in: (ck, role, text), a conversation's turns one after the other in order.

    Texts are shuffled once, to the edits of their conversation, and pass through in batches.
    """
    texts = _keyed(rows).select("ck", F.lit(0).alias("tail"), "turn", "id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("edit"), "role", "text")
    marks = edits.select("ck", "tail", "turn", "id", F.lit(0).alias("kind"), "edit", F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"))
    both = texts.unionByName(marks).repartition("ck").sortWithinPartitions(
        "ck", "tail", F.col("turn").asc_nulls_first(), F.col("id").asc_nulls_first(), "kind")
    names = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None  # the edit of the turn that comes next
        for b in batches:
            ck, roles, bodies = [], [], []
            text = b.column("text")
            for i, (c, tail, turn, who, kind, e, role) in enumerate(zip(*(b.column(k).to_pylist() for k in ("ck", "tail", "turn", "id", "kind", "edit", "role")))):
                if kind == 0 and not tail:
                    wanted = (c, turn, who, e)
                    continue
                if kind == 0:
                    add = [(names[x], "") for x in e]
                elif wanted and wanted[:3] == (c, turn, who):
                    *put, own = wanted[3]
                    add = [(names[x], "") for x in put] + [(role if own == "K" else names[own], text[i].as_py())]
                    wanted = None  # a further equal turn is a duplicate and goes
                else:
                    continue
                for r, t in add:
                    ck.append(c)
                    roles.append(r)
                    bodies.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (ck, roles, bodies)], ["ck", "role", "text"])

    return both.mapInArrow(run, "ck string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """(ck, repaired_sha256) of the result of ``repaired``: ``role:text``, joined by newlines.

    SHA-256 is sequential, so a conversation's turns pass through one task, as
    a stream of which nothing is kept but the state of the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def out(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.string())],
                                              ["ck", "repaired_sha256"])

        for b in batches:
            done = []
            for c, role, text in zip(b.column("ck").to_pylist(), b.column("role").to_pylist(), b.column("text")):
                if c == name:
                    state.update(b"\n")
                else:
                    if name is not None:
                        done.append((name, state.hexdigest()))
                    name, state = c, hashlib.sha256()
                state.update(f"{role}:".encode())
                state.update(text.as_buffer())
            yield out(done)
        if name is not None:
            yield out([(name, state.hexdigest())])

    return turns.mapInArrow(run, "ck string, repaired_sha256 string")


def repair_conversations(df: DataFrame, rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``df``: conv_id, faults, cost and audit of ``rows``, repaired_sha256.

    ``rows`` are (conv, turn, role, text), such as ``damage(df)``. Conversations
    without rows have zeros, an empty audit and the hash of nothing. A null
    conversation id is a conversation of its own.
    """
    results, edits = repair(rows)
    hashed = digests(repaired(rows, edits))
    every = df.select(F.col(conv).alias("conv_id"), key(conv).alias("ck")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = every.join(results.drop("conv"), "ck", "left").join(hashed, "ck", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
