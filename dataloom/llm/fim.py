"""Fill-in-middle transformation with a sparse index of multibyte characters.

Texts stay UTF-8 bytes. Of a batch of texts only the *exceptions* are recorded:
the characters of more than one byte, by their code-point positions and the
bytes they have in excess of one. A code-point cut is the byte
``cut + excess before it`` and a byte cut the code point ``cut - excess before
it``, where ``searchsorted`` over the exceptions finds that excess; stretches of
ASCII need no table at all. One index serves all texts of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dataloom.llm.common import named, prepare

#: Marks before the prefix, the suffix and the middle (fixed values).
MARKS = ("<P>", "<S>", "<M>")


class SparseIndex:
    """Code-point and byte positions of UTF-8 ``data``; positions count from its start."""

    def __init__(self, data: np.ndarray) -> None:
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        #: excess bytes before exception k, and of all exceptions at the end
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        #: code point and first byte of exception k
        self.byte = lead
        self.point = lead - self.excess[:-1]

    def to_byte(self, point: np.ndarray) -> np.ndarray:
        return point + self.excess[np.searchsorted(self.point, point, "left")]

    def to_point(self, byte: np.ndarray) -> np.ndarray:
        """The code point that begins at ``byte``, or the one that ``byte`` lies in."""
        before = np.searchsorted(self.byte, byte, "left")
        point = byte - self.excess[before]
        # a byte inside a character would lie past the character's own code point
        last = np.maximum(before - 1, 0)
        inside = (before > 0) & (byte < self._end(last))
        return np.where(inside, self._at(last), point)

    def _at(self, k: np.ndarray) -> np.ndarray:
        return self.point[k] if len(self.point) else np.zeros(len(k), np.int64)

    def _end(self, k: np.ndarray) -> np.ndarray:
        return self.byte[k] + 1 + self.excess[k + 1] - self.excess[k] if len(self.byte) else np.zeros(len(k), np.int64)


def flat(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of a string column and the n + 1 borders of its rows; nulls must be filled."""
    _, borders, data = column.buffers()
    ends = np.frombuffer(borders, np.int32, len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = memoryview(data) if data is not None else memoryview(b"")
    return data[int(ends[0]): int(ends[-1])], ends - ends[0]


def _text(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary()).cast(pa.string())


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = 90, spm_rate: int = 20,
              unit: str = "char", marks: tuple[str, str, str] = MARKS, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output, rest.

    ``n`` counts code points. The two cuts, the share of ``rate`` per cent that
    is transformed and the share of ``spm_rate`` per cent of those that is
    suffix first come from the SHA-256 of ``seed:id``, so a retried task makes
    the same choices. With ``unit="byte"`` cuts are drawn over bytes and moved
    to the start of the character they fall into. ``plain`` texts come back as
    they are, with null cuts: empty texts, texts that hold one of ``marks``,
    and those outside ``rate``. A null text is empty; a null id is hashed as
    no digits. Repeated rows and equal ids are rows of their own; an empty table gives
    no rows. ``rest`` is a struct of the ``carry`` columns, whatever they are called.
    """
    if unit not in ("char", "byte"):
        raise ValueError(f"unit must be char or byte, not {unit}")
    prepare(df.sparkSession)
    rest = F.struct(*[named(c) for c in carry]) if carry else F.lit(None).cast("string")
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(named(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    part = [F.conv(F.substring(draw, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    plain = (text == "") | (part[2] % 100 >= rate)
    for m in marks:
        plain = plain | F.contains(text, F.lit(m))
    form = F.when(plain, "plain").when(part[3] % 100 < spm_rate, "spm").otherwise("psm")
    rows = df.select(named(id_col).alias("doc_id"), text.alias("text"), part[0].alias("a"), part[1].alias("b"), form.alias("form"), rest.alias("rest"))
    p, s, m = (x.encode() for x in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, border = flat(batch.column("text"))
            index = SparseIndex(np.frombuffer(data, np.uint8))
            start = index.to_point(border)  # borders of texts are borders of characters
            n = np.diff(start)
            draws = np.stack([batch.column(c).to_numpy() for c in ("a", "b")])
            if unit == "char":
                cuts = start[:-1] + np.sort(draws % (n + 1), axis=0)
            else:
                cuts = index.to_point((border[:-1] + np.sort(draws % (np.diff(border) + 1), axis=0)).ravel()).reshape(2, -1)
            at = index.to_byte(cuts.ravel()).reshape(2, -1)
            forms, out = batch.column("form").to_pylist(), []
            for form, lo, x, y, hi in zip(forms, border[:-1].tolist(), *at.tolist(), border[1:].tolist()):
                if form == "plain":
                    out.append(bytes(data[lo:hi]))
                elif form == "psm":
                    out.append(b"".join((p, data[lo:x], s, data[y:hi], m, data[x:y])))
                else:
                    out.append(b"".join((s, data[y:hi], p, data[lo:x], m, data[x:y])))
            none = np.array([f == "plain" for f in forms], bool)
            sizes = (cuts[0] - start[:-1], cuts[1] - cuts[0], at[0] - border[:-1], at[1] - at[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), batch.column("form"), *(pa.array(x, pa.int64(), mask=none) for x in sizes),
                 _text(out), batch.column("rest")],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output", "rest"])

    made = StructType([StructField("doc_id", rows.schema["doc_id"].dataType)])
    for c in ("n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"):
        made = made.add(c, "string" if c in ("form", "output") else "long")
    return rows.mapInArrow(run, made.add("rest", rows.schema["rest"].dataType))


def restore(df: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The columns of ``transform`` and ``restored`` (the text), ``restored_prefix``, ``restored_middle`` (code points).

    Only ``output`` and ``form`` are read. No text that was transformed holds a
    mark and no mark overlaps itself or another, so the first mark of each kind
    is the one that was put there.
    """
    prepare(df.sparkSession)
    p, s, m = (x.encode() for x in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("output")
            data, border = flat(column)
            index = SparseIndex(np.frombuffer(data, np.uint8))
            data = bytes(data)
            out, spans, none = [], [], []
            for form, lo, hi in zip(batch.column("form").to_pylist(), border[:-1].tolist(), border[1:].tolist()):
                none.append(form == "plain")
                if form == "plain":
                    out.append(data[lo:hi])
                    spans.append((lo, lo, lo, lo))
                    continue
                first, second = (p, s) if form == "psm" else (s, p)
                a = lo + len(first)
                b = data.index(second, a, hi)
                c = b + len(second)
                d = data.index(m, c, hi)
                e = d + len(m)
                (x, y), (u, v) = ((a, b), (c, d)) if form == "psm" else ((c, d), (a, b))
                out.append(data[x:y] + data[e:hi] + data[u:v])
                spans.append((x, y, e, hi))
            points = index.to_point(np.array(spans, np.int64).reshape(-1)).reshape(-1, 4)
            mask = np.array(none, bool)
            made = [_text(out), pa.array(points[:, 1] - points[:, 0], mask=mask), pa.array(points[:, 3] - points[:, 2], mask=mask)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "restored", "restored_prefix", "restored_middle"])

    made = StructType(list(df.schema.fields)).add("restored", "string").add("restored_prefix", "long").add("restored_middle", "long")
    return df.mapInArrow(run, made)
