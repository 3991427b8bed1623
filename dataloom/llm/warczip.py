"""WARC records in ZIP packages: written once, read by range without extraction.

A package is a ZIP archive of stored (uncompressed) members: the records, one
gzip member each, in ``archive/data.warc.gz``, and ``indexes/index.cdxj`` with a
line per record that gives its offset and length in that member. A reader
parses the end of the archive (ZIP64 included), finds where the stored members
lie, reads the index, and from then on reads single records by their byte range.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.llm.common import materialize, prepare
from dataloom.session import scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ReadAt = Callable[[int, int], bytes]

# Fixed values of the formats.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MOST32, _MOST16 = 0xFFFFFFFF, 0xFFFF


def zip_package(members: list[tuple[str, bytes]], comment: bytes = b"", zip64: bool = False) -> bytes:
    """A ZIP archive of stored members; ZIP64 fields where a size needs them or ``zip64`` asks for them."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        wide = zip64 or len(data) >= _MOST32 or at >= _MOST32
        n, where = (_MOST32, _MOST32) if wide else (len(data), at)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b""
        out += _LOCAL + struct.pack("<5H3I2H", 45 if wide else 20, 0x800, 0, 0, 33, crc, n, n, len(raw), len(extra)) + raw + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if wide else b""
        central += _CENTRAL + struct.pack("<6H3I5H2I", 45, 45 if wide else 20, 0x800, 0, 0, 33, crc, n, n, len(raw), len(extra), 0, 0, 0, 0, where) + raw + extra
    start, size, count = len(out), len(central), len(members)
    out += central
    if zip64 or start + size >= _MOST32 or count >= _MOST16:
        at = len(out)
        out += _END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, count, count, size, start) + _LOCATOR64 + struct.pack("<IQI", 0, at, 1)
        start, size, count = _MOST32, _MOST32, _MOST16
    return bytes(out + _END + struct.pack("<4H2IH", 0, 0, count, count, size, start, len(comment)) + comment)


def stored_members(read_at: ReadAt, size: int) -> dict[str, tuple[int, int]]:
    """Name to (offset, length) of the data of each stored member; compressed members are left out."""
    tail_at = max(0, size - 65_557 - 20)
    tail = read_at(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (at + 22 > len(tail) or struct.unpack_from("<H", tail, at + 20)[0] != len(tail) - at - 22):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no ZIP directory")
    count, length, start = struct.unpack_from("<10xHII", tail, at)
    if _MOST32 in (length, start) or count == _MOST16:
        if tail[at - 20: at - 16] == _LOCATOR64:
            where, = struct.unpack_from("<8xQ", tail, at - 20)
            end64 = read_at(where, 56)
            if end64[:4] != _END64:
                raise ValueError("no ZIP64 directory")
            length, start = struct.unpack_from("<40xQQ", end64)
    central = read_at(start, length)
    found, p = {}, 0
    while central[p: p + 4] == _CENTRAL:
        method, packed, plain, n, m, k, where = struct.unpack_from("<10xH8xIIHHH8xI", central, p)
        name = central[p + 46: p + 46 + n].decode()
        extra, q = central[p + 46 + n: p + 46 + n + m], 0
        while q + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # the wide fields that are marked, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, q + 4))
                plain = next(wide) if plain == _MOST32 else plain
                packed = next(wide) if packed == _MOST32 else packed
                where = next(wide) if where == _MOST32 else where
            q += 4 + width
        if method == 0:
            local = read_at(where, 30)
            if local[:4] != _LOCAL:
                raise ValueError(f"no member {name}")
            a, b = struct.unpack_from("<HH", local, 26)
            found[name] = (where + 30 + a + b, packed)
        p += 46 + n + m + k
    return found


def warc_record(record_id: str, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """One record; a revisit names the record whose payload it repeats and carries none."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"] if url else []
    head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"] if refers_to is not None else []
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record's HTTP block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]


def write(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = 100, archive_bytes: int = 16 << 20) -> None:
    """Write a record per row into packages below ``path``, by tasks, with Spark's commit.

    Of rows with equal payloads of at least ``least`` bytes those with the
    smallest id are responses and the others revisit them. Null html is an
    empty payload. A row with a null id is a revisit if another id has its
    payload, else a response. An empty table writes no package. A package holds
    about ``archive_bytes`` of payload (one longer payload: that one).
    """
    prepare(df.sparkSession)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    same = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    same = materialize(same.where("n > 1 and first is not null").select("digest", "first"), "first-pages")
    refers = F.when(F.col("size") >= least, F.when(F.col("id").isNull() | (F.col("id") != F.col("first")), F.col("first")))
    told = rows.join(same, "digest", "left").select(
        "id", "url", "size", "digest", refers.alias("refers"), F.when(refers.isNull(), F.col("payload")).alias("payload"))

    def packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index, raw = bytearray(), [], 0

        def done() -> pa.RecordBatch:
            members = [(DATA, bytes(data)), (INDEX, "".join(index).encode())]
            # the writer ends the file with a line feed: it is the archive's comment
            return pa.RecordBatch.from_pydict({"archive": pa.array([zip_package(members, b"\n")[:-1]], pa.binary())})

        for b in batches:
            for r in zip(*(b.column(c) for c in ("id", "url", "size", "digest", "refers", "payload"))):
                i, url, size, digest, refers_to, body = (x.as_py() for x in r)
                name = "" if i is None else str(i)
                to = None if refers_to is None else str(refers_to)
                record = gzip.compress(warc_record(name, url, body or b"", size, digest, to), 1, mtime=0)
                index.append(json.dumps({"id": name, "offset": len(data), "length": len(record)}) + "\n")
                data += record
                raw += len(body or b"")
                if raw >= archive_bytes or len(data) >= archive_bytes:
                    yield done()
                    data, index, raw = bytearray(), [], 0
        if index:
            yield done()

    made = told.mapInArrow(packages, "archive binary")
    made.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _opener(path: str) -> ReadAt | None:
    """Range reads of a file by its address; None where this process has no file system for it."""
    address = urlparse(path)
    try:
        if address.scheme in ("", "file"):
            file = pyarrow.fs.LocalFileSystem().open_input_file(unquote(address.path))
        else:
            system, name = pyarrow.fs.FileSystem.from_uri(path)
            file = system.open_input_file(name)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
        if address.scheme in ("", "file"):
            raise
        return None
    return lambda at, n: file.read_at(n, at)


def _ranges(read_at: ReadAt, size: int) -> list[tuple[int, int]]:
    """Offset and length in the archive of every record its index names."""
    members = stored_members(read_at, size)
    base, _ = members[DATA]
    lines = read_at(*members[INDEX]).decode().splitlines()
    return [(base + x["offset"], x["length"]) for x in map(json.loads, lines)]


_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _row(data: bytes) -> tuple:
    fields, payload = parse_record(gzip.decompress(data))
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", x or "")) else None
    kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"])
    if kind == "response":
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return number(fields["warc-record-id"]), size, digest, kind, number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    cols = zip(*rows) if rows else [[] for _ in kinds]
    names = [x.split()[0] for x in _RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def read(spark: SparkSession, path: str, block_bytes: int = 4 << 20) -> DataFrame:
    """One row per record of the packages below ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    Tasks parse the directories and indexes, deal the records over blocks of
    about ``block_bytes`` and read each block's records by range. Where
    the workers have no file system for the address (a store only Spark can
    open), Spark hands over whole packages, one by one, and the same code reads
    the records out of them. A response whose payload does not match its digest
    raises an error.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    if urlparse(path).scheme not in ("", "file"):
        try:
            pyarrow.fs.FileSystem.from_uri(path)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
            return files.select("content").mapInArrow(_whole, _RECORD)
    places = files.select("path", "length").mapInArrow(_places, "path string, at long, length long")
    block = F.floor(F.col("at") / block_bytes)
    total = files.agg(F.sum("length")).first()[0] or 0
    # a given number: a range is a few bytes here but stands for a whole record, so partitions must not be merged by size
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(total / (128 << 20)))
    dealt = places.repartition(parts, "path", block).sortWithinPartitions("path", "at")
    return dealt.mapInArrow(_fetch, _RECORD)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column(0):
            data = x.as_buffer()
            read_at: ReadAt = lambda at, n, d=data: d.slice(at, n).to_pybytes()
            rows = [_row(read_at(*r)) for r in _ranges(read_at, data.size)]
            for a in range(0, len(rows), 500):
                yield _batch(rows[a: a + 500])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            read_at = _opener(path)
            if read_at is None:
                raise ValueError(f"no file system for {path}")
            found = _ranges(read_at, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                ["path", "at", "length"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened, read_at = None, None
    for b in batches:
        rows, held = [], 0
        for path, at, length in zip(*(b.column(i).to_pylist() for i in range(3))):
            if path != opened:
                opened, read_at = path, _opener(path)
            rows.append(_row(read_at(at, length)))
            held += rows[-1][1]
            if held > 8 << 20:
                yield _batch(rows)
                rows, held = [], 0
        yield _batch(rows)


def round_trip(df: DataFrame, name: str = "warc", **options) -> DataFrame:
    """Write ``df`` into packages in a new folder of the shared scratch space and read them back."""
    spark = df.sparkSession
    prepare(spark)
    path = scratch_path(spark, name)
    write(df, path, **options)
    return read(spark, path)
