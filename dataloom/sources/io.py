"""LOAD / STORE: readers and writers over Spark's data sources.

Every function is a thin, typed use of ``spark.read`` / ``df.write``; the
formats themselves are Spark's. Paths are expected on shared storage.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """LOAD 'path' USING fmt AS schema."""
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", partition_by: Sequence[str] = (), **options) -> None:
    """STORE df INTO 'path' USING fmt (save mode, partition columns, options)."""
    w = df.write.format(fmt).mode(mode).options(**{k: str(v) for k, v in options.items()})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# ------------------------------------------------------------- fixed width


def parse_ranges(spec: str) -> list[tuple[int, int | None]]:
    """cut-style column ranges '-5, 10-12, 14, 20-' -> 1-based (start, end) pairs."""
    out = []
    for part in spec.split(","):
        p = part.strip()
        if p.startswith("-"):
            out.append((1, int(p[1:])))
        elif p.endswith("-"):
            out.append((int(p[:-1]), None))
        elif "-" in p:
            a, b = p.split("-")
            out.append((int(a), int(b)))
        else:
            out.append((int(p), int(p)))
    return out


def read_fixed_width(spark: SparkSession, path: str, spec: str, schema: T.StructType) -> DataFrame:
    """Columns by character ranges; blank fields are null; typed with try_cast."""
    lines = spark.read.text(path)
    cols = []
    for (a, b), f in zip(parse_ranges(spec), schema.fields):
        raw = F.substring("value", a, (b - a + 1) if b else 1 << 30)
        txt = F.nullif(F.trim(raw), F.lit(""))
        cols.append(txt.try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.StringType) else txt.alias(f.name))
    return lines.select(*cols)


def to_fixed_width(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One text column: each field right-padded (nulls become spaces) and cut to width."""
    parts = [F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("")), w, " ") for c, w in widths.items()]
    return df.select(F.concat(*parts).alias("value"))


# ---------------------------------------------------------------- regex


def read_regex(spark: SparkSession, path: str, regex: str, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Lines to columns by capture groups; returns (parsed, rejected lines)."""
    lines = spark.read.text(path)
    ok = F.col("value").rlike(regex)
    parsed = lines.filter(ok).select(*[F.regexp_extract("value", regex, i + 1).alias(n) for i, n in enumerate(names)])
    return parsed, lines.filter(~ok)


# fixed values: common and combined access-log layouts (host ident user [time] "request" status bytes ["referrer" "agent"])
COMMON_LOG = r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d{3}) (\S+)'
COMBINED_LOG = COMMON_LOG + r' "([^"]*)" "([^"]*)"'
COMMON_FIELDS = ["remote_addr", "remote_logname", "user", "time", "method", "request", "protocol", "status", "bytes"]
COMBINED_FIELDS = COMMON_FIELDS + ["referer", "user_agent"]


# ---------------------------------------------------------- multi format

EXTENSION_FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".orc": "orc", ".txt": "text"}


def read_multi_format(spark: SparkSession, folder: str, csv_options: Mapping[str, str] | None = None) -> DataFrame:
    """Folder of mixed files: one reader per extension (``pathGlobFilter``),
    results unioned by name with missing columns as null."""
    out = None
    for ext, fmt in EXTENSION_FORMATS.items():
        r = spark.read.format(fmt).option("pathGlobFilter", f"*{ext}").option("recursiveFileLookup", "true")
        if fmt == "csv":
            r = r.options(**(csv_options or {"header": "true", "inferSchema": "true"}))
        try:
            df = r.load(folder)
        except Exception as e:  # no file of that kind in the folder
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "Unable to infer" in str(e):
                continue
            raise
        if not df.columns:
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


# ------------------------------------------------------- schema sidecar

SCHEMA_FILE = "_schema"


def write_with_schema(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", **options) -> None:
    """Store data plus its schema (JSON) in a side folder, so a reader needs no schema."""
    spark = df.sparkSession
    write(df, f"{path}/data", fmt, mode, **options)
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/{SCHEMA_FILE}")


def read_with_schema(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """Load with the schema stored beside the data (one small text row)."""
    text = spark.read.text(f"{path}/{SCHEMA_FILE}").first()[0]
    schema = T.StructType.fromJson(json.loads(text))
    return read(spark, f"{path}/data", fmt, schema=schema, **options)


def file_name(col: str = "_metadata.file_name") -> Column:
    """Source file of each row (``-tagFile``); ``_metadata.file_path`` for ``-tagPath``."""
    return F.col(col)


# ------------------------------------------------- Hadoop input and output formats

_HADOOP = "org.apache.hadoop.mapreduce.lib"
_TEXT = "org.apache.hadoop.io.Text"


def write_fixed_records(df: DataFrame, path: str, widths: Mapping[str, int]) -> str:
    """Save rows as records of one length through Hadoop's text output format; returns ``path``.

    Fields are padded to their widths (a null is blank); the format ends each
    record with a newline, which counts to its length. A longer field is an error.
    """
    fits = [F.coalesce(F.length(F.col(c).cast("string")) <= w, F.lit(True)) for c, w in widths.items()]
    checked = df.select(*[F.when(ok, F.col(c).cast("string")).otherwise(F.raise_error(F.lit(f"{c} is longer than {w}"))).alias(c)
                          for ok, (c, w) in zip(fits, widths.items())])
    to_fixed_width(checked, widths).rdd.map(lambda r: (None, r[0])).saveAsNewAPIHadoopFile(
        path, f"{_HADOOP}.output.TextOutputFormat", "org.apache.hadoop.io.NullWritable", _TEXT)
    return path


def read_fixed_records(spark: SparkSession, path: str, widths: Mapping[str, int], batch: int = 4096) -> DataFrame:
    """Records cut out by their length alone (``FixedLengthInputFormat``) as text columns, blanks cut off, blank fields null.

    Python hands over ``batch`` records at a time and Spark takes them apart.
    """
    size = sum(widths.values()) + 1
    chunks = spark.sparkContext.binaryRecords(path, size).mapPartitions(lambda it: ((bytearray(b"".join(x)),) for x in batched(it, batch)))
    many = spark.createDataFrame(chunks, "chunk binary")
    count = F.floor(F.octet_length("chunk") / size).cast("int")
    one = many.select("chunk", F.explode(F.sequence(F.lit(0), count - 1)).alias("k")).select(F.substring(F.col("chunk"), F.col("k") * size + 1, F.lit(size)).alias("r"))
    cols, at = [], 1
    for c, w in widths.items():
        cols.append(F.nullif(F.trim(F.decode(F.substring("r", at, w), "UTF-8")), F.lit("")).alias(c))
        at += w
    return one.select(*cols)


def write_hadoop_pairs(df: DataFrame, path: str) -> str:
    """Save the first two columns as texts through Hadoop's sequence file output format; returns ``path``."""
    texts = df.select(*[F.col(c).cast("string") for c in df.columns[:2]])
    texts.rdd.map(tuple).saveAsNewAPIHadoopFile(path, f"{_HADOOP}.output.SequenceFileOutputFormat", _TEXT, _TEXT)
    return path


def read_hadoop_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) texts of a sequence file, by input format class."""
    pairs = spark.sparkContext.newAPIHadoopFile(path, f"{_HADOOP}.input.SequenceFileInputFormat", _TEXT, _TEXT)
    return spark.createDataFrame(pairs, "key string, value string")
