"""Fields of web logs: search engine and query term of a referrer, date part of a log stamp.

The host table is a tab-separated file with a header: host, engine, keys. ``keys``
names the query keys of the engine as alternatives (``q|query``), in order of
preference behind ``>``; a leading ``/`` instead is the path before the term.
Null or empty: no query term is taken. The hosts, engines and keys of
``search_hosts.tsv`` are fixed values.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.operators.joins import checked_broadcast

_SCHEMA = "host string, engine string, keys string"


def host_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The host table in file ``path`` (any store), or the reference's hosts; one row per host."""
    if path is None:
        lines = resources.files("dataloom.functions").joinpath("search_hosts.tsv").read_text(encoding="utf8").splitlines()[1:]
        hosts = spark.createDataFrame([tuple(x or None for x in line.split("\t")) for line in lines], _SCHEMA)
    else:
        hosts = spark.read.csv(path, schema=_SCHEMA, sep="\t", header=True)
    return hosts.where("host IS NOT NULL").groupBy(F.lower("host").alias("host")).agg(F.min(F.struct("engine", "keys")).alias("x")).select("host", "x.*")


def search_host(df: DataFrame, host: str, hosts: DataFrame) -> DataFrame:
    """``df`` with engine and keys of the longest suffix of whole labels of column ``host`` that the table has."""
    # each different host is taken apart once and met with the table in one join
    own = df.select(F.lower(F.col(host)).alias("__host")).where(F.col("__host").isNotNull()).distinct()
    labels = F.size(F.split("__host", r"\."))
    ends = own.select("__host", F.explode(F.transform(
        F.sequence(F.lit(1), labels), lambda k: F.concat_ws(".", F.slice(F.split("__host", r"\."), -k, k)))).alias("__end"))
    met = ends.join(checked_broadcast(hosts), ends["__end"] == hosts["host"])
    best = met.groupBy("__host").agg(F.max_by(F.struct("engine", "keys"), F.length("__end")).alias("__x"))
    best = best.select(F.col("__host").alias("__known"), "__x")
    out = df.join(best, F.lower(F.col(host)) == F.col("__known"), "left")
    return out.select(*[df[c] for c in df.columns], F.col("__x.engine").alias("engine"), F.col("__x.keys").alias("keys"))


def search_term(url: Column, keys: Column) -> Column:
    """The decoded query term of a URL: of the first key that is there; null without one or when it cannot be decoded."""
    asked = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    each = F.transform(F.split(keys, ">"), lambda k: F.nullif(
        F.call_function("regexp_extract", asked, F.concat(F.lit(r"\b(?:"), k, F.lit(")=([^&]+)")), F.lit(1)), F.lit("")))
    path = F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    rest = F.when(path.startswith(keys), F.substring(path, F.length(keys) + 1, F.length(path))).otherwise(path)
    return F.try_url_decode(F.when(keys.startswith("/"), rest).otherwise(F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0))))


def date_part(stamp: Column, pattern: str = "dd/MMM/yyyy:HH:mm:ss Z", out: str = "yyyy-MM-dd") -> Column:
    """Part of a log stamp in the session's time zone; null when it cannot be parsed."""
    return F.date_format(F.try_to_timestamp(stamp, F.lit(pattern)), out)
