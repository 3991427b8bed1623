"""FOREACH / FILTER / SPLIT / ASSERT / SAMPLE and column-set operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataloom.functions.strings import normalize_name


def col_range(df: DataFrame, first: str | None = None, last: str | None = None) -> list[str]:
    """``a..c`` projection: the columns from ``first`` to ``last`` inclusive."""
    cols = df.columns
    i = cols.index(first) if first else 0
    j = cols.index(last) if last else len(cols) - 1
    return cols[i : j + 1]


def positional(df: DataFrame, n: int) -> Column:
    """``$n``: the n-th column (0-based)."""
    return F.col(df.columns[n])


def flatten_bag(bag: Column) -> Column:
    """FLATTEN of a bag column inside ``select``.

    Empty bag: the row disappears. Null bag: the row stays with a null element
    (unlike ``explode_outer``, which also keeps empty bags).
    """
    return F.explode(F.when(bag.isNull(), F.array(F.lit(None))).otherwise(bag))


def flatten_tuple(df: DataFrame, struct_col: str, prefix: str | None = None) -> DataFrame:
    """FLATTEN of a tuple: its fields become columns (optionally ``prefix::field``)."""
    fields = df.schema[struct_col].dataType.fieldNames()
    others = [c for c in df.columns if c != struct_col]
    return df.select(
        *others, *[F.col(f"{struct_col}.{f}").alias(f"{prefix}{f}" if prefix else f) for f in fields]
    )


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake_case (others characters removed)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def pluck(df: DataFrame, prefix: str | None = None, regex: str | None = None, keep: bool = True) -> DataFrame:
    """Keep (or drop) the columns starting with ``prefix`` / matching ``regex``."""
    import re

    def hit(c):
        return (prefix is not None and c.startswith(prefix)) or (regex is not None and re.search(regex, c) is not None)

    return df.select(*[c for c in df.columns if hit(c) == keep])


_KINDS = {
    "number": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "bool": (T.BooleanType,),
}


def select_dtypes(df: DataFrame, include: Iterable[str] = ("number",), exclude: Iterable[str] = ()) -> DataFrame:
    inc = tuple(t for k in include for t in _KINDS[k])
    exc = tuple(t for k in exclude for t in _KINDS[k])
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, inc) and not isinstance(f.dataType, exc)])


def split_route(
    df: DataFrame, conds: Mapping[str, Column], otherwise: str | None = None, keep_nulls: bool = False
) -> dict[str, DataFrame]:
    """SPLIT rel INTO a IF c1, b IF c2 [, rest OTHERWISE [ALL]].

    A row goes to every branch whose condition is true. OTHERWISE takes rows
    matching none; with ``keep_nulls`` (ALL) rows whose conditions are null go
    there too. Each branch is a filter over the same input; persist the input
    when several branches are written in separate jobs.
    """
    out = {name: df.filter(c) for name, c in conds.items()}
    if otherwise:
        anyc = reduce(lambda a, b: a | b, conds.values())
        out[otherwise] = df.filter(~F.coalesce(anyc, F.lit(False))) if keep_nulls else df.filter(~anyc)
    return out


def assert_rows(df: DataFrame, cond: Column, message: str = "assertion failed") -> DataFrame:
    """ASSERT rel BY cond: the job fails on the first row where cond is not true."""
    return df.filter(F.assert_true(F.coalesce(cond, F.lit(False)), F.lit(message)).isNull())


def sample(df: DataFrame, p: float, seed: int = 42) -> DataFrame:
    """SAMPLE rel p: keep a row when rand(seed) < p (Bernoulli, no replacement)."""
    return df.filter(F.rand(seed) < F.lit(p))


# fixed value: WKT point text, "POINT (lon lat)" or "POINT(lon lat)"
WKT_POINT = r"(?i)POINT\s*\(\s*([-\d\.]+)\s+([-\d\.]+)\s*\)"


def coordinates(lat: Column, lon: Column, wkt: Column) -> tuple[Column, Column]:
    """Latitude / longitude, taken from the WKT point text where missing."""
    has = wkt.rlike(WKT_POINT)
    wlon = F.when(has, F.regexp_extract(wkt, WKT_POINT, 1)).try_cast("double")
    wlat = F.when(has, F.regexp_extract(wkt, WKT_POINT, 2)).try_cast("double")
    return F.coalesce(lat.try_cast("double"), wlat), F.coalesce(lon.try_cast("double"), wlon)


def valid_coordinates(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180)
