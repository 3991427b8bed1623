"""§2.10 user functions: scalar, pandas (scalar / grouped agg / group map /
cogroup / batches), table functions, filters, typed aggregates, STREAM THROUGH.

Python runs per Arrow batch, never per row, except where the API is per-row by
definition (``udf``, here Arrow-optimised). Grouped pandas functions are used
on groups bounded by the data model (the lines of one order), never on a key
that can hold a large share of the rows; one call gets a bucket of many orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from dataloom.operators import groups as G
from dataloom.plans.registry import query
from dataloom.session import table


def _distinct_chars(s: str | None) -> int | None:
    return None if s is None else len(set(s))


@query(
    "udf_scalar_python",
    "SELECT p_partkey, CAST(len(list_distinct(string_split(p_name, ''))) AS INTEGER) AS n_chars, "
    "CAST(len(list_distinct(string_split(p_type, ''))) AS INTEGER) AS n_type_chars FROM part",
)
def udf_scalar_python(spark, sf):
    """A Python row function with a declared type (Arrow-optimised), also registered for SQL."""
    f = F.udf(_distinct_chars, T.IntegerType(), useArrow=True)
    spark.udf.register("distinct_chars", f)
    table(spark, sf, "part").createOrReplaceTempView("part_udf")
    via_sql = spark.sql("SELECT p_partkey, distinct_chars(p_type) AS n_type_chars FROM part_udf")
    return table(spark, sf, "part").select("p_partkey", f("p_name").alias("n_chars")).join(via_sql, "p_partkey")


@F.pandas_udf(T.DoubleType())
def _net_price(price: pd.Series, disc: pd.Series) -> pd.Series:
    return price * (1.0 - disc)


@F.pandas_udf(T.LongType())
def _band(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator form: set-up once per task (the band edges), then batches."""
    edges = np.array([0.0, 10000.0, 30000.0, 60000.0])
    for price in it:
        yield pd.Series(np.searchsorted(edges, price.to_numpy(), side="right")).astype("int64")


@query(
    "udf_pandas_scalar",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
              CAST(CASE WHEN l_extendedprice >= 60000 THEN 4 WHEN l_extendedprice >= 30000 THEN 3
                        WHEN l_extendedprice >= 10000 THEN 2 WHEN l_extendedprice >= 0 THEN 1 ELSE 0 END AS BIGINT) AS band
       FROM lineitem""",
)
def udf_pandas_scalar(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", _net_price("l_extendedprice", "l_discount").alias("net"),
                     _band("l_extendedprice").alias("band"))


@F.pandas_udf(T.DoubleType())
def _spread(v: pd.Series) -> float:
    x = v.to_numpy()
    got = float(x.max() - x.min())
    return got if got == got else float(v.max() - v.min())  # pandas leaves out nulls


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("spread", T.DoubleType())])))
def _spreads(key: pd.Series, v: pd.Series) -> list:
    """The spread of every order of a bucket."""
    orders = v.groupby(key, dropna=False)
    got = orders.max() - orders.min()
    return [{"l_orderkey": k, "spread": x} for k, x in zip(got.index.tolist(), got.tolist())]


@query(
    "udf_pandas_agg",
    """SELECT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_orderkey) - min(l_quantity) OVER (PARTITION BY l_orderkey) AS spread_over,
              s.spread
       FROM lineitem JOIN (SELECT l_orderkey AS k, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY 1) s ON s.k = l_orderkey""",
)
def udf_pandas_agg(spark, sf):
    """Grouped-aggregate pandas UDF in ``agg`` (a bucket of whole orders per call) and over a
    window (the lines of an order: the peers of a line among those of its bucket)."""
    from pyspark.sql import Window

    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    li = li.where("l_orderkey IS NOT NULL")  # the join below has no row of a null order
    bucket = G.key_bucket("l_orderkey", G.bucket_count(li))
    g = li.groupBy(bucket.alias("bucket")).agg(_spreads("l_orderkey", "l_quantity").alias("s")).select(F.inline("s"))
    peers = Window.partitionBy(bucket).orderBy("l_orderkey").rangeBetween(Window.currentRow, Window.currentRow)
    w = li.select("l_orderkey", "l_linenumber", _spread("l_quantity").over(peers).alias("spread_over"))
    return w.join(g, "l_orderkey")


def _shares(pdf: pd.DataFrame) -> pd.DataFrame:
    tot = pdf.groupby("l_orderkey", dropna=False, sort=False)["l_quantity"].transform("sum")
    return pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"],
                         "share": pdf["l_quantity"] / tot})


@query(
    "udf_group_map",
    """SELECT l_orderkey, l_linenumber, l_quantity / SUM(l_quantity) OVER (PARTITION BY l_orderkey) AS share FROM lineitem""",
)
def udf_group_map(spark, sf):
    """applyInPandas: the lines of a bucket of whole orders in, each line's share of its order out."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    bucket = G.key_bucket("l_orderkey", G.bucket_count(li))
    return li.groupBy(bucket.alias("bucket")).applyInPandas(_shares, "l_orderkey long, l_linenumber int, share double")


def _order_summaries(o: pd.DataFrame, li: pd.DataFrame) -> pd.DataFrame:
    """One row per order of either side."""
    price = o.groupby("o_orderkey", dropna=False)["o_totalprice"].sum()
    lines = li.groupby("l_orderkey", dropna=False)["l_extendedprice"].agg(["size", "sum"])
    both = pd.concat([price, lines], axis=1, join="outer").fillna(0)
    return pd.DataFrame({"o_orderkey": both.index, "n_lines": both["size"].to_numpy().astype("int64"),
                         "gap": [round(x, 2) for x in (both["o_totalprice"] - both["sum"]).tolist()]})


@query(
    "udf_cogroup_map",
    """SELECT o.o_orderkey, COUNT(l.l_orderkey) AS n_lines, round(o.o_totalprice - coalesce(SUM(l.l_extendedprice), 0), 2) AS gap
       FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_totalprice""",
)
def udf_cogroup_map(spark, sf):
    """cogroup(...).applyInPandas: a bucket of whole orders and their lines per call."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    n = G.bucket_count(o, li)
    return o.groupBy(G.key_bucket("o_orderkey", n).alias("bucket")).cogroup(li.groupBy(G.key_bucket("l_orderkey", n).alias("bucket"))).applyInPandas(
        _order_summaries, "o_orderkey long, n_lines long, gap double")


def _batches(it):
    for pdf in it:
        yield pdf.assign(charge=pdf["l_extendedprice"] * (1 - pdf["l_discount"]) * (1 + pdf["l_tax"]))[
            ["l_orderkey", "l_linenumber", "charge"]]


def _arrow_batches(it):
    import pyarrow.compute as pc

    for b in it:
        yield b.select(["l_orderkey", "l_linenumber"]).append_column("qty2", pc.multiply(b.column("l_quantity"), 2.0))


@query(
    "udf_map_batches",
    """SELECT 'pandas' AS kind, l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS val FROM lineitem
       UNION ALL SELECT 'arrow', l_orderkey, l_linenumber, l_quantity * 2 FROM lineitem""",
)
def udf_map_batches(spark, sf):
    """mapInPandas and mapInArrow: iterator of batches in, batches out."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    a = li.mapInPandas(_batches, "l_orderkey long, l_linenumber int, charge double")
    b = li.mapInArrow(_arrow_batches, "l_orderkey long, l_linenumber int, qty2 double")
    return a.select(F.lit("pandas").alias("kind"), "l_orderkey", "l_linenumber", F.col("charge").alias("val")).unionByName(
        b.select(F.lit("arrow").alias("kind"), "l_orderkey", "l_linenumber", F.col("qty2").alias("val")))


@udtf(returnType="token: string, pos: int")
class _Tokens:
    """Table function: one row per word of a name, with its position."""

    def eval(self, s: str):
        if s is None:
            return
        for i, w in enumerate(s.split(" ")):
            if w:
                yield w, i


@query(
    "udf_table",
    """SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token, unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part""",
)
def udf_table(spark, sf):
    """A UDTF joined LATERAL (bag + FLATTEN in the reference)."""
    spark.udtf.register("tokens", _Tokens)
    table(spark, sf, "part").createOrReplaceTempView("part_udtf")
    return spark.sql("SELECT p_partkey, t.token, CAST(t.pos AS BIGINT) AS pos FROM part_udtf, LATERAL tokens(p_name) t")


@F.pandas_udf(T.BooleanType())
def _is_round_price(p: pd.Series) -> pd.Series:
    return (p * 100).round().astype("int64") % 100 == 0


@query("udf_filter", "SELECT p_partkey, p_retailprice FROM part WHERE CAST(round(p_retailprice * 100) AS BIGINT) % 100 = 0")
def udf_filter(spark, sf):
    """A boolean (vectorised) function used as a filter."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return p.filter(_is_round_price("p_retailprice"))


def typed_aggregate(df, key, buffer, zero, reduce, merge):
    """One buffer per key: rows are folded into buffers batch by batch where
    they lie (``reduce`` from ``zero``), and only buffers are shuffled and
    merged, a bucket of many keys at a time; a key has at most one buffer per
    input batch."""
    names = [f.split()[0] for f in buffer.split(", ")]

    def fold(batches):
        for pdf in batches:
            held = {}
            for row in pdf.itertuples(index=False):
                k = getattr(row, key)
                held[k] = reduce(held.get(k, zero), row)
            yield pd.DataFrame([(k, *b) for k, b in held.items()], columns=[key, *names])

    def combine(pdf):
        held = {}
        for k, *part in pdf[[key, *names]].itertuples(index=False, name=None):
            k = None if pd.isna(k) else k
            held[k] = merge(held.get(k, zero), part)
        return pd.DataFrame([(k, *b) for k, b in held.items()], columns=[key, *names])

    schema = f"{key} {dict(df.dtypes)[key]}, {buffer}"
    bucket = G.key_bucket(key, G.bucket_count(df))
    return df.mapInPandas(fold, schema).groupBy(bucket.alias("bucket")).applyInPandas(combine, schema)


@query(
    "udf_typed_aggregate",
    """SELECT l_orderkey, round(avg(l_extendedprice), 6) AS avg_price, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_orderkey""",
)
def udf_typed_aggregate(spark, sf):
    """A user aggregate with zero, reduce, merge and finish: average price and largest quantity of an order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    out = typed_aggregate(
        li, "l_orderkey", "s double, n long, m double", zero=(0.0, 0, float("-inf")),
        reduce=lambda a, x: (a[0] + x.l_extendedprice, a[1] + 1, max(a[2], x.l_quantity)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1], max(a[2], b[2])))
    return out.select("l_orderkey", F.round(F.col("s") / F.col("n"), 6).alias("avg_price"), F.col("m").alias("max_qty"))


@query("udf_stream_through", "SELECT upper(p_name) AS name_upper FROM part")
def udf_stream_through(spark, sf):
    """STREAM THROUGH `tr`: each partition's rows piped through an external
    command as text lines and read back with a schema."""
    p = table(spark, sf, "part").select("p_name")
    out = p.rdd.map(lambda r: r[0]).pipe("tr a-z A-Z")
    return spark.createDataFrame(out.map(lambda s: (s,)), "name_upper string")


def _with_setup(it):
    table_ = {"F": 1, "O": 2, "P": 3}  # one-off set-up per partition
    for pdf in it:
        yield pd.DataFrame({"o_orderkey": pdf["o_orderkey"], "code": pdf["o_orderstatus"].map(table_).astype("int64")})


@query(
    "udf_partition_map",
    "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS BIGINT) AS code FROM orders",
)
def udf_partition_map(spark, sf):
    """Per-partition function with set-up (mapInPandas); a foreachPartition
    side effect counts rows into an accumulator."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    acc = spark.sparkContext.accumulator(0)

    def count_rows(rows):
        n = 0
        for _ in rows:
            n += 1
        acc.add(n)

    o.foreachPartition(count_rows)
    return o.mapInPandas(_with_setup, "o_orderkey long, code long")
