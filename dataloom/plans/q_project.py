"""§2.2 projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from dataloom.functions.strings import matches, yes_no
from dataloom.operators import project as P
from dataloom.plans.fixtures import CUSTOMER_NULLS_SQL, customer_nulls, with_ctes
from dataloom.plans.registry import query
from dataloom.session import table


@query("proj_select", "SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal AS acct FROM customer")
def proj_select(spark, sf):
    """Column list, rename, range ``c_custkey..c_nationkey`` minus one, positional ``$3``."""
    c = table(spark, sf, "customer")
    rng = P.col_range(c, "c_custkey", "c_nationkey")
    return c.select(rng[0], F.col(rng[1]).alias("name"), rng[2], P.positional(c, 3).alias("acct"))


@query(
    "proj_with_columns",
    """SELECT o_orderkey AS orderkey, o_custkey, round(o_totalprice * 1.1, 4) AS o_totalprice,
              year(o_orderdate) AS order_year, o_orderstatus = 'F' AS is_final
       FROM orders""",
)
def proj_with_columns(spark, sf):
    o = table(spark, sf, "orders")
    return (
        o.withColumns({"o_totalprice": F.round(F.col("o_totalprice") * 1.1, 4), "order_year": F.year("o_orderdate").cast("long")})
        .withColumnsRenamed({"o_orderkey": "orderkey"})
        .withColumn("is_final", F.col("o_orderstatus") == "F")
        .drop("o_orderstatus", "o_orderdate", "o_orderpriority")
        .withMetadata("o_totalprice", {"comment": "price incl. 10 %"})
    )


@query(
    "proj_normalize_names",
    "SELECT l_orderkey AS l_order_key, l_partkey AS part_key, l_shipdate AS ship_date, l_quantity AS qty_units FROM lineitem",
)
def proj_normalize_names(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
    messy = li.toDF(" L Order-Key", "Part/Key", "Ship Date ", "Qty (units)")
    return P.normalize_columns(messy)


@query(
    "proj_pluck_prefix",
    """SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def proj_pluck_prefix(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return P.pluck(o.join(c, o.o_custkey == c.c_custkey), prefix="c_")


@query(
    "proj_select_dtypes",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def proj_select_dtypes(spark, sf):
    return P.select_dtypes(table(spark, sf, "lineitem"), include=["number"])


@query(
    "proj_nested_fields",
    """SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status_from_map,
              round(o_totalprice * 2, 4) AS doubled, 3 AS n_fields_after
       FROM orders""",
)
def proj_nested_fields(spark, sf):
    o = table(spark, sf, "orders")
    s = o.select(
        "o_orderkey",
        F.struct("o_totalprice", "o_orderstatus", "o_orderpriority").alias("t"),
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("m"),
    )
    s = s.withColumn("t", F.col("t").withField("doubled", F.round(F.col("t.o_totalprice") * 2, 4)).dropFields("o_orderpriority"))
    return s.select(
        "o_orderkey",
        F.col("t.o_totalprice").alias("price"),
        F.col("m").getItem("status").alias("status_from_map"),
        F.col("t").getField("doubled").alias("doubled"),
        F.lit(len(s.schema["t"].dataType.fields)).alias("n_fields_after"),
    )


@query("proj_flatten_tuple", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def proj_flatten_tuple(spark, sf):
    o = table(spark, sf, "orders")
    return P.flatten_tuple(o.select("o_orderkey", F.struct("o_totalprice", "o_orderstatus").alias("t")), "t")


@query(
    "proj_flatten_bag",
    """SELECT event_id, link FROM (
         SELECT event_id, CASE WHEN event_type = 'error' THEN [NULL]
                               ELSE list_slice(['a', 'b', 'c'], 1, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4) END AS bag
         FROM events) t, unnest(t.bag) AS u(link)""",
)
def proj_flatten_bag(spark, sf):
    """FLATTEN: empty bags drop their row, a null bag (error events) keeps it with null."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    bag = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(
        F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, k % 4)
    )
    return e.select("event_id", P.flatten_bag(bag).alias("link"))


@query(
    "proj_map_family",
    """SELECT user_id AS key, lower(event_type) AS mapped, w AS flat_word, value * 2 AS map_value
       FROM (SELECT user_id, event_type, value, unnest(string_split(event_type || ' ' || CAST(user_id AS VARCHAR), ' ')) AS w
             FROM events WHERE value > 10)""",
)
def proj_map_family(spark, sf):
    """map / flatMap / filter / keyBy / mapValues as column expressions (no lambdas)."""
    e = table(spark, sf, "events")
    keyed = e.filter(F.col("value") > 10).select(
        F.col("user_id").alias("key"), F.lower("event_type").alias("mapped"), (F.col("value") * 2).alias("map_value"),
        F.split(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")), " ").alias("ws"),
    )
    return keyed.select("key", "mapped", F.explode("ws").alias("flat_word"), "map_value")


@query(
    "filter_predicate",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey FROM customer_nulls
                WHERE (bal > 1000 AND seg = 'BUILDING') OR NOT (nation < 10)""",
    ),
)
def filter_predicate(spark, sf):
    """Three-valued AND / OR / NOT: a null condition drops the row."""
    c = customer_nulls(spark, sf)
    return c.filter(((F.col("bal") > 1000) & (F.col("seg") == "BUILDING")) | ~(F.col("nation") < 10)).select("c_custkey")


@query(
    "pred_compare",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, nation = 3 AS eq, nation <> 3 AS ne, bal < 0 AS lt, bal <= 100 AS le, bal > 9000 AS gt,
                       bal >= 5000 AS ge, nation IS NOT DISTINCT FROM 3 AS eq_null_safe, bal BETWEEN 0 AND 1000 AS btw
                FROM customer_nulls""",
    ),
)
def pred_compare(spark, sf):
    c = customer_nulls(spark, sf)
    n, b = F.col("nation"), F.col("bal")
    return c.select(
        "c_custkey", (n == 3).alias("eq"), (n != 3).alias("ne"), (b < 0).alias("lt"), (b <= 100).alias("le"),
        (b > 9000).alias("gt"), (b >= 5000).alias("ge"), n.eqNullSafe(3).alias("eq_null_safe"), b.between(0, 1000).alias("btw"),
    )


@query(
    "pred_in_null",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, nation IN (1, 2, 3) AS in_list, name IS NULL AS name_null, bal IS NOT NULL AS bal_set,
                       coalesce(isnan(CASE WHEN nation = 0 THEN CAST('NaN' AS DOUBLE) ELSE bal END), FALSE) AS is_nan
                FROM customer_nulls""",
    ),
)
def pred_in_null(spark, sf):
    c = customer_nulls(spark, sf)
    b = F.col("bal")
    return c.select(
        "c_custkey", F.col("nation").isin(1, 2, 3).alias("in_list"), F.col("name").isNull().alias("name_null"),
        b.isNotNull().alias("bal_set"),
        F.isnan(F.when(F.col("nation") == 0, F.lit(float("nan"))).otherwise(b)).alias("is_nan"),
    )


@query(
    "pred_matches",
    """SELECT p_partkey, regexp_full_match(p_name, '.*(ring|bolt)') AS matches_all,
              p_name LIKE 'red%' AS like_red, p_name ILIKE '%RING' AS ilike_ring,
              regexp_matches(p_name, 'o[a-z]t') AS rlike_find, contains(p_name, 'widget') AS has_widget,
              starts_with(p_brand, 'Brand#1') AS sw, ends_with(p_type, 'ED') AS ew
       FROM part""",
)
def pred_matches(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", matches(F.col("p_name"), ".*(ring|bolt)").alias("matches_all"),
        F.col("p_name").like("red%").alias("like_red"), F.col("p_name").ilike("%RING").alias("ilike_ring"),
        F.col("p_name").rlike("o[a-z]t").alias("rlike_find"), F.col("p_name").contains("widget").alias("has_widget"),
        F.col("p_brand").startswith("Brand#1").alias("sw"), F.col("p_type").endswith("ED").alias("ew"),
    )


@query(
    "pred_bincond_case",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey,
                       CASE WHEN bal > 5000 THEN 'rich' WHEN bal > 0 THEN 'ok' WHEN bal IS NULL THEN NULL ELSE 'debt' END AS tier,
                       CASE WHEN (nation > 10) IS NULL THEN NULL WHEN nation > 10 THEN 1 ELSE 0 END AS bincond,
                       CASE seg WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE 'other' END AS decoded,
                       CASE WHEN bal <= 0 THEN 'low' WHEN bal <= 5000 THEN 'mid' WHEN bal IS NOT NULL THEN 'high' END AS bin,
                       coalesce(name, seg, 'none') AS first_set, greatest(nation, 12) AS g, least(nation, 12) AS l
                FROM customer_nulls""",
    ),
)
def pred_bincond_case(spark, sf):
    c = customer_nulls(spark, sf)
    b, n = F.col("bal"), F.col("nation")
    cond = n > 10
    return c.select(
        "c_custkey",
        F.when(b > 5000, "rich").when(b > 0, "ok").when(b.isNull(), F.lit(None)).otherwise("debt").alias("tier"),
        # c ? a : b with a null c gives null
        F.when(cond.isNull(), F.lit(None)).when(cond, 1).otherwise(0).alias("bincond"),
        F.when(F.col("seg") == "BUILDING", "B").when(F.col("seg") == "MACHINERY", "M").otherwise("other").alias("decoded"),
        F.when(b <= 0, "low").when(b <= 5000, "mid").when(b.isNotNull(), "high").alias("bin"),
        F.coalesce("name", "seg", F.lit("none")).alias("first_set"),
        # greatest / least skip nulls in Spark; the SQL twin does too
        F.greatest(n, F.lit(12)).alias("g"), F.least(n, F.lit(12)).alias("l"),
    )


#: texts that may cast to a double: a number's first and last character, or the name of a special value
MAY_BE_NUMBER = r"(?i)^[\x00-\x20]*[+-]?([0-9.].*[0-9.fd]|[0-9]|infinity|inf|nan)[\x00-\x20]*$"


def _whole_number(text, at_most: int):
    """An integer of so many digits after its leading zeros, between blanks and control characters."""
    return text.rlike(rf"^[\x00-\x20\x7F]*[+-]?0*[0-9]{{1,{at_most}}}[\x00-\x20\x7F]*$")


def numeric_checks(text):
    """Whether a text casts to an int, a long, a double. A cast that fails throws inside
    and costs as much as hundreds that succeed: only texts whose form leaves it open are cast."""
    as_long = text.try_cast("long")
    is_int = F.when(_whole_number(text, 9), True).when(_whole_number(text, 10), as_long.between(-(1 << 31), (1 << 31) - 1)).otherwise(False)
    is_long = F.when(_whole_number(text, 18), True).when(_whole_number(text, 19), as_long.isNotNull()).otherwise(False)
    is_double = F.when(text.rlike(MAY_BE_NUMBER), text.try_cast("double").isNotNull()).otherwise(False)
    return is_int.alias("is_int"), is_long.alias("is_long"), is_double.alias("is_double")


@query(
    "pred_numeric_check",
    """SELECT item, TRY_CAST(item AS INTEGER) IS NOT NULL AND regexp_full_match(trim(item), '[+-]?[0-9]+') AS is_int,
              TRY_CAST(item AS BIGINT) IS NOT NULL AND regexp_full_match(trim(item), '[+-]?[0-9]+') AS is_long,
              TRY_CAST(item AS DOUBLE) IS NOT NULL AS is_double
       FROM (SELECT unnest(string_split(props || ' ' || CAST(value AS VARCHAR) || ' ' || event_type || ' ' ||
                                        CAST(event_id * 1000000 AS VARCHAR), ' ')) AS item FROM events)""",
)
def pred_numeric_check(spark, sf):
    e = table(spark, sf, "events")
    items = e.select(
        F.explode(F.split(F.concat_ws(" ", "props", F.col("value").cast("string"), "event_type",
                                      (F.col("event_id") * 1000000).cast("string")), " ")).alias("item")
    )
    return items.select("item", *numeric_checks(F.col("item")))


@query(
    "pred_fuzzy_yes_no",
    """SELECT event_id, flag,
              CASE WHEN regexp_full_match(lower(flag), 'y|yes|true|t|1') THEN 1
                   WHEN regexp_full_match(lower(flag), 'n|no|false|f|0') THEN 0 END AS flag_bin
       FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'Yes' WHEN 'view' THEN 'N' WHEN 'purchase' THEN 'TRUE'
                                              WHEN 'signup' THEN '0' ELSE 'maybe' END AS flag FROM events)""",
)
def pred_fuzzy_yes_no(spark, sf):
    e = table(spark, sf, "events")
    flag = F.expr(
        "CASE event_type WHEN 'click' THEN 'Yes' WHEN 'view' THEN 'N' WHEN 'purchase' THEN 'TRUE' "
        "WHEN 'signup' THEN '0' ELSE 'maybe' END"
    )
    return e.select("event_id", flag.alias("flag")).withColumn("flag_bin", yes_no(F.col("flag")))


@query("assert_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def assert_rows(spark, sf):
    """ASSERT: the job fails with the message if any quantity is not positive."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return P.assert_rows(li, F.col("l_quantity") > 0, "quantity must be positive")


@query(
    "split_route",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT 'rich' AS branch, c_custkey FROM customer_nulls WHERE bal > 5000
                UNION ALL SELECT 'europe', c_custkey FROM customer_nulls WHERE nation < 8
                UNION ALL SELECT 'rest', c_custkey FROM customer_nulls WHERE NOT coalesce(bal > 5000 OR nation < 8, FALSE)""",
    ),
)
def split_route(spark, sf):
    """SPLIT into rich / europe (a row may go to both) and OTHERWISE ALL (nulls too)."""
    c = customer_nulls(spark, sf)
    parts = P.split_route(c, {"rich": F.col("bal") > 5000, "europe": F.col("nation") < 8}, otherwise="rest", keep_nulls=True)
    out = None
    for name, df in parts.items():
        d = df.select(F.lit(name).alias("branch"), "c_custkey")
        out = d if out is None else out.unionByName(d)
    return out


@query("sample_bernoulli")
def sample_bernoulli(spark, sf):
    """SAMPLE 0.1 of lineitem, a seeded 80/20 split and a stratified sample by flag."""
    li = table(spark, sf, "lineitem")
    s = P.sample(li, 0.1, seed=42).select(F.lit("sample").alias("kind"), "l_orderkey", "l_linenumber")
    tr, te = li.randomSplit([0.8, 0.2], seed=42)
    st = li.sampleBy("l_returnflag", {"A": 0.2, "N": 0.1, "R": 0.3}, seed=42)
    return s.unionByName(tr.select(F.lit("train").alias("kind"), "l_orderkey", "l_linenumber")).unionByName(
        te.select(F.lit("test").alias("kind"), "l_orderkey", "l_linenumber")
    ).unionByName(st.select(F.lit("strata").alias("kind"), "l_orderkey", "l_linenumber"))


@query(
    "cast_types",
    """SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price_long, CAST(o_orderkey AS VARCHAR) AS key_str,
              TRY_CAST(o_orderpriority AS INTEGER) AS bad_int, TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS prio,
              CAST(o_orderdate AS DATE) AS order_day, CAST(o_orderstatus = 'F' AS INTEGER) AS status_int
       FROM orders""",
)
def cast_types(spark, sf):
    """Casts; a failed cast gives null (``try_cast``, as ANSI mode would throw)."""
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        # DuckDB rounds double -> integer; Spark truncates: use round explicitly
        F.round("o_totalprice").cast("long").alias("price_long"),
        F.col("o_orderkey").cast("string").alias("key_str"),
        F.col("o_orderpriority").try_cast("int").alias("bad_int"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prio"),
        F.to_date("o_orderdate").alias("order_day"),
        (F.col("o_orderstatus") == "F").cast("int").alias("status_int"),
    )


@query(
    "scalar_subquery",
    """SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 4) AS above_avg
       FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)""",
)
def scalar_subquery(spark, sf):
    """A one-row relation used as a scalar (SQL scalar subquery; one row enforced)."""
    table(spark, sf, "orders").createOrReplaceTempView("orders_v")
    return spark.sql(
        """SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders_v), 4) AS above_avg
           FROM orders_v WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders_v)"""
    )


@query(
    "null_fill",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, coalesce(name, 'unknown') AS name, coalesce(nation, -1) AS nation,
                       coalesce(bal, 0.0) AS bal, CASE WHEN seg = 'BUILDING' THEN 'BLDG' ELSE seg END AS seg
                FROM customer_nulls
                WHERE (CASE WHEN name IS NULL THEN 1 ELSE 0 END + CASE WHEN nation IS NULL THEN 1 ELSE 0 END +
                       CASE WHEN bal IS NULL THEN 1 ELSE 0 END + CASE WHEN seg IS NULL THEN 1 ELSE 0 END) < 2
                  AND seg IS NOT NULL""",
    ),
)
def null_fill(spark, sf):
    """dropna (threshold / subset), fillna by column, replace values."""
    c = customer_nulls(spark, sf)
    c = c.na.drop(thresh=3, subset=["name", "nation", "bal", "seg"]).na.drop(subset=["seg"])
    c = c.na.fill({"name": "unknown", "nation": -1, "bal": 0.0})
    return c.na.replace({"BUILDING": "BLDG"}, subset=["seg"])


@query(
    "null_fill_directional",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, seg,
                  last(bal IGNORE NULLS) OVER (PARTITION BY seg ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bal_ffill,
                  first(bal IGNORE NULLS) OVER (PARTITION BY seg ORDER BY c_custkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bal_bfill
                FROM customer_nulls""",
    ),
)
def null_fill_directional(spark, sf):
    """ffill / bfill of the balance by segment in key order; each segment holds
    a large share of the rows, so the fill is done by positions and joins
    (no per-segment task)."""
    from dataloom.operators import seqwin as SW

    c = customer_nulls(spark, sf).select("c_custkey", "seg", F.col("bal").alias("bal_ffill"), F.col("bal").alias("bal_bfill"))
    ff = SW.fill_directional(c, ["bal_ffill"], ["c_custkey"], ["seg"], forward=True)
    return SW.fill_directional(ff, ["bal_bfill"], ["c_custkey"], ["seg"], forward=False)


@query(
    "range_coordinate_filter",
    """WITH raw AS (
         SELECT event_id,
                CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(user_id / 2.0 - 20, 3) AS VARCHAR) END AS lat,
                CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(value * 4 - 100, 3) AS VARCHAR) END AS lon,
                'POINT (' || CAST(round(value * 3 - 60, 3) AS VARCHAR) || ' ' || CAST(round(user_id * 0.9 - 40, 3) AS VARCHAR) || ')' AS geom
         FROM events)
       SELECT * FROM (SELECT event_id, coalesce(TRY_CAST(lat AS DOUBLE), TRY_CAST(regexp_extract(geom, 'POINT\\s*\\(\\s*([-\\d\\.]+)\\s+([-\\d\\.]+)\\s*\\)', 2) AS DOUBLE)) AS latitude,
              coalesce(TRY_CAST(lon AS DOUBLE), TRY_CAST(regexp_extract(geom, 'POINT\\s*\\(\\s*([-\\d\\.]+)\\s+([-\\d\\.]+)\\s*\\)', 1) AS DOUBLE)) AS longitude
       FROM raw) WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
)
def range_coordinate_filter(spark, sf):
    """Valid lat / lon only; coordinates from ``POINT (lon lat)`` where the columns are empty."""
    e = table(spark, sf, "events")
    raw = e.select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.round(F.col("user_id") / 2.0 - 20, 3).cast("string")).alias("lat"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.round(F.col("value") * 4 - 100, 3).cast("string")).alias("lon"),
        F.concat(F.lit("POINT ("), F.round(F.col("value") * 3 - 60, 3).cast("string"), F.lit(" "),
                 F.round(F.col("user_id") * 0.9 - 40, 3).cast("string"), F.lit(")")).alias("geom"),
    )
    lat, lon = P.coordinates(F.col("lat"), F.col("lon"), F.col("geom"))
    out = raw.select("event_id", lat.alias("latitude"), lon.alias("longitude"))
    return out.filter(P.valid_coordinates(F.col("latitude"), F.col("longitude")))
