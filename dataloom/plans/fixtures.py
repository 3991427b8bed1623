"""Derived inputs built from the given tables, each with its SQL twin.

Every derivation is a projection / join of the test tables, so its size grows
with them. The SQL strings are CTE bodies usable in DuckDB oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.operators.order import row_index
from dataloom.session import table


def _k(col="props"):
    return F.get_json_object(F.col(col), "$.k").cast("int")


def page_views(spark: SparkSession, sf: str) -> DataFrame:
    """The query mix's ``page_views`` from ``events``.

    user (null when k = 0), action code from event_type, timespent = k,
    query_term (null when k divisible by 10), ip_addr, timestamp = second of
    day, estimated_revenue = value, page_info map, page_links bag of maps with
    k % 4 entries (zero entries: the row disappears under FLATTEN).
    """
    e = table(spark, sf, "events").withColumn("k", _k())
    return e.select(
        F.when(F.col("k") == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user"),
        F.expr(
            "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 "
            "WHEN 'signup' THEN 4 ELSE 5 END"
        ).alias("action"),
        F.col("k").alias("timespent"),
        F.when(F.col("k") % 10 == 0, F.lit(None))
        .otherwise(F.concat(F.col("event_type"), F.lit("_"), F.expr("cast(k div 10 as string)")))
        .alias("query_term"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."), F.col("k").cast("string")).alias("ip_addr"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("long").alias("timestamp"),
        F.col("value").alias("estimated_revenue"),
        F.create_map(F.lit("a"), F.col("event_type"), F.lit("k"), F.col("k").cast("string")).alias("page_info"),
        F.slice(
            F.array(*[F.create_map(F.lit("b"), F.concat(F.col("event_type"), F.lit(str(i)))) for i in (1, 2, 3)]),
            1,
            F.col("k") % 4,
        ).alias("page_links"),
    )


PAGE_VIEWS_SQL = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
page_views AS (
  SELECT CASE WHEN k = 0 THEN NULL ELSE user_id END AS "user",
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 ELSE 5 END AS action,
         k AS timespent,
         CASE WHEN k % 10 = 0 THEN NULL ELSE event_type || '_' || CAST(k // 10 AS VARCHAR) END AS query_term,
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS ip_addr,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS "timestamp",
         value AS estimated_revenue,
         k % 4 AS n_links
  FROM ev)
"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    """The query mix's ``users``: customers outside the AUTOMOBILE segment, keyed by custkey."""
    c = table(spark, sf, "customer")
    return c.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(
        F.col("c_custkey").alias("name"), F.col("c_name").alias("phone"), F.col("c_nationkey").alias("state")
    )


USERS_SQL = """
users AS (SELECT c_custkey AS name, c_name AS phone, c_nationkey AS state
          FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
"""


def power_users(spark: SparkSession, sf: str) -> DataFrame:
    """The query mix's ``power_users``: customers with a balance above 5000."""
    c = table(spark, sf, "customer")
    return c.filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("name"), F.col("c_name").alias("phone"))


POWER_USERS_SQL = """
power_users AS (SELECT c_custkey AS name, c_name AS phone FROM customer WHERE c_acctbal > 5000)
"""


def search_log(spark: SparkSession, sf: str) -> DataFrame:
    """Search log (user, time yyMMddHHmmss, query): every event once, with a conversation turn by turns of its id."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    t = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    t = row_index(t.orderBy("conv_id", "turn", "role", "text"), "i").select("i", "text")
    n = t.count()
    return e.withColumn("i", F.pmod(F.col("event_id"), F.lit(max(1, n)))).join(t, "i").select(
        F.col("user_id").alias("user"), F.date_format("ts", "yyMMddHHmmss").alias("time"), F.col("text").alias("query")
    )


SEARCH_LOG_SQL = """
turns AS (SELECT row_number() OVER (ORDER BY conv_id, turn, role, text) - 1 AS i, text FROM conversations),
search_log AS (SELECT e.user_id AS "user", strftime(e.ts, '%y%m%d%H%M%S') AS time, t.text AS query
               FROM events e JOIN turns t ON e.event_id % (SELECT COUNT(*) FROM turns) = t.i)
"""


def access_log(spark: SparkSession, sf: str) -> DataFrame:
    """Combined-format access-log lines (one ``value`` column) from events x pages."""
    e = table(spark, sf, "events")
    p = table(spark, sf, "pages").select("page_id", "url")
    j = e.join(p, e.user_id == p.page_id)
    status = F.expr(
        "CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '302' WHEN 'click' THEN '304' ELSE '200' END"
    )
    nbytes = F.when(F.col("value") < 1, F.lit("-")).otherwise(F.floor(F.col("value") * 100).cast("long").cast("string"))
    line = F.concat(
        F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."), (F.col("event_id") % 256).cast("string"),
        F.lit(" - "),
        F.when(F.col("event_type") == "signup", F.lit("-")).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        F.lit(" ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \"GET "), F.col("url"),
        F.lit(" HTTP/1.1\" "), status, F.lit(" "), nbytes, F.lit(" \"http://ref.example.com/"),
        F.col("event_type"), F.lit("?q="), F.col("event_type"), F.lit("+page\" \"Mozilla/5.0 (X11)\""),
    )
    return j.select(line.alias("value"))


ACCESS_LOG_SQL = """
access_log AS (
  SELECT '10.0.' || CAST(e.user_id % 256 AS VARCHAR) || '.' || CAST(e.event_id % 256 AS VARCHAR) || ' - ' ||
         CASE WHEN e.event_type = 'signup' THEN '-' ELSE 'u' || CAST(e.user_id AS VARCHAR) END ||
         ' [' || strftime(e.ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET ' || p.url || ' HTTP/1.1" ' ||
         CASE e.event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '302' WHEN 'click' THEN '304' ELSE '200' END || ' ' ||
         CASE WHEN e.value < 1 THEN '-' ELSE CAST(CAST(floor(e.value * 100) AS BIGINT) AS VARCHAR) END ||
         ' "http://ref.example.com/' || e.event_type || '?q=' || e.event_type || '+page" "Mozilla/5.0 (X11)"' AS value
  FROM events e JOIN pages p ON e.user_id = p.page_id)
"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def customer_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Customer with each field null in about 5 % of rows (a rule on the key)."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    nul = lambda i, col: F.when((k * 7 + i) % 20 == 0, F.lit(None)).otherwise(F.col(col))
    return c.select(
        "c_custkey", nul(1, "c_name").alias("name"), nul(2, "c_nationkey").alias("nation"),
        nul(3, "c_acctbal").alias("bal"), nul(4, "c_mktsegment").alias("seg"),
    )


CUSTOMER_NULLS_SQL = """
customer_nulls AS (
  SELECT c_custkey,
         CASE WHEN (c_custkey * 7 + 1) % 20 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN (c_custkey * 7 + 2) % 20 = 0 THEN NULL ELSE c_nationkey END AS nation,
         CASE WHEN (c_custkey * 7 + 3) % 20 = 0 THEN NULL ELSE c_acctbal END AS bal,
         CASE WHEN (c_custkey * 7 + 4) % 20 = 0 THEN NULL ELSE c_mktsegment END AS seg
  FROM customer)
"""
