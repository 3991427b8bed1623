"""§2.15 end-to-end jobs: word count, search-phrase scoring, log stats, query mix L1-L17."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dataloom.functions.strings import ngrams_up_to_2, non_url, words
from dataloom.operators.joins import anti, join
from dataloom.operators.order import row_index
from dataloom.plans.fixtures import (
    ACCESS_LOG_SQL, PAGE_VIEWS_SQL, POWER_USERS_SQL, SEARCH_LOG_SQL, USERS_SQL,
    access_log, page_views, power_users, search_log, users, with_ctes,
)
from dataloom.plans.registry import query
from dataloom.session import fixed, table

# ---------------------------------------------------------------- word count


def wordcount(docs):
    """Lower, split on non-letters, drop empties, count per word."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("cnt"))


@query(
    "job_wordcount",
    """
    SELECT word, COUNT(*) AS cnt
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
    """,
)
def job_wordcount(spark, sf):
    return wordcount(table(spark, sf, "documents"))


# ------------------------------------------------- search phrase popularity


def _users_of_ngrams(parts: int, cells: int):
    """Per block (an hour, a share of its users, a part of the n-grams): different users of each n-gram.

    A user with one query counts through that query's number of such users;
    the queries of the others are written out as (n-gram, user) pairs, at most
    ``cells`` or one user's at a time, and equal pairs dropped.
    """

    def run(key, asked, has):
        h, _, part = (k.as_py() for k in key)
        grams = has["l"].combine_chunks()
        values, sizes = grams.flatten().to_numpy(zero_copy_only=False), grams.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        qs = has["q"].to_numpy()
        by_q = np.argsort(qs)
        q = asked["q"].to_numpy()
        at = by_q[np.minimum(np.searchsorted(qs, q, sorter=by_q), max(len(qs) - 1, 0))] if len(qs) else np.zeros(0, np.int64)
        hit = qs[at] == q if len(qs) else np.zeros(len(q), bool)
        user = asked["user"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[hit]
        by_user = np.argsort(user, kind="stable")
        user, at = user[by_user], at[hit][by_user] if len(qs) else at
        first = np.flatnonzero(np.diff(user, prepend=-1))
        queries = np.diff(first, append=len(user))
        counts = np.zeros(int(values.max()) + 1 if len(values) else 0, np.int64)
        single = np.repeat(queries == 1, queries)
        weight = np.bincount(at[single], minlength=len(qs))
        if len(values):
            counts += np.bincount(values, weights=np.repeat(weight, sizes), minlength=len(counts)).astype(np.int64)
        at, rank = at[~single], np.repeat(np.arange(int((queries > 1).sum())), queries[queries > 1])
        n = sizes[at]
        ends = np.cumsum(n)
        last = np.flatnonzero(np.diff(rank, append=-1)) + 1  # rows up to the end of each user
        a = 0
        while a < len(at):
            b = int(last[max(np.searchsorted(ends[last - 1], (ends[a - 1] if a else 0) + cells, side="right") - 1, np.searchsorted(last, a, side="right"))])
            m = n[a:b]
            place = np.repeat(starts[at[a:b]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            users = int(rank[b - 1] - rank[a]) + 1
            pairs = values[place].astype(np.int64) * users + np.repeat(rank[a:b] - rank[a], m)
            pairs.sort()
            gram = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))] // users
            new = np.flatnonzero(np.diff(gram, prepend=-1))
            counts[gram[new]] += np.diff(new, append=len(gram))
            a = b
        found = np.flatnonzero(counts)
        return pa.table({"unit": 2 * (found * parts + part) + 1, "h": np.full(len(found), h, np.int32), "count": counts[found]})

    return run


def hour_ngram_counts(log, hours=None, block_links: int = 12_000_000, block_users: int = 4_000_000, cells: int = 1 << 22):
    """Distinct (user, hour, n-gram) per cleaned query, counted per (n-gram, hour); ``hours``: of these only.

    Returns counts(unit, hour, count) and names(unit, ngram). A unit is an n-gram
    that several queries share, or a query, with whose users all n-grams of this
    query alone are counted. Queries repeat, so n-grams are made once for each
    different query (known by its MD5). Which users have a shared n-gram is a
    product of two sparse tables, (n-gram, query) and (query, user) of an hour:
    both are dealt in blocks and pairs of n-gram and user exist inside a block
    only, so neither table is multiplied by the other on its way.
    """
    spark = log.sparkSession
    hour = F.substring("time", 7, 2)
    asked = log.filter(non_url(F.col("query"))) if hours is None else log.filter(hour.isin(hours) & non_url(F.col("query")))
    asked = asked.select("user", hour.alias("hour"), F.lower("query").alias("text")).withColumn("md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    texts = row_index(asked.select("md5", "text").distinct(), "q")
    users = fixed(asked.select("md5", "hour", "user").distinct().join(texts.select("md5", "q"), "md5").select("q", "hour", "user"), "query-users")
    grams = fixed(texts.select("q", F.explode(F.array_distinct(ngrams_up_to_2(words(F.col("text"))))).alias("ngram")), "query-ngrams")
    seen = fixed(grams.groupBy("ngram").agg(F.count("*").alias("n"), F.min("q").alias("q")), "ngrams")
    shared = row_index(seen.where("n > 1").select("ngram"), "g")
    names = seen.where("n = 1").select((F.col("q") * 2).alias("unit"), "ngram").unionByName(shared.select((F.col("g") * 2 + 1).alias("unit"), "ngram"))

    links = fixed(grams.join(shared, "ngram").select("q", "g"), "shared-ngrams")
    parts = max(1, -(-links.count() // block_links))
    per_hour = users.groupBy("hour").agg(F.count("*").alias("n")).collect()  # at most as many as hours are written in two characters
    shares = [(h, r["hour"], max(1, -(-r["n"] // block_users))) for h, r in enumerate(per_hour)]
    numbered = F.broadcast(spark.createDataFrame(shares, "h int, hour string, shares int"))
    dealt = spark.createDataFrame([(h, c) for h, _, k in shares for c in range(k)], "h int, c int")
    blocks = max(1, parts * sum(k for *_, k in shares))
    asked_in = (users.join(numbered, users.hour.eqNullSafe(numbered.hour)).select("h", F.pmod(F.xxhash64("user"), "shares").cast("int").alias("c"), "q", "user")
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(blocks, "h", "c", "part"))
    has_in = (links.groupBy((F.col("g") % parts).cast("int").alias("part"), "q").agg(F.collect_list(F.floor(F.col("g") / parts).cast("int")).alias("l"))
              .crossJoin(F.broadcast(dealt)).repartition(blocks, "h", "c", "part"))
    key = ("h", "c", "part")
    counted = asked_in.groupBy(*key).cogroup(has_in.groupBy(*key)).applyInArrow(_users_of_ngrams(parts, cells), "unit long, h int, count long")
    if blocks > parts * len(shares):
        counted = counted.groupBy("unit", "h").agg(F.sum("count").alias("count"))
    counted = fixed(counted.join(numbered, "h").select("unit", "hour", "count"), "shared-counts")
    alone = users.groupBy((F.col("q") * 2).alias("unit"), "hour").agg(F.count("*").alias("count"))
    return alone.unionByName(counted), names


def ngram_hour_scores(log, min_score: float = 2.0):
    """Hours in which an n-gram is unusually popular: z-score of its hourly count.

    Mean and population deviation are over the hours the n-gram occurs in: one
    aggregate per n-gram, whose list holds at most 24 hours. N-grams with the
    same counts are scored as one unit, and named when their hours are known.
    """
    hf, names = hour_ngram_counts(log)
    c = F.col("count")
    per = hf.groupBy("unit").agg(
        F.count("*").alias("n"), F.sum(c).alias("s"), F.sum(c * c).alias("q"), F.collect_list(F.struct("hour", "count")).alias("hours"))
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    # count > mean and (count - mean) / sd > z, tested without rounding:
    # n*count > s and (n*count - s)^2 > z^2 * (n*q - s^2)
    above = lambda k: (n * k > s) & ((n * k - s) * (n * k - s) > F.lit(float(min_score) ** 2) * (n * q - s * s))
    per = per.withColumn("hours", F.filter("hours", lambda h: above(h["count"]))).withColumns({
        "mean": s / n, "sd": F.sqrt(q / n - (s / n) * (s / n))})
    scored = per.where(F.size("hours") > 0).join(names, "unit").select("ngram", "mean", "sd", F.explode("hours").alias("h")).select(
        "ngram", "mean", F.col("h.hour").alias("hour"), F.col("h.count").alias("count"), ((F.col("h.count") - F.col("mean")) / F.col("sd")).alias("score"))
    return scored.select(
        "hour", "ngram", F.round("score", 6).alias("score"), "count", F.round("mean", 6).alias("mean")
    ).orderBy("hour", "score")


_NGRAM_SQL = """
clean AS (SELECT "user", substring(time, 7, 2) AS hour, lower(query) AS q FROM search_log
          WHERE trim(query) <> '' AND NOT regexp_matches(trim(query), '^["]?(http[:|;])|(https[:|;])|(www\\.)')),
words AS (SELECT "user", hour, list_filter(regexp_split_to_array(q, '[^a-zA-Z0-9_]'), lambda x: x <> '') AS w FROM clean),
grams AS (SELECT DISTINCT "user", hour, g AS ngram FROM (
    SELECT "user", hour, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g
    FROM words)),
hf AS (SELECT ngram, hour, COUNT(*) AS "count" FROM grams GROUP BY ngram, hour)
"""


@query(
    "job_ngram_hour_score",
    with_ctes(
        SEARCH_LOG_SQL,
        _NGRAM_SQL,
        """sc AS (SELECT ngram, hour, "count", COUNT(*) OVER w AS n, SUM("count") OVER w AS s,
                        SUM("count" * "count") OVER w AS q, avg("count") OVER w AS mean,
                        stddev_pop("count") OVER w AS sd FROM hf WINDOW w AS (PARTITION BY ngram))""",
        body="""SELECT hour, ngram, round(("count" - mean) / sd, 6) AS score, "count", round(mean, 6) AS mean
                FROM sc WHERE n * "count" > s AND (n * "count" - s) * (n * "count" - s) > 4 * (n * q - s * s)
                ORDER BY hour, score""",
    ),
)
def job_ngram_hour_score(spark, sf):
    return ngram_hour_scores(search_log(spark, sf))


@query(
    "job_ngram_compare_hours",
    with_ctes(
        SEARCH_LOG_SQL,
        _NGRAM_SQL,
        body="""SELECT a.ngram, a."count" AS count00, b."count" AS count12
                FROM hf a JOIN hf b ON a.ngram = b.ngram WHERE a.hour = '00' AND b.hour = '12'""",
    ),
)
def job_ngram_compare_hours(spark, sf):
    hf, names = hour_ngram_counts(search_log(spark, sf), ["00", "12"])
    of = lambda h: F.sum(F.when(F.col("hour") == h, F.col("count")))
    both = hf.groupBy("unit").agg(of("00").alias("count00"), of("12").alias("count12")).where("count00 IS NOT NULL AND count12 IS NOT NULL")
    return both.join(names, "unit").select("ngram", "count00", "count12")


# ------------------------------------------------------------ access logs

# fixed value: the combined-log layout parsed by the log statistics job
LOG_RE = r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)".*'


def log_query_stats(lines):
    """Hits and bytes per (ip, user, request); unparsable lines go to a null key."""
    # a match always has a non-empty first group (the address): reuse that
    # extraction as the match test instead of a separate rlike pass
    first = F.regexp_extract("value", LOG_RE, 1)
    ok = first != ""
    g = lambda i: F.when(ok, first if i == 1 else F.regexp_extract("value", LOG_RE, i))
    b = g(7)
    return (
        lines.select(
            g(1).alias("ip"), g(3).alias("usr"), g(5).alias("request"),
            F.when(b.isNull() | (b == "-"), F.lit(0)).otherwise(b.cast("long")).alias("bytes"),
        )
        .groupBy("ip", "usr", "request")
        .agg(F.count("*").alias("hits"), F.sum("bytes").alias("total_bytes"))
    )


@query(
    "job_log_query_stats",
    with_ctes(
        ACCESS_LOG_SQL,
        body=f"""
        SELECT ip, usr, request, COUNT(*) AS hits, CAST(SUM(bytes) AS BIGINT) AS total_bytes FROM (
          SELECT CASE WHEN m THEN regexp_extract(value, '{LOG_RE}', 1) END AS ip,
                 CASE WHEN m THEN regexp_extract(value, '{LOG_RE}', 3) END AS usr,
                 CASE WHEN m THEN regexp_extract(value, '{LOG_RE}', 5) END AS request,
                 CASE WHEN NOT m OR regexp_extract(value, '{LOG_RE}', 7) = '-' THEN 0
                      ELSE CAST(regexp_extract(value, '{LOG_RE}', 7) AS BIGINT) END AS bytes
          FROM (SELECT value, regexp_matches(value, '{LOG_RE}') AS m FROM access_log))
        GROUP BY ip, usr, request""",
    ),
)
def job_log_query_stats(spark, sf):
    return log_query_stats(access_log(spark, sf))


# ------------------------------------------------------------------ query mix L1-L17


def _pv(spark, sf):
    return page_views(spark, sf)


@query(
    "job_mix_l1",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT "user", COUNT("user") AS cnt FROM (
                  SELECT "user", unnest(range(n_links)) AS link FROM page_views) GROUP BY "user" """,
    ),
)
def job_mix_l1(spark, sf):
    """Flatten the bag of maps, pick a header by bincond, count per user.

    COUNT skips tuples whose first field (user) is null: the null-user group
    counts 0.
    """
    pv = _pv(spark, sf)
    flat = pv.select("user", "action", "page_info", F.explode("page_links").alias("link"))
    hdr = flat.select(
        "user", F.when(F.col("action") == 1, F.col("page_info")["a"]).otherwise(F.col("link")["b"]).alias("header")
    )
    return hdr.groupBy("user").agg(F.count("user").alias("cnt"))


@query(
    "job_mix_l2",
    with_ctes(
        PAGE_VIEWS_SQL, POWER_USERS_SQL,
        body="""SELECT pv."user", pv.estimated_revenue, pu.name
                FROM page_views pv JOIN power_users pu ON pv."user" = pu.name""",
    ),
)
def job_mix_l2(spark, sf):
    b = _pv(spark, sf).select("user", "estimated_revenue")
    beta = power_users(spark, sf).select("name")
    return join(b, beta, ["user"], ["name"], strategy="replicated")


@query(
    "job_mix_l3",
    with_ctes(
        PAGE_VIEWS_SQL, USERS_SQL,
        body="""SELECT u.name AS grp, round(SUM(pv.estimated_revenue), 4) AS total_revenue
                FROM users u JOIN page_views pv ON u.name = pv."user" GROUP BY u.name""",
    ),
)
def job_mix_l3(spark, sf):
    beta = users(spark, sf).select("name")
    b = _pv(spark, sf).select("user", "estimated_revenue")
    c = join(beta, b, ["name"], ["user"])
    return c.groupBy(F.col("name").alias("grp")).agg(F.round(F.sum("estimated_revenue"), 4).alias("total_revenue"))


@query(
    "job_mix_l4",
    with_ctes(PAGE_VIEWS_SQL, body="""SELECT "user", COUNT(DISTINCT action) AS n_actions FROM page_views GROUP BY "user" """),
)
def job_mix_l4(spark, sf):
    return _pv(spark, sf).groupBy("user").agg(F.countDistinct("action").alias("n_actions"))


@query(
    "job_mix_l5",
    with_ctes(
        PAGE_VIEWS_SQL, USERS_SQL,
        body="""SELECT DISTINCT pv."user" AS grp FROM page_views pv
                WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.name = pv."user")""",
    ),
)
def job_mix_l5(spark, sf):
    """Cogroup + COUNT(beta) == 0: page-view users absent from users (null user included)."""
    b = _pv(spark, sf).select(F.col("user").alias("grp")).distinct()
    return anti(b, users(spark, sf).select("name"), ["grp"], ["name"])


@query(
    "job_mix_l6",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT "user", query_term, ip_addr, "timestamp", CAST(SUM(timespent) AS BIGINT) AS total_timespent
                FROM page_views GROUP BY "user", query_term, ip_addr, "timestamp" """,
    ),
)
def job_mix_l6(spark, sf):
    return (
        _pv(spark, sf)
        .groupBy("user", "query_term", "ip_addr", "timestamp")
        .agg(F.sum("timespent").cast("long").alias("total_timespent"))
    )


@query(
    "job_mix_l7",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT "user", COUNT("user") FILTER (WHERE "timestamp" < 43200) AS morning,
                       COUNT("user") FILTER (WHERE "timestamp" >= 43200) AS afternoon
                FROM page_views GROUP BY "user" """,
    ),
)
def job_mix_l7(spark, sf):
    ts = F.col("timestamp")
    return _pv(spark, sf).groupBy("user").agg(
        F.count(F.when(ts < 43200, F.col("user"))).alias("morning"),
        F.count(F.when(ts >= 43200, F.col("user"))).alias("afternoon"),
    )


@query(
    "job_mix_l8",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT CAST(SUM(timespent) AS BIGINT) AS total_timespent, round(AVG(estimated_revenue), 4) AS avg_revenue
                FROM page_views""",
    ),
)
def job_mix_l8(spark, sf):
    return _pv(spark, sf).agg(
        F.sum("timespent").cast("long").alias("total_timespent"),
        F.round(F.avg("estimated_revenue"), 4).alias("avg_revenue"),
    )


_PV_COLS = ["user", "action", "timespent", "query_term", "ip_addr", "timestamp", "estimated_revenue"]
_PV_COLS_SQL = '"user", action, timespent, query_term, ip_addr, "timestamp", estimated_revenue'


@query("job_mix_l9", with_ctes(PAGE_VIEWS_SQL, body=f"SELECT {_PV_COLS_SQL} FROM page_views ORDER BY query_term"))
def job_mix_l9(spark, sf):
    pv = _pv(spark, sf).select(*_PV_COLS)
    # a few terms and null: the other columns break ties, so a term spreads over many ranges
    ties = [f.name for f in pv.schema.fields if f.name != "query_term" and not f.dataType.simpleString().startswith(("map", "array<map"))]
    return pv.orderBy("query_term", *ties)


@query(
    "job_mix_l10",
    with_ctes(
        PAGE_VIEWS_SQL,
        body=f"SELECT {_PV_COLS_SQL} FROM page_views ORDER BY query_term, estimated_revenue DESC, timespent",
    ),
)
def job_mix_l10(spark, sf):
    return _pv(spark, sf).select(*_PV_COLS).orderBy("query_term", F.desc("estimated_revenue"), "timespent")


@query(
    "job_mix_l11",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT DISTINCT name FROM (
                  SELECT DISTINCT CAST("user" AS VARCHAR) AS name FROM page_views
                  UNION ALL SELECT DISTINCT CAST(doc_id AS VARCHAR) AS name FROM documents)""",
    ),
)
def job_mix_l11(spark, sf):
    c = _pv(spark, sf).select(F.col("user").cast("string").alias("name")).distinct()
    gamma = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("name")).distinct()
    return c.union(gamma).distinct()


@query(
    "job_mix_l12",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""
        SELECT 'highest_value_page_per_user' AS output, CAST("user" AS VARCHAR) AS grp,
               round(MAX(estimated_revenue), 4) AS val
        FROM page_views WHERE "user" IS NOT NULL AND query_term IS NOT NULL GROUP BY "user"
        UNION ALL
        SELECT 'total_timespent_per_term', query_term, CAST(SUM(timespent) AS DOUBLE)
        FROM page_views WHERE "user" IS NULL GROUP BY query_term
        UNION ALL
        SELECT 'queries_per_action', CAST(action AS VARCHAR), CAST(COUNT(*) AS DOUBLE)
        FROM page_views WHERE "user" IS NOT NULL AND query_term IS NULL GROUP BY action""",
    ),
)
def job_mix_l12(spark, sf):
    """Multi-store: three SPLIT branches, three aggregates, ONE scan and ONE shuffle.

    The branches are disjoint, so each row is tagged with its branch and its
    branch key, and a single aggregation computes all three outputs.
    """
    pv = _pv(spark, sf)
    u, qt = F.col("user"), F.col("query_term")
    branch = (
        F.when(u.isNotNull() & qt.isNotNull(), F.lit("highest_value_page_per_user"))
        .when(u.isNull(), F.lit("total_timespent_per_term"))
        .otherwise(F.lit("queries_per_action"))
    )
    key = (
        F.when(u.isNotNull() & qt.isNotNull(), u.cast("string"))
        .when(u.isNull(), qt)
        .otherwise(F.col("action").cast("string"))
    )
    agg = pv.select(branch.alias("output"), key.alias("grp"), "estimated_revenue", "timespent").groupBy("output", "grp").agg(
        F.max("estimated_revenue").alias("mx"), F.sum("timespent").alias("ts"), F.count("*").alias("n")
    )
    val = (
        F.when(F.col("output") == "highest_value_page_per_user", F.round("mx", 4))
        .when(F.col("output") == "total_timespent_per_term", F.col("ts").cast("double"))
        .otherwise(F.col("n").cast("double"))
    )
    return agg.select("output", "grp", val.alias("val"))


@query(
    "job_mix_l13",
    with_ctes(
        PAGE_VIEWS_SQL, POWER_USERS_SQL,
        body="""SELECT pv."user", pv.estimated_revenue, pu.name, pu.phone
                FROM page_views pv LEFT JOIN power_users pu ON pv."user" = pu.name""",
    ),
)
def job_mix_l13(spark, sf):
    b = _pv(spark, sf).select("user", "estimated_revenue")
    return join(b, power_users(spark, sf), ["user"], ["name"], how="left")


@query(
    "job_mix_l14",
    with_ctes(
        PAGE_VIEWS_SQL, USERS_SQL,
        body="""SELECT pv."user", pv.estimated_revenue, u.name FROM page_views pv JOIN users u ON pv."user" = u.name""",
    ),
)
def job_mix_l14(spark, sf):
    b = _pv(spark, sf).select("user", "estimated_revenue")
    return join(b, users(spark, sf).select("name"), ["user"], ["name"], strategy="merge")


@query(
    "job_mix_l15",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT "user", COUNT(DISTINCT action) AS n_actions,
                       round(SUM(DISTINCT estimated_revenue), 4) AS distinct_revenue,
                       CAST(trunc(AVG(DISTINCT timespent)) AS BIGINT) AS avg_timespent
                FROM page_views GROUP BY "user" """,
    ),
)
def job_mix_l15(spark, sf):
    return _pv(spark, sf).groupBy("user").agg(
        F.countDistinct("action").alias("n_actions"),
        F.round(F.sum_distinct("estimated_revenue"), 4).alias("distinct_revenue"),
        F.expr("avg(DISTINCT timespent)").cast("long").alias("avg_timespent"),
    )


@query(
    "job_mix_l16",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""SELECT "user", round(SUM(estimated_revenue), 4) AS total_revenue FROM page_views GROUP BY "user" """,
    ),
)
def job_mix_l16(spark, sf):
    """Nested ORDER then SUM: the order does not change a sum, so no sort is planned."""
    return _pv(spark, sf).groupBy("user").agg(F.round(F.sum("estimated_revenue"), 4).alias("total_revenue"))


_WIDE = ["user", "action", "timespent", "query_term", "ip_addr", "timestamp", "estimated_revenue"]


@query(
    "job_mix_l17",
    with_ctes(
        PAGE_VIEWS_SQL,
        body="""
        SELECT CAST(SUM(timespent) AS BIGINT) AS sum_ts, CAST(SUM(timespent_1) AS BIGINT) AS sum_ts1,
               CAST(SUM(timespent_2) AS BIGINT) AS sum_ts2, round(AVG(estimated_revenue), 4) AS avg_rev,
               round(AVG(estimated_revenue_1), 4) AS avg_rev1, round(AVG(estimated_revenue_2), 4) AS avg_rev2
        FROM (SELECT *, "user" AS user_1, action AS action_1, timespent AS timespent_1, query_term AS query_term_1,
                     ip_addr AS ip_addr_1, "timestamp" AS timestamp_1, estimated_revenue AS estimated_revenue_1,
                     "user" AS user_2, action AS action_2, timespent AS timespent_2, query_term AS query_term_2,
                     ip_addr AS ip_addr_2, "timestamp" AS timestamp_2, estimated_revenue AS estimated_revenue_2
              FROM page_views)
        GROUP BY "user", action, timespent, query_term, ip_addr, "timestamp", estimated_revenue,
                 user_1, action_1, timespent_1, query_term_1, ip_addr_1, timestamp_1, estimated_revenue_1,
                 user_2, action_2, timespent_2, query_term_2, ip_addr_2, timestamp_2, estimated_revenue_2""",
    ),
)
def job_mix_l17(spark, sf):
    pv = _pv(spark, sf).select(*_WIDE)
    wide = pv.select(
        *_WIDE, *[F.col(c).alias(f"{c}_1") for c in _WIDE], *[F.col(c).alias(f"{c}_2") for c in _WIDE]
    )
    keys = _WIDE + [f"{c}_1" for c in _WIDE] + [f"{c}_2" for c in _WIDE]
    return wide.groupBy(*keys).agg(
        F.sum("timespent").cast("long").alias("sum_ts"),
        F.sum("timespent_1").cast("long").alias("sum_ts1"),
        F.sum("timespent_2").cast("long").alias("sum_ts2"),
        F.round(F.avg("estimated_revenue"), 4).alias("avg_rev"),
        F.round(F.avg("estimated_revenue_1"), 4).alias("avg_rev1"),
        F.round(F.avg("estimated_revenue_2"), 4).alias("avg_rev2"),
    ).drop(*keys)
