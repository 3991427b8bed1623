"""§2.11 streaming: each query stages the given table as files, runs a stream
over them to completion (available-now trigger) and returns the sink's content."""

from __future__ import annotations

from pyspark.sql import functions as F

from dataloom.plans.registry import query
from dataloom.session import scratch_path, table
from dataloom.streaming import streams as S


def _events_stream(spark, sf, slices=4):
    """The events as a stream of ``slices`` arrivals in time order, one arrival a trigger."""
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-src")
    files = S.stage_files(e, src, slices, "ts")
    return S.file_stream(spark, src, e.schema, files_per_trigger=files)


def _closing_stream(spark, sf, after, slices=4):
    """The same behind a watermark, with a last arrival that closes all windows of at most ``after``."""
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-src")
    files = S.stage_files(e, src, slices, "ts")
    S.stage_flush(e, src, "ts", after)
    s = S.file_stream(spark, src, e.schema, files_per_trigger=files)
    return s.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")


def _arrival_rows(spark, sf, slices=4):
    """Events of one arrival: state that goes with the watermark holds hardly more."""
    return -(-table(spark, sf, "events").count() // slices)


def _closed(spark, sf, sdf, name):
    """What an append-mode stream of closed windows has put into its sink."""
    sink, ck = _paths(spark, name)
    S.run_append(sdf, sink, ck, state_rows=_arrival_rows(spark, sf))
    return spark.read.schema(sdf.schema).parquet(sink)


def _paths(spark, name):
    return scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")


@query("st_file_source", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 10")
def st_file_source(spark, sf):
    """New files of a folder as a stream (fixed schema, 2 files per trigger)."""
    s = _events_stream(spark, sf).filter(F.col("value") > 10).select("event_id", "user_id", "event_type", "value")
    sink, ck = _paths(spark, "st-file")
    S.run_append(s, sink, ck)
    return spark.read.parquet(sink)


@query(
    "st_wordcount",
    """SELECT word, COUNT(*) AS cnt FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents)
       WHERE word <> '' GROUP BY word""",
)
def st_wordcount(spark, sf):
    """Running word counts over a text file stream, one arrival a trigger; a batch
    writes the counts it changed, under its batch id, and the last one of a word holds."""
    d = table(spark, sf, "documents").select(F.col("text").alias("value"))
    src = scratch_path(spark, "st-text")
    files = S.stage_files(d, src, 3, fmt="text")
    lines = spark.readStream.option("maxFilesPerTrigger", files).text(src)
    counts = (lines.select(F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("word")).filter(F.col("word") != "")
              .groupBy("word").agg(F.count("*").alias("cnt")))
    sink, ck = _paths(spark, "st-wc")
    S.run_foreach_batch(counts, lambda df, batch_id: df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"), ck, mode="update")
    return spark.read.parquet(sink).groupBy("word").agg(F.max("cnt").alias("cnt"))  # a count only grows


@query(
    "st_sql_on_stream",
    "SELECT event_type, COUNT(*) AS n, round(SUM(value), 2) AS total FROM events GROUP BY event_type",
)
def st_sql_on_stream(spark, sf):
    """SQL text over a stream registered as a view."""
    _events_stream(spark, sf).createOrReplaceTempView("events_stream")
    agg = spark.sql("SELECT event_type, COUNT(*) AS n, round(SUM(value), 2) AS total FROM events_stream GROUP BY event_type")
    sink, ck = _paths(spark, "st-sql")
    S.run_complete(agg, sink, ck, state_rows=table(spark, sf, "events").count())
    return spark.read.parquet(sink)


@query(
    "st_filter_project",
    """SELECT event_id, 'view' AS kind, w AS word FROM (SELECT event_id, unnest(string_split(props, ' ')) AS w FROM events WHERE event_type = 'view')
       UNION ALL SELECT event_id, 'click', event_type FROM events WHERE event_type = 'click'""",
)
def st_filter_project(spark, sf):
    """Stateless filter / projection / explode and the union of two streams."""
    a = _events_stream(spark, sf).filter(F.col("event_type") == "view").select(
        "event_id", F.lit("view").alias("kind"), F.explode(F.split("props", " ")).alias("word"))
    b = _events_stream(spark, sf).filter(F.col("event_type") == "click").select(
        "event_id", F.lit("click").alias("kind"), F.col("event_type").alias("word"))
    sink, ck = _paths(spark, "st-union")
    S.run_append(a.unionByName(b), sink, ck)
    return spark.read.parquet(sink)


@query("st_batch_count_reduce", "SELECT event_type, COUNT(*) AS n, round(SUM(value), 6) AS total FROM events GROUP BY event_type")
def st_batch_count_reduce(spark, sf):
    """Per micro-batch count, sum and count-by-value, keyed by batch id (idempotent); then summed over the batches."""
    s = _events_stream(spark, sf)
    sink = scratch_path(spark, "st-batches")

    def per_batch(df, batch_id):
        (df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
         .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    S.run_foreach_batch(s, per_batch, scratch_path(spark, "st-batches-ckpt"))
    return spark.read.parquet(sink).groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 6).alias("total"))


@query(
    "st_tumbling",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
              event_type, COUNT(*) AS n FROM events GROUP BY 1, 2, 3""",
)
def st_tumbling(spark, sf):
    """Hourly windows in append mode: a window comes out when the watermark has passed it, and its state goes."""
    s = S.window_counts(_closing_stream(spark, sf, "2 HOURS"), "ts", "1 hour", None, ["event_type"], [F.count("*").alias("n")])
    return _closed(spark, sf, s, "st-tumble")


@query(
    "st_sliding",
    """SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, event_type, COUNT(*) AS n FROM (
         SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, event_type FROM events
         UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR, event_type FROM events) GROUP BY 1, 2, 3""",
)
def st_sliding(spark, sf):
    """Two-hour windows sliding by one hour, in append mode: each event counts in two windows."""
    s = S.window_counts(_closing_stream(spark, sf, "4 HOURS"), "ts", "2 hours", "1 hour", ["event_type"], [F.count("*").alias("n")])
    return _closed(spark, sf, s, "st-slide")


@query(
    "st_session",
    """WITH x AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                                        OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new
                FROM events),
            y AS (SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM x)
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS n FROM y GROUP BY user_id, sid""",
)
def st_session(spark, sf):
    """Gap-closed sessions per user (6 h gap) with ``session_window`` on the stream, given out once they are closed."""
    s = _closing_stream(spark, sf, "8 HOURS")
    agg = s.groupBy("user_id", F.session_window("ts", "6 hours").alias("sw")).agg(F.count("*").alias("n")).select(
        "user_id", F.col("sw.start").cast("timestamp_ntz").alias("session_start"),
        F.col("sw.end").cast("timestamp_ntz").alias("session_end"), "n")
    return _closed(spark, sf, agg, "st-session")


@query(
    "st_watermark_late",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, COUNT(*) AS n
       FROM events GROUP BY 1, 2
       HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def st_watermark_late(spark, sf):
    """Watermark 10 minutes, append mode: only closed windows come out, and late rows count in none.

    The events arrive in four slices in time order, then those of the first two
    slices once more. A batch drops what is behind the watermark of the batch
    before it, which has passed the third slice: all of these are late.
    """
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-src")
    files = S.stage_files(e, src, 4, "ts")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = e.agg(F.percentile_approx(at, 0.5)).first()[0]
    S.stage_files(e.where(at <= F.lit(middle)), src, 1)
    s = S.file_stream(spark, src, e.schema, files_per_trigger=files).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "10 minutes")
    agg = S.window_counts(s, "ts", "1 hour", None, [], [F.count("*").alias("n")])
    sink, ck = _paths(spark, "st-wm")
    S.run_append(agg, sink, ck, state_rows=_arrival_rows(spark, sf))
    return spark.read.parquet(sink)


@query("st_dedup", "SELECT event_id, user_id, event_type FROM events")
def st_dedup(spark, sf):
    """Every event arrives twice within its slice; within a watermark of two hours one of each passes."""
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-src")
    files = S.stage_files(e.unionByName(e), src, 4, "ts")
    s = S.file_stream(spark, src, e.schema, files_per_trigger=files).withColumn("ts", F.col("ts").cast("timestamp"))
    s = s.withWatermark("ts", "2 hours").dropDuplicatesWithinWatermark(["event_id"])
    sink, ck = _paths(spark, "st-dedup")
    S.run_append(s.select("event_id", "user_id", "event_type"), sink, ck, state_rows=_arrival_rows(spark, sf))
    return spark.read.parquet(sink)


@query("st_stateful_update", "SELECT user_id, COUNT(*) AS n, round(SUM(value), 6) AS total FROM events GROUP BY user_id")
def st_stateful_update(spark, sf):
    """Per-user state (count, sum) updated by each micro-batch; every update is
    appended, and the last one per user, returned here, is the current state."""
    s = _events_stream(spark, sf).select("user_id", "value")
    out = S.stateful_running_totals(s)
    sink = scratch_path(spark, "st-state")

    def keep(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/b={batch_id}")

    S.run_foreach_batch(out, keep, scratch_path(spark, "st-state-ckpt"), mode="update", state_rows=table(spark, sf, "events").count())
    return spark.read.parquet(sink).groupBy("user_id").agg(F.max("n").alias("n"), F.round(F.max_by("total", "n"), 6).alias("total"))


@query(
    "st_reduce_window",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
              user_id, round(SUM(value), 2) AS total, COUNT(*) AS n FROM events GROUP BY 1, 2, 3""",
)
def st_reduce_window(spark, sf):
    """Windowed reduce per key (daily sum of value per user), incremental state that goes with its window."""
    s = S.window_counts(_closing_stream(spark, sf, "2 DAYS"), "ts", "1 day", None, ["user_id"],
                        [F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n")])
    return _closed(spark, sf, s, "st-rwin")


@query(
    "st_stream_stream_join",
    """SELECT v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c
       ON v.user_id = c.user_id AND c.ts >= v.ts AND c.ts <= v.ts + INTERVAL 1 HOUR
       WHERE v.event_type = 'view' AND c.event_type = 'click'""",
)
def st_stream_stream_join(spark, sf):
    """Views joined to clicks of the same user within the next hour; both
    sides watermarked by two hours, so join state is bounded."""
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-src")
    files = S.stage_files(e, src, 4, "ts")
    stream = lambda kind: S.file_stream(spark, src, e.schema, files_per_trigger=files).filter(F.col("event_type") == kind)
    views = stream("view").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("vu"), F.col("ts").cast("timestamp").alias("vts")).withWatermark("vts", "2 hours")
    clicks = stream("click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("cu"), F.col("ts").cast("timestamp").alias("cts")).withWatermark("cts", "2 hours")
    j = views.join(clicks, F.expr("vu = cu AND cts >= vts AND cts <= vts + INTERVAL 1 HOUR"))
    sink, ck = _paths(spark, "st-join")
    S.run_append(j.select("view_id", "click_id"), sink, ck, state_rows=_arrival_rows(spark, sf))
    return spark.read.parquet(sink)


@query("st_foreach_batch", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def st_foreach_batch(spark, sf):
    """Arbitrary batch code per trigger, written idempotently under the batch id."""
    s = _events_stream(spark, sf)
    sink = scratch_path(spark, "st-fb")

    def write_batch(df, batch_id):
        df.filter(F.col("event_type") == "purchase").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{sink}/b={batch_id}")

    S.run_foreach_batch(s, write_batch, scratch_path(spark, "st-fb-ckpt"))
    return spark.read.parquet(sink).select("event_id", "user_id", "value")


@query(
    "st_sinks_modes",
    "SELECT event_id, value, event_type FROM events UNION ALL SELECT event_id, value, event_type FROM events",
)
def st_sinks_modes(spark, sf):
    """File sink partitioned by a column, and a table sink (external path)."""
    s = _events_stream(spark, sf).select("event_id", "event_type", "value")
    sink, ck = _paths(spark, "st-part")
    S.run_append(s, sink, ck, partition_by=["event_type"])
    tpath = scratch_path(spark, "st-table")
    name = f"events_stream_{tpath.rsplit('-', 1)[-1]}"
    (s.writeStream.option("checkpointLocation", scratch_path(spark, "st-table-ckpt")).option("path", tpath)
     .trigger(availableNow=True).toTable(name).awaitTermination())
    return spark.read.parquet(sink).unionByName(spark.table(name))


@query("st_recovery", "SELECT event_id, user_id, value FROM events")
def st_recovery(spark, sf):
    """Run, stop, add files, run again from the same checkpoint: every event
    reaches the sink exactly once."""
    e = table(spark, sf, "events")
    src = scratch_path(spark, "st-rec-src")
    mid = e.agg(F.percentile_approx(F.unix_seconds(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    first = e.filter(F.unix_seconds(F.col("ts").cast("timestamp")) <= mid)
    rest = e.filter(F.unix_seconds(F.col("ts").cast("timestamp")) > mid)
    S.stage_files(first, src, 4, "ts")
    sink, ck = _paths(spark, "st-rec")
    q = lambda: S.file_stream(spark, src, e.schema).select("event_id", "user_id", "value")
    S.run_append(q(), sink, ck)
    S.stage_files(rest, src, 4, "ts")
    S.run_append(q(), sink, ck)
    return spark.read.parquet(sink)


def clickstream_metrics(ev, known_users) -> dict:
    """Five page-view metrics (event type = page, user_id % 10 = zip code), each (window_start, key, value):
    views per page in 30 s, views per page in the last 30 s every 15 s, error rate per zip in 30 s,
    active users in 15 s, known users in 30 s. ``ev`` is a table or a watermarked stream."""
    pv = ev.withColumn("zip", (F.col("user_id") % 10).cast("string"))
    count = F.count("*").cast("double").alias("value")
    error = F.avg((F.col("event_type") == "error").cast("double"))
    keyed = lambda df, key: df.select("window_start", F.col(key).alias("key"), "value")
    whole = lambda df: df.select("window_start", F.lit("all").alias("key"), "value")
    known = pv.join(known_users, pv.user_id == known_users.c_custkey, "left_semi")
    return {
        "views_per_page": keyed(S.window_counts(pv, "ts", "30 seconds", None, ["event_type"], [count]), "event_type"),
        "sliding_views": keyed(S.window_counts(pv, "ts", "30 seconds", "15 seconds", ["event_type"], [count]), "event_type"),
        "error_rate": keyed(S.window_counts(pv, "ts", "30 seconds", None, ["zip"], [F.round(error, 6).alias("value")]), "zip"),
        "active_users": whole(S.distinct_users(pv, "ts", "15 seconds")),
        "known_users": whole(S.distinct_users(known, "ts", "30 seconds")),
    }


@query(
    "st_clickstream_metrics",
    """WITH last AS (SELECT max(ts) - INTERVAL 1 MINUTE AS w FROM events),
       m AS (
       SELECT 'views_per_page' AS metric, time_bucket(INTERVAL 30 SECOND, ts) AS window_start, 30 AS span, event_type AS "key", CAST(COUNT(*) AS DOUBLE) AS value FROM events GROUP BY 2, 4
       UNION ALL SELECT 'sliding_views', ws, 30, event_type, CAST(COUNT(*) AS DOUBLE) FROM (
           SELECT time_bucket(INTERVAL 15 SECOND, ts) AS ws, event_type FROM events
           UNION ALL SELECT time_bucket(INTERVAL 15 SECOND, ts) - INTERVAL 15 SECOND, event_type FROM events) GROUP BY 2, 4
       UNION ALL SELECT 'error_rate', time_bucket(INTERVAL 30 SECOND, ts), 30, CAST(user_id % 10 AS VARCHAR),
                 round(AVG(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) FROM events GROUP BY 2, 4
       UNION ALL SELECT 'active_users', time_bucket(INTERVAL 15 SECOND, ts), 15, 'all', CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM events GROUP BY 2
       UNION ALL SELECT 'known_users', time_bucket(INTERVAL 30 SECOND, ts), 30, 'all', CAST(COUNT(DISTINCT user_id) AS DOUBLE)
                 FROM events WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 2)
       SELECT metric, window_start, "key", value FROM m, last WHERE window_start + to_seconds(span) <= w""",
)
def st_clickstream_metrics(spark, sf):
    """The five click-stream metrics on a stream with a watermark of one minute; closed windows only."""
    stream = _events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 minute")
    rows = _arrival_rows(spark, sf)
    out = None
    for name, metric in clickstream_metrics(stream, table(spark, sf, "customer").select("c_custkey")).items():
        sink, ck = _paths(spark, name.replace("_", "-"))
        S.run_append(metric, sink, ck, state_rows=rows)
        got = spark.read.parquet(sink).select(F.lit(name).alias("metric"), "window_start", "key", "value")
        out = got if out is None else out.unionByName(got)
    return out


@query("st_streaming_kmeans")
def st_streaming_kmeans(spark, sf):
    """Centres updated per micro-batch with decay: assign by the k current
    centres (k small: literals in the plan), average per cluster, decayed
    merge. Each batch reads the centres saved by the previous batch and saves
    its own under its batch id, so a restarted or retried query resumes
    exactly (no model state lives only in the driver)."""
    import numpy as np

    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    src = scratch_path(spark, "st-km-src")
    S.stage_files(e, src, 6, "vec_id")
    k, decay = 4, 0.5
    state_path = scratch_path(spark, "st-km-state")
    schema = "cluster int, center array<double>, weight double"
    init = [(i, [float(x) for x in r[0]], 1.0) for i, r in enumerate(e.orderBy("vec_id").select("embedding").limit(k).collect())]

    def update(df, batch_id):
        prev = S.load_state(spark, state_path, before=batch_id)
        rows = sorted(((r["cluster"], list(r["center"]), r["weight"]) for r in prev), key=lambda t: t[0]) if prev else init
        cs = [np.array(r[1]) for r in rows]
        ws = [r[2] for r in rows]
        dist = [F.aggregate(F.zip_with("embedding", F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)),
                            F.lit(0.0), lambda acc, x: acc + x) for c in cs]
        best = F.array_position(F.array(*dist), F.array_min(F.array(*dist))) - 1
        dim = len(cs[0])
        agg = df.withColumn("cl", best).groupBy("cl").agg(
            F.count("*").alias("n"), *[F.avg(F.col("embedding")[i]).alias(f"m{i}") for i in range(dim)]).collect()
        for r in agg:
            j, n = int(r["cl"]), float(r["n"])
            mean = np.array([r[f"m{i}"] for i in range(dim)])
            w_old = ws[j] * decay
            cs[j] = (cs[j] * w_old + mean * n) / (w_old + n)
            ws[j] = w_old + n
        S.save_state(spark, state_path, batch_id, [(i, [float(x) for x in c], float(w)) for i, (c, w) in enumerate(zip(cs, ws))], schema)

    S.run_foreach_batch(S.file_stream(spark, src, e.schema), update, scratch_path(spark, "st-km-ckpt"))
    final = S.load_state(spark, state_path)
    return spark.createDataFrame([(r["cluster"], list(r["center"]), r["weight"]) for r in final], schema)


@query(
    "st_ab_test",
    """WITH g AS (SELECT event_type, COUNT(*) AS n, avg(value) AS mean, var_samp(value) AS var FROM events
                 WHERE event_type IN ('view', 'click') GROUP BY event_type),
            a AS (SELECT * FROM g WHERE event_type = 'view'), b AS (SELECT * FROM g WHERE event_type = 'click')
       SELECT a.n AS n_a, b.n AS n_b, round(a.mean, 6) AS mean_a, round(b.mean, 6) AS mean_b,
              round((a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n), 6) AS welch_t FROM a, b""",
)
def st_ab_test(spark, sf):
    """Running two-group test on a stream: n, mean and variance per group by a
    stateful aggregate, then Welch's t from the six numbers."""
    s = _events_stream(spark, sf).filter(F.col("event_type").isin("view", "click"))
    agg = s.groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))
    sink, ck = _paths(spark, "st-ab")
    S.run_complete(agg, sink, ck, state_rows=table(spark, sf, "events").count())
    r = spark.read.parquet(sink)
    # two result rows (one per group): joined on a constant key
    side = lambda g, s: r.filter(F.col("event_type") == g).select(
        F.lit(1).alias("one"), F.col("n").alias(f"n_{s}"), F.col("mean").alias(f"mean_{s}"), F.col("var").alias(f"var_{s}"))
    j = side("view", "a").join(side("click", "b"), "one")
    se = F.sqrt(F.col("var_a") / F.col("n_a") + F.col("var_b") / F.col("n_b"))
    return j.select("n_a", "n_b", F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"),
                    F.round((F.col("mean_a") - F.col("mean_b")) / se, 6).alias("welch_t"))


@query("st_streaming_regression")
def st_streaming_regression(spark, sf):
    """Linear regression weights updated by one gradient step per micro-batch;
    the gradient is a single aggregate over the batch. Weights are saved per
    batch id and each batch starts from the previous batch's saved weights."""
    li = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_quantity") / 50.0).alias("x"),
                                             (F.col("l_extendedprice") / 100000.0).alias("y"))
    src = scratch_path(spark, "st-reg-src")
    S.stage_files(li, src, 6, "l_orderkey")
    state_path = scratch_path(spark, "st-reg-state")
    schema = "slope double, intercept double, steps long"

    def step(df, batch_id):
        prev = S.load_state(spark, state_path, before=batch_id)
        a, b, n = (prev[0]["slope"], prev[0]["intercept"], prev[0]["steps"]) if prev else (0.0, 0.0, 0)
        g = df.agg(F.avg((F.lit(a) * F.col("x") + F.lit(b) - F.col("y")) * F.col("x")).alias("ga"),
                   F.avg(F.lit(a) * F.col("x") + F.lit(b) - F.col("y")).alias("gb")).first()
        if g["ga"] is not None:
            a, b, n = a - 0.5 * g["ga"], b - 0.5 * g["gb"], n + 1
        S.save_state(spark, state_path, batch_id, [(float(a), float(b), int(n))], schema)

    S.run_foreach_batch(S.file_stream(spark, src, li.schema, files_per_trigger=1), step, scratch_path(spark, "st-reg-ckpt"))
    w = S.load_state(spark, state_path)[0]
    return li.agg(F.count("*").alias("n")).select("n", F.lit(w["slope"]).alias("slope"), F.lit(w["intercept"]).alias("intercept"),
                                                   F.lit(w["steps"]).alias("steps"))


@query(
    "join_stream_static",
    """SELECT e.event_id, e.user_id, c.c_mktsegment, n.n_name FROM events e JOIN customer c ON e.user_id = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_stream_static(spark, sf):
    """A stream enriched from static tables (stream-static joins, append mode)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = _events_stream(spark, sf).select("event_id", "user_id")
    j = s.join(c, s.user_id == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    sink, ck = _paths(spark, "st-static")
    S.run_append(j.select("event_id", "user_id", "c_mktsegment", "n_name"), sink, ck)
    return spark.read.parquet(sink)
