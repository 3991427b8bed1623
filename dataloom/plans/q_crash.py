"""Crash-data rows: the cleaning job, the risk score and keyword label
functions, the train-and-compare job and batch scoring.

There is no crash table in the test data; ``crash_raw`` derives one from
``events`` with the mess the cleaning handles (mixed date formats, Y/N/1/0
words, unknown flags, missing coordinates with a WKT fallback, points out of
range), so it grows with the data."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import feature as MF
from pyspark.sql import functions as F

from dataloom.functions.strings import keyword_label
from dataloom.learn import crash as CR
from dataloom.plans.q_functions import MIXED_TIME_SPARK
from dataloom.plans.registry import query
from dataloom.session import fixed, scratch_path, table

_FLAGS = ["COLLISION ON PRIVATE PROPERTY", "PEDESTRIAN INVOLVED", "ALCOHOL INVOLVED", "DRUG INVOLVED", "SEATBELT USED",
          "MOTORCYCLE INVOLVED", "WORK ZONE"]


def _flag(j: int) -> str:
    return (f"CASE (k * 3 + {j * 7} + event_id) % 10 WHEN 0 THEN 'Y' WHEN 1 THEN 'Yes' WHEN 2 THEN '1' WHEN 3 THEN 'Unknown' "
            f"WHEN 4 THEN NULL WHEN 5 THEN 'no' ELSE 'N' END")


_SEVERITY = ("CASE WHEN value < 3 THEN 'Fatal Crash' WHEN value < 15 THEN 'Serious Injury Crash' WHEN value < 40 THEN 'Minor Injury' "
             "ELSE 'Property Damage Only' END")


def crash_raw(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    cols = {
        "CRASH DATETIME": F.expr(MIXED_TIME_SPARK),
        "CRASH CLASSIFICATION DESCRIPTION": F.expr(_SEVERITY),
        "LATITUDE": F.expr("CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(user_id / 1.5 - 20, 3) AS STRING) END"),
        "LONGITUDE": F.expr("CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(value * 4 - 100, 3) AS STRING) END"),
        "the_geom": F.expr("concat('POINT (', CAST(round(value * 3 - 60, 3) AS STRING), ' ', CAST(round(user_id * 0.5 - 30, 3) AS STRING), ')')"),
        "ROAD SURFACE DESCRIPTION": F.expr("CASE user_id % 4 WHEN 0 THEN 'Dry' WHEN 1 THEN 'Wet' WHEN 2 THEN 'Ice' END"),
        "LIGHTING CONDITION DESCRIPTION": F.expr("CASE k % 3 WHEN 0 THEN 'Daylight' WHEN 1 THEN 'Dark' END"),
        "WEATHER 1 DESCRIPTION": F.expr("CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Rain' WHEN 'error' THEN NULL ELSE 'Cloudy' END"),
    }
    for j, f in enumerate(_FLAGS):
        cols[f] = F.expr(_flag(j))
    return e.select(*[v.alias(k) for k, v in cols.items()])


def _bin_sql(name: str) -> str:
    return (f"CASE WHEN regexp_full_match(lower({name}), 'y|yes|true|t|1') THEN 1 "
            f"WHEN regexp_full_match(lower({name}), 'n|no|false|f|0') THEN 0 END")


_WKT = r"POINT\s*\(\s*([-\d\.]+)\s+([-\d\.]+)\s*\)"
_FLAG_COLS = [f.lower().replace(" ", "_") for f in _FLAGS]

CRASH_SQL = f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
raw AS (
  SELECT event_type, ts,
         CASE WHEN event_type IN ('purchase') THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS crash_ts,
         {_SEVERITY} AS crash_classification_description,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(user_id / 1.5 - 20, 3) AS VARCHAR) END AS lat_s,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(round(value * 4 - 100, 3) AS VARCHAR) END AS lon_s,
         'POINT (' || CAST(round(value * 3 - 60, 3) AS VARCHAR) || ' ' || CAST(round(user_id * 0.5 - 30, 3) AS VARCHAR) || ')' AS geom,
         CASE user_id % 4 WHEN 0 THEN 'Dry' WHEN 1 THEN 'Wet' WHEN 2 THEN 'Ice' END AS road_surface_description,
         CASE k % 3 WHEN 0 THEN 'Daylight' WHEN 1 THEN 'Dark' END AS lighting_condition_description,
         CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Rain' WHEN 'error' THEN NULL ELSE 'Cloudy' END AS weather_1_description,
         {", ".join(f"{_flag(j)} AS {c}" for j, c in enumerate(_FLAG_COLS))}
  FROM ev),
geo AS (
  SELECT *, coalesce(TRY_CAST(lat_s AS DOUBLE), TRY_CAST(regexp_extract(geom, '{_WKT}', 2) AS DOUBLE)) AS latitude,
            coalesce(TRY_CAST(lon_s AS DOUBLE), TRY_CAST(regexp_extract(geom, '{_WKT}', 1) AS DOUBLE)) AS longitude
  FROM raw),
feat AS (
  SELECT crash_ts, year(crash_ts) AS year, month(crash_ts) AS month, day(crash_ts) AS day, hour(crash_ts) AS hour,
         dayofweek(crash_ts) + 1 AS dofw, CASE WHEN dayofweek(crash_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN month(crash_ts) IN (12, 1, 2) THEN 'winter' WHEN month(crash_ts) IN (3, 4, 5) THEN 'spring'
              WHEN month(crash_ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
         latitude, longitude,
         CASE WHEN regexp_matches(lower(crash_classification_description), 'fatal') THEN 3
              WHEN regexp_matches(lower(crash_classification_description), 'serious|major|severe') THEN 2
              WHEN regexp_matches(lower(crash_classification_description), 'slight|minor') THEN 1 ELSE 0 END AS severity_label,
         {", ".join(f"{_bin_sql(c)} AS {c}_bin" for c in _FLAG_COLS)},
         road_surface_description, lighting_condition_description, weather_1_description
  FROM geo WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180),
scored AS (
  SELECT *, severity_label * 10 + alcohol_involved_bin * 5 + drug_involved_bin * 5 + pedestrian_involved_bin * 7
            + work_zone_bin * 4 + motorcycle_involved_bin * 3 + CASE WHEN seatbelt_used_bin = 0 THEN 4 ELSE 0 END AS risk_score
  FROM feat)
"""


_NUM_OUT = ["year", "month", "day", "hour", "dofw", "is_weekend", "latitude", "longitude", "severity_label", "risk_score"] + [f"{c}_bin" for c in _FLAG_COLS]
_STR_OUT = ["season", "lighting_condition_description", "road_surface_description", "weather_1_description"]


@query(
    "job_accident_clean",
    "WITH " + CRASH_SQL.strip() + ",\nmed AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in _NUM_OUT) + " FROM scored)\n"
    + "SELECT crash_ts AS \"timestamp\", " + ", ".join(f"CAST(coalesce({c}, m_{c}) AS DOUBLE) AS {c}" for c in _NUM_OUT) + ", "
    + ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in _STR_OUT) + " FROM scored, med",
)
def job_accident_clean(spark, sf):
    """The full cleaning job; output written partitioned by year / month and read back."""
    cleaned = CR.clean(crash_raw(spark, sf))
    path, sample = scratch_path(spark, "crash-clean"), scratch_path(spark, "crash-sample")
    CR.write_outputs(cleaned, path, sample)
    back = spark.read.parquet(path)
    return back.select("timestamp", *[F.col(c).cast("double").alias(c) for c in _NUM_OUT], *_STR_OUT)


@query(
    "fn_weighted_risk_score",
    "WITH " + CRASH_SQL.strip() + "\nSELECT crash_ts, latitude, longitude, severity_label, risk_score FROM scored",
)
def fn_weighted_risk_score(spark, sf):
    """Score = 10 x label + weighted flags (+ missing-belt penalty); any null flag gives a null score."""
    return CR.scored(crash_raw(spark, sf)).select(F.col("timestamp").alias("crash_ts"), "latitude", "longitude", "severity_label", "risk_score")


@query(
    "fn_keyword_label",
    f"""SELECT event_id, {_SEVERITY} AS description,
              CASE WHEN regexp_matches(lower({_SEVERITY}), 'fatal') THEN 3 WHEN regexp_matches(lower({_SEVERITY}), 'serious|major|severe') THEN 2
                   WHEN regexp_matches(lower({_SEVERITY}), 'slight|minor') THEN 1 ELSE 0 END AS severity_label FROM events""",
)
def fn_keyword_label(spark, sf):
    """Ordered keyword rules over text to an ordinal label (first match wins)."""
    e = table(spark, sf, "events").select("event_id", F.expr(_SEVERITY).alias("description"))
    return e.withColumn("severity_label", keyword_label(F.col("description"), CR.SEVERITY_RULES, 0))


def _crash_pipeline_stages(model):
    cats = ["road_surface_description", "lighting_condition_description", "weather_1_description", "season"]
    nums = ["year", "month", "day", "hour", "latitude", "longitude", "is_weekend", "risk_score"] + [f"{c}_bin" for c in _FLAG_COLS]
    return [
        MF.StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep"),
        MF.OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_oh" for c in cats]),
        MF.VectorAssembler(inputCols=[f"{c}_oh" for c in cats] + nums, outputCol="features"),
        model,
    ]


@query("mod_train_compare_job")
def mod_train_compare_job(spark, sf):
    """Clean -> split 80/20 (seed 42) -> random forest and logistic regression
    -> F1 / accuracy -> models and metrics saved to the shared folder.
    (The season string is indexed, not fed to the assembler as a number.)"""
    data = fixed(CR.clean(crash_raw(spark, sf)).withColumn("label", F.col("severity_label")), "crash-cleaned")
    train, test = data.randomSplit([0.8, 0.2], seed=42)
    rows = []
    for name, est in (("random_forest", C.RandomForestClassifier(numTrees=CR.FOREST_TREES, maxDepth=CR.FOREST_DEPTH, seed=42, labelCol="label")),
                      ("logistic_regression", C.LogisticRegression(maxIter=CR.LOGISTIC_ROUNDS, labelCol="label"))):
        m = Pipeline(stages=_crash_pipeline_stages(est)).fit(train)
        m.write().overwrite().save(scratch_path(spark, f"crash-model-{name}"))
        got = CR.label_metrics(m.transform(test))
        rows.append((name, got["f1"], got["accuracy"]))
    metrics = spark.createDataFrame(rows, "model string, f1 double, accuracy double")
    metrics.coalesce(1).write.mode("overwrite").json(scratch_path(spark, "crash-metrics"))
    return metrics


@query("mod_batch_score")
def mod_batch_score(spark, sf):
    """Score a table with a saved pipeline (the reference's one-row web service
    re-aimed as a batch job): fit once, save, load, transform every row."""
    data = fixed(CR.clean(crash_raw(spark, sf)).withColumn("label", F.col("severity_label")), "crash-cleaned")
    path = scratch_path(spark, "crash-scorer")
    forest = C.RandomForestClassifier(numTrees=CR.FOREST_TREES, maxDepth=CR.SCORER_DEPTH, seed=42, labelCol="label")
    Pipeline(stages=_crash_pipeline_stages(forest)).fit(data).write().overwrite().save(path)
    return PipelineModel.load(path).transform(data).select("timestamp", "latitude", "longitude", "prediction")
