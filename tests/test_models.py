"""Values of the rows without SQL: settings, accuracy above chance, bounds of sketches."""

from __future__ import annotations

import inspect

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dataloom.learn import crash as CR
from dataloom.plans import REGISTRY, q_crash, q_learn
from dataloom.session import table


def run(spark, name):
    return REGISTRY[name].fn(spark, SF_SMALL)


def test_training_settings(spark):
    assert (CR.FOREST_TREES, CR.FOREST_DEPTH, CR.SCORER_DEPTH, CR.LOGISTIC_ROUNDS) == (80, 12, 10, 50)
    rounds = {k: m.getMaxIter() for k, m in {**q_learn.clusterers(), **q_learn.other_regressors()}.items()}
    assert rounds == {"km": 20, "bk": 20, "gm": 100, "lda": 10, "aft": 100, "fm": 100}
    other = q_learn.other_classifiers()
    assert (other["fm"].getMaxIter(), other["ovr"].getClassifier().getMaxIter()) == (100, 10)
    for fn, words in ((q_learn.mod_classify_other, ["maxIter=100"]), (q_learn.mod_cluster, ["maxIter=20"]),
                      (q_learn.mod_recommend_als, ["maxIter=5"]), (q_learn.mod_classify_tree, ["GBTClassifier(maxIter=10"])):
        assert all(w in inspect.getsource(fn) for w in words), fn
    assert "CR.FOREST_TREES" in inspect.getsource(q_crash.mod_batch_score)


def test_label_metrics_match_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.createDataFrame([(float(i % 3), float((i * i) % 4 % 3)) for i in range(60)], "label double, prediction double")
    got = CR.label_metrics(df)
    for name in ("f1", "accuracy"):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))


def test_crash_label_from_the_code(spark):
    df = spark.createDataFrame([("3",), ("1",), ("x",)], "crash_classification_code string")
    assert [r[0] for r in df.select(CR.severity(df.columns)).collect()] == [2, 1, 1]


def test_crash_times_of_twelve_hours(spark):
    from dataloom.functions.dates import parse_first

    df = spark.createDataFrame([("01/31/2024 11:05:06 PM",), ("01/31/2024 11:05:06 PM +0000",), ("nothing",)], "t string")
    got = [str(r[0]) for r in df.select(parse_first(F.col("t"), CR.TIME_FORMATS)).collect()]
    assert got == ["2024-01-31 23:05:06", "2024-01-31 23:05:06", "None"]


def test_batch_scores_beat_the_commonest_label(spark):
    scored = run(spark, "mod_batch_score").select("timestamp", "latitude", "longitude", "prediction")
    truth = run(spark, "fn_weighted_risk_score").select(F.col("crash_ts").alias("timestamp"), "latitude", "longitude", "severity_label")
    both = scored.join(truth, ["timestamp", "latitude", "longitude"])
    n = both.count()
    commonest = both.groupBy("severity_label").count().agg(F.max("count")).first()[0]
    assert both.where("prediction = severity_label").count() > commonest <= n


def test_tuning_covers_the_grid(spark):
    rows = run(spark, "mod_tune").collect()
    assert len(rows) == 12 and len({(r.method, r.reg, r.elastic) for r in rows}) == 12 and all(0 <= r.auc <= 1 for r in rows)


def test_recommendations_are_purchases_or_go_with_them(spark):
    recs = run(spark, "mod_recommend_als")
    li, o = table(spark, SF_SMALL, "lineitem"), table(spark, SF_SMALL, "orders")
    bought = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i")).distinct()
    new = recs.join(bought, ["u", "i"], "left_anti")
    assert recs.count() > new.count() > 0 and new.join(run(spark, "mod_recommend_candidates"), ["u", "i"], "left_anti").count() == 0
    assert recs.groupBy("u").count().agg(F.max("count")).first()[0] <= 3


def test_item_sets_are_counted_exactly(spark):
    pats = {r.pattern: r.freq for r in run(spark, "mod_frequent_patterns").where("kind = 'itemset'").collect()}
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus", (F.col("l_quantity") / 10).cast("int").cast("string")).alias("item"))
    singles = {r["item"]: r["n"] for r in li.distinct().groupBy("item").agg(F.count("*").alias("n")).collect()}
    assert all(singles[p] == n for p, n in pats.items() if "," not in p) and any("," in p for p in pats)


def test_centres_stand_still(spark):
    got = run(spark, "it_kmeans_manual")
    e = table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").join(got, "vec_id")
    means = {r["cl"]: [r[f"m{i}"] for i in range(64)] for r in e.groupBy("cl").agg(*[F.avg(F.col("embedding")[i]).alias(f"m{i}") for i in range(64)]).collect()}
    for r in e.collect():
        apart = {c: sum((a - b) ** 2 for a, b in zip(r.embedding, m)) for c, m in means.items()}
        assert apart[r.cl] <= min(apart.values()) + 1e-6


def test_sketches_are_near(spark):
    li = table(spark, SF_SMALL, "lineitem")
    exact = li.agg(F.count_distinct("l_partkey")).first()[0]
    near = li.agg(F.approx_count_distinct("l_partkey")).first()[0]
    assert abs(near - exact) <= 0.15 * exact


def test_every_event_is_in_the_search_log(spark):
    from dataloom.plans.fixtures import search_log

    e = table(spark, SF_SMALL, "events")
    log = search_log(spark, SF_SMALL)
    assert log.count() == e.count()
    a = log.groupBy("user").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, e.groupBy("user_id").count().collect()))
