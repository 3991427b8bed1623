"""§2.12 feature engineering and §2.13 models / statistics on pyspark.ml.

Statistics that a query can state exactly are computed as distributed
aggregates (and checked against SQL); fitted models are checked by rows and
by tests. Iteration counts, tree counts and depths are those of the reference's
examples.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import feature as MF
from pyspark.ml import regression as R
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from dataloom.learn import lsh as L
from dataloom.learn import matrix as M
from dataloom.learn import partners as PA
from dataloom.operators import groups as G
from dataloom.operators import order as O
from dataloom.operators.joins import checked_broadcast
from dataloom.plans.fixtures import CUSTOMER_NULLS_SQL, customer_nulls, with_ctes
from dataloom.plans.registry import query
from dataloom.session import fixed, scratch_path, table


#: rounds where the reference's examples leave the library's defaults, and where they name them
DEFAULT_ROUNDS, CLUSTER_ROUNDS, ONE_VS_REST_ROUNDS = 100, 20, 10
#: places that words are hashed into
HASHED_PLACES = 1 << 20
#: items of the sequences that one task mines
LOCAL_ITEMS = 2_000_000
#: bytes of text whose terms one task counts
TERM_PART = 1 << 24
#: characters of text that one task trains word vectors on
WORD_PART = 1 << 23
#: ratings of one block of a factorisation, which a task holds and sorts
BLOCK_RATINGS = 2_000_000


def _r(c, d=6):
    return F.round(c, d)


def _lines(spark, sf):
    """Line items with numeric features and two labels."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("price_k"),
        "l_linestatus", "o_orderpriority", "l_returnflag", (F.col("l_returnflag") == "R").cast("double").alias("label"))


_NUM = ["l_quantity", "l_discount", "l_tax", "price_k"]


def _kept_lines(spark, sf, *columns):
    """The columns of ``_lines`` that a model needs, joined once and written: every
    pass of a fit reads these, none joins and shuffles again."""
    return fixed(_lines(spark, sf).select("l_orderkey", "l_linenumber", *columns), "lines")


def _assembled(spark, sf):
    return MF.VectorAssembler(inputCols=_NUM, outputCol="features").transform(_lines(spark, sf))


def _stages():
    return [
        MF.StringIndexer(inputCols=["l_linestatus", "o_orderpriority"], outputCols=["ls_idx", "prio_idx"], handleInvalid="keep"),
        MF.OneHotEncoder(inputCols=["ls_idx", "prio_idx"], outputCols=["ls_oh", "prio_oh"]),
        MF.VectorAssembler(inputCols=["ls_oh", "prio_oh", *_NUM], outputCol="features"),
    ]


# ------------------------------------------------------------------ §2.12


@query("ml_stage_chain")
def ml_stage_chain(spark, sf):
    """Stages chained (index, one-hot, assemble, logistic regression): fit,
    save, load, transform."""
    pipe = Pipeline(stages=[*_stages(), C.LogisticRegression(maxIter=10, labelCol="label")])
    data = _kept_lines(spark, sf, *_NUM, "l_linestatus", "o_orderpriority", "label")
    model = pipe.fit(data)
    path = scratch_path(spark, "pipeline-model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path).transform(data).select("l_orderkey", "l_linenumber", "label", "prediction")


@query("ml_index_onehot")
def ml_index_onehot(spark, sf):
    """String index (unknowns kept), back to strings, one-hot, vector indexer."""
    d = _lines(spark, sf)
    si = MF.StringIndexer(inputCol="o_orderpriority", outputCol="prio_idx", handleInvalid="keep").fit(d)
    x = si.transform(d)
    x = MF.IndexToString(inputCol="prio_idx", outputCol="prio_back", labels=si.labels).transform(x)
    x = MF.OneHotEncoder(inputCol="prio_idx", outputCol="prio_oh").fit(x).transform(x)
    x = MF.VectorAssembler(inputCols=["l_linenumber", "l_quantity"], outputCol="v").transform(x)
    x = MF.VectorIndexer(inputCol="v", outputCol="v_idx", maxCategories=10).fit(x).transform(x)
    return x.select("l_orderkey", "o_orderpriority", "prio_idx", "prio_back", vector_to_array("prio_oh").alias("prio_oh"),
                    vector_to_array("v_idx").alias("v_idx"))


@query("ml_encode_by_cardinality")
def ml_encode_by_cardinality(spark, sf, one_hot_up_to=60, indexed_up_to=2000):
    """Encoding tier per categorical column by its exact number of values (the
    tiers are the feature): up to 60 one-hot, up to 2000 indexed, else hashed."""
    o = table(spark, sf, "orders").withColumn("cust", F.col("o_custkey").cast("string"))
    cats = ["o_orderstatus", "o_orderpriority", "cust"]
    card = o.agg(*[F.count_distinct(c).alias(c) for c in cats]).first().asDict()
    stages, out = [], []
    for c in cats:
        if card[c] <= one_hot_up_to:
            stages += [MF.StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep"), MF.OneHotEncoder(inputCol=f"{c}_i", outputCol=f"{c}_enc")]
        elif card[c] <= indexed_up_to:
            stages += [MF.StringIndexer(inputCol=c, outputCol=f"{c}_enc", handleInvalid="keep")]
        else:
            stages += [MF.FeatureHasher(inputCols=[c], outputCol=f"{c}_enc", numFeatures=1024)]
        out.append(f"{c}_enc")
    stages.append(MF.VectorAssembler(inputCols=out, outputCol="features"))
    m = Pipeline(stages=stages).fit(o)
    return m.transform(o).select("o_orderkey", vector_to_array("features").alias("features"))


@query(
    "ml_impute",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, coalesce(bal, (SELECT avg(bal) FROM customer_nulls)) AS bal,
                       coalesce(nation, (SELECT nation FROM customer_nulls WHERE nation IS NOT NULL GROUP BY nation
                                         ORDER BY COUNT(*) DESC, nation LIMIT 1)) AS nation
                FROM customer_nulls""",
    ),
)
def ml_impute(spark, sf):
    """Imputer: mean for the balance, mode (most frequent, smallest on ties) for the nation."""
    c = customer_nulls(spark, sf).select("c_custkey", "bal", F.col("nation").cast("double").alias("nation"))
    m1 = MF.Imputer(inputCols=["bal"], outputCols=["bal"], strategy="mean").fit(c)
    m2 = MF.Imputer(inputCols=["nation"], outputCols=["nation"], strategy="mode").fit(c)
    out = m2.transform(m1.transform(c))
    return out.select("c_custkey", "bal", F.col("nation").cast("int").alias("nation"))


def median_impute(df, cols, accuracy: int = 10000):
    """Median fill of many columns from ONE ``percentile_approx`` pass (mergeable sketches)."""
    meds = df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in cols]).first().asDict()
    return df.fillna({c: v for c, v in meds.items() if v is not None})


@query(
    "ml_scale",
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, min(l_quantity) AS lo, max(l_quantity) AS hi,
                         max(abs(l_discount)) AS md, quantile_disc(l_quantity, 0.5) AS med,
                         quantile_disc(l_quantity, 0.75) - quantile_disc(l_quantity, 0.25) AS iqr FROM lineitem)
       SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS standard, round((l_quantity - lo) / (hi - lo), 6) AS minmax,
              round(l_discount / md, 6) AS maxabs, round((l_quantity - med) / iqr, 6) AS robust,
              round(l_quantity / sqrt(l_quantity * l_quantity + l_discount * l_discount), 6) AS l2_norm_q
       FROM lineitem, s""",
)
def ml_scale(spark, sf):
    """Standard / min-max / max-abs / robust scalers and the L2 normaliser."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    x = MF.VectorAssembler(inputCols=["l_quantity"], outputCol="q").transform(li)
    x = MF.VectorAssembler(inputCols=["l_discount"], outputCol="d").transform(x)
    x = MF.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="qd").transform(x)
    x = MF.StandardScaler(inputCol="q", outputCol="std", withMean=True, withStd=True).fit(x).transform(x)
    x = MF.MinMaxScaler(inputCol="q", outputCol="mm").fit(x).transform(x)
    x = MF.MaxAbsScaler(inputCol="d", outputCol="ma").fit(x).transform(x)
    x = MF.RobustScaler(inputCol="q", outputCol="rb", withCentering=True, withScaling=True).fit(x).transform(x)
    x = MF.Normalizer(inputCol="qd", outputCol="n2", p=2.0).transform(x)
    e = lambda c: vector_to_array(c)[0]
    return x.select("l_orderkey", "l_linenumber", _r(e("std")).alias("standard"), _r(e("mm")).alias("minmax"),
                    _r(e("ma")).alias("maxabs"), _r(e("rb")).alias("robust"), _r(e("n2")).alias("l2_norm_q"))


@query(
    "ml_bucketize",
    """WITH q AS (SELECT quantile_disc(l_quantity, 0.25) AS a, quantile_disc(l_quantity, 0.5) AS b, quantile_disc(l_quantity, 0.75) AS c FROM lineitem)
       SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END AS binary,
              CASE WHEN l_quantity < 10 THEN 0.0 WHEN l_quantity < 25 THEN 1.0 WHEN l_quantity < 40 THEN 2.0 ELSE 3.0 END AS fixed_bucket,
              CASE WHEN l_quantity < a THEN 0.0 WHEN l_quantity < b THEN 1.0 WHEN l_quantity < c THEN 2.0 ELSE 3.0 END AS quantile_bucket
       FROM lineitem, q""",
)
def ml_bucketize(spark, sf):
    """Binarizer (threshold), Bucketizer (given splits), QuantileDiscretizer (4 bins)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    x = MF.Binarizer(threshold=0.05, inputCol="l_discount", outputCol="binary").transform(li)
    x = MF.Bucketizer(splits=[-math.inf, 10, 25, 40, math.inf], inputCol="l_quantity", outputCol="fixed_bucket").transform(x)
    x = MF.QuantileDiscretizer(numBuckets=4, inputCol="l_quantity", outputCol="quantile_bucket", relativeError=0.0001).fit(x).transform(x)
    return x.select("l_orderkey", "l_linenumber", "binary", "fixed_bucket", "quantile_bucket")


@query("ml_assemble_slice")
def ml_assemble_slice(spark, sf):
    """Assemble, slice, size hint, interaction, element-wise product, polynomial, DCT."""
    from pyspark.ml.linalg import Vectors

    x = _assembled(spark, sf)
    x = MF.VectorSizeHint(inputCol="features", size=4, handleInvalid="error").transform(x)
    x = MF.VectorSlicer(inputCol="features", outputCol="sliced", indices=[0, 3]).transform(x)
    x = MF.ElementwiseProduct(scalingVec=Vectors.dense([1.0, 10.0, 10.0, 0.1]), inputCol="features", outputCol="scaled").transform(x)
    x = MF.PolynomialExpansion(degree=2, inputCol="sliced", outputCol="poly").transform(x)
    x = MF.DCT(inverse=False, inputCol="features", outputCol="dct").transform(x)
    x = MF.VectorAssembler(inputCols=["l_tax"], outputCol="t").transform(x)
    x = MF.Interaction(inputCols=["sliced", "t"], outputCol="inter").transform(x)
    return x.select("l_orderkey", *[vector_to_array(c).alias(c) for c in ("sliced", "scaled", "poly", "dct", "inter")])


@query(
    "ml_vector_array",
    "SELECT l_orderkey, l_linenumber, l_quantity AS e0, l_discount AS e1, l_tax AS e2, round(l_quantity + l_discount + l_tax, 6) AS total FROM lineitem",
)
def ml_vector_array(spark, sf):
    """Vectors to arrays and back."""
    li = table(spark, sf, "lineitem")
    v = MF.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="v").transform(li)
    a = v.select("l_orderkey", "l_linenumber", vector_to_array("v").alias("a"))
    back = a.select("*", array_to_vector("a").alias("v2")).select("l_orderkey", "l_linenumber", vector_to_array("v2").alias("b"))
    return back.select("l_orderkey", "l_linenumber", F.col("b")[0].alias("e0"), F.col("b")[1].alias("e1"), F.col("b")[2].alias("e2"),
                       _r(F.aggregate("b", F.lit(0.0), lambda s, y: s + y)).alias("total"))


# fixed values: the stop words of this example (a short custom list)
STOP = ["the", "a", "an", "and", "of", "to", "in", "is", "it", "on", "for", "with", "le", "la", "les", "de", "des", "et", "der", "die", "und"]


@query(
    "ml_text",
    f"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s'), lambda x: x <> '') AS toks,
                          list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> '') AS words FROM documents)
        SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(words) AS BIGINT) AS n_words,
               CAST(len(list_filter(words, lambda w: NOT list_contains({STOP!r}, w))) AS BIGINT) AS n_kept,
               CAST(greatest(len(list_filter(words, lambda w: NOT list_contains({STOP!r}, w))) - 1, 0) AS BIGINT) AS n_bigrams
        FROM t""",
)
def ml_text(spark, sf):
    """Tokenizer (whitespace), RegexTokenizer (non-word gaps), stop words, 2-grams over whole documents."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    x = MF.Tokenizer(inputCol="text", outputCol="toks").transform(d)
    x = MF.RegexTokenizer(inputCol="text", outputCol="words", pattern="[^a-zA-Z0-9_]+", gaps=True, toLowercase=True).transform(x)
    x = MF.StopWordsRemover(inputCol="words", outputCol="kept", stopWords=STOP).transform(x)
    x = MF.NGram(n=2, inputCol="kept", outputCol="bigrams").transform(x)
    return x.select("doc_id", F.size(F.filter("toks", lambda t: t != "")).cast("long").alias("n_tokens"),
                    F.size("words").cast("long").alias("n_words"), F.size("kept").cast("long").alias("n_kept"),
                    F.size("bigrams").cast("long").alias("n_bigrams"))


@query(
    "ml_tfidf",
    """WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '')) AS term FROM documents),
            tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM w GROUP BY doc_id, term),
            df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
            n AS (SELECT COUNT(*) AS n FROM documents)
       SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * ln((n.n + 1.0) / (df.df + 1.0)), 6) AS tfidf
       FROM tf JOIN df ON tf.term = df.term, n""",
)
def ml_tfidf(spark, sf):
    """Term counts x IDF = log((N + 1) / (df + 1)) (the IDF estimator's formula),
    as distributed aggregates: no vocabulary on the driver."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    n, size = d.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    # texts are dealt by document, so their many more words and counts stay where they are
    dealt = d.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // TERM_PART)), "doc_id")
    w = dealt.select("doc_id", F.explode(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "")).alias("term"))
    tf = w.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    df = fixed(tf.groupBy("term").agg(F.count("*").alias("df")), "document-counts")
    return tf.join(checked_broadcast(df), "term").select("doc_id", "term", "tf", _r(F.col("tf") * F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0))).alias("tfidf"))


@query(
    "ml_tfidf_hashed",
    """SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '')) AS DOUBLE) AS terms, true AS weighted FROM documents""",
)
def ml_tfidf_hashed(spark, sf):
    """Hashed term counts and their IDF weights: words are hashed into 2^20 places,
    where two words may share one; per document the sum of the counts, and whether
    every place that is not zero has the weight of its document count."""
    d = table(spark, sf, "documents").select("doc_id", F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "").alias("w"))
    x = MF.HashingTF(inputCol="w", outputCol="tf", numFeatures=HASHED_PLACES).transform(d)
    x = MF.IDF(inputCol="tf", outputCol="tfidf").fit(x).transform(x)
    counts, weights = F.unwrap_udt("tf")["values"], F.unwrap_udt("tfidf")["values"]  # of the places that are not zero
    most = F.log(F.lit(d.count()) + 1.0)
    return x.select("doc_id", F.aggregate(counts, F.lit(0.0), lambda s, v: s + v).alias("terms"),
                    F.forall(F.zip_with(counts, weights, lambda a, b: (b >= 0) & (b < a * most)), lambda ok: ok).alias("weighted"))


@query("ml_word2vec")
def ml_word2vec(spark, sf):
    """Word vectors over the whole documents, and synonyms of one word. Each part of the
    texts is trained on by one task and the vectors of the parts are averaged by the estimator;
    parts grow in number with the texts, not in size."""
    d = table(spark, sf, "documents").select("text")
    parts = 1 + (d.agg(F.sum(F.length("text"))).first()[0] or 0) // WORD_PART
    x = MF.RegexTokenizer(inputCol="text", outputCol="words", pattern="[^a-z]+", gaps=True).transform(d)
    m = MF.Word2Vec(vectorSize=8, minCount=5, maxIter=1, seed=42, numPartitions=parts, inputCol="words", outputCol="vec").fit(x)
    vectors = m.getVectors().select("word", vector_to_array("vector").alias("vector"), F.lit(None).cast("double").alias("similarity"))
    word = vectors.agg(F.min("word")).first()[0]
    if word is None:
        return vectors
    near = m.findSynonyms(word, 10)  # ten words: the feature
    return vectors.unionByName(near.select(F.concat(F.lit(f"like {word}: "), "word").alias("word"), F.lit(None).cast("array<float>").alias("vector"), "similarity"))


@query("ml_pca")
def ml_pca(spark, sf):
    """Principal components (k = 3) of the embeddings."""
    e = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    m = MF.PCA(k=3, inputCol="v", outputCol="pc").fit(e)
    return m.transform(e).select("vec_id", vector_to_array("pc").alias("pc"))


@query("ml_select_features")
def ml_select_features(spark, sf):
    """Chi-square, univariate (F-test) and variance-threshold selectors."""
    x = _assembled(spark, sf)
    x = x.withColumn("q_bin", F.floor(F.col("l_quantity") / 10)).withColumn("ship_late", (F.col("l_linestatus") == "F").cast("int"))
    x = MF.VectorAssembler(inputCols=["l_linenumber", "q_bin", "ship_late"], outputCol="cats").transform(x)
    x = MF.ChiSqSelector(numTopFeatures=2, featuresCol="cats", labelCol="label", outputCol="chi").fit(x).transform(x)
    u = MF.UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="uni", selectionMode="numTopFeatures")
    u.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(2)
    x = u.fit(x).transform(x)
    x = MF.VarianceThresholdSelector(varianceThreshold=0.01, featuresCol="features", outputCol="var").fit(x).transform(x)
    return x.select("l_orderkey", *[vector_to_array(c).alias(c) for c in ("chi", "uni", "var")])


@query("ml_rformula_sql")
def ml_rformula_sql(spark, sf):
    """RFormula and a SQL statement as pipeline stages."""
    d = _lines(spark, sf)
    st = MF.SQLTransformer(statement="SELECT *, l_quantity * price_k AS q_price FROM __THIS__")
    rf = MF.RFormula(formula="label ~ l_quantity + q_price + l_linestatus", featuresCol="rf_features", labelCol="rf_label")
    out = Pipeline(stages=[st, rf]).fit(d).transform(d)
    return out.select("l_orderkey", "rf_label", vector_to_array("rf_features").alias("rf_features"))


@query("ml_lsh_similarity")
def ml_lsh_similarity(spark, sf):
    """Random-projection (Euclid) and MinHash (Jaccard) LSH: nearest neighbours
    of a key taken from the data (no pair enumeration)."""
    e = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    brp = MF.BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=2.0, numHashTables=3, seed=7).fit(e)
    key = e.orderBy("vec_id").first()["v"]
    nn = brp.approxNearestNeighbors(e, key, 5).select("vec_id", F.col("distCol").alias("dist"), F.lit("euclid").alias("kind"))
    from pyspark.ml.linalg import Vectors

    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    sets = MF.FeatureHasher(inputCols=["p_brand"], outputCol="b", numFeatures=64).transform(p)
    mh = MF.MinHashLSH(inputCol="b", outputCol="h", numHashTables=3, seed=7).fit(sets)
    k2 = sets.orderBy("p_partkey").first()["b"]
    nn2 = mh.approxNearestNeighbors(sets, k2 if k2.numNonzeros() else Vectors.sparse(64, [0], [1.0]), 5).select(
        F.col("p_partkey").alias("vec_id"), F.col("distCol").alias("dist"), F.lit("jaccard").alias("kind"))
    return nn.unionByName(nn2)


@query("ml_lsh_similarity_join")
def ml_lsh_similarity_join(spark, sf):
    """Similarity joins by hashing: vectors at most 1.5 apart (random projections),
    and orders whose sets of brands are at most 0.4 apart (least hashes). One row per
    vector or order with the class of its equals and the number of its links."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    near = L.links(*L.similar(e, "vec_id", "v", L.euclid_hashes(4.0, 8, 4, 7), L.euclid, 1.5, 8, counts=True))
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sets = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.xxhash64("p_brand"))).alias("v"))  # as many items as there are brands
    alike = L.links(*L.similar(sets, "l_orderkey", "v", L.jaccard_hashes(12, 2, 7), L.jaccard, 0.4, 12, counts=True))
    return near.withColumn("kind", F.lit("euclid")).unionByName(alike.withColumn("kind", F.lit("jaccard")))


# ------------------------------------------------------------------ §2.13


def _split(spark, sf):
    """Training and test rows, 80 to 20: the draw of ``randomSplit`` (rows in order within
    a partition, one random number each) made once and written with what the models
    need, so no pass of a fit joins, shuffles, sorts or draws again."""
    x = _lines(spark, sf)
    drawn = fixed(x.sortWithinPartitions(*x.columns).select("l_orderkey", "l_linenumber", *_NUM, "l_returnflag", "label", F.rand(42).alias("draw")), "drawn-lines")
    whole = MF.VectorAssembler(inputCols=_NUM, outputCol="features").transform(drawn)
    return whole.where("draw < 0.8").drop("draw"), whole.where("draw >= 0.8").drop("draw")


@query("mod_classify_linear")
def mod_classify_linear(spark, sf):
    """Logistic regression (binary; multinomial with elastic net) and linear SVM."""
    tr, te = _split(spark, sf)
    lr = C.LogisticRegression(maxIter=10, labelCol="label").fit(tr)
    idx = MF.StringIndexer(inputCol="l_returnflag", outputCol="flag_idx").fit(tr)
    mlr = C.LogisticRegression(maxIter=10, family="multinomial", elasticNetParam=0.5, regParam=0.01, labelCol="flag_idx").fit(idx.transform(tr))
    svc = C.LinearSVC(maxIter=10, labelCol="label").fit(tr)
    out = lr.transform(te).select("l_orderkey", "l_linenumber", "features", F.col("prediction").alias("p_lr"))
    out = mlr.transform(out).select("l_orderkey", "l_linenumber", "features", "p_lr", F.col("prediction").alias("p_mlr"))
    return svc.transform(out).select("l_orderkey", "l_linenumber", "p_lr", "p_mlr", F.col("prediction").alias("p_svc"))


@query("mod_classify_tree")
def mod_classify_tree(spark, sf):
    """Decision tree, random forest and gradient-boosted trees."""
    tr, te = _split(spark, sf)
    dt = C.DecisionTreeClassifier(maxDepth=5, labelCol="label", predictionCol="p_dt", probabilityCol="pr_dt", rawPredictionCol="r_dt").fit(tr)
    rf = C.RandomForestClassifier(numTrees=10, maxDepth=5, seed=42, labelCol="label", predictionCol="p_rf", probabilityCol="pr_rf",
                                  rawPredictionCol="r_rf").fit(tr)
    gbt = C.GBTClassifier(maxIter=10, seed=42, labelCol="label", predictionCol="p_gbt").fit(tr)
    return gbt.transform(rf.transform(dt.transform(te))).select("l_orderkey", "l_linenumber", "p_dt", "p_rf", "p_gbt")


def other_classifiers():
    """Factorisation machine and one-vs-rest, with the rounds of the reference's examples."""
    return {"fm": C.FMClassifier(maxIter=DEFAULT_ROUNDS, seed=42, labelCol="label", predictionCol="p_fm", probabilityCol="pr_fm", rawPredictionCol="r_fm"),
            "ovr": C.OneVsRest(classifier=C.LogisticRegression(maxIter=ONE_VS_REST_ROUNDS), labelCol="flag_idx", predictionCol="p_ovr")}


def other_regressors():
    return {"aft": R.AFTSurvivalRegression(maxIter=DEFAULT_ROUNDS, labelCol="price_k", censorCol="censor", predictionCol="p_aft"),
            "fm": R.FMRegressor(maxIter=DEFAULT_ROUNDS, seed=42, labelCol="price_k", predictionCol="p_fm")}


def clusterers():
    return {"km": K.KMeans(k=4, seed=42, maxIter=CLUSTER_ROUNDS, predictionCol="c_km"),
            "bk": K.BisectingKMeans(k=4, seed=42, maxIter=CLUSTER_ROUNDS, predictionCol="c_bk"),
            "gm": K.GaussianMixture(k=2, seed=42, maxIter=DEFAULT_ROUNDS, predictionCol="c_gm", probabilityCol="pr_gm"),
            "lda": K.LDA(k=10, maxIter=10, seed=42)}


@query("mod_classify_other")
def mod_classify_other(spark, sf):
    """Naive Bayes, multilayer perceptron, factorisation machine, one-vs-rest."""
    tr, te = _split(spark, sf)
    nb = C.NaiveBayes(labelCol="label", predictionCol="p_nb", probabilityCol="pr_nb", rawPredictionCol="r_nb").fit(tr)
    mlp = C.MultilayerPerceptronClassifier(layers=[4, 5, 2], maxIter=100, seed=42, labelCol="label", predictionCol="p_mlp",
                                           probabilityCol="pr_mlp", rawPredictionCol="r_mlp").fit(tr)
    fm = other_classifiers()["fm"].fit(tr)
    idx = MF.StringIndexer(inputCol="l_returnflag", outputCol="flag_idx").fit(tr)
    ovr = other_classifiers()["ovr"].fit(idx.transform(tr))
    return ovr.transform(fm.transform(mlp.transform(nb.transform(te)))).select("l_orderkey", "l_linenumber", "p_nb", "p_mlp", "p_fm", "p_ovr")


@query("mod_regress_linear")
def mod_regress_linear(spark, sf):
    """Linear (elastic net), generalised linear, isotonic and AFT survival regression."""
    x = MF.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(_kept_lines(spark, sf, *_NUM))
    x = x.withColumn("censor", F.lit(1.0))
    lin = R.LinearRegression(maxIter=10, elasticNetParam=0.5, regParam=0.01, labelCol="price_k", predictionCol="p_lin").fit(x)
    glr = R.GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=10, labelCol="price_k", predictionCol="p_glr").fit(x)
    iso = R.IsotonicRegression(featuresCol="l_quantity", labelCol="price_k", predictionCol="p_iso").fit(x)
    aft = other_regressors()["aft"].fit(x)
    return aft.transform(iso.transform(glr.transform(lin.transform(x)))).select("l_orderkey", "l_linenumber", "p_lin", "p_glr", "p_iso", "p_aft")


@query("mod_regress_tree")
def mod_regress_tree(spark, sf):
    """Tree, forest, boosted and factorisation-machine regressors."""
    x = MF.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(_kept_lines(spark, sf, *_NUM))
    dt = R.DecisionTreeRegressor(maxDepth=5, labelCol="price_k", predictionCol="p_dt").fit(x)
    rf = R.RandomForestRegressor(numTrees=10, maxDepth=5, seed=42, labelCol="price_k", predictionCol="p_rf").fit(x)
    gbt = R.GBTRegressor(maxIter=10, seed=42, labelCol="price_k", predictionCol="p_gbt").fit(x)
    fm = other_regressors()["fm"].fit(x)
    return fm.transform(gbt.transform(rf.transform(dt.transform(x)))).select("l_orderkey", "l_linenumber", "p_dt", "p_rf", "p_gbt", "p_fm")


@query("mod_cluster")
def mod_cluster(spark, sf):
    """K-means, bisecting k-means, Gaussian mixture (embeddings); LDA topics
    (documents); power iteration clustering (supplier-part graph)."""
    # the fits go over their rows many times: vectors and hashed words are made once
    e = fixed(table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("features")), "vectors")
    km, bk, gm = (clusterers()[x].fit(e) for x in ("km", "bk", "gm"))
    a = gm.transform(bk.transform(km.transform(e))).select(F.col("vec_id").alias("id"), F.lit("vec").alias("kind"),
                                                           F.array("c_km", "c_bk", "c_gm").alias("clusters"))
    d = table(spark, sf, "documents").select("doc_id", "text")
    x = MF.RegexTokenizer(inputCol="text", outputCol="w", pattern="[^a-z]+", gaps=True).transform(d)
    # every word counts: hashed into a fixed number of places (two words may share one), no vocabulary on the driver
    x = fixed(MF.HashingTF(inputCol="w", outputCol="features", numFeatures=1 << 16).transform(x).select("doc_id", "features"), "hashed-words")
    lda = clusterers()["lda"].fit(x)
    b = lda.transform(x).select(F.col("doc_id").alias("id"), F.lit("doc").alias("kind"),
                                F.transform(vector_to_array("topicDistribution"), lambda t: F.round(t * 100).cast("int")).alias("clusters"))
    li = table(spark, sf, "lineitem")
    g = li.select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + 1_000_000).alias("dst")).distinct().withColumn("weight", F.lit(1.0))
    pic = K.PowerIterationClustering(k=2, maxIter=20, weightCol="weight").assignClusters(g)
    c = pic.select(F.col("id"), F.lit("graph").alias("kind"), F.array("cluster").alias("clusters"))
    return a.unionByName(b).unionByName(c)


@query("mod_recommend_als")
def mod_recommend_als(spark, sf):
    """ALS on customer x part quantities; of the parts a customer has bought and the
    new ones that go with them (at most five per part, so candidates grow with the
    purchases, not with customers x parts), the three of highest predicted
    rating; unseen ids dropped (cold start)."""
    lines = _orders_of_customers(spark, sf)
    r = fixed(lines.groupBy("u", "i").agg(F.sum("l_quantity").cast("float").alias("r")), "ratings")
    als = ALS(rank=4, maxIter=5, regParam=0.1, userCol="u", itemCol="i", ratingCol="r", coldStartStrategy="drop", seed=42)
    m = als.setNumBlocks(_blocks(r.count())).fit(r)
    candidates = r.select("u", "i").unionByName(PA.new_items(lines, PA.partners(lines, top=5)))
    top = G.top_n(m.transform(candidates), ["u"], [F.desc("prediction"), F.col("i")], 3)
    return top.select("u", "i", F.col("prediction").alias("score"))


def _blocks(ratings: int) -> int:
    """The library's ten blocks or as many as keep a block at ``BLOCK_RATINGS``: a task holds a block's
    ratings several times while it sorts them."""
    return max(10, -(-ratings // BLOCK_RATINGS))


def _orders_of_customers(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("l_orderkey").alias("basket"), F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), "l_quantity")
    return fixed(lines, "lines-of-customers")  # joined once: ratings, baskets and candidates read it


_X = "CASE WHEN {0} > 0 THEN {0} * ln({0}) ELSE 0 END"


def _h(*counts: str) -> str:
    return "(" + _X.format("(" + " + ".join(counts) + ")") + "".join(" - " + _X.format(c) for c in counts) + ")"


_PARTNERS_SQL = f"""ln AS (SELECT DISTINCT l_orderkey AS b, o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       bk AS (SELECT DISTINCT b, i FROM ln), t AS (SELECT COUNT(DISTINCT b) AS n FROM bk), c AS (SELECT i, COUNT(*) AS n FROM bk GROUP BY i),
       co AS (SELECT x.i, y.i AS other, COUNT(*) AS k FROM bk x JOIN bk y ON x.b = y.b AND x.i <> y.i GROUP BY 1, 2),
       q AS (SELECT co.i, co.other, CAST(co.k AS DOUBLE) AS p, CAST(a.n - co.k AS DOUBLE) AS q, CAST(z.n - co.k AS DOUBLE) AS r, CAST(t.n - a.n - z.n + co.k AS DOUBLE) AS s
             FROM co JOIN c a ON a.i = co.i JOIN c z ON z.i = co.other, t WHERE co.k * t.n > a.n * z.n),
       l AS (SELECT i, other, round(2 * ({_h("(p + q)", "(r + s)")} + {_h("(p + r)", "(q + s)")} - {_h("p", "q", "r", "s")}), 9) AS llr FROM q),
       pt AS (SELECT i, other FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY llr DESC, other) AS place FROM l) WHERE place <= 5)"""


@query(
    "mod_recommend_candidates",
    f"""WITH {_PARTNERS_SQL}
       SELECT DISTINCT ln.u, pt.other AS i FROM ln JOIN pt ON ln.i = pt.i WHERE NOT EXISTS (SELECT 1 FROM ln x WHERE x.u = ln.u AND x.i = pt.other)""",
)
def mod_recommend_candidates(spark, sf):
    """New parts for a customer: of every part bought, the five parts that share
    orders with it most significantly, less those the customer has."""
    lines = _orders_of_customers(spark, sf)
    return PA.new_items(lines, PA.partners(lines, top=5))


@query("mod_recommend_new_parts")
def mod_recommend_new_parts(spark, sf):
    """ALS on customer x part quantities; of the new parts that go with a
    customer's parts (at most five per part), the three of highest predicted
    rating; candidates without factors dropped (cold start)."""
    lines = _orders_of_customers(spark, sf)
    r = fixed(lines.groupBy("u", "i").agg(F.sum("l_quantity").cast("float").alias("r")), "ratings")
    als = ALS(rank=4, maxIter=5, regParam=0.1, userCol="u", itemCol="i", ratingCol="r", coldStartStrategy="drop", seed=42)
    m = als.setNumBlocks(_blocks(r.count())).fit(r)
    top = G.top_n(m.transform(PA.new_items(lines, PA.partners(lines, top=5))), ["u"], [F.desc("prediction"), F.col("i")], 3)
    return top.select("u", "i", F.col("prediction").alias("score"))


@query("mod_frequent_patterns")
def mod_frequent_patterns(spark, sf):
    """FP-growth item sets and rules over each order's line flags; PrefixSpan
    over each order's flag sequence (by line number)."""
    li = table(spark, sf, "lineitem").withColumn("item", F.concat("l_returnflag", "l_linestatus", (F.col("l_quantity") / 10).cast("int").cast("string")))
    # each order's set and sequence are made once, in one shuffle; both miners go over them several times
    orders = fixed(li.groupBy("l_orderkey").agg(
        F.collect_set("item").alias("items"),
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))), lambda s: F.array(s["l_returnflag"])).alias("seq")), "orders-of-lines")
    baskets = orders.select("l_orderkey", "items")
    fp = FPGrowth(itemsCol="items", minSupport=0.01, minConfidence=0.05).fit(baskets)
    sets = fp.freqItemsets.select(F.array_join(F.array_sort("items"), ",").alias("pattern"), F.col("freq"), F.lit("itemset").alias("kind"), F.lit(None).cast("double").alias("confidence"))
    side = lambda c: F.array_join(F.array_sort(c), ",")
    rules = fp.associationRules.select(F.concat_ws(" => ", side("antecedent"), side("consequent")).alias("pattern"), F.lit(None).cast("long").alias("freq"),
                                       F.lit("rule").alias("kind"), F.round("confidence", 8).alias("confidence"))
    seqs = orders.select("l_orderkey", "seq")
    # an order has at most seven lines, fewer than the default pattern length
    # a prefix's sequences of more than 2 million items are mined by all tasks, not by one as up to 32 million are by default
    ps = PrefixSpan(minSupport=0.1, maxLocalProjDBSize=LOCAL_ITEMS, sequenceCol="seq").findFrequentSequentialPatterns(seqs)
    pats = ps.select(F.array_join(F.transform("sequence", lambda s: F.array_join(s, "")), ">").alias("pattern"), "freq", F.lit("sequence").alias("kind"), F.lit(None).cast("double").alias("confidence"))
    return sets.unionByName(rules).unionByName(pats)


@query("mod_tune")
def mod_tune(spark, sf):
    """Cross validation and train / validation split over a parameter grid."""
    tr = _split(spark, sf)[0].select("features", "label")  # the folds are cached: only what a fit reads
    lr = C.LogisticRegression(maxIter=10, labelCol="label")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build()
    ev = BinaryClassificationEvaluator(labelCol="label")
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, numFolds=2, seed=42).fit(tr)
    tvs = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.8, seed=42).fit(tr)
    rows = [(how, float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m))
            for how, got in (("cv", cv.avgMetrics), ("tvs", tvs.validationMetrics)) for p, m in zip(grid, got)]
    return spark.createDataFrame(rows, "method string, reg double, elastic double, auc double")


@query(
    "mod_evaluate",
    """WITH d AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS p,
                         l_discount AS s, l_extendedprice / 1000 AS yr, l_quantity * 1.5 AS pr FROM lineitem),
            c AS (SELECT SUM(y * p) AS tp, SUM((1 - y) * p) AS fp, SUM(y * (1 - p)) AS fn, SUM((1 - y) * (1 - p)) AS tn FROM d),
            sc AS (SELECT s, SUM(y) AS pos, SUM(1 - y) AS neg FROM d GROUP BY s),
            cum AS (SELECT s, pos, neg, coalesce(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc),
            auc AS (SELECT SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg)) AS v FROM cum),
            reg AS (SELECT sqrt(avg((yr - pr) * (yr - pr))) AS rmse, avg(abs(yr - pr)) AS mae,
                           1 - SUM((yr - pr) * (yr - pr)) / SUM((yr - (SELECT avg(yr) FROM d)) * (yr - (SELECT avg(yr) FROM d))) AS r2 FROM d)
       SELECT 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 8) AS value FROM c
       UNION ALL SELECT 'precision', round(tp / (tp + fp), 8) FROM c
       UNION ALL SELECT 'recall', round(tp / (tp + fn), 8) FROM c
       UNION ALL SELECT 'f1', round(2 * tp / (2 * tp + fp + fn), 8) FROM c
       UNION ALL SELECT 'auc', round(v, 8) FROM auc
       UNION ALL SELECT 'rmse', round(rmse, 6) FROM reg UNION ALL SELECT 'mae', round(mae, 6) FROM reg UNION ALL SELECT 'r2', round(r2, 6) FROM reg""",
)
def mod_evaluate(spark, sf):
    """Binary, ranking (AUC) and regression metrics as plain distributed
    aggregates over (label, prediction, score)."""
    li = table(spark, sf, "lineitem")
    d = li.select((F.col("l_returnflag") == "R").cast("long").alias("y"), (F.col("l_discount") > 0.05).cast("long").alias("p"),
                  F.col("l_discount").alias("s"), (F.col("l_extendedprice") / 1000).alias("yr"), (F.col("l_quantity") * 1.5).alias("pr"))
    c = d.agg(F.sum(F.col("y") * F.col("p")).alias("tp"), F.sum((1 - F.col("y")) * F.col("p")).alias("fp"),
              F.sum(F.col("y") * (1 - F.col("p"))).alias("fn"), F.sum((1 - F.col("y")) * (1 - F.col("p"))).alias("tn"))
    # AUC (Mann-Whitney): per score value with positives, positives x (negatives
    # below + half the tied negatives). Negatives below s = rows below s minus
    # positives below s, both from the distributed global rank (no sorted window).
    sc = d.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    all_rk = O.global_rank(d.select("s"), ["s"], out="rk").groupBy("s").agg(F.min("rk").alias("ark"))
    pos_rk = O.global_rank(d.filter(F.col("y") == 1).select("s"), ["s"], out="rk").groupBy("s").agg(F.min("rk").alias("prk"))
    cum = sc.filter(F.col("pos") > 0).join(all_rk, "s").join(pos_rk, "s").withColumn("below", F.col("ark") - F.col("prk"))
    positive, negative, mean_y = d.agg(F.sum("y"), F.sum(1 - F.col("y")), F.avg("yr")).first()  # three numbers
    auc = cum.agg((F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))) / F.lit((positive or 0) * (negative or 0))).alias("v"))
    reg = d.agg(
        F.sqrt(F.avg((F.col("yr") - F.col("pr")) ** 2)).alias("rmse"), F.avg(F.abs(F.col("yr") - F.col("pr"))).alias("mae"),
        (1 - F.sum((F.col("yr") - F.col("pr")) ** 2) / F.sum((F.col("yr") - F.lit(mean_y)) ** 2)).alias("r2"))
    m8 = lambda e: F.round(e.cast("double"), 8)
    out = c.select(F.array(
        F.struct(F.lit("accuracy").alias("metric"), m8((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))).alias("value")),
        F.struct(F.lit("precision").alias("metric"), m8(F.col("tp") / (F.col("tp") + F.col("fp"))).alias("value")),
        F.struct(F.lit("recall").alias("metric"), m8(F.col("tp") / (F.col("tp") + F.col("fn"))).alias("value")),
        F.struct(F.lit("f1").alias("metric"), m8(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("value"))).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    out = out.unionByName(auc.select(F.lit("auc").alias("metric"), m8(F.col("v")).alias("value")))
    out = out.unionByName(reg.select(F.explode(F.array(F.struct(F.lit("rmse").alias("metric"), F.round("rmse", 6).alias("value")),
                                                        F.struct(F.lit("mae").alias("metric"), F.round("mae", 6).alias("value")), F.struct(F.lit("r2").alias("metric"), F.round("r2", 6).alias("value"))))).select("col.*"))
    return out


@query(
    "mod_metadata_report",
    """SELECT "column", value, cnt, rnk FROM (
         SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, COUNT(*) AS cnt, row_number() OVER (ORDER BY COUNT(*) DESC, o_orderstatus) AS rnk FROM orders GROUP BY o_orderstatus
         UNION ALL SELECT 'o_orderpriority', o_orderpriority, COUNT(*), row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) FROM orders GROUP BY o_orderpriority
         UNION ALL SELECT 'c_mktsegment', c_mktsegment, COUNT(*), row_number() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) FROM customer GROUP BY c_mktsegment)
       WHERE rnk <= 3""",
)
def mod_metadata_report(spark, sf):
    """Top-3 values per categorical column as (column, value, count, rank),
    written as JSON to the shared folder and read back."""
    parts = []
    for t, col in (("orders", "o_orderstatus"), ("orders", "o_orderpriority"), ("customer", "c_mktsegment")):
        vc = table(spark, sf, t).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("cnt")).withColumn("column", F.lit(col))
        parts.append(vc)
    allv = parts[0].unionByName(parts[1]).unionByName(parts[2])
    from pyspark.sql import Window

    ranked = allv.withColumn("rnk", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("cnt"), "value")).cast("long")).filter(F.col("rnk") <= 3)
    path = scratch_path(spark, "metadata-report")
    ranked.write.mode("overwrite").json(path)
    return spark.read.schema("column string, value string, cnt long, rnk long").json(path)


@query(
    "stat_tests",
    """WITH ct AS (SELECT l_returnflag AS a, l_linestatus AS b, COUNT(*) AS o FROM lineitem GROUP BY 1, 2),
            ra AS (SELECT a, SUM(o) AS na FROM ct GROUP BY a), rb AS (SELECT b, SUM(o) AS nb FROM ct GROUP BY b),
            n AS (SELECT SUM(o) AS n FROM ct),
            full_ AS (SELECT ra.a, rb.b, coalesce(ct.o, 0) AS o, ra.na * rb.nb / n.n AS e FROM ra, rb, n LEFT JOIN ct ON ct.a = ra.a AND ct.b = rb.b)
       SELECT 'chi2_flag_status' AS stat, round(SUM((o - e) * (o - e) / e), 6) AS value FROM full_
       UNION ALL SELECT 'chi2_dof', CAST(((SELECT COUNT(*) FROM ra) - 1) * ((SELECT COUNT(*) FROM rb) - 1) AS DOUBLE)
       UNION ALL SELECT 'mean_quantity', round(avg(l_quantity), 6) FROM lineitem
       UNION ALL SELECT 'var_quantity', round(var_samp(l_quantity), 6) FROM lineitem
       UNION ALL SELECT 'l2_discount', round(sqrt(SUM(l_discount * l_discount)), 6) FROM lineitem
       UNION ALL SELECT 'nnz_discount', CAST(COUNT(*) FILTER (WHERE l_discount <> 0) AS DOUBLE) FROM lineitem""",
)
def stat_tests(spark, sf):
    """Chi-square independence (statistic, dof) from the contingency table as
    aggregates; column summary (mean, variance, L2 norm, non-zeros) by Summarizer."""
    li = table(spark, sf, "lineitem")
    ct = li.groupBy(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").alias("o"))
    ra, rb = ct.groupBy("a").agg(F.sum("o").alias("na")), ct.groupBy("b").agg(F.sum("o").alias("nb"))
    # chi2 = n * (sum over observed cells of o^2 / (na * nb) - 1): empty cells need no row
    share = F.sum(F.col("o") * F.col("o") / (F.col("na") * F.col("nb")))
    both = ct.join(ra, "a").join(rb, "b").agg(
        (F.sum("o") * (share - 1)).alias("chi2"), ((F.count_distinct("a") - 1) * (F.count_distinct("b") - 1)).cast("double").alias("dof"))
    chi = both.select(F.explode(F.array(
        F.struct(F.lit("chi2_flag_status").alias("stat"), F.round("chi2", 6).alias("value")),
        F.struct(F.lit("chi2_dof").alias("stat"), F.col("dof").alias("value")))).alias("x")).select("x.*")
    v = MF.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="f").transform(li)
    sm = v.select(Summarizer.metrics("mean", "variance", "normL2", "numNonZeros").summary(F.col("f")).alias("s")).select(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"), vector_to_array("s.normL2").alias("l2"),
        vector_to_array("s.numNonZeros").alias("nnz"))
    summ = sm.select(F.explode(F.array(
        F.struct(F.lit("mean_quantity").alias("stat"), F.round(F.col("mean")[0], 6).alias("value")),
        F.struct(F.lit("var_quantity").alias("stat"), F.round(F.col("var")[0], 6).alias("value")), F.struct(F.lit("l2_discount").alias("stat"), F.round(F.col("l2")[1], 6).alias("value")),
        F.struct(F.lit("nnz_discount").alias("stat"), F.col("nnz")[1].alias("value")))).alias("x")).select("x.*")
    return chi.unionByName(summ)


_COS_T = 0.1


@query(
    "stat_cosine_pairs",
    f"""WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(64)) AS j FROM embeddings),
            nrm AS (SELECT j, sqrt(SUM(v * v)) AS n FROM x GROUP BY j),
            dots AS (SELECT a.j AS i, b.j AS k, SUM(a.v * b.v) AS d FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.j < b.j GROUP BY 1, 2)
       SELECT CAST(i AS INTEGER) AS i, CAST(k AS INTEGER) AS k, round(d / (na.n * nb.n), 6) AS cosine
       FROM dots JOIN nrm na ON na.j = dots.i JOIN nrm nb ON nb.j = dots.k WHERE d / (na.n * nb.n) > {_COS_T}""",
)
def stat_cosine_pairs(spark, sf):
    """All column pairs of the 64-dim embeddings with cosine above 0.1.

    The rows are unioned with their negations: the column means become zero,
    so the Pearson correlation matrix of that union equals the cosine
    similarity of the original columns. ``Correlation.corr`` computes it as
    one JVM tree-aggregate (a d x d result set by the dimension, not the data);
    no Python runs per row and no (row, column, column) triples are emitted."""
    from pyspark.ml.stat import Correlation

    e = table(spark, sf, "embeddings").select("embedding")
    both = e.select(array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v")).unionByName(
        e.select(array_to_vector(F.transform("embedding", lambda v: -v.cast("double"))).alias("v")))
    cells = M.entries(Correlation.corr(both, "v", "pearson").first()[0].toArray(), e)
    return cells.where((F.col("i") < F.col("j")) & (F.col("v") > _COS_T)).select("i", F.col("j").alias("k"), F.round("v", 6).alias("cosine"))


_KDE_POINTS = list(range(0, 55, 5))


@query(
    "stat_kde",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {p}.0 AS point, round(avg(exp(-(l_quantity - {p}) * (l_quantity - {p}) / 8.0)) / (2.0 * sqrt(2 * pi())), 8) AS density FROM lineitem"
        for p in _KDE_POINTS) + ")",
)
def stat_kde(spark, sf):
    """Gaussian kernel density (bandwidth 2) of quantity at 11 points: one
    aggregate with one average per point, then unpivoted (no cross join)."""
    li = table(spark, sf, "lineitem")
    h = 2.0
    aggs = [F.round(F.avg(F.exp(-((F.col("l_quantity") - p) ** 2) / (2 * h * h))) / (h * math.sqrt(2 * math.pi)), 8).alias(f"p{p}")
            for p in _KDE_POINTS]
    row = li.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(F.lit(float(p)).alias("point"), F.col(f"p{p}").alias("density")) for p in _KDE_POINTS])).alias("x")).select("x.*")


@query(
    "stat_distributed_matrix",
    """WITH a AS (SELECT l_suppkey AS i, l_linenumber AS j, SUM(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
            b AS (SELECT l_linenumber AS j, l_returnflag AS k, avg(l_discount) AS v FROM lineitem GROUP BY 1, 2)
       SELECT a.i, b.k, round(SUM(a.v * b.v), 6) AS v FROM a JOIN b ON a.j = b.j GROUP BY a.i, b.k""",
)
def stat_distributed_matrix(spark, sf):
    """Coordinate matrices (i, j, v): C = A x B as a join on the inner index
    and a sum of products. B is tiny here (line number x flag) and is
    broadcast after a size check; a large B would shuffle."""
    from dataloom.operators.joins import checked_broadcast

    li = table(spark, sf, "lineitem")
    a = li.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").alias("j")).agg(F.sum("l_quantity").alias("va"))
    b = li.groupBy(F.col("l_linenumber").alias("j"), F.col("l_returnflag").alias("k")).agg(F.avg("l_discount").alias("vb"))
    c = a.join(checked_broadcast(b), "j").groupBy("i", "k").agg(F.round(F.sum(F.col("va") * F.col("vb")), 6).alias("v"))
    return c
