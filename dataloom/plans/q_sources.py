"""§2.1 sources and sinks: write a table derived from the given ones to the
shared scratch folder through the connector under test, read it back, and
compare with the same rows computed straight from the tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataloom.plans.fixtures import ACCESS_LOG_SQL, CUSTOMER_NULLS_SQL, access_log, customer_nulls, with_ctes
from dataloom.plans.registry import query
from dataloom.session import scratch_path, table
from dataloom.sources import io as IO

_NAME_ML = "CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || chr(10) || c_mktsegment WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name || ' \"q\"|x' ELSE c_name END"


@query("src_csv", f"SELECT c_custkey, {_NAME_ML} AS name, c_acctbal FROM customer")
def src_csv(spark, sf):
    """Delimited text with header, Excel-style quoting (doubled quotes), a
    multi-line field and a delimiter inside quotes; read with a fixed schema."""
    c = table(spark, sf, "customer").select("c_custkey", F.expr(_NAME_ML.replace('\\"', '"')).alias("name"), "c_acctbal")
    path = scratch_path(spark, "csv")
    IO.write(c, path, "csv", "overwrite", header=True, sep="|", quote='"', escape='"')
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    return IO.read(spark, path, "csv", schema=schema, header=True, sep="|", quote='"', escape='"', multiLine=True)


@query("src_csv_dropmalformed", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def src_csv_dropmalformed(spark, sf):
    """CSV read that drops rows not matching the schema (price text 'bad')."""
    o = table(spark, sf, "orders")
    lines = o.select(F.concat_ws(",", F.col("o_orderkey").cast("string"),
                                 F.when(F.col("o_orderstatus") == "P", F.lit("bad")).otherwise(F.col("o_totalprice").cast("string"))).alias("value"))
    path = scratch_path(spark, "csv-bad")
    lines.write.mode("overwrite").text(path)
    schema = "o_orderkey LONG, o_totalprice DOUBLE"
    return IO.read(spark, path, "csv", schema=schema, mode="DROPMALFORMED")


@query("src_text", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text(spark, sf):
    """Text source: one row per line of the whole documents."""
    d = table(spark, sf, "documents").select(F.col("text").alias("value"))
    path = scratch_path(spark, "text")
    d.write.mode("overwrite").text(path)
    return spark.read.option("lineSep", "\n").text(path)


@query(
    "src_json",
    """SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id AS first_elem
       FROM events""",
)
def src_json(spark, sf):
    """JSON lines with a nested object, a map and an array; schema given on read."""
    e = table(spark, sf, "events")
    nested = e.select(
        "event_id", "ts", F.struct("event_type", "value").alias("info"),
        F.from_json("props", "map<string,int>").alias("props_map"), F.array("user_id", "event_id").alias("arr"))
    path = scratch_path(spark, "json")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    nested.write.mode("overwrite").option("timestampNTZFormat", fmt).json(path)
    back = spark.read.schema(nested.schema).option("timestampNTZFormat", fmt).json(path)
    return back.select("event_id", "ts", "info.event_type", "info.value", F.col("props_map")["k"].alias("k"),
                       F.element_at("arr", 1).alias("first_elem"))


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40")
def src_parquet(spark, sf):
    """Parquet round trip; the filter and the column list reach the scan."""
    path = scratch_path(spark, "parquet")
    table(spark, sf, "lineitem").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).filter(F.col("l_quantity") > 40).select("l_orderkey", "l_linenumber", "l_quantity")


@query("src_orc", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.08")
def src_orc(spark, sf):
    """ORC with zlib compression and search-argument pushdown."""
    path = scratch_path(spark, "orc")
    table(spark, sf, "lineitem").write.mode("overwrite").option("compression", "zlib").orc(path)
    return spark.read.orc(path).filter(F.col("l_discount") >= 0.08).select("l_orderkey", "l_linenumber", "l_discount")


@query("src_sequencefile", """SELECT CAST(c_custkey AS VARCHAR) AS "key", c_name AS value FROM customer""")
def src_sequencefile(spark, sf):
    """Hadoop sequence files of (key, value) text pairs, written and read back."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "seq")
    c.rdd.map(lambda r: (str(r[0]), r[1])).saveAsSequenceFile(path)
    return spark.sparkContext.sequenceFile(path).toDF(["key", "value"])


_FW = {"c_custkey": 8, "name": 20, "nation": 3, "bal": 10}


@query("src_fixed_width", with_ctes(CUSTOMER_NULLS_SQL, body="SELECT c_custkey, name, nation, bal FROM customer_nulls"))
def src_fixed_width(spark, sf):
    """Fixed-width text: written with padding (nulls become spaces), read back
    by cut-style ranges '1-8, 9-28, 29-31, 32-'."""
    c = customer_nulls(spark, sf)
    path = scratch_path(spark, "fixed")
    IO.to_fixed_width(c, _FW).write.mode("overwrite").text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("nation", T.IntegerType()), T.StructField("bal", T.DoubleType())])
    return IO.read_fixed_width(spark, path, "1-8, 9-28, 29-31, 32-", schema)


_RE_SQL = IO.COMBINED_LOG


@query(
    "src_regex_log",
    with_ctes(
        ACCESS_LOG_SQL,
        body=f"""SELECT regexp_extract(value, '{_RE_SQL}', 1) AS remote_addr, regexp_extract(value, '{_RE_SQL}', 3) AS "user",
                        regexp_extract(value, '{_RE_SQL}', 4) AS time, regexp_extract(value, '{_RE_SQL}', 5) AS method,
                        regexp_extract(value, '{_RE_SQL}', 6) AS request, regexp_extract(value, '{_RE_SQL}', 8) AS status,
                        regexp_extract(value, '{_RE_SQL}', 9) AS bytes, regexp_extract(value, '" [0-9]{{3}} [^ ]+ "([^"]*)"', 1) AS referer
                 FROM access_log WHERE NOT regexp_matches(value, '" 500 ')""",
    ),
)
def src_regex_log(spark, sf):
    """Combined-format access log read by capture groups; lines of server
    errors are garbled first and land in the reject set."""
    lines = access_log(spark, sf)
    lines = lines.select(F.when(F.col("value").rlike('" 500 '), F.concat(F.lit("junk "), F.col("value"))).otherwise(F.col("value")).alias("value"))
    path = scratch_path(spark, "logs")
    lines.write.mode("overwrite").text(path)
    parsed, _rejected = IO.read_regex(spark, path, IO.COMBINED_LOG, IO.COMBINED_FIELDS)
    return parsed.select("remote_addr", "user", "time", "method", "request", "status", "bytes", "referer")


@query("src_xml_records", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def src_xml_records(spark, sf):
    """XML: one row per <order> element (rowTag), typed by a given schema."""
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    path = scratch_path(spark, "xml")
    rows.write.format("xml").option("rootTag", "orders").option("rowTag", "order").mode("overwrite").save(path)
    schema = "id LONG, status STRING, price DOUBLE"
    return spark.read.format("xml").option("rowTag", "order").schema(schema).load(path)


@query(
    "src_multi_format",
    """SELECT c_custkey AS "key", c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
       UNION ALL SELECT n_nationkey, n_name FROM nation""",
)
def src_multi_format(spark, sf):
    """Folder of CSV, JSON and Parquet files: reader chosen by extension, unioned by name."""
    base = scratch_path(spark, "multi")
    table(spark, sf, "customer").select("c_custkey", "c_name").write.option("header", True).csv(f"{base}/a")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.json(f"{base}/b")
    table(spark, sf, "nation").select("n_nationkey", "n_name").write.parquet(f"{base}/c")
    u = IO.read_multi_format(spark, base)
    return u.select(F.coalesce("c_custkey", "s_suppkey", "n_nationkey").cast("long").alias("key"),
                    F.coalesce("c_name", "s_name", "n_name").alias("name"))


@query("src_partitioned_read", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def src_partitioned_read(spark, sf):
    """key=value folders; the filter on the partition column prunes folders
    (PartitionFilters in the scan), the other partitions are never opened."""
    path = scratch_path(spark, "by-status")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return spark.read.parquet(path).filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "src_binary_image",
    """SELECT CAST(SUM(octet_length(encode(p_name)) + 1) AS BIGINT) AS length, CAST(SUM(octet_length(encode(p_name)) + 1) AS BIGINT) AS content_bytes,
              COUNT(*) AS lines, true AS dated FROM part""",
)
def src_binary_image(spark, sf):
    """Whole files as rows (path, modification time, length, content); the contents hold every line."""
    path = scratch_path(spark, "bin")
    table(spark, sf, "part").select("p_name").write.text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    text = F.col("content").cast("string")
    return files.agg(
        F.sum("length").alias("length"), F.sum(F.octet_length("content")).alias("content_bytes"),
        F.sum(F.size(F.split(text, "\n")) - 1).alias("lines"), F.every(F.col("modificationTime").isNotNull()).alias("dated"))


@query("src_whole_text", "SELECT CAST(SUM(length(text) + 1) AS BIGINT) AS n_chars, COUNT(*) AS n_docs FROM documents")
def src_whole_text(spark, sf):
    """One row per file (wholetext): the files together hold every document."""
    d = table(spark, sf, "documents").select("text")
    path = scratch_path(spark, "whole")
    # files of about 32 MB by the bytes of the texts (a file is read whole); a document ends with a mark that no text holds
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    d.repartition(max(4, -(-size >> 25))).write.option("lineSep", "\u0001").text(path)
    files = spark.read.text(path, wholetext=True)
    return files.agg(F.sum(F.length("value")).cast("long").alias("n_chars"),
                     F.sum(F.size(F.split("value", "\u0001")) - 1).cast("long").alias("n_docs"))


@query("src_hadoop_formats", "SELECT n_name AS line, true AS placed FROM nation")
def src_hadoop_formats(spark, sf):
    """A Hadoop input format by class name: (byte offset, line) pairs."""
    path = scratch_path(spark, "hadoop")
    table(spark, sf, "nation").select("n_name").write.text(path)
    rdd = spark.sparkContext.newAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    return rdd.toDF(["offset", "line"]).select("line", (F.col("offset") >= 0).alias("placed"))


@query(
    "src_hadoop_records",
    """SELECT 'fixed length' AS format, l_orderkey AS orderkey, l_linenumber AS linenumber, CAST(round(l_quantity * 100) AS BIGINT) AS hundredths FROM lineitem
       UNION ALL SELECT 'key and value', l_orderkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT) FROM lineitem""",
)
def src_hadoop_records(spark, sf):
    """Lines saved through two Hadoop output formats and read back through input
    formats by class name: records of a fixed length without separators, cut out
    by that length and decoded by Spark; and a sequence file of texts."""
    li = table(spark, sf, "lineitem")
    hundredths = F.round(F.col("l_quantity") * 100).cast("long")
    numbers = li.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").cast("long").alias("linenumber"), hundredths.alias("hundredths"))
    records = IO.write_fixed_records(numbers, scratch_path(spark, "hadoop-records"), {"orderkey": 20, "linenumber": 11, "hundredths": 20})
    fixed = IO.read_fixed_records(spark, records, {"orderkey": 20, "linenumber": 11, "hundredths": 20})
    pairs = IO.write_hadoop_pairs(numbers.select("orderkey", F.concat_ws(",", "linenumber", "hundredths").alias("value")), scratch_path(spark, "hadoop-pairs"))
    back = IO.read_hadoop_pairs(spark, pairs).select(F.col("key").cast("long").alias("orderkey"), F.split("value", ",").alias("p"))
    back = back.select("orderkey", F.col("p")[0].cast("long").alias("linenumber"), F.col("p")[1].cast("long").alias("hundredths"))
    read = fixed.select(*[F.col(c).cast("long").alias(c) for c in ("orderkey", "linenumber", "hundredths")])
    return read.withColumn("format", F.lit("fixed length")).unionByName(back.withColumn("format", F.lit("key and value")))


@query("src_libsvm", "SELECT CAST(label AS DOUBLE) AS label, len(list_filter(embedding, lambda x: x <> 0)) AS n_features FROM embeddings")
def src_libsvm(spark, sf):
    """Sparse label + index:value text read by the libsvm source (64 features)."""
    e = table(spark, sf, "embeddings")
    lines = e.select(F.concat_ws(" ", F.col("label").cast("string"),
                                 F.array_join(F.transform("embedding", lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x.cast("string"))), " ")).alias("value"))
    path = scratch_path(spark, "libsvm")
    lines.write.text(path)
    back = spark.read.format("libsvm").option("numFeatures", "64").load(path)
    return back.select("label", F.size(F.filter(vector_to_array("features"), lambda x: x != 0)).cast("long").alias("n_features"))


@query(
    "src_generic_options",
    """SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'""",
)
def src_generic_options(spark, sf):
    """format / options / load: glob filter, recursive lookup and schema merge
    over two Parquet sets with different columns (plus a stray text file)."""
    base = scratch_path(spark, "generic")
    o = table(spark, sf, "orders")
    o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice").write.format("parquet").save(f"{base}/x/a")
    o.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderpriority").write.format("parquet").save(f"{base}/y/b")
    o.select("o_orderstatus").limit(10).write.format("text").save(f"{base}/notes")
    df = spark.read.format("parquet").options(pathGlobFilter="*.parquet", recursiveFileLookup="true", mergeSchema="true").load(base)
    return df.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "sink_text_csv_out",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT 'c_custkey|name|nation' AS value UNION ALL
                SELECT CAST(c_custkey AS VARCHAR) || '|' || coalesce(name, 'NA') || '|' || coalesce(CAST(nation AS VARCHAR), 'NA') FROM customer_nulls""",
    ),
)
def sink_text_csv_out(spark, sf):
    """CSV out with a null marker and gzip in as many files as tasks, and one header
    in a file of its own; read back as raw lines."""
    c = customer_nulls(spark, sf).select("c_custkey", "name", "nation")
    path = scratch_path(spark, "csv-out")
    out = lambda df: df.write.mode("append").option("sep", "|").option("nullValue", "NA").option("compression", "gzip")
    out(c).csv(path)
    out(spark.range(1).select(F.lit("|".join(c.columns)).alias("value"))).text(path)
    return spark.read.text(path)


_STATUS = [("F", "finished"), ("O", "open"), ("P", "partial")]


@query(
    "src_range_memory",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_name,
              o_custkey < (SELECT COUNT(*) FROM customer) AS in_range
       FROM orders""",
)
def src_range_memory(spark, sf):
    """spark.range over [0, customer count) and an in-memory dimension table
    (createDataFrame with a schema, broadcast: three rows)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ids = spark.range(0, table(spark, sf, "customer").count()).withColumnRenamed("id", "rid")
    dim = spark.createDataFrame(_STATUS, "o_orderstatus string, status_name string")
    j = o.join(F.broadcast(dim), "o_orderstatus", "left").join(ids, o.o_custkey == ids.rid, "left")
    return j.select("o_orderkey", "status_name", F.col("rid").isNotNull().alias("in_range"))


@query("src_with_filename", "SELECT c_custkey, 'customer.parquet' AS file_name FROM customer")
def src_with_filename(spark, sf):
    """Source file name on each row (hidden _metadata column)."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", IO.file_name().alias("file_name"))


@query("src_schema_sidecar", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_schema_sidecar(spark, sf):
    """Store with a schema side file; load without spelling the schema."""
    path = scratch_path(spark, "sidecar")
    IO.write_with_schema(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "csv")
    return IO.read_with_schema(spark, path, "csv")


@query(
    "sink_partitioned",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def sink_partitioned(spark, sf):
    """MultiStorage: folders by column values, snappy; read back per folder."""
    path = scratch_path(spark, "multistore")
    IO.write(table(spark, sf, "lineitem"), path, "parquet", "overwrite", partition_by=["l_returnflag", "l_linestatus"], compression="snappy")
    back = spark.read.parquet(path)
    return back.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query(
    "sink_bucketed_table",
    "SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey",
)
def sink_bucketed_table(spark, sf):
    """Both sides bucketed and sorted on the key: the join reads without Exchange."""
    from dataloom.plans.q_groups import _bucketed

    o = _bucketed(spark, table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "bk_orders", "o_orderkey")
    li = _bucketed(spark, table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "bk_lines", "l_orderkey")
    return o.join(li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "o_orderdate", "l_linenumber")


@query(
    "sink_modes",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE (o_orderstatus IN ('F', 'O') AND o_orderpriority <> '1-URGENT') OR o_orderpriority = '1-URGENT'""",
)
def sink_modes(spark, sf):
    """Save modes in sequence: error (new), append, ignore (no-op on an existing
    path), then dynamic partition overwrite of one priority folder."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "modes")
    w = lambda df, mode: df.write.mode(mode).partitionBy("o_orderpriority")
    w(o.filter(F.col("o_orderstatus") == "F"), "error").parquet(path)
    w(o.filter(F.col("o_orderstatus") == "O"), "append").parquet(path)
    w(o.filter(F.col("o_orderstatus") == "P"), "ignore").parquet(path)
    w(o.filter(F.col("o_orderpriority") == "1-URGENT"), "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "sink_single_sample_csv",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def sink_single_sample_csv(spark, sf):
    """Top-100 rows by score written as ONE CSV file with a header."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "sample-csv")
    o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).coalesce(1).write.option("header", True).csv(path)
    return spark.read.schema("o_orderkey LONG, o_totalprice DOUBLE").option("header", True).csv(path)


@query(
    "sink_column_index",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey BETWEEN 1000 AND 1100",
)
def sink_column_index(spark, sf):
    """Key-sorted Parquet (range-partitioned, sorted inside files): a key lookup
    skips row groups by their min / max statistics instead of a full scan."""
    path = scratch_path(spark, "indexed")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    li.repartitionByRange("l_orderkey").sortWithinPartitions("l_orderkey").write.option("parquet.block.size", 1 << 20).parquet(path)
    return spark.read.parquet(path).filter(F.col("l_orderkey").between(1000, 1100))


@query(
    "sink_lines_pickle_seq",
    """SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS v, 'text' AS src FROM nation
       UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name, 'pickle' FROM nation""",
)
def sink_lines_pickle_seq(spark, sf):
    """Rows saved as text lines and as pickled objects, both read back."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    tpath, ppath = scratch_path(spark, "lines"), scratch_path(spark, "pickle")
    n.select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name").alias("value")).write.text(tpath)
    n.rdd.map(tuple).saveAsPickleFile(ppath)
    lines = spark.read.text(tpath).select(F.split("value", "\t").getItem(0).cast("long").alias("k"), F.split("value", "\t").getItem(1).alias("v"))
    pick = spark.sparkContext.pickleFile(ppath).toDF(["k", "v"])
    return lines.withColumn("src", F.lit("text")).unionByName(pick.withColumn("src", F.lit("pickle")))


@query("catalog_tables", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def catalog_tables(spark, sf):
    """Temp / global views, an external table in the shared folder, listing,
    caching, refresh and existence checks; the table's rows come back."""
    c = table(spark, sf, "customer")
    c.createOrReplaceTempView("customer_v")
    c.createOrReplaceGlobalTempView("customer_g")
    path = scratch_path(spark, "catalog")
    name = f"customer_ext_{path.rsplit('-', 1)[-1]}"
    c.write.option("path", path).saveAsTable(name)
    assert spark.catalog.tableExists(name) and "c_custkey" in [col.name for col in spark.catalog.listColumns(name)]
    spark.catalog.cacheTable(name)
    spark.catalog.refreshTable(name)
    names = {t.name for t in spark.catalog.listTables()}
    assert "customer_v" in names
    spark.catalog.uncacheTable(name)
    return spark.table(name).join(spark.table("global_temp.customer_g").select("c_custkey"), "c_custkey")


@query(
    "sql_text_entry",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
)
def sql_text_entry(spark, sf):
    """SQL text with named parameters over a registered view."""
    table(spark, sf, "orders").createOrReplaceTempView("orders_sql")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders_sql WHERE o_totalprice > :minp AND o_orderstatus = :st",
                     args={"minp": 100000, "st": "F"})
