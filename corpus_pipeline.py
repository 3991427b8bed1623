"""The document pipeline: language ID, near-duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows its predecessor kept and all but the last return the columns of ``docs``.
Null texts are empty texts, repeated rows are documents of their own (of which
the second stage keeps one), an empty table passes through, and columns beyond
doc_id, text and lang ride along whatever they are called.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataloom.llm import langid, packing, sanitise, simhash, suffix
from dataloom.llm.common import materialize, named, prepare, spare
from dataloom.session import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; those without a letter (``und``) go."""
    prepare(spark)
    lang, score = spare(docs.columns, "lang_pred"), spare(docs.columns, "score")
    judged = langid.identify(docs, langid.learn_from_training_rows(docs), out=(lang, score))
    return judged.where(named(lang) != "und").select(*map(named, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document of the smallest id (of equal ids, one row)."""
    prepare(spark)
    found = simhash.near_duplicates(docs, "doc_id", "text", shingle=3, max_bits=3)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key"))
    key = spare(docs.columns, "kept row")
    kept = found.groupBy("component_fp").agg(first.alias("first")).select(F.col("first.row_key").alias(key))
    kept = materialize(kept.distinct(), "kept-documents")
    keyed = docs.withColumn(key, simhash.row_key("doc_id", "text"))
    # the join deals both sides by the key, so the rows of one key lie together already
    return keyed.join(kept.hint("merge"), key, "left_semi").dropDuplicates([key]).select(*map(named, docs.columns))


def _with_text(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from a result with doc_id, text and the others in ``rest``; n_chars follows the text."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    kind = dict(docs.dtypes).get("n_chars")
    if kind in ("int", "bigint"):
        own["n_chars"] = F.length("text").cast(kind)
    return result.select(*[own[c].alias(c) if c in own else F.col("rest").getField(c).alias(c) for c in docs.columns])


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of runs of 35 words that stand anywhere else as well."""
    return _with_text(suffix.remove_repeats(docs, "doc_id", "text", window=35, carry=_others(docs)), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data removed and the terms that reveal it generalised."""
    return _with_text(sanitise.clean(sanitise.find(docs, "doc_id", "text", carry=_others(docs))), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("pii", personal_data),
    ("best_fit_packing", packing_stage),
]

#: No stage but the fourth is within SQL's reach; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
