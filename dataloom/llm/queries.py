"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from dataloom.llm import fim, itq, langid, lexicon, online, packing, sanitise, simhash, suffix, topk, toxic, turns, warczip
from dataloom.llm.common import held_out
from dataloom.session import table


def op1_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label among all embeddings, cosine 0.98 or more."""
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every hundredth vector against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents: 3-word shingles, at most 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded through the word transducer and decoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    out = lexicon.decode(lexicon.encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after removing every repeated run of 35 words."""
    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(suffix.kept_words("text"), 256).alias("kept_sha256"))


def op7_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written into ZIP packages and read back by range."""
    out = warczip.round_trip(table(spark, sf_dir, "pages"), least=100)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_information_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it, in all documents."""
    found = sanitise.find(table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in sanitise.KINDS]
    return found.select("doc_id", *counts, F.sha2(sanitise.joined(sanitise.KINDS), 256).alias("base_sha256"),
                        sanitise.joined((*sanitise.KINDS, "term")).alias("spans"))


def op9_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = toxic.score(docs, toxic.learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from the ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), langid.learn_from_training_rows(docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of all conversations after known damage."""
    rows = table(spark, sf_dir, "conversations")
    return turns.repair_conversations(rows, turns.damage(rows))


def op12_sparse_index_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed for filling in the middle, and restored from that."""
    out = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


def op13_online_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed online into sequences of at most 1024 tokens, none of them padded."""
    return online.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)


QUERIES = {f.__name__: f for f in (op1_itq_near_dedup, op2_uniform_threshold_topk, op3_sum_of_squares_packing, op4_simhash_trie, op5_transducer_bpe,
                                   op6_suffix_dedup,
                                   op7_zip_warc, op8_information_pii, op9_crf_toxicity, op10_rank_order_langid, op11_run_length_repair,
                                   op12_sparse_index_fim, op13_online_sum_of_squares)}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op12_sparse_index_fim": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
             k AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
                          CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
                          CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
             c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
                          CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                               WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
             p AS (SELECT *, substring(t, 1, x) AS pre, substring(t, x + 1, y - x) AS mid, substring(t, y + 1, n - y) AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
        FROM p""",
    "op7_zip_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
}
