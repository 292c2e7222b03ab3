"""One query per operator, each over its whole table, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, exact_dedup, fingerprints, language_model, near_dedup, packing, quality, ranked_search, substrings, url_filter,
               warc, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is, by the package that holds them."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(turns.unionByName(more))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"), width=2)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(_table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_digests(_table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL_OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
own AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l'))
    + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')) + 14 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM own GROUP BY conv_id
"""

SQL_OP7 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


SQL_OP11 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
g AS (SELECT payload, min(page_id) AS keep_id FROM p GROUP BY payload),
r AS (SELECT p.page_id, p.payload, CASE WHEN g.keep_id <> p.page_id OR p.page_id IS NULL THEN g.keep_id END AS refers_to
      FROM p JOIN g ON p.payload = g.payload),
h AS (SELECT *, sha1(payload) AS hex FROM r)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)
    for i in range(32)], '') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM h
"""

SQL_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (
  SELECT row_number() OVER () AS row_id, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
sizes AS (SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
tf AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d) GROUP BY row_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
m AS (SELECT row_id, doc_id, 100 - 50 + ((50 * n * docs) // words) AS m FROM sizes, total),
scored AS (
  SELECT i.row_id AS item, i.item_id, m.doc_id, m.row_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
  FROM (SELECT row_id, item_id, unnest(terms) AS term FROM q) i JOIN tf ON tf.term = i.term JOIN w ON w.term = i.term JOIN m ON m.row_id = tf.row_id
  GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_chat_formatting, op3_packing, op4_substring_dedup, op5_url_filters, op6_quality, op7_exact_dedup, op8_near_dedup, op9_fingerprints, op10_lm_scoring,
                                   op11_warc, op12_whitening, op13_ranked_search)}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": SQL_OP2, "op7_exact_dedup": SQL_OP7, "op11_warc": SQL_OP11, "op13_ranked_search": SQL_OP13}
