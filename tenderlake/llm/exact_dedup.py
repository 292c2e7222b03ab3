"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes.

Texts are equal when identical after each run of ASCII white space became one
space.  The aggregation is partitioned by the 128-bit hash of the normalised
text, and its key also holds the text itself, so that the bytes are compared
inside each hash group and colliding texts stay apart.  Map-side combining
leaves one row per distinct text and task, however many copies there are.  A
narrow table of (row, hash, digest) then takes each document to its group; no
text moves in that join, and AQE splits a hot hash in it.

Defined results: null text counts as empty (all null, empty and missing texts
form one group; a text of white space only is one space, another group).  A null
doc_id is larger than every other: ``keep_id`` is null only if every id of
the group is null.  Rows repeated with one doc_id are in the same group; each is
returned, and each of them is kept when its id is the smallest.  Empty
table: empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, text_or_empty, written


def normalised(name: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(name), f"[{SPACE}]+", " ")


def md5_bytes(text: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_bytes) -> DataFrame:
    """(content_hash, text_sha256, keep_id, group_size): a row for each distinct normalised text."""
    texts = docs.select(F.col("doc_id"), normalised().alias("norm"))
    return (texts.withColumn("content_hash", content_hash(F.col("norm")))
            .groupBy("content_hash", "norm")
            .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("content_hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_bytes) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = (docs.select(F.col("doc_id"), normalised().alias("norm"))
            .select("doc_id", content_hash(F.col("norm")).alias("content_hash"), F.sha2("norm", 256).alias("text_sha256")))
    return (keys.join(exact_groups(docs, content_hash), ["content_hash", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without later copies, with all its columns; of rows that agree in
    doc_id and text, one stays."""
    judged = written(exact_dedup(docs).select("doc_id", "kept", F.col("text_sha256").alias("__sha")), "exact")
    rows = judged.groupBy("doc_id", "__sha").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    # What goes, and what stands there more than once: short lists beside the documents.
    special = written(rows.filter("not kept or n > 1").select(F.col("doc_id").alias("__id"), F.col("__sha").alias("__key"), "kept"), "copies")
    marked = docs.withColumn("__sha", F.sha2(normalised(), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__key"))
    single = marked.join(special.drop("kept"), same, "left_anti")
    repeated = marked.join(special.filter("kept").drop("kept"), same, "left_semi").dropDuplicates(["doc_id", "__sha"])
    return single.unionByName(repeated).drop("__sha")
