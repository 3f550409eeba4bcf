"""Queries of the operators that compare documents with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.common import documents
from envlake.llm.exact_dedup import exact_dedup
from envlake.llm.jaccard_join import jaccard_classes
from envlake.llm.line_dedup import line_dedup


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return jaccard_classes(rows).select("doc_id", "class_id", "n_links")


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    body = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"),
        F.char_length(body).cast("long").alias("n_chars"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
k AS (
  SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM k
"""

QUERIES = {
    "op1_jaccard_join": jaccard_query,
    "op4_line_dedup": line_dedup_query,
    "op6_exact_dedup": exact_dedup_query,
}
SQL = {"op6_exact_dedup": EXACT_SQL}
