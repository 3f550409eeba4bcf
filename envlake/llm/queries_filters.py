"""Queries of the operators that judge single documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.common import documents
from envlake.llm.language_id import identify_language, train_languages
from envlake.llm.quality_rules import EDGE, STOP_WORDS, quality_rules
from envlake.llm.toxicity import labelled_texts, score_toxicity, train_toxicity


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    judged = quality_rules(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{n}" for n in names])


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train_languages(docs.where(~held_out).select("text", "lang"))
    found = identify_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train_toxicity(labelled_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score_toxicity(docs, model).select(
        "doc_id", (remainder == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_EDGE = EDGE.replace("'", "''")
_WORD = r"[^\x20\x09-\x0D]"

QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT *, regexp_extract_all(text, '{_WORD}+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ln
  FROM d),
p AS (
  SELECT r, g.i, list_slice(w, g.i, g.i + 4) AS win
  FROM t, LATERAL (SELECT unnest(generate_series(1, len(w) - 4)) AS i) g),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM p) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(ln) AS n_lines,
         (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: trim(lower(x), '{_EDGE}') IN ({_STOP}))) AS stops,
         len(list_filter(w, lambda x: NOT regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) AS signs
  FROM t LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 16 AND n_symbols / n_words <= 0.25
       AND (stops + 1) / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.4 AND signs / n_words <= 0.3 AS kept
FROM b
"""

QUERIES = {
    "op7_quality_rules": quality_rules_query,
    "op8_language_id": language_query,
    "op9_toxicity": toxicity_query,
}
SQL = {"op7_quality_rules": QUALITY_SQL}
