"""Queries of the searches over vectors, and of the phrases of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.collocations import collocations
from envlake.llm.common import documents
from envlake.llm.hard_negatives import hard_negatives
from envlake.llm.maxscore import top_k
from envlake.llm.vectors import quantised

SCALE = 256


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.withColumn("embedding", quantised(F.col("embedding"), SCALE))


def top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(_embeddings(spark, sf_dir), "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("candidate_id", "vec_id")


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is one too high, as in labels that are partly wrong."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _embeddings(spark, sf_dir).withColumn("label", wrong)
    return hard_negatives(rows, "vec_id", "embedding", "label", F.col("vec_id") % 50 == 0)


def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


_VECTORS = f"""
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

TOP_K_SQL = f"""
WITH {_VECTORS},
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM r WHERE n <= 5
"""

NEGATIVES_SQL = f"""
WITH {_VECTORS},
l AS (
  SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM v WHERE label IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS alike,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM l a JOIN l c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n
  FROM s WHERE alike),
h AS (
  SELECT p.anchor_id, positive_id, s.other_id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS n
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike AND p.n <= 5
       AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INT) AS rank, negative_id, positive_score, negative_score
FROM h WHERE n <= 3
"""

COLLOCATIONS_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS ws, k
  FROM p, (SELECT unnest(range(1, 6)) AS k) ks, LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i) s),
c AS (SELECT lang, ws, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
cuts AS (
  SELECT c.lang, c.ws, c.k, c.f AS a, j, list_slice(ws, 1, j) AS lw, list_slice(ws, j + 1, k) AS rw
  FROM c, LATERAL (SELECT unnest(range(1, c.k)) AS j) WHERE c.k > 1),
s AS (
  SELECT t.lang, t.ws, t.k, t.a, t.j, x.f AS l, y.f AS r, n.n,
         CAST((1000 * t.a::HUGEINT * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts t JOIN c x ON t.lang = x.lang AND t.lw = x.ws JOIN c y ON t.lang = y.lang AND t.rw = y.ws JOIN n ON t.lang = n.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
longer AS (
  SELECT DISTINCT lang, list_slice(ws, i, i + m - 1) AS ws, f
  FROM c, (SELECT unnest(range(2, 5)) AS m) ms, LATERAL (SELECT unnest(generate_series(1, c.k - m + 1)) AS i) z
  WHERE m < c.k),
kept AS (
  SELECT b.*, array_to_string(b.ws, ' ') AS phrase
  FROM b WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = b.lang AND x.ws = b.ws AND 100 * x.f >= 100 * b.a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000
"""

QUERIES = {
    "op11_collocations": collocations_query,
    "op12_maxscore_search": top_k_query,
    "op13_hard_negatives": hard_negatives_query,
}
SQL = {
    "op11_collocations": COLLOCATIONS_SQL,
    "op12_maxscore_search": TOP_K_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
