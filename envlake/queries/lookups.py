"""Dimension copies, lookups, order and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from envlake.operators import duplicate_keys, left_lookup, preview, seed_copy, sorted_observations
from envlake.queries.inputs import table
from envlake.sources import inline_table, scratch_dir


def unit_lookup_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return left_lookup(
        documents, table(spark, sf_dir, "labels"), "doc_id", "doc_id", calidad="quality"
    )


def unit_lookup_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event names against the units of some of them, by name."""
    units = inline_table(
        spark,
        [("click", "veces"), ("view", "s"), ("purchase", "EUR")],
        "nombre string, uom string",
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return left_lookup(events, units, "event_type", "nombre", uom="uom")


def seed_copy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_copy(table(spark, sf_dir, "part"))


def dimension_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names that would multiply fact rows if they were used as a key."""
    return duplicate_keys(table(spark, sf_dir, "part"), "p_name")


def sorted_observations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("indicativo"),
        F.to_date("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("prec"),
    )
    return sorted_observations(orders)


def sort_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the written order where a row should stand before the one ahead of it.

    Neighbours are compared inside each file, and the last row of a file with the first of
    the next, so no task sees more than one file or one row per file.
    """
    path = f"{scratch_dir(spark, 'sorted')}/observations"
    sorted_observations_query(spark, sf_dir).write.parquet(path)
    key = F.struct("indicativo", "fecha").alias("key")
    rows = spark.read.parquet(path).select(
        key, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    ahead = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    files = (
        rows.withColumn("broken", (ahead > F.col("key")).cast("long"))
        .groupBy("file")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("broken"), F.lit(0)).alias("inside"),
            F.min_by("key", "row").alias("first"),
            F.max_by("key", "row").alias("last"),
        )
    )
    between = F.coalesce((F.lag("last").over(Window.orderBy("file")) > F.col("first")).cast("long"), F.lit(0))
    return files.withColumn("between", between).agg(
        F.sum("n").alias("n_filas"), F.sum(F.col("inside") + F.col("between")).alias("n_rupturas")
    )


def preview_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), "o_orderkey")


QUERIES = {
    "unit_lookup_int": unit_lookup_int,
    "unit_lookup_str": unit_lookup_str,
    "seed_copy": seed_copy_query,
    "dimension_duplicates": dimension_duplicates,
    "sorted_observations": sorted_observations_query,
    "sort_breaks": sort_breaks,
    "preview_top5": preview_top5,
}

SQL = {
    "unit_lookup_int": """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality AS calidad
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
    "unit_lookup_str": """
WITH units(nombre, uom) AS (VALUES ('click', 'veces'), ('view', 's'), ('purchase', 'EUR'))
SELECT e.event_id, e.event_type, e.value, u.uom
FROM events e LEFT JOIN units u ON e.event_type = u.nombre
""",
    "seed_copy": "SELECT * FROM part",
    "dimension_duplicates": """
SELECT p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1
""",
    "sorted_observations": """
SELECT CAST(o_custkey AS VARCHAR) AS indicativo, CAST(o_orderdate AS DATE) AS fecha,
       o_totalprice AS prec
FROM orders ORDER BY indicativo NULLS LAST, fecha NULLS LAST
""",
    "sort_breaks": "SELECT count(*) AS n_filas, 0::BIGINT AS n_rupturas FROM orders",
    "preview_top5": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
}
