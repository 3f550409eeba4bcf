"""Windows, gaps, coverage and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.functions import half_year_start, half_year_windows, landing_key, window_bound_text
from envlake.operators import (
    coverage,
    coverage_of_parts,
    dataset_summary,
    expected_windows,
    missing_window_count,
    missing_windows,
    missing_windows_by_bits,
    summary_of_parts,
)
from envlake.queries.inputs import table
from envlake.sources import DatasetSpec, refresh, refresh_summaries, scratch_dir
from envlake.sources.tables import remove_partition

# The requested period, clipped at both ends.
START, END = "1995-03-15", "2001-10-10"


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("indicativo"), F.col("c_name").alias("nombre")
    )


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("indicativo"), F.to_date("o_orderdate").alias("fecha")
    )


def half_year_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer the half-years between the first and the last order."""
    spans = _observations(spark, sf_dir).groupBy("indicativo").agg(
        F.min("fecha").alias("primero"), F.max("fecha").alias("ultimo")
    )
    windows = half_year_windows(F.col("primero"), F.col("ultimo"))
    return spans.select("indicativo", F.inline(windows)).select(
        "indicativo",
        "inicio",
        "fin",
        window_bound_text(F.col("inicio"), True).alias("ini_texto"),
        window_bound_text(F.col("fin"), False).alias("fin_texto"),
        landing_key(F.col("indicativo").cast("string"), F.col("inicio")).alias("documento"),
    )


def missing_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = (
        _observations(spark, sf_dir)
        .where(F.col("fecha").between(START, END))
        .select(
            "indicativo",
            F.greatest(half_year_start(F.col("fecha")), F.lit(START).cast("date")).alias("inicio"),
        )
    )
    expected = expected_windows(_stations(spark, sf_dir), START, END)
    return missing_windows(expected, observed, ["indicativo", "inicio"]).select(
        "indicativo", "nombre", "inicio", "fin"
    )


def missing_windows_bits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by bits; the stations of the first nations are in the list twice."""
    stations = _stations(spark, sf_dir)
    twice = table(spark, sf_dir, "customer").where("c_nationkey < 5").select(
        F.col("c_custkey").alias("indicativo"), F.col("c_name").alias("nombre")
    )
    return missing_windows_by_bits(stations.union(twice), _observations(spark, sf_dir), START, END)


def missing_window_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_window_count(missing_windows_query(spark, sf_dir))


def coverage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(_stations(spark, sf_dir), _observations(spark, sf_dir), START, END)


def coverage_empty_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No expected day at all: the share is 0, not an error."""
    return coverage(
        _stations(spark, sf_dir), _observations(spark, sf_dir), "2000-01-01", "1999-12-31"
    )


def coverage_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period of 400 days, where many shares lie halfway between two decimals."""
    return coverage(
        _stations(spark, sf_dir), _observations(spark, sf_dir), "2000-01-01", "2001-02-03"
    )


def dataset_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_summary(_observations(spark, sf_dir))


_DAYS = DatasetSpec("crudo/dias.csv", ";", {"indicativo": "bigint", "fecha": "date"})


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of observations in 12 files, after one of them went and only the others' summaries were there."""
    root = scratch_dir(spark, "summaries")
    days = _observations(spark, sf_dir).withColumn("mes", F.month("fecha"))
    days.write.partitionBy("mes").csv(f"{root}/{_DAYS.path}", sep=";", header=True)
    for _ in range(2):
        refresh(spark, root, {"dias": _DAYS})
        found = refresh_summaries(spark, root, _DAYS)
        remove_partition(spark, f"{root}/{_DAYS.path}", "mes", "2")
    return found


def coverage_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage_of_parts(_stations(spark, sf_dir), _summaries(spark, sf_dir), START, END)


def summary_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_of_parts(_summaries(spark, sf_dir))


QUERIES = {
    "half_year_windows": half_year_windows_query,
    "missing_windows": missing_windows_query,
    "missing_window_count": missing_window_count_query,
    "coverage": coverage_query,
    "coverage_empty_period": coverage_empty_period,
    "coverage_ties": coverage_ties,
    "dataset_summary": dataset_summary_query,
    "missing_windows_bits": missing_windows_bits_query,
    "coverage_by_part": coverage_by_part,
    "summary_by_part": summary_by_part,
}

_HALF = """make_date(year({d}), CASE WHEN month({d}) <= 6 THEN 1 ELSE 7 END, 1)"""

_MISSING = f"""
halves AS (
  SELECT CAST(h AS DATE) AS h
  FROM generate_series(DATE '1995-01-01', DATE '2001-07-01', INTERVAL 6 MONTH) t(h)),
windows AS (
  SELECT greatest(h, DATE '{START}') AS inicio,
         least(CAST(h + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE), DATE '{END}') AS fin
  FROM halves),
seen AS (
  SELECT o_custkey, greatest({_HALF.format(d='o_orderdate')}, DATE '{START}') AS inicio FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'),
missing AS (
  SELECT c.c_custkey AS indicativo, c.c_name AS nombre, w.inicio, w.fin
  FROM customer c CROSS JOIN windows w
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.o_custkey = c.c_custkey AND s.inicio = w.inicio))
"""


def _coverage_sql(days: str, of: str = "orders") -> str:
    pct = f"CASE WHEN {days} <> 0 THEN 100.0::DOUBLE * coalesce(n, 0) / nullif({days}, 0) ELSE 0.0::DOUBLE END"
    return f"""
WITH n AS (SELECT o_custkey, count(*) AS n FROM {of} GROUP BY o_custkey)
SELECT c_custkey AS indicativo, c_name AS nombre, coalesce(n, 0) AS n_dias,
       CAST({days} AS INT) AS dias_esperados, {pct} AS pct, format('{{:.1f}}', {pct}) AS pct_texto
FROM customer LEFT JOIN n ON c_custkey = o_custkey
"""


SQL = {
    "half_year_windows": f"""
WITH spans AS (
  SELECT o_custkey AS indicativo, CAST(min(o_orderdate) AS DATE) AS primero,
         CAST(max(o_orderdate) AS DATE) AS ultimo
  FROM orders GROUP BY o_custkey),
halves AS (
  SELECT indicativo, primero, ultimo, CAST(unnest(generate_series(
           {_HALF.format(d='primero')}, {_HALF.format(d='ultimo')}, INTERVAL 6 MONTH)) AS DATE) AS h
  FROM spans),
windows AS (
  SELECT indicativo, greatest(h, primero) AS inicio,
         least(CAST(h + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE), ultimo) AS fin
  FROM halves)
SELECT indicativo, inicio, fin, strftime(inicio, '%Y-%m-%dT00:00:00UTC') AS ini_texto,
       strftime(fin, '%Y-%m-%dT23:59:59UTC') AS fin_texto,
       indicativo || '_' || strftime(inicio, '%Y_%m') AS documento
FROM windows
""",
    "missing_windows": f"WITH {_MISSING} SELECT * FROM missing",
    "missing_windows_bits": f"""
WITH {_MISSING} SELECT m.* FROM missing m JOIN customer c ON indicativo = c_custkey, range(CASE WHEN c_nationkey < 5 THEN 2 ELSE 1 END)
""",
    "coverage_by_part": _coverage_sql(
        f"(date_diff('day', DATE '{START}', DATE '{END}') + 1)", "(SELECT * FROM orders WHERE month(o_orderdate) <> 2)"
    ),
    "summary_by_part": """
SELECT count(*) AS n_registros, CAST(min(o_orderdate) AS DATE) AS fecha_min, CAST(max(o_orderdate) AS DATE) AS fecha_max
FROM orders WHERE month(o_orderdate) <> 2
""",
    "missing_window_count": f"WITH {_MISSING} SELECT count(*) AS n_ventanas FROM missing",
    "coverage": _coverage_sql(f"(date_diff('day', DATE '{START}', DATE '{END}') + 1)"),
    "coverage_empty_period": _coverage_sql(
        "(date_diff('day', DATE '2000-01-01', DATE '1999-12-31') + 1)"
    ),
    "coverage_ties": _coverage_sql("(date_diff('day', DATE '2000-01-01', DATE '2001-02-03') + 1)"),
    "dataset_summary": """
SELECT count(*) AS n_registros, CAST(min(o_orderdate) AS DATE) AS fecha_min,
       CAST(max(o_orderdate) AS DATE) AS fecha_max
FROM orders
""",
}
