"""Reshaping, cleaning and stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.functions import hour_of_label, int_from_double, int_from_text, locale_decimal
from envlake.operators import (
    clean_collected,
    stack_by_name,
    stack_by_position,
    unpivot_hours,
    unpivot_measures,
)
from envlake.plans.air import hourly_fact
from envlake.queries.inputs import (
    HOURLY_EVENTS_FACT_SQL,
    HOURLY_EVENTS_LABEL_SQL,
    hourly_events,
    table,
    unit_dimension,
)


def wide_hours_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_fact(hourly_events(spark, sf_dir), unit_dimension(spark, sf_dir))


def unpivot_hour_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The melt alone, every other column kept, with the parsed label beside it."""
    return unpivot_hours(hourly_events(spark, sf_dir)).withColumn(
        "hora_num", hour_of_label(F.col("hora"))
    )


def weather_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("indicativo"),
        F.col("l_linenumber").alias("linea"),
        F.date_format("l_shipdate", "yyyy-MM-dd").cast("date").alias("fecha"),
        *[
            F.nullif(F.col(f"l_{m}"), F.lit(0.0)).alias(m)
            for m in ("quantity", "extendedprice", "discount", "tax")
        ],
    )
    return unpivot_measures(
        wide,
        ["indicativo", "linea", "fecha"],
        {m: m for m in ("quantity", "extendedprice", "discount", "tax")},
    )


_MELT_BRANCHES = " UNION ALL ".join(
    f"SELECT indicativo, linea, fecha, '{m}' AS variable_meteo, {m} AS valor FROM base"
    for m in ("quantity", "extendedprice", "discount", "tax")
)

_EVENT_TEXT = {"error": "Ip", "signup": "Acum"}


def _event_text() -> F.Column:
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    for event_type, token in _EVENT_TEXT.items():
        text = F.when(F.col("event_type") == event_type, token).otherwise(text)
    return text


def locale_decimal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        locale_decimal(_event_text(), {"Ip": "0.0"}).alias("con_traza"),
        locale_decimal(_event_text()).alias("sin_traza"),
    )


def cast_int_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.floor("o_totalprice") + 0.5
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        int_from_double(F.col("o_totalprice")).alias("from_double"),
        int_from_double(half).alias("tie_from_double"),
        int_from_text(F.col("o_totalprice").cast("string")).alias("from_text"),
        int_from_text(half.cast("string")).alias("tie_from_text"),
    )


def union_all_nway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each year as one frame per year, stacked again."""
    orders = table(spark, sf_dir, "orders")
    return stack_by_position(
        [
            orders.where(F.col("o_orderdate") < "1996-01-01"),
            *[
                orders.where(
                    (F.col("o_orderdate") >= f"{y}-01-01") & (F.col("o_orderdate") < f"{y + 1}-01-01")
                )
                for y in range(1996, 2001)
            ],
            orders.where(F.col("o_orderdate") >= "2001-01-01"),
        ]
    )


def union_positional_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"),
        F.col("c_acctbal").alias("saldo"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return stack_by_position([customers, suppliers], cast_to_first=True)


def ragged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("segmento"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("saldo"), F.col("s_suppkey").alias("clave"),
        F.col("s_name").alias("nombre"),
    )
    return stack_by_name([customers, suppliers])


def collector_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "Ip").otherwise(number).alias("prec"),
        F.when(F.col("event_type") == "signup", "nan").otherwise(number).alias("tmed"),
        F.when(F.col("event_type") == "click", "").otherwise(number).alias("sol"),
        number.alias("horaracha"),
        F.when(F.col("event_type") == "view", "2024/13/45")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("fecha"),
    )
    return clean_collected(records)


QUERIES = {
    "wide_hours_to_fact": wide_hours_to_fact,
    "unpivot_hour_labels": unpivot_hour_labels,
    "weather_melt": weather_melt,
    "locale_decimal": locale_decimal_query,
    "cast_int_rounding": cast_int_rounding,
    "union_all_nway": union_all_nway,
    "union_positional_names": union_positional_names,
    "ragged_union": ragged_union,
    "collector_clean": collector_clean,
}

SQL = {
    "wide_hours_to_fact": HOURLY_EVENTS_FACT_SQL,
    "unpivot_hour_labels": HOURLY_EVENTS_LABEL_SQL,
    "weather_melt": f"""
WITH base AS (
  SELECT l_orderkey AS indicativo, l_linenumber AS linea,
         CAST(strftime(l_shipdate, '%Y-%m-%d') AS DATE) AS fecha,
         nullif(l_quantity, 0) AS quantity, nullif(l_extendedprice, 0) AS extendedprice,
         nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax
  FROM lineitem),
melted AS ({_MELT_BRANCHES})
SELECT * FROM melted WHERE valor IS NOT NULL
""",
    "locale_decimal": """
SELECT event_id,
       CASE event_type WHEN 'error' THEN 0.0 WHEN 'signup' THEN NULL ELSE value END AS con_traza,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS sin_traza
FROM events
""",
    "cast_int_rounding": """
SELECT o_orderkey, CAST(o_totalprice AS INT) AS from_double,
       CAST(floor(o_totalprice) + CAST(0.5 AS DOUBLE) AS INT) AS tie_from_double,
       CAST(CAST(o_totalprice AS VARCHAR) AS INT) AS from_text,
       CAST(CAST(floor(o_totalprice) + CAST(0.5 AS DOUBLE) AS VARCHAR) AS INT) AS tie_from_text
FROM orders
""",
    "union_all_nway": "SELECT * FROM orders",
    "union_positional_names": """
SELECT c_custkey AS clave, c_name AS nombre, c_acctbal AS saldo FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
""",
    "ragged_union": """
SELECT c_custkey AS clave, c_name AS nombre, c_mktsegment AS segmento, NULL::DOUBLE AS saldo
FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""",
    "collector_clean": """
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN value END AS prec,
       CASE WHEN event_type <> 'signup' THEN value END AS tmed,
       CASE WHEN event_type <> 'click' THEN value END AS sol,
       replace(CAST(value AS VARCHAR), '.', ',') AS horaracha,
       CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS fecha
FROM events
""",
}
