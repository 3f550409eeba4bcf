"""The supplied tables, reshaped into the layouts the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.schemas import HOURS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, key: str) -> DataFrame:
    """The rows dealt to tasks by a key: a small file whose rows each become a lot of text is one task's work otherwise."""
    return frame.repartition(2 * frame.sparkSession.sparkContext.defaultParallelism, key)


# --- events -> wide hourly rows ------------------------------------------------


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, event type and day with the highest value of each hour."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "value", F.to_date("ts").alias("d"), F.hour("ts").alias("hour")
    )
    return (
        events.groupBy("user_id", "event_type", "d")
        .agg(
            *[F.expr(f"max(CASE WHEN hour = {n} THEN value END) AS {h}") for n, h in enumerate(HOURS)]
        )
        .select(
            (F.col("user_id") % 5).cast("int").alias("provincia"),
            (F.col("user_id") % 11).cast("int").alias("municipio"),
            F.col("user_id").cast("int").alias("estacion"),
            F.when(F.col("event_type") != "error", F.col("user_id") % 30)
            .cast("int")
            .alias("magnitud"),
            F.concat_ws("_", "user_id", "event_type").alias("punto muestreo"),
            F.year("d").alias("anno"),
            F.month("d").alias("mes"),
            F.dayofmonth("d").alias("dia"),
            *HOURS,
        )
    )


# The highest value of each hour is one group: no wide table, no melt.
_EVENT_COLUMNS = """
CAST(user_id % 5 AS INT) AS provincia, CAST(user_id % 11 AS INT) AS municipio,
CAST(user_id AS INT) AS estacion, CASE WHEN event_type <> 'error' THEN CAST(user_id % 30 AS INT) END AS magnitud"""

HOURLY_EVENTS_FACT_SQL = f"""
WITH top AS (
  SELECT user_id, event_type, date_trunc('hour', ts) AS fecha, max(value) AS uom_value
  FROM events GROUP BY ALL)
SELECT {_EVENT_COLUMNS}, concat_ws('_', CAST(user_id AS VARCHAR), event_type) AS punto_muestreo,
       CAST(fecha AS TIMESTAMP) AS fecha,
       (SELECT n_name FROM nation WHERE n_nationkey = user_id % 30 AND event_type <> 'error') AS uom, uom_value
FROM top WHERE uom_value IS NOT NULL
"""

HOURLY_EVENTS_LABEL_SQL = f"""
WITH top AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INT) AS hora_num, max(value) AS valor
  FROM events GROUP BY ALL)
SELECT {_EVENT_COLUMNS}, concat_ws('_', CAST(user_id AS VARCHAR), event_type) AS "punto muestreo",
       CAST(year(d) AS INT) AS anno, CAST(month(d) AS INT) AS mes, CAST(day(d) AS INT) AS dia,
       format('h{{:02d}}', hora_num + 1) AS hora, valor, hora_num
FROM top WHERE valor IS NOT NULL
"""


def unit_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes 0..24 with a unit text; the facts use codes up to 29."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("MAGNITUD"), F.col("n_name").alias("UNIDAD")
    )


# --- orders -> wide hourly rows, for the file-based jobs -----------------------


def hourly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: 24 hour cells, some of them empty."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).cast("int").alias("provincia"),
        (F.col("o_custkey") % 179).cast("int").alias("municipio"),
        F.col("o_custkey").cast("int").alias("estacion"),
        (F.col("o_orderkey") % 30).cast("int").alias("magnitud"),
        F.concat_ws("_", "o_custkey", "o_orderkey", "o_orderstatus").alias("punto muestreo"),
        F.year("o_orderdate").alias("anno"),
        F.month("o_orderdate").alias("mes"),
        F.dayofmonth("o_orderdate").alias("dia"),
        *[
            F.expr(f"CASE WHEN (o_orderkey + {n}) % 3 <> 0 THEN o_totalprice / {n + 1} END AS {h}")
            for n, h in enumerate(HOURS)
        ],
    )


HOURLY_ORDERS_FACT_SQL = """
SELECT CAST(o_custkey % 50 AS INT) AS provincia, CAST(o_custkey % 179 AS INT) AS municipio,
       CAST(o_custkey AS INT) AS estacion, CAST(o_orderkey % 30 AS INT) AS magnitud,
       o_custkey || '_' || o_orderkey || '_' || o_orderstatus AS punto_muestreo,
       date_trunc('day', o_orderdate)::TIMESTAMP + to_hours(h) AS fecha,
       (SELECT n_name FROM nation WHERE n_nationkey = o_orderkey % 30) AS uom,
       o_totalprice / (h + 1) AS uom_value
FROM orders, range(24) AS hours(h)
WHERE (o_orderkey + h) % 3 <> 0
"""


# --- orders -> daily weather rows as locale text -------------------------------

# column -> what the price is divided by
_DIVISORS = {
    "tmed": 2, "tmin": 3, "tmax": 5, "prec": 7, "dir": 11, "velmedia": 13, "racha": 17,
    "presMax": 19, "presMin": 23, "hrMedia": 29, "hrMax": 31, "hrMin": 37, "sol": 41,
}
# order status -> what replaces the number, per column
_TOKENS = {
    "tmin": {"F": ""},
    "prec": {"F": "Ip", "P": "Acum"},
    "dir": {"O": "99"},
    "sol": {"O": "n/d"},
}


def _measure_text(column: str) -> F.Column:
    number = F.col("o_totalprice") / _DIVISORS[column]
    text = F.replace(number.cast("string"), F.lit("."), F.lit(","))
    for status, token in _TOKENS.get(column, {}).items():
        text = F.when(F.col("o_orderstatus") == status, token).otherwise(text)
    return text.alias(column)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order in the layout of the daily weather file."""
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("fecha"),
        F.concat(F.lit("S"), "o_custkey").alias("indicativo"),
        F.concat(F.lit("STATION, "), "o_custkey").alias("nombre"),
        F.col("o_orderpriority").alias("provincia"),
        (F.col("o_custkey") % 2000).cast("int").alias("altitud"),
        *[_measure_text(c) for c in _DIVISORS],
    )


def daily_value_sql(column: str, trace: str | None = "0.0") -> str:
    """The number that the text of ``column`` stands for."""
    cases = []
    for status, token in _TOKENS.get(column, {}).items():
        number = {"99": "99.0", "Ip": trace or "NULL"}.get(token, "NULL")
        cases.append(f"WHEN o_orderstatus = '{status}' THEN {number}")
    value = f"o_totalprice / {_DIVISORS[column]}"
    return f"CAST(CASE {' '.join(cases)} ELSE {value} END AS DOUBLE)" if cases else value


def weather_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of some measures, derived from the nations."""
    return table(spark, sf_dir, "nation").select(
        F.element_at(F.array(*[F.lit(m) for m in _UNIT_NAMES]), F.col("n_nationkey") + 1).alias(
            "variable_meteo"
        ),
        F.col("n_name").alias("uom"),
    ).where(F.col("variable_meteo").isNotNull())


# 25 names for 25 nations; humedad_min and insolacion get no unit
_UNIT_NAMES = (
    "temp_media", "temp_min", "temp_max", "precipitacion", "viento_direccion",
    "viento_velocidad", "viento_racha", "presion_max", "presion_min", "humedad_media",
    "humedad_max", *[f"otra_{n}" for n in range(11, 25)],
)
WEATHER_UNITS_SQL = (
    f"SELECT list_extract({list(_UNIT_NAMES)}, n_nationkey + 1) AS variable_meteo, n_name AS uom FROM nation"
)
