"""Daily weather: one row per station and day -> one row per measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from envlake.operators import clean_weather, left_lookup
from envlake.operators.reshape import name_at, position_of
from envlake.schemas import MEASURES


def weather_fact(raw: DataFrame, units: DataFrame) -> DataFrame:
    """Melt and clean the 13 measures and attach their units.

    Only the units of the 13 measures can match, so the rest of the dimension is
    left out. The join is on the measure's position, which is cheaper to hash on
    every row than its name.
    """
    names = list(MEASURES)
    known_units = units.where(F.col("variable_meteo").isin(names)).withColumn(
        "posicion", position_of(names, F.col("variable_meteo"))
    )
    long = clean_weather(raw, label=False)
    return left_lookup(long, known_units, "variable_meteo", "posicion", uom="uom").select(
        F.col("indicativo").alias("estacion_id"),
        F.col("nombre").alias("estacion_nombre"),
        "provincia",
        "altitud",
        "fecha",
        name_at(names, F.col("variable_meteo")).alias("variable_meteo"),
        "uom",
        "valor",
    )
