"""Hourly air quality: wide daily rows -> one row per station, pollutant and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from envlake.functions import observation_hour
from envlake.operators import left_lookup, parse_cells, stack_by_position, unpivot_hours
from envlake.schemas import HOURS


def hourly_fact(
    wide: DataFrame, units: DataFrame, strict_dates: bool = True, decimal_comma: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Melt the 24 hours, build the hour's timestamp and attach the unit.

    The columns ``keep`` of the wide rows come last in the fact.

    The unit depends on the wide row alone, so it is looked up before the melt:
    24 times fewer rows meet the join, whichever join it is. The timestamp is
    built after it, so a row without any value cannot fail on its date.
    """
    ids = ["provincia", "municipio", "estacion", "magnitud", "punto muestreo", "anno", "mes", "dia"]
    slim = _with_hours_as(
        wide.select(*[f"`{c}`" for c in (*ids, *keep, *HOURS)]), "string" if decimal_comma else "double"
    )
    with_unit = left_lookup(slim, units, "magnitud", "MAGNITUD", uom="UNIDAD")
    long = unpivot_hours(with_unit, [*ids, *keep, "uom"], label=False)
    if decimal_comma:
        long = parse_cells(long)
    return long.select(
        "provincia",
        "municipio",
        "estacion",
        "magnitud",
        F.col("`punto muestreo`").alias("punto_muestreo"),
        observation_hour(
            F.col("anno"), F.col("mes"), F.col("dia"), F.col("hora"), strict_dates
        ).alias("fecha"),
        "uom",
        F.col("valor").alias("uom_value"),
        *keep,
    )


def _with_hours_as(wide: DataFrame, cell_type: str) -> DataFrame:
    """All hour cells in one type, so that they can be melted into one column."""
    others = [h for h in HOURS if wide.schema[h].dataType.simpleString() != cell_type]
    return wide.withColumns({h: F.col(h).cast(cell_type) for h in others}) if others else wide


def air_fact(
    years: Sequence[DataFrame],
    pollutants: Sequence[DataFrame],
    units: DataFrame,
    strict_dates: bool = True,
    decimal_comma: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Stack the yearly files, then the per-pollutant files, and melt them.

    The first yearly file names the columns of all. The columns ``keep`` stay with their rows.
    """
    wide = stack_by_position([*years, *pollutants], cast_to_first=True)
    return hourly_fact(wide, units, strict_dates, decimal_comma, keep)
