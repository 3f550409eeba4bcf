"""Cleaning of the daily weather columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from envlake.functions import (
    collector_number,
    date_or_null,
    int_from_double,
    int_from_text,
)
from envlake.operators.reshape import parse_cells, unpivot_measures
from envlake.schemas import MEASURES, TRACE_MEASURE, TRACE_TOKEN, TRACE_VALUE


def clean_weather(raw: DataFrame, label: bool = True) -> DataFrame:
    """Long daily rows: the station columns, ``variable_meteo`` and ``valor`` as double.

    Without ``label`` the variable is its position in ``MEASURES``.

    The 13 measures are melted as text and then parsed in one expression; text
    that is no number gives no row. The trace token of the rain column is 0.0.
    """
    as_int = (
        int_from_text
        if isinstance(raw.select("altitud").schema[0].dataType, StringType)
        else int_from_double
    )
    texts = {variable: F.col(source).cast("string") for variable, source in MEASURES.items()}
    texts[TRACE_MEASURE] = F.replace(texts[TRACE_MEASURE], F.lit(TRACE_TOKEN), F.lit(TRACE_VALUE))
    ids = ["indicativo", "nombre", "provincia", "altitud", "fecha"]
    typed = raw.withColumns(
        {"altitud": as_int(F.col("altitud")), "fecha": F.col("fecha").cast("date")}
    )
    return parse_cells(unpivot_measures(typed, ids, texts, label))


def clean_collected(records: DataFrame) -> DataFrame:
    """Raw records with numeric measures and dates; other columns stay text.

    Only the columns that are present are touched. Unlike :func:`clean_weather`
    the trace token becomes NULL.
    """
    measures = [c for c in MEASURES.values() if c in records.columns]
    cleaned = {}
    if measures:
        # One lambda over an array: written out per column, the generated method
        # is too long for the JVM to compile, which halves the speed.
        texts = F.array(*[F.col(c).cast("string") for c in measures])
        records = records.withColumn("__numbers", F.transform(texts, collector_number))
        cleaned = {c: F.col("__numbers")[i] for i, c in enumerate(measures)}
    if "fecha" in records.columns:
        cleaned["fecha"] = date_or_null(F.col("fecha"))
    return records.withColumns(cleaned).drop("__numbers")
