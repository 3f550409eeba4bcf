"""Row counts, coverage per station and missing download windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from envlake.functions import day_count, half_year_windows, percent, percent_text

_BITS = 62  # half-years in one number


def dataset_summary(observations: DataFrame, day: str = "fecha") -> DataFrame:
    """One row: number of rows, first and last day."""
    return observations.agg(
        F.count("*").alias("n_registros"),
        F.min(day).alias("fecha_min"),
        F.max(day).alias("fecha_max"),
    )


def coverage(
    stations: DataFrame,
    observations: DataFrame,
    start: Column | date | str,
    end: Column | date | str,
    station: str = "indicativo",
) -> DataFrame:
    """Rows per station and their share of the expected days.

    Counts rows, so duplicated days count twice. Stations without rows stay with 0.
    All stations are counted in one pass, pre-aggregated before the shuffle.
    """
    counts = observations.groupBy(station).agg(F.count("*").alias("__n"))
    return _shares(stations, counts, start, end, station)


def _shares(
    stations: DataFrame, counts: DataFrame, start: Column | date | str, end: Column | date | str, station: str
) -> DataFrame:
    expected = day_count(start, end)
    return (
        stations.join(counts, station, "left")
        .withColumn("n_dias", F.coalesce("__n", F.lit(0).cast("bigint")))
        .withColumn("dias_esperados", expected.cast("int"))
        .withColumn("pct", percent(F.col("n_dias"), F.col("dias_esperados")))
        .withColumn("pct_texto", percent_text(F.col("pct")))
        .drop("__n")
    )


def summary_of_parts(summaries: DataFrame) -> DataFrame:
    """:func:`dataset_summary` from the summaries of a dataset's parts."""
    return summaries.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_registros"),
        F.min("fecha_min").alias("fecha_min"),
        F.max("fecha_max").alias("fecha_max"),
    )


def coverage_of_parts(
    stations: DataFrame,
    summaries: DataFrame,
    start: Column | date | str,
    end: Column | date | str,
    station: str = "indicativo",
) -> DataFrame:
    """:func:`coverage` from the summaries of a dataset's parts."""
    counts = summaries.groupBy(station).agg(F.sum("n").alias("__n"))
    return _shares(stations, counts, start, end, station)


def expected_windows(
    stations: DataFrame, start: Column | date | str, end: Column | date | str
) -> DataFrame:
    """Every station with every half-year of the range, as ``inicio`` and ``fin``.

    The windows are an expression on each station row, so no join is involved.
    """
    return stations.select("*", F.inline(half_year_windows(start, end)))


def missing_windows(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected windows without a single record."""
    return expected.join(observed.select(*keys).distinct(), keys, "left_anti")


def missing_windows_by_bits(
    stations: DataFrame,
    observations: DataFrame,
    start: date | str,
    end: date | str,
    station: str = "indicativo",
    day: str = "fecha",
) -> DataFrame:
    """Every station's half-years of the period without a single row of that station and half-year.

    The same rows as :func:`missing_windows`, by other means: the half-years of a station are bits of
    a few numbers, which tasks join by OR before the one shuffle of observations. Pairs of station and
    window are made only where they are missing, and none are joined.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    half = lambda d: F.year(d) * 2 + F.when(F.month(d) > 6, 1).otherwise(0)
    begin, until = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    count = max(1, (until.year - begin.year) * 2 + (until.month > 6) - (begin.month > 6) + 1)
    numbers = [f"__w{i}" for i in range(-(-count // _BITS))]
    bit = F.expr(f"shiftleft(1L, __place % {_BITS})")
    seen = (
        observations.where(F.col(day).between(first, last))
        .select(station, (half(F.col(day)) - half(first)).alias("__place"))
        .groupBy(station)
        .agg(*[F.bit_or(F.when(F.floor(F.col("__place") / _BITS) == i, bit)).alias(n) for i, n in enumerate(numbers)])
    )
    found = F.array(*[F.coalesce(n, F.lit(0).cast("bigint")) for n in numbers])
    absent = F.filter(
        half_year_windows(first, last),
        lambda _, i: F.getbit(F.get("__found", (i / _BITS).cast("int")), (i % _BITS).cast("int")) == 0,
    )
    return (
        stations.join(seen, station, "left")
        .select(*[F.col(f"`{c}`") for c in stations.columns], found.alias("__found"))
        .select(*[F.col(f"`{c}`") for c in stations.columns], F.inline(absent))
    )


def missing_window_count(missing: DataFrame) -> DataFrame:
    return missing.agg(F.count("*").alias("n_ventanas"))
