"""Global order and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sorted_observations(
    observations: DataFrame, station: str = "indicativo", day: str = "fecha"
) -> DataFrame:
    """By station, then day, NULLs last; ties in the order of a hash of the row.

    A range-partitioned sort. The day and the hash in the key let a large station,
    or a day with many rows, spread over partitions, and make the order repeatable.
    """
    return observations.orderBy(
        F.asc_nulls_last(station), F.asc_nulls_last(day), F.xxhash64(*observations.columns)
    )


def preview(table: DataFrame, *order: str, rows: int = 5) -> DataFrame:
    """The first rows, for a look at a written table."""
    return (table.orderBy(*order) if order else table).limit(rows)
