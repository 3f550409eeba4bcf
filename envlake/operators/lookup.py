"""Dimension copies and unit lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def seed_copy(dimension: DataFrame) -> DataFrame:
    """The dimension as it is, every column."""
    return dimension.select("*")


def left_lookup(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, **columns: str
) -> DataFrame:
    """LEFT OUTER lookup: ``columns`` maps new fact columns to dimension columns.

    Every fact row is kept; an unknown or NULL key gives NULL, and a key that the
    dimension holds twice gives two rows. No broadcast hint: Spark broadcasts the
    dimension when its size is below ``spark.sql.autoBroadcastJoinThreshold``,
    and otherwise shuffles, where AQE splits the partitions of hot keys.
    """
    slim = dimension.select(
        F.col(f"`{dim_key}`").alias("__key"),
        *[F.col(f"`{source}`").alias(name) for name, source in columns.items()],
    )
    on = facts[f"`{fact_key}`"] == slim["__key"]
    return facts.join(slim, on, "left").drop("__key")


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that would multiply fact rows, with how often each occurs."""
    return (
        dimension.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )
