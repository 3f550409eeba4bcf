"""Registered queries: every operator on the supplied tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from envlake.queries import facts, files, jobs, lookups, quality

_MODULES = (facts, lookups, quality, files, jobs)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def expected_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
