"""Operators for training corpora. Nothing else in the library imports this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import envlake

from envlake.llm import queries_dedup, queries_files, queries_filters, queries_pieces, queries_search

# functions travel to executors by value, so that the library need not be installed there
cloudpickle.register_pickle_by_value(envlake)

_MODULES = (queries_filters, queries_files, queries_dedup, queries_pieces, queries_search)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def expected_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
