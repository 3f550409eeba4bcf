"""Parquet tables and named views."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from envlake.sources.versions import file_system, read_version, replace_table


def inline_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few literal rows as a local relation: Spark knows its size and needs no task."""
    schema = StructType.fromDDL(ddl)
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns), schema=schema)


def register_views(sources: Mapping[str, DataFrame]) -> None:
    """Make each frame available to SQL under its alias."""
    for alias, frame in sources.items():
        frame.createOrReplaceTempView(alias)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``path`` and put it in the place of ``path``.

    What is at ``path`` stays until the new folder is complete: a failed job changes
    nothing. The exchange is two renames, cheap on a file system; between them the
    old folder lies beside ``path`` under a name that Spark passes over. It is for folders that others
    read by their path, such as CSV; tables have versions (:func:`write_fact`).
    """
    folder, name = posixpath.split(path.rstrip("/"))
    mark = uuid.uuid4().hex
    fresh, old = (posixpath.join(folder, f"_{name}.{mark}.{kind}") for kind in ("new", "old"))
    files, fresh_at = file_system(spark, fresh)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        write(fresh)
        replaced = files.exists(hadoop_path(path))
        if replaced and not files.rename(hadoop_path(path), hadoop_path(old)):
            raise OSError(f"cannot move {path}")
        if not files.rename(fresh_at, hadoop_path(path)):
            if replaced:
                files.rename(hadoop_path(old), hadoop_path(path))
            raise OSError(f"cannot replace {path}")
    except BaseException:
        files.delete(fresh_at, True)
        raise
    if replaced:
        files.delete(hadoop_path(old), True)


def remove_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Delete one partition folder of a table."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    files, at = file_system(spark, posixpath.join(path, f"{column}={escaped}"))
    files.delete(at, True)


def write_fact(frame: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Make ``frame`` the current version of the Parquet table at ``path``.

    Readers get the version before until the new one is complete, and :func:`read_table` finds the
    current one; nothing is renamed or overwritten (see :mod:`envlake.sources.versions`).
    Rows are written where they are, without a shuffle. With ``partition_by`` they
    are first rebalanced on those columns, which keeps the number of files per
    folder low and still splits a folder that holds most of the rows.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    replace_table(frame, path, partition_by)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, or the plain Parquet table at ``path``."""
    return read_version(spark, path)
