"""Counts and days of a staged dataset, kept for each of its parts.

The summary of a part is a few rows, one for each station. It is computed once, when the part is
new; later reports merge summaries and read no observation.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.sources.bronze import located, read_staged_parts, staged_parts, staged_path
from envlake.sources.catalog import DatasetSpec
from envlake.sources.versions import PART, manifest, read_version, replace_parts


def summaries_path(root: str, entry: DatasetSpec | str) -> str:
    """Where the summaries of a dataset are: beside its staged copy."""
    stem, _ = posixpath.splitext(staged_path(located(root, entry)))
    return f"{stem}.resumen.parquet"


def refresh_summaries(
    spark: SparkSession, root: str, entry: DatasetSpec | str, station: str = "indicativo", day: str = "fecha"
) -> DataFrame:
    """Summarise the parts that have no summary yet, and return those of all parts.

    One row for each part and station: the station, ``n`` rows, ``fecha_min`` and ``fecha_max``.
    Parts that left the dataset leave the summaries. The dataset must be staged.
    """
    path = summaries_path(root, entry)
    parts = staged_parts(spark, root, entry)
    noted = manifest(spark, path)
    there, known = {p["part"] for p in parts}, {p["part"] for p in noted or []}
    added = [p for p in parts if p["part"] not in known]
    if noted is None or there != known:
        rows = read_staged_parts(spark, root, entry, added)
        made = rows.groupBy(PART, station).agg(
            F.count("*").alias("n"), F.min(day).alias("fecha_min"), F.max(day).alias("fecha_max")
        )
        kept = [p for p in noted or [] if p["part"] in there]
        replace_parts(spark, path, made, kept, [{"part": p["part"], "file": p["file"]} for p in added], made.drop(PART).schema)
    return read_version(spark, path)
