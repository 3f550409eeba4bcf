"""Readers, staging and sinks."""

from envlake.sources.bronze import (
    read_dataset,
    refresh,
    rejects,
    stage,
    staged_path,
    stale_datasets,
)
from envlake.sources.catalog import CATALOG, DatasetSpec
from envlake.sources.delimited import read_delimited, write_delimited
from envlake.sources.raw_json import (
    land_records,
    parse_documents,
    read_documents,
    read_landed,
    read_raw_documents,
    write_documents,
)
from envlake.sources.scratch import scratch_dir
from envlake.sources.summaries import refresh_summaries
from envlake.sources.tables import inline_table, read_table, register_views, write_fact

__all__ = [
    "CATALOG",
    "DatasetSpec",
    "inline_table",
    "land_records",
    "parse_documents",
    "read_dataset",
    "read_delimited",
    "read_documents",
    "read_landed",
    "read_raw_documents",
    "read_table",
    "refresh",
    "refresh_summaries",
    "register_views",
    "rejects",
    "scratch_dir",
    "stage",
    "staged_path",
    "stale_datasets",
    "write_delimited",
    "write_documents",
    "write_fact",
]
