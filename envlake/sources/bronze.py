"""Staged Parquet copies of the delimited sources, kept up to date.

A source is staged beside itself, ``dir/name.csv`` -> ``dir/parquet_files/name.parquet``, as a
table of parts, one for each of its files. A part is named by a digest of the file's name, time and
size, and a manifest lists all files with their parts and rows. Files that were added or changed
are staged in parts of their own, and one step puts a new manifest in the place of the old one:
readers see either all of the old files or all of the new ones, and a file without rows is an entry
with 0 rows. Files count, not settings: a changed separator alone does not make a copy stale.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from envlake.sources.catalog import CATALOG, DatasetSpec, as_spec
from envlake.sources.delimited import read_delimited, rejected_cells
from envlake.sources.tables import inline_table
from envlake.sources.versions import PART, current, literal, manifest, read_parts, read_version, replace_parts


REJECTED = "__linea"  # the line of a cell that does not fit, in staged copies of datasets that allow some


def staged_path(path: str) -> str:
    """Where jobs read ``path`` from: its staged copy, or itself if it is no CSV."""
    folder, name = posixpath.split(path.rstrip("/"))
    stem, suffix = posixpath.splitext(name)
    if suffix.lower() != ".csv":
        return path
    return posixpath.join(folder, "parquet_files", f"{stem}.parquet")


def located(root: str, entry: DatasetSpec | str) -> str:
    path = as_spec(entry).path
    return path if path.startswith("/") or "://" in path else posixpath.join(root, path)


def _side_by_side(spark: SparkSession, work: Callable, items: list, concurrent: int) -> list:
    if not items:
        return []
    with ThreadPool(min(concurrent, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def _files(spark: SparkSession, dataset: str, path: str) -> DataFrame | None:
    """A dataset's files, their times and sizes, without opening them; None if absent."""
    entry = current(spark, path)  # a table with versions, as it is now
    roots = [posixpath.join(path, f) for f in entry["folders"]] if entry else literal(path)
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return listed.select(
        F.lit(dataset).alias("dataset"), _relative(F.col("path"), path).alias("file"),
        "modificationTime", "length",
    )


def _relative(file: Column, path: str) -> Column:
    """A file's path below the dataset; its name if the dataset is that file."""
    name = posixpath.basename(path.rstrip("/"))
    below = F.substring_index(file, f"/{name}/", -1)
    return F.when(F.contains(file, F.lit(f"/{name}/")), below).otherwise(F.lit(name))


def part_name(file: Column, time: Column, length: Column) -> Column:
    """The part of a file as it is at some time."""
    return F.sha1(F.concat_ws("|", file, F.unix_micros(time).cast("string"), length.cast("string")))


def _decoded(path: Column) -> Column:
    """A file's path without percent signs for other characters; a plus sign stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _listed(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, list[dict] | None]:
    """Files of each dataset with the name of each one's part, listed in one job; None if it is absent."""
    found = _side_by_side(spark, lambda item: _files(spark, *item), list(paths.items()), 8)
    there = [f for f in found if f is not None]
    out = {key: None if f is None else [] for key, f in zip(paths, found, strict=True)}
    if there:
        files = reduce(DataFrame.union, there)
        files = files.withColumn("part", part_name(F.col("file"), F.col("modificationTime"), F.col("length")))
        for r in files.collect():  # Spark itself keeps the list of a read's files on the driver
            out[r.dataset].append({"part": r.part, "file": r.file, "bytes": r.length})
    return out


def dataset_status(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, DatasetSpec | str] = CATALOG,
    keys: Iterable[str] | None = None,
) -> DataFrame:
    """One row per dataset: ``state`` is absent, unstaged, stale or fresh.

    A copy whose write did not end counts as none. Sources that need no staging are always fresh.
    """
    keys = list(catalog if keys is None else keys)
    sources = {k: located(root, catalog[k]) for k in keys}
    files = _listed(spark, sources)

    def state(key: str) -> str:
        copy = staged_path(sources[key])
        if not files[key]:
            return "absent"
        if copy == sources[key]:
            return "fresh"
        noted = manifest(spark, copy)
        if noted is None:
            return "unstaged"
        return "fresh" if {f["part"] for f in files[key]} == {p["part"] for p in noted} else "stale"

    return inline_table(spark, [(k, state(k)) for k in keys], "dataset string, state string")


def stale_datasets(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, DatasetSpec | str] = CATALOG,
    keys: Iterable[str] | None = None,
) -> DataFrame:
    """The datasets whose staged copy is missing or older than the source."""
    return dataset_status(spark, root, catalog, keys).where(
        F.col("state").isin("unstaged", "stale")
    )


def stage(spark: SparkSession, root: str, entry: DatasetSpec | str) -> str:
    """Bring the staged copy of one dataset up to date and return its path.

    Only files that are new or changed are read, in one job. Parts of other files stay as
    they are, those of removed or changed files leave the manifest. A job that fails or ends anywhere leaves the
    copy as it was. Without a whole copy, or with one of other columns, all files are staged.
    """
    spec, source = as_spec(entry), located(root, entry)
    target = staged_path(source)
    files = _listed(spark, {"": source})[""]
    if files is None:
        raise FileNotFoundError(source)
    now = current(spark, target)
    noted = manifest(spark, target, now) if now else None

    def read(some: list[str]) -> DataFrame:
        alone = some == [posixpath.basename(source.rstrip("/"))]
        paths = literal(source) if alone else [literal(posixpath.join(source, f)) for f in some]
        frame = read_delimited(
            spark, paths, spec.sep, spec.types, spec.infer_rest, spec.latin9, spec.multi_line,
            base=None if alone else source, rejected=REJECTED if spec.max_rejects else None,
        )
        file = _relative(_decoded(F.col("_metadata.file_path")), source)
        part = part_name(file, F.col("_metadata.file_modification_time"), F.col("_metadata.file_size"))
        return frame.withColumn(PART, part)

    def check(rows: DataFrame) -> None:
        if REJECTED in rows.columns:
            found = rejected_cells(rows, REJECTED, spec.sep).count()
            if found > spec.max_rejects:
                raise ValueError(f"more than {spec.max_rejects} cells of {source} do not fit their types")

    if noted is not None:
        known, there = {p["part"] for p in noted}, {f["part"] for f in files}
        added = [f for f in files if f["part"] not in known]
        frame = read(sorted(f["file"] for f in added)) if added else None
        staged = StructType.fromJson(json.loads(now["schema"]))
        if frame is None or _kinds(frame.drop(PART).schema) == _kinds(staged):
            replace_parts(spark, target, frame, [p for p in noted if p["part"] in there], added, staged, check)
            return target
    frame = read(sorted(f["file"] for f in files))
    replace_parts(spark, target, frame, [], files, frame.drop(PART).schema, check)
    return target


def _kinds(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def refresh(
    spark: SparkSession,
    root: str,
    catalog: Mapping[str, DatasetSpec | str] = CATALOG,
    keys: Iterable[str] | None = None,
    concurrent: int = 8,
) -> list[str]:
    """Stage every stale dataset and return their keys.

    Only the names of the stale datasets reach the driver.
    """
    stale = sorted(r.dataset for r in stale_datasets(spark, root, catalog, keys).collect())
    stage_all(spark, root, [catalog[k] for k in stale], concurrent)
    return stale


def stage_all(
    spark: SparkSession, root: str, entries: list[DatasetSpec | str], concurrent: int = 8
) -> None:
    """Stage some datasets, a few side by side so that no executors idle at the end of one."""
    _side_by_side(spark, lambda entry: stage(spark, root, entry), entries, concurrent)


def read_dataset(spark: SparkSession, root: str, entry: DatasetSpec | str) -> DataFrame:
    """The staged copy of a dataset (or the dataset itself if it is no CSV)."""
    return read_version(spark, staged_path(located(root, entry))).drop(REJECTED)


def rejects(spark: SparkSession, root: str, entry: DatasetSpec | str) -> DataFrame:
    """The cells of a staged dataset that do not fit their types: fichero, linea, columna, texto.

    They are found in the staged copy, which keeps the lines of such cells; the files are not read again.
    """
    path = staged_path(located(root, entry))
    parts = manifest(spark, path)
    rows = read_parts(spark, path, parts)
    if REJECTED not in rows.columns:
        return spark.createDataFrame([], "fichero string, linea string, columna string, texto string")
    files = inline_table(spark, [(p["part"], p["file"]) for p in parts], f"{PART} string, fichero string")
    found = rejected_cells(rows, REJECTED, as_spec(entry).sep)
    return found.join(files, PART).select("fichero", "linea", "columna", "texto")


def staged_parts(spark: SparkSession, root: str, entry: DatasetSpec | str) -> list[dict]:
    """The parts of a staged dataset: part, folder, rows, file, bytes."""
    return manifest(spark, staged_path(located(root, entry)))


def read_staged_parts(spark: SparkSession, root: str, entry: DatasetSpec | str, parts: list[dict]) -> DataFrame:
    """The rows of some parts of a staged dataset, with their part's name in the column ``PART``."""
    return read_parts(spark, staged_path(located(root, entry)), parts).drop(REJECTED)


def files_digest(spark: SparkSession, root: str, entries: Mapping[str, DatasetSpec | str]) -> str:
    """A digest of some datasets' files, their times and sizes."""
    files = _listed(spark, {k: located(root, e) for k, e in entries.items()})
    names = sorted((key, f["part"]) for key, listed in files.items() for f in listed or [])
    return hashlib.sha1(json.dumps(names).encode()).hexdigest()
