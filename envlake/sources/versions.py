"""Tables whose versions lie side by side, and the log that says which one is current.

Below a table's folder each write fills a folder of its own, ``_v.<id>``, and then adds one small
file to the log, ``_versions/<number>.json``. The highest whole entry is the table; nothing is
renamed or overwritten, so a job that stops anywhere leaves the version before as it was, also on
stores that rename by copying. What a version replaces is kept for those who still read it and removed
when the next one is added.

An entry names either one folder, or a manifest: a list of parts with their rows, of which some may
stem from earlier writes. There is a part for each file of a source, so the driver holds the list
as it holds the files that a read lists.
"""

from __future__ import annotations

import json
import posixpath
import re
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

LOG = "_versions"
PART = "__parte"  # the column by which rows are laid out in parts
ORPHAN_DAYS = 1  # a folder that no entry names may belong to a write that still runs


def literal(path: str) -> str:
    """A path for a reader, in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _child(spark: SparkSession, path: str, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path(posixpath.join(path, *names))


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their times; none if it is absent."""
    files, at = file_system(spark, path)
    if not files.exists(at):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(at)}


def _entries(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of each log entry, the latest first."""
    found = [(int(m[1]), name) for name in _names(spark, posixpath.join(path, LOG)) if (m := re.fullmatch(r"(\d+)\.json", name))]
    return sorted(found, reverse=True)


def _read_text(spark: SparkSession, path: str) -> str:
    files, at = file_system(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; one that is there already fails."""
    files, at = file_system(spark, path)
    out = files.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _whole(spark: SparkSession, path: str, name: str) -> dict | None:
    """A log entry; None if its write did not end."""
    text = _read_text(spark, posixpath.join(path, LOG, name))
    return json.loads(text) if text.endswith("\n") else None


def current(spark: SparkSession, path: str) -> dict | None:
    """The entry of the table's current version; None if there is no version."""
    for number, name in _entries(spark, path):
        entry = _whole(spark, path, name)
        if entry is not None:
            return entry | {"number": number}
    return None


def _publish(spark: SparkSession, path: str, entry: dict) -> None:
    """Add an entry to the log: from here on its version is the table. Of two writers of one version one fails."""
    number = next((n for n, _ in _entries(spark, path)), 0) + 1
    _write_text(spark, posixpath.join(path, LOG, f"{number:012d}.json"), json.dumps(entry) + "\n")


def _sweep(spark: SparkSession, path: str) -> None:
    """Remove what only versions before the last two need, and what no version names."""
    files, _ = file_system(spark, path)
    entries = _entries(spark, path)
    named = set()
    for i, (_, name) in enumerate(entries):
        entry = _whole(spark, path, name)
        if i >= 1:
            for folder in (entry or {}).get("dropped", []):
                files.delete(_child(spark, path, folder), True)
        if i >= 2:
            files.delete(_child(spark, path, LOG, name), False)
        named |= set((entry or {}).get("folders", []))
    old = (time.time() - ORPHAN_DAYS * 86_400) * 1000
    for name, at in _names(spark, path).items():
        plain = not name.startswith(("_", "."))  # files of a table without versions, or its columns' folders
        if plain or name == "_SUCCESS" or (name.startswith("_v.") and name not in named and at < old):
            files.delete(_child(spark, path, name), True)


def add_version(spark: SparkSession, path: str, write: Callable[[str], dict]) -> None:
    """Let ``write`` fill a new folder and make what it returns the table's current version.

    It returns the entry: ``folders`` are those in use, ``dropped`` those that the version before
    used. A failed write removes its folder.
    """
    name = f"_v.{uuid.uuid4().hex}"
    files, _ = file_system(spark, path)
    try:
        entry = write(name)
        _publish(spark, path, entry)
    except BaseException:
        files.delete(_child(spark, path, name), True)
        raise
    _sweep(spark, path)


def replace_table(frame: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``frame`` as the table's next version."""
    spark = frame.sparkSession
    before = current(spark, path)

    def write(folder: str) -> dict:
        writer = frame.write.option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(posixpath.join(path, folder))
        return {"folder": folder, "schema": frame.schema.json(), "folders": [folder], "dropped": before["folders"] if before else []}

    add_version(spark, path, write)


def manifest(spark: SparkSession, path: str, entry: dict | None = None) -> list[dict] | None:
    """The current version's parts (part, folder, rows and more); None if the table has none."""
    entry = entry or current(spark, path)
    if entry is None or "manifest" not in entry:
        return None
    return json.loads(_read_text(spark, posixpath.join(path, entry["manifest"])))


def replace_parts(
    spark: SparkSession, path: str, frame: DataFrame | None, kept: list[dict], written: list[dict], schema: StructType,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Make a version of the parts ``kept``, from the manifest, and of those in ``frame``.

    ``frame`` has the columns of ``schema`` and each row's part in the column ``PART``; ``written`` lists the parts it may hold,
    with whatever else the manifest has to say of them. A part without rows is an entry with 0
    rows. A row of a part that is not listed fails the write, as does whatever ``check`` raises on the
    written rows.
    """
    before = current(spark, path)

    def write(folder: str) -> dict:
        here, counts = posixpath.join(path, folder), {}
        if frame is not None:
            frame.write.option("compression", "snappy").partitionBy(PART).parquet(here)
            of_part = spark.read.schema(StructType([*schema.fields]).add(PART, StringType())).parquet(literal(here))
            counts = {r[PART]: r["count"] for r in of_part.groupBy(PART).count().collect()}
            if check:
                check(of_part)
        stray = counts.keys() - {w["part"] for w in written}
        if stray:
            raise RuntimeError(f"a file changed while it was read: {path} has rows of {len(stray)} unknown parts")
        made = [w | {"folder": f"{folder}/{PART}={w['part']}", "rows": counts.get(w["part"], 0)} for w in written]
        parts = sorted([*kept, *made], key=lambda p: p["part"])
        name = f"{folder}/_manifest.json"
        _write_text(spark, posixpath.join(path, name), json.dumps(parts))
        used = {p["folder"] for p in parts}
        runs = {f.split("/")[0] for f in used} | {folder}
        entry = {"manifest": name, "schema": schema.json(), "folders": sorted(runs)}
        if before is not None:
            unused = set(before["folders"]) - runs
            gone = {p["folder"] for p in manifest(spark, path, before) or []} - used
            entry["dropped"] = sorted({f for f in gone if f.split("/")[0] not in unused} | unused)
        return entry

    add_version(spark, path, write)


def read_parts(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    """The rows of some parts of the manifest, with the part's name in the column ``PART``."""
    schema = StructType.fromJson(json.loads(current(spark, path)["schema"])).add(PART, StringType())
    runs: dict[str, list[str]] = {}
    for p in parts:
        if p["rows"]:
            runs.setdefault(p["folder"].split("/")[0], []).append(literal(posixpath.join(path, p["folder"])))
    found = [
        spark.read.schema(schema).option("basePath", posixpath.join(path, run)).parquet(*folders)
        for run, folders in sorted(runs.items())
    ]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table's current version, or of a plain Parquet table where there are no versions."""
    entry = current(spark, path)
    if entry is None:
        return spark.read.parquet(literal(path))
    schema = StructType.fromJson(json.loads(entry["schema"]))
    if "folder" in entry:
        return spark.read.schema(schema).parquet(literal(posixpath.join(path, entry["folder"])))
    # one path for each part, as Spark's reader keeps one for each file
    parts = [p["folder"] for p in manifest(spark, path, entry) if p["rows"]]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[literal(posixpath.join(path, p)) for p in parts])
