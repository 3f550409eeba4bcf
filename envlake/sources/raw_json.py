"""Raw weather documents: JSON arrays, one per station and download window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from envlake.functions import (
    from_latin9,
    half_year_start,
    landing_key,
    landing_key_of_path,
    landing_key_parts,
)
from envlake.schemas import RAW_FIELDS


# What the readers add to the records besides their document's key.
DOCUMENT_COLUMNS = ("documento_estacion", "documento_mes", "ventana")
REST = "otros"  # the keys that are not asked for by name


def _text_fields(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_documents(spark: SparkSession, path: str, latin9: bool = False) -> DataFrame:
    """All document files below ``path``: their landing key and their whole text.

    Bytes that are no valid text in the charset make the text NULL.
    """
    if latin9:
        text = from_latin9(F.decode("content", "ISO-8859-1"))
    else:
        text = F.try_validate_utf8(F.col("content").cast("string"))
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(landing_key_of_path(F.col("path")).alias("documento"), text.alias("texto"))
    )


def parse_documents(
    documents: DataFrame, fields: Sequence[str] = RAW_FIELDS, rest: bool = True
) -> DataFrame:
    """The records of each document (``documento``, ``texto``), one row per record.

    A document counts only as a whole: one that is not one complete JSON array and
    nothing else, or is empty, contributes nothing. Keys absent from a record are NULL, and
    of a key that a record repeats the last value counts. Keys outside ``fields`` are kept in a
    map, ``otros``, unless ``rest`` is False.
    """
    trimmed = F.btrim("texto", F.lit(" \t\r\n"))
    # inside one more pair of brackets a second array or text after the first shows up
    wrapped = F.concat(F.lit("["), "texto", F.lit("]"))
    arrays = F.from_json(wrapped, "array<array<map<string,string>>>", {"allowSingleQuotes": "false"})
    bracketed = F.startswith(trimmed, F.lit("[")) & F.endswith(trimmed, F.lit("]"))
    station, month = landing_key_parts(F.col("documento"))

    def value(key: Column | str) -> Column:
        """The last value of a key: the first, read backwards."""
        return F.get("valores", F.array_position("claves", key) - 1)

    values = [value(n).alias(n) for n in fields]
    if rest:
        others = F.array_except("claves", F.array(*[F.lit(n) for n in fields]).cast("array<string>"))
        some = F.map_from_arrays(others, F.transform(others, value))
        none = F.create_map().cast("map<string,string>")
        values.append(F.when(F.size(others) > 0, some).otherwise(none).alias(REST))
    # First the document's columns, then its records: so a text is parsed once and not once for each use of the result,
    # and the key is taken apart once for a document. An inner explode or a filter on the text would undo that.
    whole = documents.select(
        "documento",
        station.alias("documento_estacion"),
        month.alias("documento_mes"),
        F.when(bracketed, arrays).alias("listas"),
    )
    records = F.when(F.size("listas") == 1, F.get("listas", F.lit(0)))
    return (
        whole.select("documento", "documento_estacion", "documento_mes", F.explode_outer(records).alias("r"))
        .where(F.col("r").isNotNull())
        .withColumns({"claves": F.reverse(F.map_keys("r")), "valores": F.reverse(F.map_values("r"))})
        .select(
            "documento",
            "documento_estacion",
            "documento_mes",
            *values,
        )
    )


def write_documents(documents: DataFrame, path: str, folders: int = 1) -> None:
    """Land each document (``documento``, ``texto``) as a file of its own, ``<documento>.json``.

    Many documents share a folder: there are ``folders`` of them, by a hash of the key. Tasks write
    through the file system of ``path`` (a local or shared folder, or a store that Arrow opens); a task
    that runs again writes the same files again. A document without key or text is left out, and a
    key with a slash in it fails.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            for folder, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if "/" in key:
                    raise ValueError(f"no file name: {key}")
                if folder not in made:
                    store.create_dir(f"{base}/{folder}", recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{base}/{folder}/{key}.json") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    named = documents.where("documento is not null and texto is not null")
    folder = F.lpad(F.hex(F.pmod(F.xxhash64("documento"), F.lit(folders))), 6, "0")
    # one task for each core and not only as many as the table has files
    spread = named.select(folder, "documento", "texto").repartition(documents.sparkSession.sparkContext.defaultParallelism)
    spread.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def read_raw_documents(
    spark: SparkSession,
    path: str,
    fields: Sequence[str] = RAW_FIELDS,
    latin9: bool = False,
    rest: bool = True,
) -> DataFrame:
    """The records of all document files below ``path``, which are listed once and dealt to tasks by size."""
    return parse_documents(read_documents(spark, path, latin9), fields, rest)


def land_records(records: DataFrame, path: str, start: date | str | None = None) -> None:
    """Land records as JSON lines, one folder per station and half-year.

    ``start`` clips the first window, as in the download. Records without a date, or
    from before ``start``, belong to no window and land in the folder of NULL. Landing a window again
    replaces that folder and leaves the others alone. The rebalance keeps files few
    and splits a folder that holds most of the records.
    """
    window = half_year_start(F.col("fecha").try_cast("date"))
    if start is not None:
        first = F.lit(start).cast("date")
        window = F.when(F.col("fecha").try_cast("date") >= first, F.greatest(window, first))
    (
        records.withColumn("ventana", window.cast("string"))
        .hint("rebalance", "indicativo", "ventana")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("indicativo", "ventana")
        .json(path)
    )


def read_landed(
    spark: SparkSession, path: str, fields: Sequence[str] = RAW_FIELDS, rest: bool = True
) -> DataFrame:
    """Records landed by :func:`land_records`, with the window's first day and key.

    A line that is no record is left out. Keys outside ``fields`` that were landed in the map ``otros`` stay
    there, unless ``rest`` is False.
    """
    names = [n for n in fields if n != "indicativo"]
    schema = _text_fields([*names, "indicativo", "ventana"])
    if rest:
        schema = schema.add(REST, MapType(StringType(), StringType()))
    landed = spark.read.schema(schema)
    landed = landed.option("mode", "DROPMALFORMED").json(path)
    key = landing_key(F.col("indicativo"), F.col("ventana").try_cast("date"))
    return landed.select(
        F.when(F.col("ventana").isNotNull(), key).alias("documento"),
        "ventana",
        *fields,
        *([REST] if rest else []),
    )
