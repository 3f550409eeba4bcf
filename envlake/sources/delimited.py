"""Delimited files with a header."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from envlake.functions import from_latin9
from envlake.sources.tables import replace_folder

_LFS_POINTER = "version https://git-lfs"
_BOM = "\ufeff"


def _header_schema(
    spark: SparkSession, path: str | list[str], options: dict, types: Mapping[str, str], infer_rest: bool
) -> StructType:
    """The file's own columns: declared types by name, the rest text or inferred."""
    found = spark.read.options(**options, inferSchema=infer_rest).csv(path).schema
    if found.names and found.names[0].startswith(_LFS_POINTER):
        raise ValueError(f"{path} is a Git-LFS pointer, not data: fetch the file first")
    declared = {name.lower(): ddl for name, ddl in types.items()}
    fields = []
    for f in found:
        ddl = declared.get(f.name.lower())
        if ddl:
            kind = StructType.fromDDL(f"c {ddl}")[0].dataType
        elif isinstance(f.dataType, TimestampType):
            kind = TimestampNTZType()  # files carry no zone
        else:
            kind = f.dataType
        fields.append(StructField(f.name, kind))
    return StructType(fields)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    types: Mapping[str, str] | None = None,
    infer_rest: bool = False,
    latin9: bool = False,
    multi_line: bool = False,
    base: str | None = None,
    rejected: str | None = None,
) -> DataFrame:
    """Read a header CSV with declared column types.

    Only the first line is read to learn the columns, unless ``infer_rest`` asks
    for the types of undeclared ones. A cell that does not fit its declared type
    fails the read instead of turning into NULL. ``multi_line`` allows line breaks
    inside quotes but then a file is no longer split over tasks. With ``base``, ``path``
    lists files below that folder. With ``rejected``, a cell that does not fit is NULL and a column of
    that name has the whole line; it is NULL for lines where all cells fit.
    """
    options = {
        "header": True,
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "encoding": "ISO-8859-1" if latin9 else "UTF-8",
        "multiLine": multi_line,
        "dateFormat": "yyyy-MM-dd",
    }
    if base:
        options["basePath"] = base
    schema = _header_schema(spark, path, options, types or {}, infer_rest)
    if rejected:
        schema = schema.add(rejected, StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejected}
    else:
        options["mode"] = "FAILFAST"
    frame = spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)
    if not latin9:
        return frame
    texts = [f.name for f in schema if isinstance(f.dataType, StringType)]
    return frame.withColumns({n: from_latin9(F.col(f"`{n}`")) for n in texts})


def rejected_cells(frame: DataFrame, rejected: str, sep: str = ";") -> DataFrame:
    """The cells that did not fit in a frame of :func:`read_delimited`: linea, columna, texto, and the
    frame's columns beside those of the file.

    A line whose number of cells is wrong and that has no such cell is one row without column. Only
    rejected lines are parsed again.
    """
    names = [c for c in frame.columns if c != rejected]
    typed = [c for c in names if not c.startswith("__")]
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in typed)
    texts = F.from_csv(rejected, ddl, {"sep": sep, "quote": '"', "escape": '"'})
    bad = F.array(*[
        F.when(F.col(f"__textos.`{c}`").isNotNull() & F.col(f"`{c}`").isNull(), F.struct(F.lit(c).alias("columna"), F.col(f"__textos.`{c}`").alias("texto")))
        for c in typed
    ])
    others = [f"`{c}`" for c in names if c not in typed]
    return (
        frame.where(F.col(rejected).isNotNull())
        .withColumn("__textos", texts)
        .select(*others, F.col(rejected).alias("linea"), F.explode_outer(F.array_compact(bad)).alias("c"))
        .select(*others, "linea", "c.columna", "c.texto")
    )


def write_delimited(
    frame: DataFrame, path: str, sep: str = ",", bom: bool = False, multi_line: bool = False
) -> None:
    """Write header CSV, UTF-8, replacing ``path``; ``bom`` marks each file as UTF-8.

    Blanks around texts are kept. A text with a line break fails the write unless
    ``multi_line`` says that readers will be told of them.
    """
    if not multi_line:
        frame = frame.select(*[_one_line(f) for f in frame.schema])
    if bom:
        frame = frame.toDF(_BOM + frame.columns[0], *frame.columns[1:])
    writer = frame.write.options(
        header=True,
        sep=sep,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        dateFormat="yyyy-MM-dd",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    )
    replace_folder(frame.sparkSession, path, writer.csv)


def _one_line(field: StructField) -> Column:
    name = f"`{field.name.replace('`', '``')}`"
    if not isinstance(field.dataType, StringType):
        return F.col(name)
    broken = F.raise_error(F.lit(f"line break in column {field.name}: write it with multi_line"))
    return F.when(F.col(name).rlike("[\\r\\n]"), broken).otherwise(F.col(name)).alias(field.name)
