"""Landed raw documents -> cleaned, sorted daily CSV with its reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType

from envlake.functions import half_year_start, landing_key
from envlake.operators import (
    clean_collected,
    coverage,
    dataset_summary,
    expected_windows,
    missing_windows,
    sorted_observations,
)
from envlake.schemas import FIRST_DAY, LAST_DAY, STATIONS
from envlake.sources import inline_table, scratch_dir, write_delimited
from envlake.sources.raw_json import DOCUMENT_COLUMNS, REST

KEY_COLUMNS = 200  # keys outside the field list that become columns


def station_list(spark: SparkSession) -> DataFrame:
    return inline_table(spark, STATIONS, "indicativo string, nombre string")


def expected_documents(
    stations: DataFrame, start: date | str = FIRST_DAY, end: date | str = LAST_DAY
) -> DataFrame:
    """Every station's download windows with the key of the document each lands as."""
    return expected_windows(stations, start, end).withColumn(
        "documento", landing_key(F.col("indicativo"), F.col("inicio"))
    )


def requested_documents(
    documents: DataFrame,
    stations: DataFrame,
    start: date | str = FIRST_DAY,
    end: date | str = LAST_DAY,
) -> DataFrame:
    """The documents of the stations and period, chosen by key before any is parsed."""
    expected = expected_documents(stations, start, end)
    return documents.join(expected.select("documento"), "documento", "left_semi")


def _of_period(records: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Landed records of the period's windows: a plain range, so that other folders are not read."""
    first = half_year_start(F.lit(start).cast("date")).cast("string")
    last = F.lit(end).cast("date").cast("string")
    return records.where((F.col("ventana") >= first) & (F.col("ventana") <= last))


def key_counts(frame: DataFrame) -> DataFrame:
    """How many records have each key of the map ``otros``: (clave, n). Tasks send counts, not records."""
    return frame.select(F.explode(F.map_keys(REST)).alias("clave")).groupBy("clave").agg(F.count("*").alias("n"))


def with_rest(clean: DataFrame, most: int = KEY_COLUMNS) -> DataFrame:
    """The ``most`` most frequent keys outside the list as columns of their own.

    Rarer ones, if there are any, stay in the map ``otros``, so that the number of columns and what the driver sees are
    bounded however many keys the records have. A key that is a name of theirs or of the
    library's, whatever its case, gets leading underscores.
    """
    if REST not in clean.columns:
        return clean
    found = key_counts(clean).orderBy(F.desc("n"), "clave").limit(most + 1).collect()
    keys = sorted(r.clave for r in found[:most])
    columns = [c for c in clean.columns if c != REST]
    left = [REST] if len(found) > most else []
    taken = {c.lower() for c in [*columns, *left, "documento", *DOCUMENT_COLUMNS]}
    extra = []
    for key in sorted(keys, key=lambda k: k.lower() in taken):  # those that clash last
        name = key
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        extra.append(F.try_element_at(REST, F.lit(key)).alias(name))
    if left:
        extra.append(F.map_filter(REST, lambda k, _: ~k.isin(*keys)).alias(REST))
    return clean.select(*columns, *extra)


def collect_observations(
    spark: SparkSession,
    records: DataFrame,
    csv: str,
    stations: DataFrame | None = None,
    start: date | str = FIRST_DAY,
    end: date | str = LAST_DAY,
    work: str | None = None,
    key_columns: int = KEY_COLUMNS,
) -> dict[str, DataFrame]:
    """Clean and sort raw records into the CSV folder ``csv``, and report on them.

    ``records`` come from ``read_raw_documents``, ``parse_documents`` or ``read_landed``;
    those of other stations or windows are left out. They are parsed once, into a
    table below ``work``; the sort (which reads its input twice) and the reports use
    that table, whose path is the one row of ``work``. Of the keys that the records keep in a map the
    ``key_columns`` most frequent become columns; the others, if any, are in the last one, ``otros``, which the CSV has as
    a JSON object. Without any record an earlier CSV is left alone. A document counts for its window as soon as it holds one record;
    ``coverage`` shows what is short.
    """
    stations = station_list(spark) if stations is None else stations
    clean_path = f"{work or scratch_dir(spark, 'collected')}/clean"
    expected = expected_documents(stations, start, end)
    if "ventana" in records.columns:
        records = _of_period(records, start, end)
    requested = records.join(expected.select("documento"), "documento", "left_semi")
    clean_collected(requested).write.mode("overwrite").parquet(clean_path)
    clean = with_rest(spark.read.parquet(clean_path), key_columns)
    observations = clean.drop("documento", *DOCUMENT_COLUMNS)
    if not clean.isEmpty():
        maps = {f.name: F.to_json(f.name) for f in observations.schema if isinstance(f.dataType, MapType)}
        write_delimited(sorted_observations(observations.withColumns(maps)), csv, bom=True)
    return {
        "observations": observations,
        "summary": dataset_summary(clean),
        "coverage": coverage(stations, clean, start, end),
        "missing_windows": missing_windows(expected, clean, ["documento"]),
        "work": inline_table(spark, [(clean_path,)], "path string"),
    }
