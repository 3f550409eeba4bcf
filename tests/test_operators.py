"""Operators on small frames, and the shape of their plans."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from envlake.operators import (
    clean_collected,
    clean_weather,
    coverage,
    duplicate_keys,
    expected_windows,
    header_drift,
    left_lookup,
    missing_windows,
    missing_windows_by_bits,
    preview,
    sorted_observations,
    stack_by_name,
    stack_by_position,
    unpivot_hours,
    unpivot_measures,
)
from envlake.functions import half_year_start
from envlake.plans.air import air_fact, hourly_fact
from envlake.plans.weather import weather_fact
from envlake.schemas import AIR_TYPES, HOURS, MEASURES


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def air_row(magnitud, day, cells, extra=None):
    year, month, dom = day
    hours = [cells.get(h) for h in HOURS]
    return (28, 79, 4, magnitud, "28079004_1", year, month, dom, *hours)


AIR_DDL = ", ".join(f"`{name}` {ddl}" for name, ddl in AIR_TYPES.items())


@pytest.fixture()
def units(spark):
    return spark.createDataFrame([(1, "ug"), (7, "mg"), (7, "mg twice"), (None, "no code")], "MAGNITUD int, UNIDAD string")


def test_hourly_fact(spark, units):
    wide = spark.createDataFrame(
        [
            air_row(1, (2024, 2, 29), {"h01": 1.0, "h24": 2.5}),
            air_row(1, (2024, 3, 31), {"h03": float("nan")}),
            air_row(7, (2024, 1, 1), {"h10": 0.0}),
            air_row(9, (2024, 1, 1), {"h02": 4.0}),
            air_row(None, (2024, 1, 1), {"h02": 5.0}),
            air_row(1, (2023, 2, 29), {}),
        ],
        AIR_DDL,
    )
    got = sorted(
        (r.magnitud or 0, r.fecha, r.uom or "", str(r.uom_value)) for r in hourly_fact(wide, units).collect()
    )
    assert got == [
        (0, dt.datetime(2024, 1, 1, 1), "", "5.0"),
        (1, dt.datetime(2024, 2, 29, 0), "ug", "1.0"),
        (1, dt.datetime(2024, 2, 29, 23), "ug", "2.5"),
        (1, dt.datetime(2024, 3, 31, 2), "ug", "nan"),
        (7, dt.datetime(2024, 1, 1, 9), "mg", "0.0"),
        (7, dt.datetime(2024, 1, 1, 9), "mg twice", "0.0"),
        (9, dt.datetime(2024, 1, 1, 1), "", "4.0"),
    ]


def test_hourly_fact_fails_on_an_impossible_date_with_a_value(spark, units):
    wide = spark.createDataFrame([air_row(1, (2023, 2, 29), {"h01": 1.0})], AIR_DDL)
    with pytest.raises(Exception, match="2023|FEBRUARY|date"):
        hourly_fact(wide, units).collect()
    assert hourly_fact(wide, units, strict_dates=False).first().fecha is None


def test_hourly_fact_with_decimal_commas(spark, units):
    ddl = ", ".join(f"`{n}` {'string' if n in HOURS else d}" for n, d in AIR_TYPES.items())
    wide = spark.createDataFrame([air_row(1, (2024, 1, 1), {"h01": "12,5", "h02": "x"})], ddl)
    assert [r.uom_value for r in hourly_fact(wide, units, decimal_comma=True).collect()] == [12.5]


def test_air_fact_takes_names_and_types_from_the_first_file(spark, units):
    first = spark.createDataFrame([air_row(1, (2024, 1, 1), {"h01": 1.0})], AIR_DDL)
    other_names = [f"c{i}" for i in range(len(first.columns))]
    second = first.select([F.col(f"`{c}`").cast("string") for c in first.columns]).toDF(*other_names)
    assert rows(air_fact([first], [second], units)) == {
        tuple(hourly_fact(first, units).first()): 2
    }


def test_air_fact_ignores_further_columns(spark, units):
    wide = spark.createDataFrame([air_row(1, (2024, 1, 1), {"h01": 1.0})], AIR_DDL)
    flagged = wide.withColumn("v01", F.lit("V"))
    assert rows(air_fact([flagged], [], units)) == rows(air_fact([wide], [], units))


def test_headers_and_dimension_in_other_case(spark, units):
    wide = spark.createDataFrame([air_row(1, (2024, 1, 1), {"h01": 1.0})], AIR_DDL)
    shouted = wide.toDF(*[c.upper() for c in wide.columns])
    quiet_units = units.toDF("magnitud", "unidad")
    want = rows(hourly_fact(wide, units))
    assert rows(hourly_fact(shouted, quiet_units)) == want
    assert hourly_fact(shouted, quiet_units).columns == hourly_fact(wide, units).columns
    long = unpivot_hours(shouted)
    assert long.first().hora == "h01" and "PUNTO MUESTREO" in long.columns


def test_unpivot_hours_keeps_other_columns_and_drops_nulls(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", None, None)], "id string, h01 double, H02 double")
    assert rows(unpivot_hours(wide, hours=("h01", "h02"))) == {("a", "h01", 1.0): 1}
    assert rows(unpivot_hours(wide, ["id"], ("h01", "h02"), label=False)) == {("a", 0, 1.0): 1}


def weather_row(**cells):
    base = {"fecha": "2022-01-01", "indicativo": "3195", "nombre": "N", "provincia": "P", "altitud": "664.5"}
    return {**{c: None for c in MEASURES.values()}, **base, **cells}


def weather_frame(spark, *given):
    names = ["fecha", "indicativo", "nombre", "provincia", "altitud", *MEASURES.values()]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in given], ", ".join(f"{n} string" for n in names))


def test_weather_fact(spark):
    raw = weather_frame(
        spark,
        weather_row(tmed="12,5", prec="Ip", dir="99", sol="Ip"),
        weather_row(fecha="2022-01-02", prec="Acum"),
    )
    units = spark.createDataFrame([("temp_media", "C"), ("otra", "x")], "variable_meteo string, uom string")
    got = rows(weather_fact(raw, units).select("altitud", "fecha", "variable_meteo", "uom", "valor"))
    day = dt.date(2022, 1, 1)
    assert got == {
        (665, day, "temp_media", "C", 12.5): 1,
        (665, day, "precipitacion", None, 0.0): 1,
        (665, day, "viento_direccion", None, 99.0): 1,
    }


def test_trace_rain_is_null_for_the_collector_and_zero_for_the_fact(spark):
    raw = weather_frame(spark, weather_row(prec="Ip"))
    assert clean_collected(raw).first().prec is None
    assert clean_weather(raw).first().valor == 0.0


def test_clean_collected_leaves_other_columns(spark):
    records = spark.createDataFrame([("x", "2022-13-01", "1,5", "16:05")], "nombre string, fecha string, racha string, horaracha string")
    cleaned = clean_collected(records)
    assert cleaned.columns == records.columns
    assert tuple(cleaned.first()) == ("x", None, 1.5, "16:05")
    assert tuple(clean_collected(records.select("nombre")).first()) == ("x",)


def test_stack_by_position_refuses_different_widths(spark):
    with pytest.raises(ValueError, match="different numbers"):
        stack_by_position([spark.range(1), spark.range(1).withColumn("b", F.lit(1))])


def test_stack_by_position_keeps_duplicates(spark):
    stacked = stack_by_position([spark.range(2), spark.range(2).toDF("other")])
    assert stacked.columns == ["id"] and rows(stacked) == {(0,): 2, (1,): 2}


def test_stack_by_name_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(stack_by_name([a, b]).select("k", "a", "b")) == {(1, "x", None): 1, (2, None, "y"): 1}


def test_duplicate_keys(spark, units):
    assert rows(duplicate_keys(units, "MAGNITUD")) == {(7, 2): 1}


def test_sorted_observations(spark):
    data = [("3195", "2022-01-01"), ("3190Z", "2022-01-02"), ("3129", None), ("3129", "2022-05-01"), (None, "2022-01-01"), ("3190Z", "2022-01-01")]
    frame = spark.createDataFrame(data, "indicativo string, fecha string").repartition(5)
    want = [("3129", "2022-05-01"), ("3129", None), ("3190Z", "2022-01-01"), ("3190Z", "2022-01-02"), ("3195", "2022-01-01"), (None, "2022-01-01")]
    assert [tuple(r) for r in sorted_observations(frame).collect()] == want


def test_sort_is_repeatable_and_spreads_a_hot_station(spark):
    frame = spark.range(20000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("indicativo"),
        F.lit("2022-01-01").alias("fecha"),
        "id",
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        once = sorted_observations(frame)
        spread = once.where("indicativo = 'hot'").groupBy(F.spark_partition_id()).count().count()
        again = sorted_observations(frame.repartition(3))
        assert spread > 1 and [r.id for r in once.collect()] == [r.id for r in again.collect()]
    finally:
        spark.conf.set(setting, before)


def test_preview(spark):
    assert [r.id for r in preview(spark.range(100, numPartitions=7), "id").collect()] == [0, 1, 2, 3, 4]
    assert preview(spark.range(3)).count() == 3


def test_coverage_counts_rows_and_keeps_idle_stations(spark):
    stations = spark.createDataFrame([("a", "A"), ("b", "B")], "indicativo string, nombre string")
    seen = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "indicativo string")
    got = rows(coverage(stations, seen, "2020-01-01", "2024-12-31").drop("pct"))
    assert got == {("a", "A", 2, 1827, "0.1"): 1, ("b", "B", 0, 1827, "0.0"): 1}


def test_missing_windows(spark):
    stations = spark.createDataFrame([("a",), ("b",)], "indicativo string")
    expected = expected_windows(stations, "2020-03-01", "2021-02-01")
    assert expected.count() == 6
    seen = spark.createDataFrame([("a", dt.date(2020, 7, 1))] * 3, "indicativo string, inicio date")
    gone = missing_windows(expected, seen, ["indicativo", "inicio"])
    assert ("a", dt.date(2020, 7, 1)) not in {(r.indicativo, r.inicio) for r in gone.collect()}
    assert gone.count() == 5


# --- plans -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def wide_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "wide")
    frame = spark.createDataFrame([air_row(n % 3, (2024, 1, 1), {"h01": float(n)}) for n in range(50)], AIR_DDL)
    frame.withColumn("unused", F.lit("x")).write.parquet(path)
    return path


def test_melt_reads_once_and_does_not_shuffle(spark, wide_path, units):
    units.write.mode("overwrite").parquet(wide_path + "-units")
    text = plan(hourly_fact(spark.read.parquet(wide_path), spark.read.parquet(wide_path + "-units")))
    assert text.count("FileScan") == 2  # the wide rows once, the dimension once
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "unused" not in text


def test_stacked_files_are_read_narrow_and_joined_once(spark, wide_path, units):
    files = [spark.read.parquet(wide_path) for _ in range(5)]
    units.write.mode("overwrite").parquet(wide_path + "-units")
    text = plan(air_fact(files[:2], files[2:], spark.read.parquet(wide_path + "-units")))
    assert text.count("FileScan") == 6 and text.count("BroadcastHashJoin") == 1
    assert "unused" not in text and "Exchange hashpartitioning" not in text


def test_measure_melt_reads_once(spark, wide_path):
    text = plan(unpivot_measures(spark.read.parquet(wide_path), ["estacion"], {h: h for h in HOURS}))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_lookup_beyond_the_broadcast_limit_splits_the_hot_key(spark):
    """A third of the rows share a key; the join shuffles and AQE splits that key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    facts = spark.range(0, 60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("pad")
    )
    dimension = spark.range(400).select(F.col("id").cast("int").alias("MAGNITUD"), F.col("id").cast("string").alias("UNIDAD"))
    want = rows(left_lookup(facts, dimension, "k", "MAGNITUD", uom="UNIDAD"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = left_lookup(facts, dimension, "k", "MAGNITUD", uom="UNIDAD")
        assert rows(joined) == want
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(want.values()) == 60000


def test_missing_windows_by_bits(spark):
    """The same rows as by pairs, over more half-years than one number holds, with odd stations and days."""
    stations = spark.createDataFrame([("A", 1), ("B", 2), ("B", 2), ("C", None), (None, 3)], "indicativo string, n int")
    days = [("A", "1980-05-05"), ("A", "1980-05-06"), ("A", "2019-12-31"), ("B", "1985-06-30"), ("B", "1985-07-01"), ("B", None), ("X", "1990-01-01"), ("C", "1950-01-01"), ("C", "2030-01-01"), (None, "1990-01-01")]
    seen = spark.createDataFrame(days, "indicativo string, fecha string").withColumn("fecha", F.col("fecha").cast("date"))
    for start, end in (("1980-03-01", "2019-12-31"), ("1980-03-01", "1980-03-01"), ("2000-01-01", "1999-01-01")):
        inside = seen.where(F.col("fecha").between(start, end))
        key = F.greatest(half_year_start(F.col("fecha")), F.lit(start).cast("date"))
        plain = missing_windows(expected_windows(stations, start, end), inside.select("indicativo", key.alias("inicio")), ["indicativo", "inicio"])
        bits = missing_windows_by_bits(stations, seen, start, end)
        assert bits.columns == ["indicativo", "n", "inicio", "fin"]
        assert rows(bits) == rows(plain.select("indicativo", "n", "inicio", "fin"))
    text = plan(missing_windows_by_bits(stations, seen, "1980-03-01", "2019-12-31"))
    assert text.count("Join") == 1 and "inicio" not in text.split("Join")[1].split("]")[0]


def test_header_drift(spark):
    frames = {n: spark.createDataFrame([], ddl) for n, ddl in {
        "a": "x int, `punto muestreo` int, y int", "b": "X int, punto_muestreo int, ` y` int", "c": "y int, `punto muestreo` int, x int, z int",
    }.items()}
    assert header_drift(frames) == [
        ("b", 2, "punto muestreo", "punto_muestreo", False), ("c", 1, "x", "y", True), ("c", 3, "y", "x", True), ("c", 4, None, "z", False),
    ]
