"""Scalar helpers, with the values an embedded SQL engine or pandas gives."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from envlake import functions as E


def values(spark, inputs, expression, ddl="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {ddl}")
    return [r.o for r in rows.select("i", expression.alias("o")).orderBy("i").collect()]


LOCALE = {
    "12,5": 12.5, "12.5": 12.5, "Ip": 0.0, "Acum": None, "": None, " 1,5 ": 1.5, "-0,1": -0.1,
    "1.234,5": None, "99": 99.0, "1.0d": None, "2f": None, "5.d": None, "1e3d": None, " 7D ": None,
    "7d\t": None, "7D\n": None, "0x10": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+1": 1.0,
    "1_000": 1000.0, "1_000,5": 1000.5, "_1": None, "1_": None, "1__0": None, "1_.5": None,
    "Ipd": None, "inf": math.inf, "-Infinity": -math.inf, "1 2": None, "\t1.5\n": 1.5,
    "1e400": math.inf, None: None, "0x1p3": None, "0X1P3": None, "n/d": None, ".": None, "1e": None,
    "5,": 5.0, " 5. ": 5.0, "+": None, "x1": None,
}


def test_locale_decimal(spark):
    got = values(spark, list(LOCALE), E.locale_decimal(F.col("v"), {"Ip": "0.0"}))
    assert dict(zip(LOCALE, got)) == LOCALE


def test_locale_decimal_keeps_nan(spark):
    assert math.isnan(values(spark, ["nan"], E.locale_decimal(F.col("v")))[0])


def test_trace_token_is_case_sensitive(spark):
    assert values(spark, ["ip", "IP"], E.locale_decimal(F.col("v"), {"Ip": "0.0"})) == [None, None]


def test_locale_decimal_of_numbers_is_lossless(spark):
    numbers = [0.1, 1e-7, 12345678.9, 1e22, -0.0, 5e-324]
    assert values(spark, numbers, E.locale_decimal(F.col("v")), "v double") == numbers


def test_collector_number_is_what_pandas_makes_of_the_text(spark):
    texts = [
        "12,5", "Ip", "Acum", "", "nan", "NaN", " 1,5 ", "1_000", "1.0d", "2f", "inf", "-inf",
        "Infinity", "1e400", "-1e400", "1e3", "0x10", "+1", "5.", ".5", "1.2.3", "1e-400", "info", "0x1p3", " 2. ", "n/d", " inf ",
    ]
    cleaned = pd.Series(texts, dtype=object).str.replace(",", ".", regex=False)
    want = pd.to_numeric(cleaned.replace({"nan": None, "": None}), errors="coerce")
    want = [None if math.isnan(v) else v for v in want]
    assert values(spark, texts, E.collector_number(F.col("v"))) == want


def test_date_or_null_is_what_pandas_makes_of_the_text(spark):
    texts = ["2021-11-08", "2022-1-5", "2022", "2022-12", " 2022-01-05", "2022-01-05 10:00",
             "2022/01/05", "20220105", "05/01/2022", "2022-02-30", "x", None]
    want = [None if pd.isna(d) else d.date() for d in pd.to_datetime(pd.Series(texts), errors="coerce")]
    assert values(spark, texts, E.date_or_null(F.col("v"))) == want


def test_int_from_double_rounds_half_to_even(spark):
    got = values(spark, [664.5, 665.5, -1.5, -0.5, 664.7], E.int_from_double(F.col("v")), "v double")
    assert got == [664, 666, -2, 0, 665]


def test_int_from_text_rounds_half_away_from_zero(spark):
    got = values(spark, ["664.5", "665.5", "-1.5", "-0.5", "2.5", " 664 ", "1e3", None], E.int_from_text(F.col("v")))
    assert got == [665, 666, -2, -1, 3, 664, 1000, None]


def test_int_from_text_is_strict(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["664,7"], E.int_from_text(F.col("v")))


def hour(spark, year, month, day, h, strict=True):
    frame = spark.createDataFrame([(year, month, day, h)], "y int, m int, d int, h int")
    stamp = E.observation_hour(F.col("y"), F.col("m"), F.col("d"), F.col("h"), strict)
    return frame.select(stamp.alias("t")).first().t


def test_observation_hour_ignores_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        assert hour(spark, 2024, 3, 31, 2) == dt.datetime(2024, 3, 31, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_observation_hour_of_impossible_date(spark):
    assert hour(spark, 2024, 2, 29, 0) == dt.datetime(2024, 2, 29)
    assert hour(spark, 2023, None, 1, 0) is None
    assert hour(spark, 2023, 2, 29, 0, strict=False) is None
    with pytest.raises(Exception, match="2023|FEBRUARY|date"):
        hour(spark, 2023, 2, 29, 0)


def test_hour_of_label(spark):
    labels = [f"h{n:02d}" for n in range(1, 25)]
    assert values(spark, labels, E.hour_of_label(F.col("v"))) == list(range(24))


def half_years(start, end):
    """The windows by a plain walk over the calendar."""
    found = []
    while start <= end:
        last = dt.date(start.year, 6, 30) if start.month <= 6 else dt.date(start.year, 12, 31)
        found.append((start, min(last, end)))
        start = last + dt.timedelta(days=1)
    return found


@pytest.mark.parametrize(
    "start, end",
    [
        ("2020-01-01", "2024-12-31"), ("2020-03-15", "2020-03-15"), ("2020-06-30", "2020-07-01"),
        ("2019-12-31", "2021-01-01"), ("2020-02-29", "2023-05-01"), ("2021-01-01", "2020-12-31"),
    ],
)
def test_half_year_windows(spark, start, end):
    frame = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "a date, b date")
    want = half_years(dt.date.fromisoformat(start), dt.date.fromisoformat(end))
    by_column = frame.select(F.inline(E.half_year_windows(F.col("a"), F.col("b")))).collect()
    by_literal = frame.select(F.inline(E.half_year_windows(start, end))).collect()
    assert [tuple(r) for r in by_column] == [tuple(r) for r in by_literal] == want


def test_landing_key_and_back(spark):
    paths = ["/x/a_2021_01/5210X_2022_07.json", "/x/documento=3129_2020_01/part-0.txt",
             "/x/other.json", "/x/a_b_2020_07.json"]
    keys = values(spark, paths, E.landing_key_of_path(F.col("v")))
    assert keys == ["5210X_2022_07", "3129_2020_01", None, "a_b_2020_07"]
    station, month = E.landing_key_parts(F.col("v"))
    assert values(spark, keys, station) == ["5210X", "3129", None, "a_b"]
    assert values(spark, keys, month) == [dt.date(2022, 7, 1), dt.date(2020, 1, 1), None, dt.date(2020, 7, 1)]


def test_latin9_both_ways(spark):
    text = "€ŠšŽžŒœŸ Ñandú çé ß"
    frame = spark.createDataFrame([(text, bytearray(text.encode("iso-8859-15")))], "t string, b binary")
    row = frame.select(
        E.from_latin9(F.decode("b", "ISO-8859-1")).alias("decoded"),
        F.encode(E.to_latin9(F.col("t")), "ISO-8859-1").alias("encoded"),
    ).first()
    assert row.decoded == text and bytes(row.encoded) == text.encode("iso-8859-15")


def test_percent(spark):
    frame = spark.createDataFrame([(1, 3), (5, 0), (0, 7)], "a int, b int")
    pct = E.percent(F.col("a"), F.col("b"))
    got = frame.select(pct.alias("p"), E.percent_text(pct).alias("t")).collect()
    assert [tuple(r) for r in got] == [(100 / 3, "33.3"), (0.0, "0.0"), (0.0, "0.0")]
