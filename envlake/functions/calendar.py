"""Dates, hour labels and the half-year download windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def _day(value: Column | date | str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def hour_of_label(label: Column) -> Column:
    """``h01`` .. ``h24`` -> 0 .. 23."""
    return F.replace(label, F.lit("h"), F.lit("")).cast("int") - 1


def observation_hour(
    year: Column, month: Column, day: Column, hour: Column, strict: bool = True
) -> Column:
    """Wall-clock timestamp of an hour; no time zone, so DST gaps do not shift it.

    An impossible date is an error when ``strict``, else NULL.
    """
    make = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    return make(year, month, day, hour, F.lit(0), F.lit(0))


def date_or_null(value: Column) -> Column:
    """Year-month-day text as a date; any other text is NULL."""
    text = value.cast("string")
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date"))


def day_count(start: Column | date | str, end: Column | date | str) -> Column:
    """Days from ``start`` to ``end``, both included."""
    return F.datediff(_day(end), _day(start)) + 1


def half_year_start(day: Column | date | str) -> Column:
    """1 January or 1 July on or before ``day``."""
    d = _day(day)
    return F.make_date(F.year(d), F.when(F.month(d) <= 6, 1).otherwise(7), F.lit(1))


def half_year_windows(start: Column | date | str, end: Column | date | str) -> Column:
    """Half-years covering ``start`` .. ``end`` as ``array<struct<inicio, fin>>``.

    The first and last windows are clipped to the range; an empty range has none.
    """
    first, last = _day(start), _day(end)
    halves = F.sequence(
        half_year_start(first), half_year_start(last), F.expr("interval 6 months")
    )
    windows = F.transform(
        halves,
        lambda h: F.struct(
            F.greatest(h, first).alias("inicio"),
            F.least(F.date_sub(F.add_months(h, 6), 1), last).alias("fin"),
        ),
    )
    empty = F.array().cast("array<struct<inicio:date,fin:date>>")
    return F.when(first <= last, windows).otherwise(empty)


def window_bound_text(day: Column, is_start: bool) -> Column:
    """A window bound in the notation of the download API."""
    time_of_day = "T00:00:00UTC" if is_start else "T23:59:59UTC"
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(time_of_day))


def landing_key(station: Column, window_start: Column) -> Column:
    """``{station}_{yyyy}_{mm}``, the name of one landed document."""
    return F.format_string(
        "%s_%d_%02d", station, F.year(window_start), F.month(window_start)
    )


def landing_key_of_path(path: Column) -> Column:
    """The landing key in a document's path: its file name, else its directory."""
    name = F.regexp_extract(path, r"([^/=]+_[0-9]{4}_[0-9]{2})[.]json$", 1)
    folder = F.regexp_extract(path, r"([^/=]+_[0-9]{4}_[0-9]{2})/[^/]*$", 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(folder, F.lit("")))


def landing_key_parts(key: Column) -> tuple[Column, Column]:
    """Station and first month (as its first day) of a landing key."""
    pattern = "^(.+)_([0-9]{4})_([0-9]{2})$"
    station = F.nullif(F.regexp_extract(key, pattern, 1), F.lit(""))
    month = F.concat_ws(
        "-", F.regexp_extract(key, pattern, 2), F.regexp_extract(key, pattern, 3), F.lit("01")
    )
    return station, month.try_cast("date")
