"""Wide -> long. NULL cells do not become rows.

The cells of a row are exploded as one array: a single scan and no shuffle,
however many columns are melted, and code that stays small enough to be compiled
(an ``Expand`` repeats every id column in each of its 24 or 13 projections).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from envlake.functions import locale_decimal
from envlake.schemas import HOURS, MEASURES


def _cells(
    wide: DataFrame, ids: Sequence[str], cells: Sequence[Column | str], value: str
) -> DataFrame:
    """Id columns, ``__pos`` (which cell, from 0) and ``value``, without NULL values."""
    return wide.select(
        *_quoted(ids), F.posexplode(F.array(*cells)).alias("__pos", value)
    ).where(F.col(value).isNotNull())


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def parse_cells(long: DataFrame, value: str = "valor") -> DataFrame:
    """Text cells as numbers; a cell that is no number gives no row.

    Exploding an array of one keeps the NULL filter above the parsed value; on a
    plain column it would be pushed down and every text parsed twice.
    """
    others = [c for c in long.columns if c != value]
    number = locale_decimal(F.col(value))
    return long.select(*_quoted(others), F.explode(F.array(number)).alias(value)).where(
        F.col(value).isNotNull()
    )


def name_at(names: Sequence[str], position: Column) -> Column:
    """The name at a position counted from 0."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position + 1)


def position_of(names: Sequence[str], name: Column) -> Column:
    """Inverse of :func:`name_at`; -1 for other names."""
    return (F.array_position(F.array(*[F.lit(n) for n in names]), name) - 1).cast("int")


def unpivot_hours(
    wide: DataFrame,
    ids: Sequence[str] | None = None,
    hours: Sequence[str] = HOURS,
    label: bool = True,
) -> DataFrame:
    """One row per non-NULL hour cell: the id columns, ``hora`` and ``valor``.

    ``hora`` is the label (``h01`` ..) or, without ``label``, the hour itself
    (0 ..), which saves parsing the label on every row. Without ``ids`` every
    column that is not an hour is kept.
    """
    if ids is None:
        labels = {h.lower() for h in hours}
        ids = [c for c in wide.columns if c.lower() not in labels]
    long = _cells(wide, ids, _quoted(hours), "valor")
    return long.select(
        *_quoted(ids),
        (name_at(hours, F.col("__pos")) if label else F.col("__pos")).alias("hora"),
        "valor",
    )


def unpivot_measures(
    wide: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str | Column] = MEASURES,
    label: bool = True,
) -> DataFrame:
    """One row per non-NULL measure: the id columns, ``variable_meteo`` and ``valor``.

    ``measures`` maps the variable's name to its column. ``variable_meteo`` is that
    name or, without ``label``, its position in ``measures``.
    """
    cells = [f"`{c}`" if isinstance(c, str) else c for c in measures.values()]
    long = _cells(wide, ids, cells, "valor")
    variable = name_at(list(measures), F.col("__pos")) if label else F.col("__pos")
    return long.select(*_quoted(ids), variable.alias("variable_meteo"), "valor")
