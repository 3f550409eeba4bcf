"""The datasets that the named jobs read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from envlake.schemas import (
    AIR_TYPES,
    AIR_UNIT_TYPES,
    AIR_YEARS,
    POLLUTANTS,
    WEATHER_TYPES,
    WEATHER_UNIT_TYPES,
)


@dataclass(frozen=True)
class DatasetSpec:
    """A file (or folder of files) below the data root.

    ``latin9`` is the charset of older files, ``multi_line`` allows line breaks
    inside quotes. ``types`` declares the columns that jobs rely on. Other columns are read as
    text, or have their type inferred with ``infer_rest``, which costs one more
    pass and is meant for small dimensions.

    A cell that does not fit its declared type fails the staging. ``max_rejects`` allows so many
    in the files that are staged at once: such a cell is NULL in the copy, and
    :func:`envlake.sources.rejects` lists it.
    """

    path: str
    sep: str = ";"
    types: Mapping[str, str] = field(default_factory=dict)
    infer_rest: bool = False
    latin9: bool = False
    multi_line: bool = False
    max_rejects: int = 0


def as_spec(entry: DatasetSpec | str) -> DatasetSpec:
    """A bare path is a ``;``-delimited dataset whose types are inferred."""
    return DatasetSpec(entry, infer_rest=True) if isinstance(entry, str) else entry


def _hourly(path: str) -> DatasetSpec:
    return DatasetSpec(f"data/raw/datos_aire/{path}", ";", AIR_TYPES)


# Dataset keys and file locations.
CATALOG: dict[str, DatasetSpec | str] = {
    **{f"aire{y}": _hourly(f"DatosAire20{y}.csv") for y in AIR_YEARS},
    **{f"aire24{p}": _hourly(f"DatosAire2024/{p}_HH_2024.csv") for p in POLLUTANTS.values()},
    "dim_variable_aire_csv": DatasetSpec(
        "data/raw/static_files/variable_aire.csv", ",", AIR_UNIT_TYPES, infer_rest=True
    ),
    "aemet_climatologia_diaria": DatasetSpec(
        "data/raw/datos_meteo/aemet_diarios_2020_2024.csv", ",", WEATHER_TYPES
    ),
    "dim_variable_meteo_csv": DatasetSpec(
        "data/raw/static_files/variables_meteo.csv", ",", WEATHER_UNIT_TYPES, infer_rest=True
    ),
}
