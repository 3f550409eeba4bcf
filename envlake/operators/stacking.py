"""UNION ALL by position and by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import zip_longest

from pyspark.sql import DataFrame, functions as F


def stack_by_position(frames: Sequence[DataFrame], cast_to_first: bool = False) -> DataFrame:
    """All rows of all frames; names (and with ``cast_to_first`` also types) of the first.

    Columns are matched by position only, so files whose headers spell a column
    differently still line up. Different widths are refused.
    """
    first, *rest = frames
    widths = [len(f.columns) for f in frames]
    if len(set(widths)) != 1:
        raise ValueError(f"frames to stack have different numbers of columns: {widths}")
    if cast_to_first:
        rest = [_retype(f, first) for f in rest]
    return reduce(DataFrame.union, rest, first)


def header_drift(frames: Mapping[str, DataFrame]) -> list[tuple[str, int, str | None, str | None, bool]]:
    """Where the columns of files to stack by position differ from the first one's: (file, position
    from 1, expected name, found name, whether the expected one stands elsewhere in the file).

    Names are compared without regard to case and blanks around. A name that merely is spelt otherwise
    lines up; one that stands elsewhere means that stacking by position would mix up columns.
    Only names are looked at, no row is read.
    """
    plain = {name: [c.strip().lower() for c in frame.columns] for name, frame in frames.items()}
    first = next(iter(plain.values()))
    found = []
    for name, columns in plain.items():
        for i, (want, got) in enumerate(zip_longest(first, columns)):
            if want != got:
                shown = [x[i] if i < len(x) else None for x in (next(iter(frames.values())).columns, frames[name].columns)]
                found.append((name, i + 1, *shown, want in columns))
    return found


def _retype(frame: DataFrame, like: DataFrame) -> DataFrame:
    if [f.dataType for f in frame.schema] == [f.dataType for f in like.schema]:
        return frame
    aligned = frame.toDF(*like.columns)
    return aligned.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in like.schema]
    )


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
