"""ISO-8859-15 text through Spark's ISO-8859-1 codec.

The two charsets differ in eight positions only, so reading the bytes as
ISO-8859-1 and swapping those eight characters is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The eight code points in both charsets, in the same order.
_LATIN1 = "¤¦¨´¸¼½¾"
_LATIN9 = "€ŠšŽžŒœŸ"


def from_latin9(read_as_latin1: Column) -> Column:
    return F.translate(read_as_latin1, _LATIN1, _LATIN9)


def to_latin9(text: Column) -> Column:
    """Inverse of :func:`from_latin9`, for text about to be written as ISO-8859-1."""
    return F.translate(text, _LATIN9, _LATIN1)
