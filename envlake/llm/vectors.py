"""What the searches over vectors share: usable rows, waves of queries, blocks and best lists.

A search lets every partition of the rows meet all queries of a wave, a bounded number of
vectors that is broadcast, and merges the partitions' best rows. It runs in two steps over
disjoint rows: the best of the first sixteenth are the thresholds from which the rest starts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from envlake.llm.common import dropped, stored

WAVE_VALUES = 1 << 22  # components of all queries that are broadcast at once: 32 MB
BLOCK_VALUES = 1 << 18  # components of the rows or queries that are laid out as one matrix
FIRST_STEP = 16  # one row in so many is searched first


def quantised(vector: Column, scale: float) -> Column:
    """Each component as the whole number floor(scale * component), a double."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger ones are whole

    return F.transform(vector, whole)


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str, asks: Column, label: Column | None = None) -> DataFrame:
    """(key, id, vec, asks, label) of the rows with a vector of finite components, stored.

    ``key`` numbers the rows in ascending order of the id, nulls last, so it stands for the id
    where ties are decided, whatever the id's type; rows that repeat an id have keys of their own.
    ``label`` is text. A shorter vector counts as one with zeros at its end.
    """
    vec = F.col(f"`{vec_col}`")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.lit("") if label is None else label.cast("string")
    usable = rows.where(vec.isNotNull() & finite).select(
        F.col(f"`{id_col}`").alias("id"),
        F.transform(vec, lambda x: x.cast("double")).alias("vec"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        label.alias("label"),
    )
    numbered = usable.where("label is not null").orderBy(F.col("id").asc_nulls_last())
    return stored(numbered.select(F.monotonically_increasing_id().alias("key"), "*"), "vectors")


@dataclass
class Wave:
    """Some of the queries: their keys, ids, labels and vectors."""

    keys: np.ndarray
    ids: pa.Array
    labels: pa.Array
    offsets: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.keys)

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        return matrices(self.offsets, self.values, 256)


def waves(rows: DataFrame) -> Iterator[Wave]:
    """The queries among the rows, about ``WAVE_VALUES`` components at a time.

    They are dealt by a hash of the key, so a wave keeps to that size as closely as any two
    waves do to each other; only one is on the driver at a time.
    """
    asked = stored(rows.where("asks").drop("asks"), "queries")
    total = asked.agg(F.sum(F.size("vec") + 8)).first()[0] or 0
    n = -(-total // WAVE_VALUES)
    for i in range(n):
        table = asked.where(F.pmod(F.xxhash64("key"), F.lit(n)) == i).toArrow().combine_chunks()
        if table.num_rows:
            vec = table.column("vec").combine_chunks()
            offsets, values = flat(vec)
            one = lambda name, t=table: t.column(name).combine_chunks()
            yield Wave(one("key").to_numpy(), one("id"), one("label"), offsets, values)
    dropped(asked)


def flat(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and components of a column of vectors."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    return np.r_[0, np.cumsum(sizes)], np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)


def matrices(offsets: np.ndarray, values: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, matrix) of blocks of at most ``most`` vectors and ``BLOCK_VALUES`` cells."""
    sizes, at = np.diff(offsets), 0
    while at < len(sizes):
        width = np.maximum.accumulate(sizes[at : at + most])
        fits = width * np.arange(1, len(width) + 1) <= BLOCK_VALUES
        to = at + max(1, int(fits.argmin()) if not fits.all() else len(fits))
        cells = np.zeros((to - at, int(sizes[at:to].max(initial=0))))
        inside = np.arange(cells.shape[1]) < sizes[at:to, None]
        cells[inside] = values[offsets[at] : offsets[to]]
        yield at, to, cells
        at = to


def exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """A float type in which every partial sum of products of these whole numbers is exact."""
    d = min(a.shape[1], b.shape[1])
    most = float(np.abs(a[:, :d]).max(axis=0, initial=0) @ np.abs(b[:, :d]).max(axis=0, initial=0))
    if most < 2.0**52:
        return np.float64
    if most < 2.0**62 and np.finfo(np.longdouble).nmant >= 63:
        return np.longdouble
    raise OverflowError("a score may not fit a long")


class Best:
    """The best ``k`` (score, key) of each of ``n`` groups: higher scores, then lower keys, first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf, np.longdouble)
        self.keys = np.full((n, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        """The lowest kept score of each group, minus infinity where fewer than ``k`` are kept."""
        return self.scores[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(group):
            return
        touched = np.unique(group)
        g = np.concatenate([np.repeat(touched, self.k), group])
        s = np.concatenate([self.scores[touched].ravel(), score.astype(np.longdouble)])
        k = np.concatenate([self.keys[touched].ravel(), key])
        order = np.lexsort((k, -s, g))
        g, s, k = g[order], s[order], k[order]
        place = np.arange(len(g)) - np.searchsorted(g, g)
        kept = place < self.k
        self.scores[g[kept], place[kept]], self.keys[g[kept], place[kept]] = s[kept], k[kept]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, score and key of everything kept."""
        group, place = np.nonzero(np.isfinite(self.scores))
        return group, self.scores[group, place].astype(np.int64), self.keys[group, place]


class Ids:
    """Ids of the rows that a task has read, by key."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.ids: list[pa.Array] = []

    def add(self, keys: np.ndarray, ids: pa.Array) -> None:
        self.keys.append(keys)
        self.ids.append(ids)

    def of(self, keys: np.ndarray) -> pa.Array:
        every = np.concatenate(self.keys)
        order = np.argsort(every)
        return pa.chunked_array(self.ids).take(pa.array(order[np.searchsorted(every[order], keys)])).combine_chunks()


def best_of(hits: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    """The best ``k`` rows (score, key) of each group, with their rank from 1.

    Each task sends its ``k`` best of a group at most.
    """
    by = Window.partitionBy(*group).orderBy(F.desc("score"), "key")
    return hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def two_steps(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One in ``FIRST_STEP`` rows, and all others."""
    early = F.pmod(F.xxhash64("key", F.lit("first")), F.lit(FIRST_STEP)) == 0
    rows = rows.select("key", "id", "vec", "label")
    return rows.where(early), rows.where(~early)
