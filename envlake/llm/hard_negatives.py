"""Hard negatives by threshold joins over an index without the dimensions that norms cover."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from envlake.llm.common import dropped, give_back, stored
from envlake.llm.vectors import (
    Best, Ids, Wave, best_of, exact_kind, flat, matrices, two_steps, usable_vectors, waves,
)

BLOCK_ROWS = 4096
CHUNK = 8  # dimensions whose products are added between two tests
SPARE = 1 + 1e-9  # bounds from norms are rounded up
LEVELS = (0.5, 0.25, 0.1)  # first thresholds, as shares of the largest product of two norms
STEPS = (0.25, 0.5, 1.0)  # first thresholds of a window, as shares of its height from the top


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """The norm of each vector's components from each chunk on, and a last column of zeros."""
    n, d = vectors.shape
    squares = np.add.reduceat(np.square(vectors, dtype=np.float64), np.arange(0, d, CHUNK), axis=1)
    tails = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.hstack([np.sqrt(tails) * SPARE, np.zeros((n, 1))])


class SuffixIndex:
    """Rows of a block with as many leading dimensions as a threshold needs.

    From the chunk ``first`` on, a row's dimensions are not indexed: with them alone it
    cannot reach the threshold of any query. Rows are ordered so that each chunk's postings are
    the first rows of the block.
    """

    def __init__(self, rows: np.ndarray, queries: np.ndarray, thresholds: np.ndarray):
        norms, asked = suffix_norms(rows), suffix_norms(queries)
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(thresholds[:, None] > 0, asked / thresholds[:, None], np.inf).max(axis=0)
            covered = norms * reach < 1
        covered[:, -1] = True
        first = covered.argmax(axis=1)
        self.order = np.argsort(-first, kind="stable")
        self.rows, self.norms, self.first = rows[self.order], norms[self.order], first[self.order]
        self.queries, self.asked, self.thresholds = queries, asked, thresholds[:, None]

    def join(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all wanted pairs whose score reaches the query's threshold."""
        n, chunks = len(self.rows), self.norms.shape[1] - 1
        scores = np.zeros((len(self.queries), n), self.rows.dtype)
        for c in range(chunks):  # traverse the postings
            m = int(np.searchsorted(-self.first, -c, side="left"))  # rows that index this chunk
            if m:
                at = slice(c * CHUNK, (c + 1) * CHUNK)
                scores[:, :m] += self.queries[:, at] @ self.rows[:m, at].T
        rest = self.asked[:, self.first] * self.norms[np.arange(n), self.first]
        alive = wanted[:, self.order] & (scores + rest >= self.thresholds)
        for c in range(int(self.first.min(initial=chunks)), chunks):  # complete what is left
            m = int(np.searchsorted(-self.first, -c, side="left"))
            at, part = slice(c * CHUNK, (c + 1) * CHUNK), alive[:, m:]
            left = np.count_nonzero(part)
            if left * 8 > part.size:
                scores[:, m:] += self.queries[:, at] @ self.rows[m:, at].T
                rest = self.asked[:, c + 1, None] * self.norms[m:, c + 1]
                part &= scores[:, m:] + rest >= self.thresholds
            elif left:
                q, r = np.nonzero(part)
                r += m
                scores[q, r] += (self.queries[q, at] * self.rows[r, at]).sum(axis=1)
                rest = self.asked[q, c + 1] * self.norms[r, c + 1]
                alive[q, r] = scores[q, r] + rest >= self.thresholds[q, 0]
        q, r = np.nonzero(alive)
        return q, self.order[r], scores[q, r]


def _blocks(wave: Wave, batches: Iterator[pa.RecordBatch], ids: Ids) -> Iterator[tuple]:
    """All blocks of a partition's rows with all blocks of the wave.

    Yields (from, to, queries, rows, the rows' keys, whether a row has the query's label).
    """
    known = pc.unique(wave.labels)
    mine = pc.index_in(wave.labels, value_set=known).to_numpy()
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        label = pc.fill_null(pc.index_in(batch.column("label"), value_set=known), -1).to_numpy()
        ids.add(keys, batch.column("id"))
        for low, high, cells in matrices(*flat(batch.column("vec")), BLOCK_ROWS):
            for a, b, asked in wave.blocks():
                d, kind = min(asked.shape[1], cells.shape[1]), exact_kind(asked, cells)
                asked, part = asked[:, :d].astype(kind), cells[:, :d].astype(kind)
                if not d:  # all scores are 0
                    asked, part = np.zeros((b - a, 1)), np.zeros((high - low, 1))
                yield a, b, asked, part, keys[low:high], mine[a:b, None] == label[low:high]


def _lowered(
    queries: np.ndarray, rows: np.ndarray, wanted: np.ndarray, thresholds: Callable[[int], np.ndarray],
    filled: Callable[[int], np.ndarray], add: Callable, levels: int,
) -> None:
    """Threshold joins with lower and lower thresholds, until each query's windows are full.

    A query that is full stops; each join adds only the pairs below the one before.
    """
    above = np.full(len(queries), np.inf)
    todo = np.arange(len(queries))
    for level in range(levels):
        least = thresholds(level)[todo]
        if len(todo):
            index = SuffixIndex(rows, queries[todo], least)
            q, r, score = index.join(wanted[todo])
            new = score < above[todo][q]
            add(todo[q[new]], r[new], score[new])
            above[todo] = least
        todo = np.setdiff1d(todo, np.flatnonzero(filled(level)), assume_unique=True)


def _positives(wave: Wave, k: int, start: np.ndarray, columns: list[str]):
    """A partition's best rows of each anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids = Best(len(wave), k), Ids()
        for a, b, asked, rows, keys, alike in _blocks(wave, batches, ids):
            wanted = alike & (wave.keys[a:b, None] != keys)
            most = np.linalg.norm(asked.astype(float), axis=1) * np.linalg.norm(rows.astype(float), axis=1).max(initial=0)
            known = np.maximum(start[a:b], best.least()[a:b].astype(float))

            def least(level: int) -> np.ndarray:
                share = LEVELS[level] if level < len(LEVELS) else -np.inf
                return np.where(known > -np.inf, known, share * np.maximum(most, 1))

            def full(level: int, a: int = a, b: int = b) -> np.ndarray:
                return (best.least()[a:b] > -np.inf) | (least(level) <= known)

            def add(q: np.ndarray, r: np.ndarray, score: np.ndarray, a: int = a) -> None:
                best.add(a + q, score, keys[r])

            _lowered(asked, rows, wanted, least, full, add, len(LEVELS) + 1)
        anchor, score, key = best.found()
        if len(anchor):
            yield pa.RecordBatch.from_arrays([pa.array(wave.keys[anchor]), pa.array(key), ids.of(key), pa.array(score)], columns)
        give_back()

    return run


def _negatives(wave: Wave, k: int, windows: dict[str, np.ndarray], start: np.ndarray, columns: list[str]):
    """A partition's best rows of other labels in each window of each anchor.

    ``windows``: line of the anchor in the wave, lowest and highest score, anchors ascending.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, low, high = windows["owner"], windows["low"], windows["high"]
        best, ids = Best(len(owner), k), Ids()
        for a, b, asked, rows, keys, alike in _blocks(wave, batches, ids):
            w0, w1 = np.searchsorted(owner, [a, b])
            if w0 == w1:
                continue
            mine, lo, hi = owner[w0:w1] - a, low[w0:w1], high[w0:w1]
            wanted = ~alike & np.isin(np.arange(b - a), mine)[:, None]
            held = np.maximum(start[w0:w1], best.least()[w0:w1].astype(float))
            known = np.maximum(held, lo)

            def open_to(level: int) -> np.ndarray:
                return np.where(held > -np.inf, known, np.maximum(lo, np.floor(hi - STEPS[level] * (hi - lo))))

            def least(level: int) -> np.ndarray:
                out = np.full(b - a, np.inf)
                np.minimum.at(out, mine, open_to(level))
                return out

            def full(level: int) -> np.ndarray:
                done = (best.least()[w0:w1] > -np.inf) | (open_to(level) <= known)
                out = np.ones(b - a, bool)
                np.logical_and.at(out, mine, done)
                return out

            def add(q: np.ndarray, r: np.ndarray, score: np.ndarray) -> None:
                first, last = np.searchsorted(mine, q), np.searchsorted(mine, q, side="right")
                for j in range(int((last - first).max(initial=0))):  # an anchor's windows, few
                    some = first + j < last
                    w = (first + j)[some]
                    s = score[some]
                    inside = (s >= known[w]) & (s <= hi[w])
                    best.add(w0 + w[inside], s[inside], keys[r[some][inside]])

            _lowered(asked, rows, wanted, least, full, add, len(STEPS))
        window, score, key = best.found()
        if len(window):
            out = [
                pa.array(wave.keys[owner[window]]), pa.array(windows["positive"][window]), pa.array(key), ids.of(key), pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(out, columns)
        give_back()

    return run


def _reached(first: DataFrame, group: list[str], k: int) -> dict[tuple, int]:
    """The ``k``-th score of each group that has as many."""
    table = first.where(F.col("rank") == k).select(*group, "score").toArrow().to_pydict()
    return dict(zip(zip(*[table[g] for g in group], strict=True), table["score"], strict=True))


def hard_negatives(
    rows: DataFrame, id_col: str, vec_col: str, label_col: str, anchors: Column,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """For each anchor and each of its nearest rows of the same label, the nearest rows of other
    labels whose score is between ``low`` and ``high`` percent of the positive's.

    ``vec_col`` holds whole numbers (see :func:`envlake.llm.vectors.quantised`); scores are
    exact inner products with the anchor, higher ones first, ties by smaller id, null ids last. An
    anchor has ``positives`` positives, or all where there are fewer, and each of them up to
    ``negatives`` negatives. Returns anchor_id, positive_id, rank (int, from 1), negative_id,
    positive_score, negative_score; a positive without negatives has no row, so a positive with a
    negative score has none either. Rows with a null label or a vector that is null or holds a null or
    non-finite component take no part; a shorter vector counts as padded with zeros. An anchor is
    only left out of its own positives: rows that repeat it compete, and a repeated anchor
    has rows of its own. An empty table gives an empty result. Other columns are ignored,
    whatever their names.
    """
    usable = usable_vectors(rows, id_col, vec_col, anchors, F.col(f"`{label_col}`"))
    kind = usable.schema["id"].dataType
    like = StructType([StructField("anchor", LongType()), StructField("key", LongType()), StructField("id", kind), StructField("score", LongType())])
    unlike = StructType([like.fields[0], StructField("positive", LongType()), *like.fields[1:]])
    out = StructType([
        StructField("anchor_id", kind), StructField("positive_id", kind), StructField("rank", IntegerType()),
        StructField("negative_id", kind), StructField("positive_score", LongType()), StructField("negative_score", LongType()),
    ])
    early, late = two_steps(usable)
    lists = []
    for wave in waves(usable):
        names = wave.keys.tolist()
        line = {key: i for i, key in enumerate(names)}
        ids = usable.where("asks").select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))

        start = np.full(len(wave), -np.inf)
        first = stored(best_of(early.mapInArrow(_positives(wave, positives, start, like.names), like), ["anchor"], positives), "first-positives")
        for (key,), score in _reached(first, ["anchor"], positives).items():
            start[line[key]] = score
        rest = late.mapInArrow(_positives(wave, positives, start, like.names), like)
        found = stored(best_of(rest.unionByName(first.drop("rank")), ["anchor"], positives).drop("rank"), "positives")
        dropped(first)

        # windows of this wave, `positives` at most for each anchor: 100 * n in [low * p, high * p]
        pairs = found.select("anchor", "key", "score").toArrow()
        score = pairs.column("score").to_numpy()
        owner = np.array([line[key] for key in pairs.column("anchor").to_pylist()], np.int64)
        key = pairs.column("key").to_numpy()
        order = np.lexsort((key, owner))
        below, above = -((-low * score) // 100), high * score // 100
        order = order[(below <= above)[order]]
        windows = {
            "owner": owner[order], "positive": key[order],
            "low": below[order].astype(float), "high": above[order].astype(float),
        }
        start = np.full(len(order), -np.inf)
        group = ["anchor", "positive"]
        first = stored(best_of(early.mapInArrow(_negatives(wave, negatives, windows, start, unlike.names), unlike), group, negatives), "first-negatives")
        reached = _reached(first, group, negatives)
        start = np.array([reached.get((names[o], p), -np.inf) for o, p in zip(windows["owner"], windows["positive"].tolist(), strict=True)])
        rest = late.mapInArrow(_negatives(wave, negatives, windows, start, unlike.names), unlike)
        merged = best_of(rest.unionByName(first.drop("rank")), group, negatives)
        known = found.select("anchor", F.col("key").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        whole = merged.join(known, group).join(ids, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        lists.append(stored(whole, "negatives"))
        dropped(first)
        dropped(found)
    dropped(usable)
    return reduce(DataFrame.unionByName, lists) if lists else usable.sparkSession.createDataFrame([], out)
