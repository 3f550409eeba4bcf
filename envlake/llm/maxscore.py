"""Exact top-k search by inner product: MaxScore over blocks of postings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from envlake.llm.common import dropped, give_back, stored
from envlake.llm.vectors import (
    Best, Ids, Wave, best_of, exact_kind, flat, matrices, two_steps, usable_vectors, waves,
)

BLOCK_ROWS = 4096
PROBED = 4  # non-essential terms looked up between two tests


def split_terms(bounds: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's terms by descending score bound, the bounds' sums from each place on, and the
    number of essential terms: the others together stay below the query's threshold."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, axis=1)
    rest = np.zeros((len(bounds), bounds.shape[1] + 1), bounds.dtype)
    rest[:, :-1] = np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1]
    below = rest < threshold[:, None]
    essential = np.where(below.any(axis=1), below.argmax(axis=1), bounds.shape[1])
    return order, rest, essential


def search_block(queries: np.ndarray, postings: np.ndarray, threshold: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores) of all rows that reach the query's threshold, perhaps some more.

    ``postings`` has one line for each term (a dimension) with the rows' values. A term's
    contribution is at most its bound in this block. Essential terms are added up over their
    whole postings; a row goes on to the next terms only while its sum and the bounds of the
    terms that it has not met reach the threshold.
    """
    high, low = postings.max(axis=1), postings.min(axis=1)
    bounds = np.maximum(queries * high, queries * low)
    order, rest, essential = split_terms(bounds, threshold)
    for q in np.flatnonzero(rest[:, 0] >= threshold):  # others have no row here that could compete
        terms, e, least = order[q], int(essential[q]), threshold[q]
        sums = queries[q, terms[:e]] @ postings[terms[:e]]
        rows = np.flatnonzero(sums + rest[q, e] >= least)
        sums = sums[rows]
        for at in range(e, len(terms), PROBED):
            if not len(rows):
                break
            some = terms[at : at + PROBED]
            sums = sums + queries[q, some] @ postings[np.ix_(some, rows)]
            alive = sums + rest[q, min(at + PROBED, len(terms))] >= least
            rows, sums = rows[alive], sums[alive]
        if len(rows):
            yield q, rows, sums


def _search(wave: Wave, k: int, start: np.ndarray, columns: list[str]):
    """A partition's best rows of each query, given scores that the query has reached elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids = Best(len(wave), k), Ids()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            ids.add(keys, batch.column("id"))
            for low, high, cells in matrices(*flat(batch.column("vec")), BLOCK_ROWS):
                own = keys[low:high]
                for a, b, asked in wave.blocks():
                    d, kind = min(asked.shape[1], cells.shape[1]), exact_kind(asked, cells)
                    if d:
                        postings = np.ascontiguousarray(cells[:, :d].T, dtype=kind)
                    else:  # all scores are 0
                        asked, postings, d = np.zeros((b - a, 1)), np.zeros((1, high - low)), 1
                    least = np.maximum(start[a:b], best.least()[a:b]).astype(kind)
                    hits = []
                    for q, rows, scores in search_block(asked[:, :d].astype(kind), postings, least):
                        other = own[rows] != wave.keys[a + q]
                        rows, scores = rows[other], scores[other]
                        if len(rows) > k:
                            top = np.lexsort((own[rows], -scores))[:k]
                            rows, scores = rows[top], scores[top]
                        hits.append((np.full(len(rows), a + q), scores, own[rows]))
                    if hits:
                        best.add(*map(np.concatenate, zip(*hits, strict=True)))
        query, score, key = best.found()
        if len(query):
            out = [pa.array(wave.keys[query]), wave.ids.take(pa.array(query)), pa.array(key), ids.of(key), pa.array(score)]
            yield pa.RecordBatch.from_arrays(out, columns)
        give_back()

    return run


def top_k(rows: DataFrame, id_col: str, vec_col: str, queries: Column, k: int = 5) -> DataFrame:
    """The ``k`` highest inner products of each row for which ``queries`` holds, with all other rows.

    ``vec_col`` holds whole numbers (see :func:`envlake.llm.vectors.quantised`); scores are exact.
    Returns query_id, rank (int, from 1), candidate_id and score (long), by score descending,
    ties to the smaller id, null ids last. Vectors that are null or hold a null or
    non-finite component take no part; a shorter one counts as padded with zeros, so an empty one scores
    0. A row is only left out of its own list: rows that repeat its id or vector compete, and a
    repeated query has a list for each row. Fewer than ``k`` other rows give shorter lists, an
    empty table an empty result. Other columns are ignored, whatever their names. A score
    beyond 2 ** 62 fails the job.
    """
    usable = usable_vectors(rows, id_col, vec_col, queries)
    kind = usable.schema["id"].dataType
    hit = StructType([
        StructField("query", LongType()), StructField("query_id", kind), StructField("key", LongType()),
        StructField("candidate_id", kind), StructField("score", LongType()),
    ])
    early, late = two_steps(usable)
    lists = []
    for wave in waves(usable):
        nothing = np.full(len(wave), -np.inf)
        first = stored(best_of(early.mapInArrow(_search(wave, k, nothing, hit.names), hit), ["query"], k), "first-hits")
        reached = first.where(F.col("rank") == k).select("query", "score").toArrow()
        at = dict(zip(reached.column("query").to_pylist(), reached.column("score").to_pylist(), strict=True))
        start = np.array([at.get(key, -np.inf) for key in wave.keys.tolist()])
        rest = late.mapInArrow(_search(wave, k, start, hit.names), hit)
        merged = best_of(rest.unionByName(first.drop("rank")), ["query"], k)
        lists.append(stored(merged, "hits"))
        dropped(first)
    dropped(usable)
    if not lists:
        return usable.sparkSession.createDataFrame([], StructType([
            StructField("query_id", kind), StructField("rank", IntegerType()), StructField("candidate_id", kind), StructField("score", LongType()),
        ]))
    return reduce(DataFrame.unionByName, lists).select("query_id", "rank", "candidate_id", "score")
