"""Best-fit packing: length patterns fitted by non-negative least squares, the rest best-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from envlake.llm.common import slices, stored
from envlake.llm.tokens import MOST_REMEMBERED, SLICE, default_tokenizer, encoder

CAPACITY = 2048
BINS = 512  # classes of lengths that patterns are made of
GAIN = 1e-3  # share of the squared error that a round must remove
DEPTH = 3  # documents in a pattern


def patterns(bins: int = BINS, depth: int = DEPTH) -> np.ndarray:
    """All multisets of 1 to ``depth`` lengths from 1 to ``bins`` that add up to ``bins``.

    One row each, descending, filled with 0.
    """
    rows: list[tuple[int, ...]] = []

    def extend(prefix: tuple[int, ...], left: int) -> None:
        if left == 0:
            rows.append(prefix + (0,) * (depth - len(prefix)))
        elif len(prefix) < depth:
            top = min(left, prefix[-1] if prefix else bins)
            low = -(-left // (depth - len(prefix)))
            for x in range(top, low - 1, -1):
                extend((*prefix, x), left - x)

    extend((), bins)
    return np.array(rows, np.int64)


def fitted_counts(histogram: np.ndarray, shapes: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns with least ``|A x - histogram|``, by active sets.

    ``histogram[i]`` counts documents of class i, from 1. A holds how often each pattern uses
    each class. Columns enter by steepest slope and leave at 0, so at most as many patterns
    are used as there are classes. Rounds end when they hardly lessen the error.
    """
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0
    x = np.zeros(len(shapes))
    active = np.zeros(len(shapes), bool)

    def column(j: np.ndarray) -> np.ndarray:
        a = np.zeros((size, len(j)))
        for k in range(shapes.shape[1]):
            np.add.at(a, (shapes[j, k], np.arange(len(j))), 1.0)
        a[0] = 0
        return a

    rest, before = target.copy(), np.inf
    for _ in range(rounds):
        now = float(rest @ rest)
        if now > before * (1 - GAIN):
            break
        before = now
        padded = rest.copy()
        padded[0] = 0
        slope = padded[shapes].sum(axis=1)
        slope[active] = -np.inf
        if slope.max() <= 0.5:
            break
        # several columns enter at once if they share no class
        taken, added = np.zeros(size, bool), 0
        for j in np.argsort(-slope, kind="stable")[:64]:
            parts = shapes[j][shapes[j] > 0]
            if slope[j] > 0.5 and not taken[parts].any() and added < 16:
                active[j], added = True, added + 1
                taken[parts] = True
        while True:
            j = np.flatnonzero(active)
            a = column(j)
            z = np.linalg.solve(a.T @ a + 1e-7 * np.eye(len(j)), a.T @ target)
            if z.min() > 1e-9:
                x[:] = 0
                x[j] = z
                break
            low = z <= 1e-9
            step = np.min(x[j][low] / np.maximum(x[j][low] - z[low], 1e-12))
            x[j] += step * (z - x[j])
            gone = j[(x[j] <= 1e-9) & low]
            x[gone] = 0
            active[gone if len(gone) else j[low][:1]] = False
            if not active.any():
                break
        j = np.flatnonzero(active)
        rest = target - column(j) @ x[j]
    return x


@dataclass
class Layout:
    """Which document lengths stand in which sequences.

    Slot i takes ``count[i]`` documents of ``length[i]``, from rank ``rank[i]`` of that length
    on, one in each of the sequences ``sequence[i]``, ``sequence[i] + 1``, ... at ``offset[i]``.
    The number of slots depends on the number of different lengths, not of documents.
    """

    sequences: int = 0
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)


def layout(histogram: np.ndarray, capacity: int = CAPACITY, bins: int = BINS, depth: int = DEPTH) -> Layout:
    """Pack ``histogram[l]`` documents of each length l, 1 to ``capacity``, into few sequences.

    Lengths are classed by rounding up to ``capacity / bins``, patterns of classes are fitted
    to the classed histogram and their counts rounded down to what the histogram still holds.
    Documents left over are packed longest first into the fullest sequence that has room,
    those of the patterns included.
    """
    out = Layout()
    left = np.array(histogram, np.int64)
    used = np.zeros(len(left), np.int64)  # documents of each length that have a place
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, sequences)
    free: list[int] = []  # keys of room, ascending

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        for name, value in (("length", length), ("rank", int(used[length])), ("count", count), ("sequence", sequence), ("offset", offset)):
            getattr(out, name).append(value)
        used[length] += count
        left[length] -= count

    def open_(sequence: int, count: int, tokens: int) -> None:
        if tokens and count:
            if tokens not in room:
                room[tokens] = []
                insort(free, tokens)
            room[tokens].append((sequence, count))

    width = -(-capacity // bins)
    classes = -(-np.arange(len(left)) // width)
    if left[1:].any() and depth:
        shapes = patterns(bins, depth)
        classed = np.bincount(classes, weights=left, minlength=bins + 1)[: bins + 1].astype(np.int64)
        usable = (classed[shapes] > 0) | (shapes == 0)
        shapes = shapes[usable.all(axis=1)]
        wish = fitted_counts(classed, shapes) if len(shapes) else np.empty(0)
        still = classed.copy()
        for j in np.argsort(-wish, kind="stable"):
            parts = shapes[j][shapes[j] > 0]
            want = int(np.floor(wish[j] + 0.5))
            kinds, times = np.unique(parts, return_counts=True)
            want = min([want, *(still[kinds] // times).tolist()])
            if want <= 0:
                continue
            # exact lengths: of each class the longest first; the last document is the longest
            # one that fits, so that what the classes round up is not lost
            todo = [(out.sequences, want, 0)]
            out.sequences += want
            for c, last in zip(parts.tolist(), [False] * (len(parts) - 1) + [True], strict=True):
                after = []
                for sequence, count, offset in todo:
                    while count:
                        length = capacity - offset if last else min(c * width, capacity)
                        while not left[length]:
                            length -= 1
                        some = min(count, int(left[length]))
                        place(length, some, sequence, offset)
                        still[classes[length]] -= some
                        after.append((sequence, some, offset + length))
                        sequence, count = sequence + some, count - some
                todo = after
            for sequence, count, offset in todo:
                open_(sequence, count, capacity - offset)

    for length in range(capacity, 0, -1):
        while left[length]:
            at = bisect_left(free, length)
            count = int(left[length])
            if at == len(free):
                each = capacity // length
                full, rest = divmod(count, each)
                for sequences, times in ((full, each), (1 if rest else 0, rest)):
                    if sequences:
                        for k in range(times):
                            place(length, sequences, out.sequences, k * length)
                        open_(out.sequences, sequences, capacity - times * length)
                        out.sequences += sequences
                continue
            tokens = free[at]
            sequence, there = room[tokens].pop()
            if not room[tokens]:
                del room[tokens]
                free.pop(at)
            some = min(count, there)
            place(length, some, sequence, capacity - tokens)
            open_(sequence, some, tokens - length)
            if there > some:
                open_(sequence + some, there - some, tokens)
    return out


def _pieces(path: str, capacity: int, with_ids: bool, remembered: int = MOST_REMEMBERED):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = encoder(path, remembered)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text", SLICE):
            ids, offsets = memo.encode(batch.column("text"))
            total = np.diff(offsets)
            pieces = -(-total // capacity)
            owner = np.repeat(np.arange(len(total)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = total - (pieces - 1) * capacity  # the first piece takes what is over
            start = np.where(number == 0, 0, head[owner] + (number - 1) * capacity)
            length = np.where(number == 0, head[owner], capacity)
            low = offsets[:-1][owner] + start
            flat = np.ascontiguousarray(ids, "<u4")
            crc = np.fromiter((zlib.crc32(flat[a : a + n]) for a, n in zip(low.tolist(), length.tolist(), strict=True)), np.int64, len(low))
            order = np.argsort(length, kind="stable")  # rank of each piece among those of its length
            ordered = length[order]
            first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
            rank = seen[length] + place
            seen += np.bincount(length, minlength=capacity + 1)
            columns = {
                "id": batch.column("id").take(pa.array(owner)),
                "piece": pa.array(number.astype(np.int32)), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array(crc), "part": pa.array(np.full(len(low), part, np.int32)), "place": pa.array(rank),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets_of(length)), pa.array(flat.astype(np.int32)))
            yield pa.record_batch(columns)
        memo.rest()

    return run


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(lengths)].astype(np.int32)


def _placed(plan: Layout):
    """Sequence and offset of pieces by (length, rank)."""
    length = np.array(plan.length, np.int64)
    rank = np.array(plan.rank, np.int64)
    order = np.lexsort((rank, length))
    length, rank = length[order], rank[order]
    sequence, offset = np.array(plan.sequence, np.int64)[order], np.array(plan.offset, np.int64)[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(length, np.arange(length.max(initial=0) + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("length").to_numpy()
            mine = batch.column("rank").to_numpy()
            low, high = first[size], first[size + 1]  # slots of the length; the last with rank <= mine
            high = high - 1
            while (low < high).any():
                middle = (low + high + 1) // 2
                right = rank[middle] <= mine
                low = np.where(right, middle, low)
                high = np.where(right, high, middle - 1)
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence[low] + mine - rank[low]), pa.array(offset[low])],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    remembered: int = MOST_REMEMBERED,
) -> DataFrame:
    """Pieces of all texts in token sequences of at most ``capacity``, as few as possible.

    One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` (from 0, none left out), ``offset`` and, if wanted, ``ids``. A text is its
    byte-level BPE ids and a closing 0, so a null or empty one is one token long. Longer ones
    are cut into pieces of ``capacity``, the first of which takes what is over. Rows with the
    same or no id are packed each; an empty table gives an empty one. Other columns of
    ``docs`` are not returned, whatever their names.

    Texts are encoded in place and written once, with the rank of each piece among those of
    its length in the partition. Only counts by partition and length are shuffled and added
    up; the driver sees the histogram, one number for each length. The layout made from it
    has some thousand slots whatever the number of documents. A task keeps the ids of at most ``remembered``
    pieces of text (131,072 at least): fewer take less memory and more time, and change no row.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, part int, place long"
    pieces = stored(
        docs.select(F.col(id_col).alias("id"), body.alias("text")).mapInArrow(
            _pieces(tokenizer or default_tokenizer(), capacity, with_ids, remembered), schema + (", ids array<int>" if with_ids else "")
        ),
        "pieces",
    )
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    plan = layout(histogram, capacity)
    by_part = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    columns = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    types = {f.name: f.dataType.simpleString() for f in pieces.schema}
    placed = ranked.select(*columns, "rank").mapInArrow(
        _placed(plan), ", ".join(f"{c} {types[c]}" for c in columns) + ", sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)
