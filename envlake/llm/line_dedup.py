"""Line dedup: documents are aligned with those that had their passages first."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from envlake.llm.common import BLANK, dropped, free_name, give_back, maybe_in, slices, stored

MIN_BLOCK_WORDS = 20
MAX_BITS = 1 << 27  # of one table of longest_common()
FACTORS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd
WHOLE = np.uint64(0xA0761D6478BD642F)


def patience(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Patience diff over (place here, place there) of common lines, ascending by the first.

    Lines that occur once on either side are anchors; their longest increasing subsequence is kept.
    """
    here, there = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    anchors = [(a, b) for a, b in pairs if here[a] == 1 and there[b] == 1]
    tails: list[int] = []  # least last place of an increasing run, by length
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(anchors):
        k = bisect_left(tails, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
    matched = {}
    i = at[-1] if at else -1
    while i >= 0:
        matched[anchors[i][0]] = anchors[i][1]
        i = back[i]
    return sorted(matched.items())


def longest_common(here: Sequence[int], there: Sequence[int]) -> list[tuple[int, int]]:
    """A longest common subsequence as (place here, place there), by rows of bits.

    Takes len(here) * len(there) / 64 steps; the table of bits stays below ``MAX_BITS``, as
    larger ones are halved where the best subsequences of both halves meet.
    """
    if not here or not there:
        return []
    if len(here) > 1 and len(here) * len(there) > MAX_BITS:
        half = len(here) // 2
        low = _lengths(_bit_rows(here[:half], there)[1], len(there))
        high = _lengths(_bit_rows(here[half:][::-1], there[::-1])[1], len(there))
        cut = max(range(len(there) + 1), key=lambda j: low[j] + high[len(there) - j])
        rest = longest_common(here[half:], there[cut:])
        return longest_common(here[:half], there[:cut]) + [(a + half, b + cut) for a, b in rest]
    rows, _ = _bit_rows(here, there, keep=True)
    out = []
    i, j = len(here), len(there)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((i, j))
    return out[::-1]


def _bit_rows(here: Sequence[int], there: Sequence[int], keep: bool = False) -> tuple[list[int], int]:
    """A row of bits per place here (if kept) and the last: a 0 at j if the subsequence grows there."""
    places: dict[int, int] = {}
    for j, line in enumerate(there):
        places[line] = places.get(line, 0) | 1 << j
    full = row = (1 << len(there)) - 1
    rows = []
    for line in here:
        hit = row & places.get(line, 0)
        row = (row + hit | row - hit) & full
        if keep:
            rows.append(row)
    return rows, row


def _lengths(row: int, n: int) -> list[int]:
    """Length of the longest common subsequence with each of the n + 1 beginnings."""
    return [0, *accumulate(1 - (row >> j & 1) for j in range(n))]


def aligned(here: Sequence[int], there: Sequence[int]) -> list[tuple[int, int]]:
    """Patience diff of two whole documents: aligned places (here, there), ascending.

    Equal lines at both ends are aligned, then the anchors of :func:`patience` between them, and
    so on between the anchors. Where no line is unique, a longest common subsequence is.
    """
    out: list[tuple[int, int]] = []
    open_ = [(0, len(here), 0, len(there))]
    while open_:
        a, a_end, b, b_end = open_.pop()
        while a < a_end and b < b_end and here[a] == there[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and here[a_end - 1] == there[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        often, often_there = Counter(here[a:a_end]), Counter(there[b:b_end])
        if not often.keys() & often_there.keys():
            continue
        at = {x: j for j, x in enumerate(there[b:b_end], b) if often_there[x] == 1}
        anchors = patience([(i, at[x]) for i, x in enumerate(here[a:a_end], a) if often[x] == 1 and x in at])
        if anchors:
            out += anchors
            edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
            open_ += [(p + 1, q, r + 1, t) for (p, r), (q, t) in zip(edges, edges[1:], strict=False)]
        else:
            out += [(a + i, b + j) for i, j in longest_common(here[a:a_end], there[b:b_end])]
    return sorted(out)


def blocks(matched: Sequence[tuple[int, int]], words: Mapping[int, int] | Sequence[int], min_words: int = MIN_BLOCK_WORDS) -> list[int]:
    """Places here in blocks of at least ``min_words`` words.

    ``matched`` are the aligned places (here, there) of two documents, ascending; a block is a
    passage that goes on in both, and ``words`` has the words of each place here.
    """
    out: list[int] = []
    start = 0
    for i in range(1, len(matched) + 1):
        if i == len(matched) or matched[i] != (matched[i - 1][0] + 1, matched[i - 1][1] + 1):
            block = [a for a, _ in matched[start:i]]
            if sum(words[a] for a in block) >= min_words:
                out += block
            start = i
    return out


def without_lines(text: str, places: Sequence[int]) -> str:
    """The text without its lines of these places, which count lines with a word from 0."""
    gone, kept, place = set(places), [], 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            if place not in gone:
                kept.append(line)
            place += 1
        else:
            kept.append(line)
    return "\n".join(kept)


def run_bounds(words: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First lines, ends and documents of the runs by which documents are paired.

    ``words`` has the words of all lines of the documents in a row. From each line on, and up to
    each line, the shortest run of at least ``min_words`` words is taken, so every passage of as
    many words that two documents have in a row is covered by runs of both. Each two neighbours
    of so many words are a run too.
    """
    n = len(words)
    total = np.r_[0, np.cumsum(words, dtype=np.int64)]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(n)
    ends = np.maximum(np.searchsorted(total, total[:-1] + min_words), at + 1)
    starts = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, at)
    two = np.flatnonzero((ends == at + 1) & (at + 2 <= offsets[1:][doc]))
    low, high, of = np.r_[at, starts, two], np.r_[ends, at + 1, two + 2], np.r_[doc, doc, doc[two]]
    good = (low >= offsets[of]) & (high <= offsets[of + 1])
    _, one = np.unique(low[good] * (n + 1) + high[good], return_index=True)
    return low[good][one], high[good][one], of[good][one]


def run_keys(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, factor: int) -> np.ndarray:
    """A 64-bit hash of each run of lines from theirs: a polynomial of an odd factor."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[np.uint64(1), np.full(n, factor, np.uint64)])
        back = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(factor, -1, 1 << 64), np.uint64)])
        total = np.r_[np.uint64(0), np.cumsum(hashes * power[:n])]
        keys = (total[high] - total[low]) * back[low]
        return (keys ^ (keys >> np.uint64(29))) * np.uint64(FACTORS[0]) + (high - low).astype(np.uint64)


def _runs(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column("lines")
            values = lines.flatten()
            offsets = np.r_[0, np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False))].astype(np.int64)
            h1, h2, words = (values.field(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "words"))
            low, high, doc = run_bounds(words, offsets, min_words)
            # whole documents, told apart from runs, so that a copy meets the first of its kind
            whole = np.flatnonzero(np.add.reduceat(words, offsets[:-1]) >= min_words) if len(offsets) > 1 else np.empty(0, np.int64)
            low, high, doc = np.r_[low, offsets[whole]], np.r_[high, offsets[whole + 1]], np.r_[doc, whole]
            k1 = run_keys(h1.astype(np.int64).view(np.uint64), low, high, FACTORS[0])
            k2 = run_keys(h2.astype(np.int64).view(np.uint64), low, high, FACTORS[1])
            k1[len(low) - len(whole) :] ^= WHOLE
            columns = [batch.column(c).take(pa.array(doc)) for c in ("id", "row")]
            columns += [pa.array(k1.view(np.int64)), pa.array((k2 >> np.uint64(32)).astype(np.uint32).view(np.int32))]
            columns += [pa.array((x).astype(np.int32)) for x in (low - offsets[doc], high - low)]
            yield pa.record_batch(columns, ["id", "row", "k1", "k2", "at", "lines"])
        give_back()

    return run


def shared_blocks(
    lines: np.ndarray, words: np.ndarray, here: np.ndarray, there: np.ndarray, size: np.ndarray, min_words: int = MIN_BLOCK_WORDS
) -> list[int]:
    """Places of one document's lines in the blocks that it shares with another one.

    ``lines`` and ``words`` are hash and words of each of its lines; the lines from ``here[i]`` on are those
    from ``there[i]`` on in the other document, ``size[i]`` of them. Only these lines of both are aligned, so the
    work follows what is shared, however long the documents are.
    """
    steps = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    mine, other = np.repeat(here, size) + steps, np.repeat(there, size) + steps
    ours, theirs = np.unique(mine), np.unique(other, return_index=True)
    pairs = aligned(lines[ours].tolist(), lines[mine[theirs[1]]].tolist())
    return blocks([(int(ours[a]), int(theirs[0][b])) for a, b in pairs], words, min_words)


def _aligned(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                lines, words = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("here", "words"))
                runs = batch.column("runs")[i].values
                owner, at, there, size = (runs.field(c).to_numpy(zero_copy_only=False) for c in ("owner", "at", "there", "lines"))
                order = np.argsort(owner, kind="stable")
                gone: set[int] = set()
                for part in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
                    gone.update(shared_blocks(lines, words, at[part], there[part], size[part], min_words))
                found.append(sorted(gone))
            rows = [r for r, f in zip(batch.column("row").to_pylist(), found, strict=True) if f]
            yield pa.record_batch({
                "row": pa.array(rows, pa.int64()),
                "removed": pa.array([f for f in found if f], pa.list_(pa.int32())),
            })

    return run


def _rewritten(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            removed = batch.column(batch.num_columns - 1).to_pylist()
            texts = [without_lines(t, r) for t, r in zip(batch.column(text).to_pylist(), removed, strict=True)]
            i = batch.schema.names.index(text)
            yield batch.set_column(i, text, pa.array(texts, pa.string()))

    return run


def line_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """The columns of ``docs``, ``text`` without repeated passages, and ``removed``.

    ``removed`` lists the places of the deleted lines, counting lines with a word from 0; it
    is empty for texts left as they are. Documents are ordered by id, null ids last, then by
    row. A run of lines is owned by the first document that has it in a row. Every other
    document is aligned, by patience diff, with the owners of its runs of at least ``min_words``
    words (:func:`run_bounds`), of any line and however common, and with the first document of the
    same lines. The diff sees the lines of the runs that the two share. Blocks of at least ``min_words`` words that go on in
    both go from the later document. The first copy of a line always stays, so no line is lost.
    Lines are equal if their characters are; null and empty texts have none, and lines repeated
    inside one document stay. Of passages that stand in crossing order in two documents only
    those go that the diff aligns. Repeated rows are documents of their own: the later one loses
    its lines. An empty table gives an empty one. Columns named ``removed`` stay and the new one
    gets a leading underscore.

    A run that very many documents share costs one row for each, joined with its single owner:
    rows grow with the lines, never with pairs of documents, however common a run is. A document's
    lines travel once, and no other document's lines with them: an owner is known by the places of the runs.
    Only documents that lose lines are shuffled with their text.
    """
    names = docs.columns
    row, removed = free_name(names, "row"), free_name(names, "removed")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "line-rows")
    worded = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    line = F.transform(worded, lambda x: F.struct(
        F.xxhash64(x).alias("h1"), F.hash(x, F.char_length(x)).alias("h2"),
        F.size(F.filter(F.split(x, BLANK + "+"), lambda w: w != "")).alias("words"),
    ))
    listed = numbered.select(F.col(id_col).alias("id"), F.col(row).alias("row"), line.alias("lines"))
    listed = stored(listed.where(F.size("lines") > 0), "lines")
    keys = StructType([
        *listed.select("id", "row").schema, StructField("k1", LongType()),
        *[StructField(c, IntegerType()) for c in ("k2", "at", "lines")],
    ])
    runs = stored(listed.mapInArrow(_runs(min_words), keys), "line-runs")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "at")).alias("first")
    owners = (
        runs.groupBy("k1", "k2")
        .agg(first, F.min("row").alias("low"), F.max("row").alias("high"))
        .where("low != high")
        .select("k1", "k2", F.col("first.row").alias("owner"), F.col("first.at").alias("there"))
    )
    owners = stored(owners, "owners")
    # of each document its runs with their owners: no more than its own lines make up
    shared = (
        runs.join(owners.hint("merge"), ["k1", "k2"])  # either side grows with the input
        .where("row != owner")
        .groupBy("row")
        .agg(F.collect_list(F.struct("owner", "at", "there", "lines")).alias("runs"))
    )
    own = listed.select("row", F.col("lines.h1").alias("here"), F.col("lines.words").alias("words"))
    gone = shared.join(own.hint("merge"), "row").mapInArrow(_aligned(min_words), "row long, removed array<int>")
    gone = stored(gone, "removed")
    for done in (listed, runs, owners):
        dropped(done)

    gone = gone.select(F.col("row").alias(row), F.col("removed").alias(removed))
    marked, maybe = maybe_in(numbered, row, gone)
    same = marked.where(~F.col(maybe)).select(*names, F.array().cast("array<int>").alias(removed))
    changed = (
        marked.where(maybe)
        .join(gone.hint("merge"), row, "left")
        .select(*names, F.coalesce(removed, F.array().cast("array<int>")).alias(removed))
    )
    some = changed.where(F.size(removed) > 0)
    some = some.mapInArrow(_rewritten(text), some.schema)
    return same.unionByName(changed.where(F.size(removed) == 0)).unionByName(some)
