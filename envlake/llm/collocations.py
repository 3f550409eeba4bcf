"""Phrases whose words occur together more often than their parts would by chance.

Best-first growth: a phrase of first word u and last word v scores at most 1000 * n / f(u) and
1000 * n / f(v), whatever lies between, as one cut leaves u alone, one leaves v alone, and the other part
occurs at least as often as the phrase. The frontier takes words from the highest bound down; phrases grow word by
word from prefixes that are frequent themselves, and once the highest bound outside the frontier lies
below the last score that a language returns, no other phrase of that language can matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from envlake.llm.common import dropped, give_back, slices, stored, text_bytes
from envlake.llm.shingles import mix, word_hashes

LONGEST = 5
SHARES = (1 / 8, 1 / 2, 1)  # of a language's word occurrences that the frontier covers, step by step
UNKNOWN = "und"
SLICE = 1 << 19  # bytes of text that are cut into words at once
ROWS = 1 << 16  # phrases sent at once
LEAST_BITS, MOST_BITS = 20, 28  # bitmaps of 128 KB to 32 MB
_END = {ord(c) for c in ".,;:!?"} | set(range(0x0A, 0x0E))
_KIND = np.array([2 if b in _END else b in (0x20, 0x09) for b in range(256)], np.uint8)  # word, blank, end of a piece
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_PLACE = mix(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)


def _words(texts: pa.Array, langs: list, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; start, end, text and key of each word; whether a piece begins with it.

    A key is a 64-bit hash of language and word, never 0.
    """
    raw, offsets = text_bytes(texts)
    raw = _LOWER[raw]
    kind = _KIND[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = kind == 0
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] |= inside[1:-1][edges]
    last[edges - 1] |= inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    stops = np.cumsum(np.r_[0, kind == 2])
    opens = np.ones(len(starts), bool)
    opens[1:] = (text[1:] != text[:-1]) | (stops[starts[1:]] > stops[ends[:-1]])
    salts = np.array([xxhash.xxh64_intdigest(lang, seed) for lang in langs], np.uint64)
    key = mix(word_hashes(raw, starts, ends) ^ salts[text]) if len(starts) else np.empty(0, np.uint64)
    return raw, starts, ends, text, np.where(key == 0, np.uint64(1), key), opens


def _langs(batch: pa.RecordBatch) -> list[str]:
    return [UNKNOWN if lang is None else lang for lang in batch.column("lang").to_pylist()]


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            langs = _langs(batch)
            raw, starts, ends, text, key, _ = _words(batch.column("text"), langs, seed)
            some, at, n = np.unique(key, return_index=True, return_counts=True)
            body = raw.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(some.view(np.int64)), pa.array([langs[t] for t in text[at]], pa.string()),
                pa.array([body[s:e] for s, e in zip(starts[at], ends[at], strict=True)], pa.binary()).cast(pa.string()), pa.array(n),
            ], ["key", "lang", "word", "n"])
        give_back()

    return run


@dataclass(frozen=True)
class Bitmap:
    """A set of keys that may hold more: one bit for each of 2 ** ``bits`` hash values."""

    bits: int
    cells: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.bits)
        return (self.cells[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def phrase_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    n = len(words) - size + 1
    return mix(sum(words[j : j + n] * _PLACE[j] for j in range(size))) if n > 0 else np.empty(0, np.uint64)


def bitmap(phrases: DataFrame, size: int) -> Bitmap:
    """The phrases (``ws``, arrays of ``size`` keys) as a bitmap of 32 MB at most.

    It has 16 bits for each phrase as long as they fit, so few others are let through; with very many
    phrases it lets more through, which costs time but no phrase.
    """
    count = phrases.count()
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * max(count, 1)))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("ws").flatten().to_numpy().view(np.uint64)
            keys = phrase_keys(words, size)[::size] if size > 1 else words
            place = (keys >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 15), pa.array(place & 32767)], ["bucket", "bit"])

    maps = phrases.select("ws").mapInArrow(places, "bucket long, bit long").groupBy("bucket")
    cells = np.zeros(1 << (bits - 3), np.uint8)
    for row in maps.agg(F.expr("bitmap_construct_agg(bit)").alias("cells")).collect():
        part = np.frombuffer(row.cells, np.uint8)
        cells[row.bucket << 12 : (row.bucket + 1) << 12] = part[: len(cells)]
    return Bitmap(bits, cells)


def _encode(seed: int, frequent: Bitmap):
    """Runs of frequent words as their keys, with a 0 before and after each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            key, opens = _words(batch.column("text"), _langs(batch), seed)[4:]
            if not len(key):
                continue
            out = np.zeros(len(key) + int(opens.sum()) + 1, np.uint64)
            out[np.arange(len(key)) + np.cumsum(opens)] = np.where(frequent.has(key), key, np.uint64(0))
            lit = np.r_[False, out != 0, False]
            out[lit[1:-1] & ~lit[:-2] & ~lit[2:]] = 0  # a word alone is in no phrase
            out = out[(out != 0) | np.r_[True, out[:-1] != 0]]
            if len(out) > 1:
                yield pa.RecordBatch.from_arrays([pa.array([out.view(np.int64)], pa.list_(pa.int64()))], ["words"])
        give_back()

    return run


def _grow(size: int, front: Bitmap, before: Bitmap | None, parts: Bitmap | None):
    """All phrases of ``size`` words that begin or end with a word of the frontier, one row each time.

    Left out are those that an earlier frontier had, and those with a part one word shorter
    that was counted and is not among the frequent ``parts``.
    """
    columns = [*(f"w{j}" for j in range(size)), "p", "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.r_[np.uint64(0), batch.column("words").flatten().to_numpy().view(np.uint64), np.uint64(0)]
            n = len(words) - size - 1  # phrases begin at 1, 2, ..., n: one word is before and after them
            if n <= 0:
                continue
            near = front.has(words)
            old = before.has(words) if before else np.zeros(len(words), bool)
            here = np.ones(n, bool)
            for j in range(size):
                here &= words[1 + j : 1 + j + n] != 0
            head, tail = slice(1, 1 + n), slice(size, size + n)
            here &= (near[head] | near[tail]) & ~(old[head] | old[tail])
            at = np.flatnonzero(here) + 1
            if parts:
                any_front = near | old
                for shift in (0, 1):
                    low = at + shift
                    counted = any_front[low] | any_front[low + size - 2]
                    key = mix(sum(words[low + j] * _PLACE[j] for j in range(size - 1)))
                    at = at[~counted | parts.has(key)]
            for low in range(0, len(at), ROWS):
                some = at[low : low + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[some + j].view(np.int64)) for j in (*range(size), -1, size)], columns
                )
        give_back()

    return run


def _frequent(runs: DataFrame, size: int, front: Bitmap, before: Bitmap | None, parts: Bitmap | None, least: int) -> DataFrame:
    """(ws, a, inside) of the frequent phrases of one size: inside a longer one as often as at all?

    All occurrences of a phrase lie in a longer one just if the same word precedes or follows each.
    """
    words = [f"w{j}" for j in range(size)]
    rows = runs.mapInArrow(_grow(size, front, before, parts), ", ".join(f"{c} long" for c in [*words, "p", "x"]))
    found = rows.groupBy(*words).agg(
        F.count("*").alias("a"), *[f(c).alias(f"{name}_{c}") for c in ("p", "x") for name, f in (("min", F.min), ("max", F.max))]
    )
    same = reduce(Column.__or__, [(F.col(f"min_{c}") == F.col(f"max_{c}")) & (F.col(f"min_{c}") != 0) for c in ("p", "x")])
    inside = same if size < LONGEST else F.lit(False)
    return stored(found.where(F.col("a") >= least).select(F.array(*words).alias("ws"), "a", inside.alias("inside")), f"phrases-{size}")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _scored(phrases: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """(ws, lang, a, l, r, n, score) of the phrases whose parts are all counted and that lie in no longer one.

    The cut of the lowest score counts, the first of several. Products are exact decimals.
    """
    # parts of a phrase: its prefixes and suffixes, which have fewer words than the longest
    parts = phrases.where(F.size("ws") < LONGEST).select("ws", "a")
    parts = parts.unionByName(words.select(F.array("key").alias("ws"), F.col("f").alias("a")))
    cuts = phrases.where("not inside").select("ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("slice(ws, 1, k)").alias("left"), F.expr("slice(ws, k + 1, size(ws) - k)").alias("right"))
    named = lambda part, count: parts.select(F.col("ws").alias(part), F.col("a").alias(count))
    cuts = cuts.join(named("left", "l"), "left", "left").join(named("right", "r"), "right", "left")
    whole = cuts.join(words.select(F.col("key").alias("first"), "lang"), F.col("ws")[0] == F.col("first")).join(sizes.select("lang", "n"), "lang")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    score = whole.select(
        "ws", "lang", "a", "n", "k", "l", "r",
        (F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n")).alias("above"), (exact("l") * exact("r")).alias("below"),
    ).withColumn("score", F.expr("above div below"))
    best = score.groupBy("ws", "lang", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.bool_or(F.col("score").isNull()).alias("open")
    )
    return best.where("not open").select("ws", "lang", "a", "n", "cut.l", "cut.r", "cut.score")


def _first(rows: DataFrame, top: int, *order: Column | str) -> DataFrame:
    """The first ``top`` rows of each language, with their rank.

    A language's rows are ranked in 16 shares first, so that the task that ranks them all gets
    16 times ``top`` at most, however many tasks hold some.
    """
    share = Window.partitionBy("lang", F.pmod(F.xxhash64(*rows.columns), F.lit(16))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs`` (text, lang), by score.

    Letters A to Z count as lower case, a null language as ``und``, a null text as empty. Texts are cut
    at ``.,;:!?`` and the line breaks into pieces, those at blanks and tabs into words. A phrase is two
    to five words in a row within a piece that occur ``min_count`` times or more, overlaps included.
    Its score is the least floor(1000 * a * n / (l * r)) over its cuts (a: its count, n: words of the
    language, l and r: counts of the two sides). Phrases that always stand inside a longer one are left out.
    Order: score and count descending, phrase ascending by bytes. Returns lang, rank (from 1), phrase,
    a, l, r, n, score.

    Repeated rows count as often as they occur; ties are settled by the phrase, so the result is
    unique; a language without phrases, and an empty table, give no rows; other columns are
    ignored, whatever their names. Texts are read whole, some hundred kilobytes at a time.
    """
    docs = docs.select("text", "lang")
    for seed in range(4):
        counted = docs.mapInArrow(_count_words(seed), "key long, lang string, word string, n long")
        every = stored(counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("f")), "words")
        if every.groupBy("key").count().where("count > 1").isEmpty():
            break
        dropped(every)  # two words share a key: take other keys
    else:
        raise RuntimeError("words share their keys under every seed")
    words = stored(every.where(F.col("f") >= min_count), "frequent-words")
    sizes = stored(every.groupBy("lang").agg(F.sum("f").alias("n")), "languages")
    dropped(every)

    frequent = bitmap(words.select(F.array("key").alias("ws")), 1)
    runs = stored(docs.mapInArrow(_encode(seed, frequent), "words array<long>"), "runs")

    # words by power of two of their count: how many occurrences a frontier up to each covers
    power = F.floor(F.log2("f")).cast("int")
    classes = words.groupBy("lang", power.alias("power")).agg(F.sum("f").alias("covered"))
    upward = Window.partitionBy("lang").orderBy("power")
    classes = stored(classes.join(sizes, "lang").select("lang", "power", "n", F.sum("covered").over(upward).alias("covered")), "classes")
    everything = F.lit(1 << 62)
    limits = sizes.select("lang", "n", F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("settles"))
    before, phrases, result = None, {size: [] for size in range(2, LONGEST + 1)}, None
    for share in SHARES:
        reach = classes.where(F.col("covered") >= F.col("n") * share).groupBy("lang").agg(F.min("power").alias("power"))
        step = F.coalesce(F.expr("shiftleft(1L, power + 1)"), everything) if share < 1 else everything
        limits = stored(
            limits.join(reach, "lang", "left").select(
                "lang", "n", F.greatest("below", F.least(step, F.coalesce("settles", everything))).alias("below")
            ),
            "limits",
        )
        near = words.join(limits.select("lang", "below"), "lang").where(F.col("f") < F.col("below"))
        front = bitmap(near.select(F.array("key").alias("ws")), 1)
        parts = None
        for size in range(2, LONGEST + 1):
            phrases[size].append(_frequent(runs, size, front, before, parts, min_count))
            if size < LONGEST:
                parts = bitmap(_union(phrases[size]), size)
        before = front
        result = stored(_scored(_union([p for some in phrases.values() for p in some]), words, sizes), "scored")
        last = _first(result.select("lang", "score", "ws"), top, F.desc("score")).where(F.col("rank") == top)
        last = last.select("lang", F.col("score").alias("last"))
        limits = stored(
            limits.join(last, "lang", "left").select(
                "lang", "n", "below", "last",
                # a word outside the frontier occurs `below` times or more; it matters up to this count
                F.expr("1000 * cast(n as decimal(25,0)) div nullif(last, 0) + 1").alias("settles"),
            ),
            "limits",
        )
        open_ = limits.where((F.col("below") < everything) & (F.col("settles").isNull() | (F.col("settles") > F.col("below"))))
        if open_.isEmpty():
            break
    dropped(runs)

    kept = result.join(limits.select("lang", "last"), "lang").where(F.col("last").isNull() | (F.col("score") >= F.col("last")))
    spelled = (
        kept.select("lang", "a", "l", "r", "n", "score", "ws", F.posexplode("ws").alias("i", "key"))
        .join(words.select("key", "word"), "key")
        .groupBy("lang", "a", "l", "r", "n", "score", "ws")
        .agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("spelled"))
        .withColumn("phrase", F.array_join("spelled.word", " "))
    )
    ranked = _first(spelled, top, F.desc("score"), F.desc("a"), "phrase")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
