"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import BLANK, free_name, maybe_in, stored

FINGERPRINT_BITS = 60
QUOTIENT_BITS = 16  # of a segment's filter
ROWS_PER_SEGMENT = 250_000  # fingerprints that one task merges, about


@dataclass(frozen=True)
class QuotientFilter:
    """A counting quotient filter over whole fingerprints.

    A fingerprint is its quotient, the leading bits, and its remainder, the last
    ``remainder_bits``. Slots are runs: ``run_length[i]`` remainders belong to the occupied
    quotient ``quotient[i]``, ascending, each with its count. As remainders are kept whole,
    nothing is lost: the fingerprints can be listed again, and filters merge into the one
    that all rows together would have built.
    """

    remainder_bits: int
    quotient: np.ndarray  # uint64, the occupied ones, ascending
    run_length: np.ndarray  # uint32
    remainder: np.ndarray  # uint64, by quotient, then ascending
    count: np.ndarray  # int64

    @classmethod
    def build(cls, fingerprints: np.ndarray, remainder_bits: int, counts: np.ndarray | None = None) -> QuotientFilter:
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order].astype(np.uint64)
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
        weight = np.ones(len(ordered), np.int64) if counts is None else counts[order]
        found = np.add.reduceat(weight, first) if len(first) else np.empty(0, np.int64)
        keys = ordered[first]
        quotient, runs = np.unique(keys >> np.uint64(remainder_bits), return_counts=True)
        mask = np.uint64((1 << remainder_bits) - 1)
        return cls(remainder_bits, quotient, runs.astype(np.uint32), keys & mask, found)

    def fingerprints(self) -> np.ndarray:
        quotient = np.repeat(self.quotient, self.run_length)
        return (quotient << np.uint64(self.remainder_bits)) | self.remainder

    @classmethod
    def merge(cls, filters: Sequence[QuotientFilter]) -> QuotientFilter:
        bits = {f.remainder_bits for f in filters}
        if len(bits) != 1:
            raise ValueError("filters of different shapes do not merge")
        return cls.build(
            np.concatenate([f.fingerprints() for f in filters]), bits.pop(),
            np.concatenate([f.count for f in filters]),
        )

    def pack(self) -> bytes:
        head = np.array([len(self.quotient), len(self.remainder)], np.uint64)
        return b"".join(x.tobytes() for x in (head, self.quotient, self.remainder, self.count, self.run_length))

    @classmethod
    def unpack(cls, data: bytes, remainder_bits: int) -> QuotientFilter:
        q, n = (int(x) for x in np.frombuffer(data, np.uint64, 2))
        at = 16 + 8 * q
        return cls(
            remainder_bits, np.frombuffer(data, np.uint64, q, 16),
            np.frombuffer(data, np.uint32, q, at + 16 * n),
            np.frombuffer(data, np.uint64, n, at), np.frombuffer(data, np.int64, n, at + 8 * n),
        )


def _filters(segment_bits: int, remainder_bits: int, bits: int):
    """One filter for each segment of the fingerprints that a partition holds."""
    low = bits - segment_bits
    step = 1 << 20  # fingerprints held before they are folded into filters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[np.ndarray]) -> pa.RecordBatch:
            ordered = np.sort(np.concatenate(held))
            segment = (ordered >> np.uint64(low)).astype(np.int64)
            edges = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
            packed = [
                QuotientFilter.build(ordered[a:b], remainder_bits).pack()
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            return pa.record_batch({"segment": pa.array(segment[edges[:-1]]), "filter": pa.array(packed, pa.binary())})

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
                n += batch.num_rows
            if n >= step:
                yield emit(held)
                held, n = [], 0
        if held:
            yield emit(held)

    return run


def _merged(remainder_bits: int):
    def run(table: pa.Table) -> pa.Table:
        filters = [QuotientFilter.unpack(x.as_buffer(), remainder_bits) for x in table.column("filter")]
        total = QuotientFilter.merge(filters)
        often = total.count > 1
        found = total.fingerprints()[often].astype(np.int64)
        return pa.table({"fingerprint": pa.array(found), "n": pa.array(total.count[often])})

    return run


def repeated_fingerprints(rows: DataFrame, fingerprint: str, bits: int = FINGERPRINT_BITS, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """``fingerprint`` and count ``n`` of each value that occurs in more than one row.

    Every partition builds filters of its fingerprints, one for each range of the leading
    bits, and only filters are shuffled: a fingerprint that a third of all rows share is one
    counted slot per partition. The number of ranges grows with the number of rows.
    """
    segment_bits = min(bits // 2, max(3, (rows.count() // rows_per_segment).bit_length()))
    remainder_bits = max(1, bits - segment_bits - QUOTIENT_BITS)
    return (
        rows.select(fingerprint)
        .mapInArrow(_filters(segment_bits, remainder_bits, bits), "segment long, filter binary")
        .groupBy("segment")
        .applyInArrow(_merged(remainder_bits), "fingerprint long, n long")
    )


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK + "+", "")


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """The columns of ``docs`` and ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if their bytes are, white space aside. Of equal texts the row with the
    most code points stays, then the one with the least id (a null id after all others); of
    rows that agree in both, exactly one. Ids may be of any type that has an order. Null counts as the empty text. Columns named like
    a new one stay and the new one gets a leading underscore. An empty table gives none.

    Rows whose fingerprint is counted once are done without a shuffle. The others are written
    once with a row number, so that a repeated task cannot choose another row. Those with one
    digest are compared byte by byte: the least and the greatest text of the group
    must be the same bytes, which partial aggregates find without bringing a group together.
    """
    names = docs.columns
    keep_id, size, kept, sha = (free_name(names, x) for x in ("keep_id", "group_size", "kept", "text_sha256"))
    norm, print_, chars, row, first = (free_name(names, x) for x in ("norm", "fingerprint", "chars", "row", "first_row"))
    fingerprint = F.xxhash64(norm).bitwiseAND(F.lit((1 << bits) - 1))
    prints = docs.select(normalised(F.col(text)).alias(norm)).select(fingerprint.alias(print_))
    repeated = stored(repeated_fingerprints(prints, print_, bits), "repeated")

    rows = (
        docs.withColumn(norm, normalised(F.col(text)))
        .withColumn(print_, fingerprint)
        .withColumn(chars, F.coalesce(F.char_length(text), F.lit(0)))
    )
    marked, maybe = maybe_in(rows, print_, repeated.select(F.col("fingerprint").alias(print_)))
    marked = marked.withColumn(sha, F.sha2(norm, 256))
    alone = marked.where(~F.col(maybe)).select(
        *names, F.col(id_col).alias(keep_id), F.lit(1).cast("long").alias(size), F.lit(True).alias(kept), sha
    )
    numbered = marked.where(maybe).withColumn(row, F.monotonically_increasing_id())
    shared = stored(numbered.drop(norm, maybe, print_), "shared").withColumn(norm, normalised(F.col(text)))
    best = F.struct((-F.col(chars)).alias("c"), F.col(id_col).isNull().alias("none"), F.col(id_col).alias("i"), F.col(row).alias("r"))
    groups = shared.groupBy(sha).agg(
        F.min(best).alias("best"),
        F.count("*").alias(size),
        F.min(norm).alias("least"),
        F.max(norm).alias("greatest"),
    )
    same = F.expr("assert_true(least = greatest, 'different texts with one SHA-256 digest')")
    groups = groups.where(same.isNull()).select(
        sha, size, F.col("best.i").alias(keep_id), F.col("best.r").alias(first)
    )
    groups = stored(groups, "groups")  # so that a hot digest can be split in the join
    judged = shared.join(groups.hint("merge"), sha).select(
        *names, keep_id, size, (F.col(row) == F.col(first)).alias(kept), sha
    )
    return alone.select(*judged.columns).unionByName(judged)
