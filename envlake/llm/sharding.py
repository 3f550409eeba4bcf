"""Sharding by a Feistel permutation of global row numbers, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from envlake.llm.common import free_name, let, stored

ROUNDS = 6
PRIME = 2_147_483_647  # products of two residues fit a long
CELL_ROWS = 32_768  # rows that one task numbers, on average
CELLS_TOGETHER = 1024  # cells whose sizes are added up in one task
RUN = 8192  # copies of one row that a task numbers at once


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and increment of each round, from a small linear congruence."""
    state, keys = (seed * 2 + 1) % PRIME or 1, []
    for _ in range(rounds):
        pair = []
        for _ in range(2):
            state = (state * 48_271 + 11) % PRIME
            pair.append(state or 1)
        keys.append((pair[0], pair[1]))
    return keys


def mixed(value: int, key: tuple[int, int]) -> int:
    """The round function: two squarings with an affine map before each, modulo a prime."""
    a, b = key
    y = (value % PRIME * a + b) % PRIME
    y = (y * y + b) % PRIME
    y = (y * a + value % PRIME) % PRIME
    return y * y % PRIME


def halves(n: int) -> tuple[int, int]:
    """Two factors whose product is at least ``n`` and exceeds it by less than its root + 1."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permuted(number: int, n: int, seed: int = 0) -> int:
    """Place of row ``number`` of ``n``: what a reader computes without any table."""
    a, b = halves(n)
    while True:
        left, right = divmod(number, b)
        for i, key in enumerate(round_keys(seed)):
            if i % 2 == 0:
                left = (left + mixed(right, key)) % a
            else:
                right = (right + mixed(left, key)) % b
        number = left * b + right
        if number < n:
            return number


def _mixed(value: Column, a: Column, b: Column) -> Column:
    def last(y: Column) -> Column:
        z = (y * a + value % PRIME) % PRIME
        return let(z, lambda x: x * x % PRIME)

    first = (value % PRIME * a + b) % PRIME
    return let(let(first, lambda y: (y * y + b) % PRIME), last)


def permuted_column(number: Column, n: int, seed: int = 0) -> Column:
    """:func:`permuted` as an expression.

    The rounds are one fold. A first image outside ``0 .. n - 1`` is walked along its cycle;
    fewer than the root of ``n`` places lie outside, so that many further steps always end
    inside, and fewer than that many rows walk at all.
    """
    a, b = halves(n)
    long = lambda v: F.lit(v).cast("long")
    keys = F.array(
        *[F.struct(long(x).alias("a"), long(y).alias("b"), F.lit(i % 2 == 0).alias("even"))
          for i, (x, y) in enumerate(round_keys(seed))]
    )

    def once(x: Column) -> Column:
        start = F.struct(F.floor(_div(x, b)).cast("long").alias("l"), (x % long(b)).alias("r"))

        def step(s: Column, k: Column) -> Column:
            left = F.when(k["even"], (s["l"] + _mixed(s["r"], k["a"], k["b"])) % long(a)).otherwise(s["l"])
            right = F.when(k["even"], s["r"]).otherwise((s["r"] + _mixed(s["l"], k["a"], k["b"])) % long(b))
            return F.struct(left.alias("l"), right.alias("r"))

        return F.aggregate(keys, start, step, lambda s: s["l"] * long(b) + s["r"])

    outside = a * b - n

    def walked(x: Column) -> Column:
        if not outside:
            return x
        return F.when(x < n, x).otherwise(
            F.aggregate(
                F.sequence(F.lit(1), F.lit(outside + 1)), x,
                lambda y, _: F.when(y < n, y).otherwise(once(y)),
            )
        )

    return let(let(number.cast("long"), once), walked)


def _div(x: Column, by: int) -> Column:
    """Whole quotient; exact below 2 ** 53."""
    return (x - x % F.lit(by).cast("long")) / F.lit(by)


def feistel_shards(rows: DataFrame, shards: int, seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """Every row with its ``row_number``, ``shard`` and ``slot`` in a reproducible shuffle.

    Rows are numbered from 0 by a hash cell and then by their values, so numbers depend on the
    rows alone, not on files, partitions or tasks. The number of cells follows the number of
    different rows; their sizes are added up a thousand cells at a time, then over these sums. The number is permuted; the place modulo
    ``shards`` is the shard, the quotient the slot. Counts of shards are at most one apart and
    slots have no gap. ``permuted(row_number, n, seed)`` computes the place of any row.

    Equal rows are counted before anything is shuffled and numbered as one run, which is dealt
    out in pieces of 8,192: a row repeated any number of times is no hot spot. Nulls are
    values like others; an empty table gives an empty table. ``key`` (default all columns)
    names the columns whose values order the rows; columns outside it must depend on them.
    Columns of ``rows`` named like a new one stay, the new one gets a leading underscore.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    names = rows.columns
    key = list(key or names)
    number = free_name(names, "row_number")
    shard, slot = free_name(names, "shard"), free_name(names, "slot")
    cell, times, first, run, upto_ = (free_name(names, x) for x in ("cell", "times", "first", "run", "upto"))
    rest = [F.first(c).alias(c) for c in names if c not in key]
    distinct = stored(rows.groupBy(*key).agg(F.count("*").alias(times), *rest), "sharding")
    cells = -(-distinct.count() // CELL_ROWS)
    distinct = distinct.withColumn(cell, F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(cells or 1)))
    sizes = stored(distinct.groupBy(cell).agg(F.sum(times).alias("size")), "cells")
    together = F.floor(F.col(cell) / CELLS_TOGETHER).cast("long")
    before, n = {}, 0
    for r in sizes.groupBy(together.alias("group")).agg(F.sum("size").alias("size")).orderBy("group").collect():
        before[r.group] = n
        n += r["size"]
    starts = F.array(*[F.lit(before.get(i, n)).cast("long") for i in range(-(-cells // CELLS_TOGETHER))] or [F.lit(0).cast("long")])
    upward = Window.partitionBy(together).orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = sizes.select(cell, (F.get(starts, together.cast("int")) + F.sum("size").over(upward) - F.col("size")).alias(first))
    order = Window.partitionBy(cell).orderBy(*[F.col(c).asc_nulls_first() for c in key])
    upto = F.sum(times).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = distinct.withColumn(upto_, upto).join(begins, cell)
    numbered = numbered.withColumn(first, F.col(first) + F.col(upto_) - F.col(times))
    pieces = numbered.withColumn(
        run, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / RUN)))
    )
    pieces = pieces.repartition(cell, run)
    low = F.col(run) * RUN
    single = pieces.withColumn(
        number,
        F.explode(F.sequence(F.col(first) + low, F.col(first) + F.least(low + RUN, F.col(times)) - 1)),
    )
    place = free_name(names, "place")
    return (
        single.withColumn(place, permuted_column(F.col(number), n, seed))
        .withColumn(shard, (F.col(place) % shards).cast("int"))
        .withColumn(slot, F.floor(_div(F.col(place), shards)).cast("long"))
        .select(*names, number, shard, slot)
    )
