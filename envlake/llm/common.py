"""What the corpus operators share: frames, scratch tables, prefilters and components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.sources.scratch import scratch_dir

#: The white space of every contract: a blank and the control characters 9 to 13.
BLANK = r"[\x20\x09-\x0D]"

BITMAP_BITS = 32768  # what one bitmap of bitmap_construct_agg holds
LEAST_BITMAPS, MOST_BITMAPS = 1024, 16_384  # 4 MB to 64 MB
BITS_PER_KEY = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where body reads it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(taken: Sequence[str], wanted: str) -> str:
    """A column name that clashes with none of ``taken``, whatever their case."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet into the shared scratch folder and read again.

    This cuts the lineage: a lost executor costs a read of the table, not the work before it.
    Columns without a type, which Parquet cannot hold, become text.
    """
    spark = frame.sparkSession
    untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in frame.schema if f.dataType.simpleString() == "void"}
    frame = frame.withColumns(untyped) if untyped else frame
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def dropped(frame: DataFrame) -> None:
    """Delete a table of :func:`stored` that nothing reads any more."""
    spark = frame.sparkSession
    for file in frame.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def maybe_in(frame: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, str]:
    """``frame`` with a flag that is true for each row whose ``key`` occurs in ``wanted``.

    The flag may also be true for other keys, never false for a wanted one. The keys are counted
    and hashed into bitmaps of 4 KB, eight bits for each key: 4 MB in all at least and 64 MB at most, which hold
    67 million keys. With more keys the flag merely excludes fewer rows. ``wanted`` should be a
    written table, as it is read twice. Returns the frame and the flag's name.
    """
    needed = -(-wanted.count() * BITS_PER_KEY // BITMAP_BITS)
    bits = BITMAP_BITS * min(MOST_BITMAPS, max(LEAST_BITMAPS, 1 << max(0, needed - 1).bit_length()))
    flag = free_name(frame.columns, "maybe")
    bucket, bitmap = free_name(frame.columns, "bucket"), free_name(frame.columns, "bitmap")
    position = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(bits))
    maps = (
        wanted.select(position.alias("p"))
        .groupBy((F.col("p") / BITMAP_BITS).cast("long").alias(bucket))
        .agg(F.expr(f"bitmap_construct_agg(p % {BITMAP_BITS})").alias(bitmap))
    )
    place = free_name(frame.columns, "place")
    rows = frame.withColumn(place, position).withColumn(
        bucket, (F.col(place) / BITMAP_BITS).cast("long")
    )
    byte = F.conv(
        F.hex(F.substring(F.col(bitmap), ((F.col(place) % BITMAP_BITS) / 8).cast("int") + 1, F.lit(1))),
        16, 10,
    ).cast("int")
    hit = F.expr(f"shiftright(255, 7 - cast(`{place}` % 8 as int))")  # 1, 3, 7, ...
    hit = byte.bitwiseAND(hit - F.shiftright(hit, 1)) != 0
    return (
        rows.join(F.broadcast(maps), bucket, "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop(bucket, bitmap, place),
        flag,
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (node, root) per node, root the least.

    Alternating stars: each round links every node's larger neighbours to its least neighbour,
    then its smaller ones. Rounds are logarithmic in the longest path, and each shuffles a number
    of rows linear in the edges. Least neighbours are aggregated in the tasks first. They and the
    edges are written before they are joined: both sides of the join are then plain tables, and
    adaptive execution can split the rows of a node with very many neighbours over tasks.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = stored(least(both).select("u", F.least("u", "m").alias("m")), f"{label}-near")
        large = both.where("v > u").join(near.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), f"{label}-large")
        nearest = stored(least(large), f"{label}-nearest")
        small = large.join(nearest.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = stored(small.union(nearest.select("u", F.col("m").alias("v"))).where("u != v").distinct(), label)
        for done in (near, large, nearest):
            dropped(done)
        return out

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    now = stored(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        label,
    )
    before = digest(now)
    while True:
        after = star(now)
        dropped(now)
        now, seen = after, digest(after)
        if seen == before:
            break
        before = seen
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20, rows: int = 512
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes, in at most ``rows`` rows.

    A row is never cut, so a longer text is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = max(at + 1, min(to, at + rows, batch.num_rows))
            yield batch.slice(at, to - at)
            at = to


def give_back() -> None:
    """Return freed memory to the system at the end of a task: idle Python workers stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only where the C library offers it
        ctypes.CDLL(None).malloc_trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
