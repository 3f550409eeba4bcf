"""Token files: Parquet list columns in id order, with page indexes for selective reads."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from envlake.llm.common import slices, stored
from envlake.llm.tokens import SLICE, default_tokenizer, encoder

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
#: Ids take few distinct values: dictionary. Keys and counts are numbers in order: delta, which
#: the second version of the format uses for whole numbers without a dictionary. Its writer
#: adds a column and an offset index for the pages of every row group.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = encoder(path)
        for batch in slices(batches, "text", SLICE):
            ids, offsets = memo.encode(batch.column("text"))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(offsets)),
                "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))),
            })

    return run


def write_token_files(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", tokenizer: str | None = None) -> None:
    """Write (doc_id, n_tokens, ids) of all ``docs`` below ``path``, in ascending id.

    Files follow each other in id order, rows inside a file too; null ids come first, rows
    with one id in any order. Null texts count as empty; each text ends with id 0. An empty
    table gives a folder without rows. Texts, not ids, are shuffled, as they are shorter.
    Ranges are split at a row number where one id has very many rows. Other columns are left out,
    whatever their names.
    """
    tie = F.monotonically_increasing_id()
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), tie.alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(
        _encoded(tokenizer or default_tokenizer()), f"doc_id {id_type}, n_tokens long, ids array<int>"
    ).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Documents with ``low <= doc_id <= high``; pages of others are passed over."""
    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens) without reading a token."""
    return spark.read.parquet(path).select("doc_id", "n_tokens")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        names = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            [*names, "n_ids", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it in file order. Running sums are taken
    inside each file and shifted by the sums of the files before it, one row per file.
    """
    rows = spark.read.parquet(path)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = rows.select("doc_id", "ids", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    index = stored(read.mapInArrow(_digest, f"doc_id {id_type}, file string, row long, n_ids long, ids_crc32 long"), "token-index")
    files = index.groupBy("file").agg(F.sum("n_ids").alias("n"))
    number = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long")
    earlier = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    shifts = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        index.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(shifts, "file")
        .select("doc_id", (F.col("inside") + F.col("shift")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")
    )
