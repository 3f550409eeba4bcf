"""Query of SentencePiece encoding and decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.common import documents
from envlake.llm.sentencepiece_scan import decoded_batches, default_model, encode_pieces


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in decoded_batches(default_model())(batches):
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()  # of a slice: they do not begin at 0
        flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], "<u4")
        offsets = offsets - offsets[0]
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.record_batch({
            "doc_id": batch.column("id"),
            "n_pieces": pa.array(np.diff(offsets).astype(np.int64)),
            "ids_crc32": pa.array(crc, pa.int64()),
            "decoded": batch.column("text"),
        })


def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to."""
    finish = (_digest, "doc_id long, n_pieces long, ids_crc32 long, decoded string")
    found = encode_pieces(documents(spark, sf_dir).select("doc_id", "text"), finish=finish)
    return found.select(
        "doc_id", "n_pieces", "ids_crc32",
        F.octet_length("decoded").cast("long").alias("decoded_bytes"),
        F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
    )


QUERIES = {"op3_sentencepiece_scan": sentencepiece_query}
SQL: dict[str, str] = {}
