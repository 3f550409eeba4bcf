"""Queries of the operators that lay the corpus out: shards, token files, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.common import documents
from envlake.llm.packing import pack_documents
from envlake.llm.sharding import feistel_shards
from envlake.llm.token_files import token_index, write_token_files
from envlake.sources.scratch import scratch_dir

SHARDS = 8


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    return feistel_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir).select("doc_id", "text"), with_ids=False)


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    write_token_files(documents(spark, sf_dir).select("doc_id", "text"), path)
    return token_index(spark, path)


QUERIES = {
    "op2_best_fit_packing": packing_query,
    "op5_feistel_sharding": sharding_query,
    "op10_token_files": token_files_query,
}
SQL: dict[str, str] = {}
