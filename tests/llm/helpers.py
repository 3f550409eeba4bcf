"""Small tables and plain reference answers for the corpus operators."""

from __future__ import annotations

import re

import duckdb
from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def docs(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    """A documents table of these texts, with ids from 0 and nulls elsewhere."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids, texts, strict=True)], DOCS)


def table(name: str, sf_dir: str = SF_DIR) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')").fetchall()


def documents(sf_dir: str = SF_DIR) -> dict[int, str | None]:
    return {r[0]: r[1] for r in table("documents", sf_dir)}


#: Null, empty and blank texts, a word, ties, repeated rows, odd characters and a long text.
ODD = [
    None, "", " \t\n", "one", "one", "two words", "two\nwords", "a b c d e f", "a b c d e f",
    "été ñandú straße ÷ ×", "日本語 тест 😀 é", "x" * 3000, "la " * 30_000, "tab\tand\x0bfeed\x0c", "don't 'tis 12 34.5",
]
