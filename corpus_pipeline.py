"""Documents to packed training sequences: the corpus operators in a row.

Each stage is written and read again before the next one. Every stage works on all rows that
the one before kept, and every rejection takes effect.

All stages take any documents table: other columns stay, also where a stage has a name of its own for
one like them; an empty table gives an empty one; ids may be null or repeat. What a stage does with null
and empty texts, ties and repeated rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm.common import free_name, stored
from envlake.llm.exact_dedup import exact_dedup
from envlake.llm.jaccard_join import drop_near_duplicates
from envlake.llm.packing import pack_documents
from envlake.llm.quality_rules import quality_rules
from envlake.llm.toxicity import labelled_texts, score_toxicity, train_toxicity

REMEMBERED = 1 << 17  # pieces of text: executors that ran the stages before have less memory left


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts have no words and go, repeated rows fare alike."""
    judged = quality_rules(docs)
    return judged.where(F.col(f"{free_name(docs.columns, 'quality')}.kept")).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier trained on the labelled ones among them does not find toxic.

    Null and empty texts get the score of no evidence, repeated rows equal scores; a score of 0.5 is toxic. Without
    labelled rows nothing is toxic.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(labelled_texts(docs, labels))
    score = free_name(docs.columns, "score")
    return score_toxicity(docs, model).where(F.col(score) < 0.5).select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest, then first, of equal texts; null counts as empty, of repeated rows one stays."""
    judged = exact_dedup(docs)
    return judged.where(free_name(docs.columns, "kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of similar texts; those without words are in no class, so all of them stay."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in token sequences; null counts as empty, repeated rows are packed each."""
    return pack_documents(docs, with_ids=False, remembered=REMEMBERED)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packing),
]

#: SQL expresses neither the classifier nor the similarity join nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: those before the last are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
