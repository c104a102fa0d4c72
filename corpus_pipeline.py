"""The corpus pipeline: quality, near duplicates, personal data, mixing, encoding.

Each stage takes (spark, documents, folder of the tables) and works on all rows that the one before
it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from olapkit.llm import bpe, mixing, near_duplicates, personal_data, quality_cnn
from olapkit.llm.common import table
from olapkit.llm.queries import TOKENIZER
from olapkit.workspace import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the network accepts."""
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.keep_one(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts sanitised and their lengths counted anew."""
    done = personal_data.sanitise(docs)
    if "n_chars" not in docs.columns:
        return done
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of ids and decoded text, and the ids of every document."""
    return bpe.encode_documents(docs, TOKENIZER, keep_ids=True)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("personal_data", personal), ("mix", mix), ("encode", encode)]

#: SQL can't express the network, the signatures and the merges; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, each but the last written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
