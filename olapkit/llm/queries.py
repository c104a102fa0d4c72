"""The queries of this folder by name, and their SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from olapkit.llm import (
    bottom_k,
    bpe,
    chat,
    hidden_markov,
    mixing,
    near_duplicates,
    page_text,
    periodic_runs,
    personal_data,
    quality_cnn,
    shard_tree,
    token_alignment,
    weak_rules,
)
from olapkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


#: The tokenizer file of the encoding queries.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The two that are aligned.
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"), TOKENIZER)


@query
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat.read_back(conversations.unionByName(more))


@query
def op3_quality_cnn(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_cnn.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        quality_cnn.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


@query
def op5_shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    return shard_tree.place(table(spark, folder, "documents"))


@query
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op7_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract_pages(table(spark, folder, "pages"))


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    met = bottom_k.compare_with_next(table(spark, folder, "documents"))
    return met.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        bottom_k.as_text(F.col("sketch")).alias("fingerprint"),
        bottom_k.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottom_k.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        bottom_k.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in personal_data.KINDS[:4]],
        F.sha2(personal_data.spans_text(F.col("base")), 256).alias("base_sha256"),
        personal_data.spans_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == "term")).cast("long").alias("n_terms"),
    )


@query
def op10_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    done = token_alignment.align(table(spark, folder, "documents"), *ALIGNED).documents
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov.score_documents(table(spark, folder, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    done = periodic_runs.runs_of_documents(table(spark, folder, "documents"), alter=True)
    return done.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
