"""Whole documents in place of words: each source's copies against the words that its mix takes."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from olapkit.llm import mixing


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 90))), rng.choice("abc")) for i in range(400)]
    # A source of three texts, one of which holds nearly all of its words, and one of a single text.
    rows += [(500, "x " * 9000, "d"), (501, "y " * 40, "d"), (502, "z " * 700, "d"), (510, "only " * 77, None)]
    rows += [(600, "same text", "a")] * 5 + [(601, None, "a"), (602, " ", None), (None, "without an id", "b")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").repartition(7)


def taken_of(documents):
    return mixing.mix(documents.select("doc_id", "source", "text", F.md5("text").alias("_text_key")), ["_text_key"])


def test_copies_are_the_rounded_running_sum_of_shares(spark, documents):
    taken = taken_of(documents)
    hashed = taken.where("size > 0").withColumn("seeded", F.xxhash64(F.lit(mixing.SEED), "doc_id", "_text_key"))
    groups = defaultdict(list)
    for r in hashed.collect():
        groups[r["source"], r["doc_id"], r["_text_key"]].append(r)
    sources = defaultdict(list)
    for (source, doc, key), same in groups.items():
        share = round(sum(r["taken"] for r in same) * 2**mixing.SHARE_BITS / (same[0]["size"] * len(same)))
        sources[source].append((same[0]["size"] * len(same), same[0]["seeded"], doc, key, share))
    want = {}
    half = 2 ** (mixing.SHARE_BITS - 1)
    for source, docs in sources.items():
        before = 0
        for _, _, doc, key, share in sorted(docs, key=lambda d: d[:2]):
            want[source, doc, key] = (before + share + half >> mixing.SHARE_BITS) - (before + half >> mixing.SHARE_BITS)
            before += share
    got = {(r["source"], r["doc_id"], r["_text_key"]): r["_times"] for r in mixing.whole_copies(taken).collect()}
    assert got == want and set(want.values()) > {0, 1}


def test_whole_copies_are_near_the_words_taken(spark, documents):
    words, largest, mixed = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in taken_of(documents).collect():
        words[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    first = mixing.mixed_documents(documents)
    for r in first.collect():
        mixed[r["source"]] += len((r["text"] or "").split())
    assert all(abs(mixed[s] - words[s]) < max(largest[s], 10) for s in words)
    again = mixing.mixed_documents(documents.repartition(3))
    assert sorted(first.collect(), key=str) == sorted(again.collect(), key=str)


def test_an_empty_table_and_one_without_words_mix_to_nothing(spark, documents):
    assert mixing.mixed_documents(documents.limit(0)).count() == 0
    assert mixing.mixed_documents(documents.where("doc_id in (601, 602)")).count() == 0
