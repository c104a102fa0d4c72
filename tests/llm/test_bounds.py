"""Bounds that hold at any size: blocks in their billions, the words of the lexicon, pieces of long texts."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from olapkit.llm import bpe, mixing, quality_cnn
from olapkit.llm.queries import TOKENIZER

ROOT = Path(__file__).resolve().parents[2]


def test_every_block_has_one_seeded_place(spark):
    for n in (1, 2, 97, 65536, 100_003):
        rows = spark.range(n).select(mixing.seeded_place(F.col("id"), F.lit(n).cast("long"), F.lit(3).cast("long")).alias("p"))
        assert rows.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()[:] == (n, 0, n - 1)


def test_places_of_billions_of_blocks_are_exact(spark):
    sizes = [5_000_000_000, (1 << 45) + 7, mixing.PRIMES[0] * 4, mixing.PRIMES[0]]
    pairs = [(n, b) for n in sizes for b in (0, 1, 65535, 65536, n // 3, n - 2, n - 1)]
    df = spark.createDataFrame(pairs, "n bigint, b bigint")
    shift = F.pmod(F.xxhash64(F.lit(mixing.SEED), F.lit(0).cast("long")), F.col("n")).alias("shift")
    place = mixing.seeded_place(F.col("b"), F.col("n"), F.lit(0).cast("long")).alias("place")
    for r in df.select("n", "b", shift, place).collect():
        prime = mixing.PRIMES[1] if r["n"] % mixing.PRIMES[0] == 0 else mixing.PRIMES[0]
        assert r["place"] == (r["b"] * prime + r["shift"]) % r["n"]
    taken = df.select(mixing.times_taken(F.col("b"), F.col("n"), (F.col("n") * 2 + 1), F.lit(0).cast("long")).alias("t"))
    assert {r["t"] for r in taken.collect()} <= {2, 3}


def test_the_lexicon_holds_the_most_frequent_words_and_no_more(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(w for i, w in enumerate(words) for _ in range(1 + (300 - i) // 10)) for _ in range(3)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING").repartition(3)
    t = bpe.Tokenizer.read(TOKENIZER)
    splitter = bpe.Splitter(t.special, t.classes, t.small)
    counts = Counter(w for text in texts for w in splitter(text))
    assert set(bpe.frequent_words(df, t)) == set(counts)
    for most in (1, 10, 57, 250):
        monkeypatch.setattr(bpe, "LEXICON_WORDS", most)
        best = bpe.frequent_words(df, t)
        assert len(best) <= most
        rest = [n for w, n in counts.items() if w not in best]
        assert not best or min(counts[w] for w in best) >= max(rest, default=0)
    assert bpe.frequent_words(df.limit(0), t) == []


def test_long_texts_are_learned_from_all_their_parts(spark):
    size = quality_cnn.SAMPLE_CHARS
    long = "".join(chr(0x4E00 + i // 50) for i in range(20 * size))
    short = "x" * size
    df = spark.createDataFrame([(i, t) for i in range(20) for t in (long, short, "", "é")], "doc_id BIGINT, text STRING")
    rows = df.select("doc_id", "text", quality_cnn.seeded_pieces(F.col("text"), F.col("doc_id")).alias("p")).collect()
    seen = set()
    for r in rows:
        if r["text"] == long:
            assert len(r["p"]) == size and set(r["p"]) <= set(long)
            seen |= set(r["p"])
        else:
            assert r["p"] == r["text"]
    # Over some documents every part of the text comes up, the middle as well as the ends.
    assert len(seen) > 0.55 * len(set(long))


def test_reading_the_tokenizer_takes_little_of_the_driver():
    code = """
import re, sys
from olapkit.llm import bpe
most = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1])
before = most()
bpe.Tokenizer.read(sys.argv[1])
print((most() - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code, TOKENIZER], cwd=ROOT, capture_output=True, text=True, check=True)
    assert int(done.stdout) < 150, done.stdout


def test_classes_of_code_points_do_not_depend_on_the_blocks(monkeypatch):
    got = bpe.class_ranges("L"), bpe.class_ranges("N"), bpe.newer_small_letters()
    assert all(b + 1 < c for found in got[:2] for (_, b), (c, _) in zip(found, found[1:]))
    # In one piece, as before.
    monkeypatch.setattr(bpe, "BLOCK_POINTS", 0x110000)
    assert got == (bpe.class_ranges("L"), bpe.class_ranges("N"), bpe.newer_small_letters())
