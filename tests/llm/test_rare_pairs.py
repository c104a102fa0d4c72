"""The prefix filter of large buckets: it loses no link, and a common passage makes no pairs."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from olapkit.llm import near_duplicates
from olapkit.llm.common import text_of
from olapkit.llm.near_duplicates import _rare_pairs, _rarest, element_set, similarity, text_key


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_a_rarest_element(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(60):
        base = rng.integers(-(1 << 62), 1 << 62, rng.integers(1, 60))
        for _ in range(3):
            keep = base[rng.random(len(base)) < rng.choice([0.85, 0.95, 1.0])]
            extra = rng.integers(-(1 << 62), 1 << 62, rng.integers(0, 4))
            sets.append(np.unique(np.r_[keep, extra]))
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    # Counts that say nothing must do no harm either.
    for counts in (np.zeros(1 << near_duplicates.CELL_BITS, np.int64), rng.integers(0, 9, 1 << near_duplicates.CELL_BITS)):
        values, rank, plain_rank, taken = _rarest(np.concatenate(sets), sizes, counts)
        ends = np.cumsum(taken)
        rare = [
            (dict(zip(values[e - n : e].tolist(), rank[e - n : e].tolist())), dict(zip(values[e - n : e].tolist(), plain_rank[e - n : e].tolist())))
            for e, n in zip(ends, taken, strict=True)
        ]
        linked = 0
        for i, j in itertools.combinations(range(len(sets)), 2):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            for kind, (x, y) in enumerate(((a, b), ({v for v in a if v % 2 == 0}, {v for v in b if v % 2 == 0}))):
                if x | y and 5 * len(x & y) >= 4 * len(x | y):
                    linked += 1
                    p, q = rare[i][kind], rare[j][kind]
                    need = -(-4 * (len(x) + len(y)) // 9)
                    assert any(p[v] <= len(x) - need and q[v] <= len(y) - need for v in p.keys() & q.keys())
        assert linked > 60


def _texts(rng):
    """Own words around a common passage, some with a near copy, some that repeat it or a part."""
    passage, texts = [f"w{i}" for i in range(90)], []
    for i in range(240):
        own = [f"a{i}y{j}" for j in range(40)]
        texts.append(passage + own)
        if i % 6 == 0:
            texts.append(passage + [w if j != 20 else f"z{i}" for j, w in enumerate(own)])
        if i % 40 == 0:
            texts.append(passage + own + own[:25] * 3)
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def test_a_common_passage_makes_no_pairs_and_no_link_is_lost(spark):
    texts = _texts(random.Random(3))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = df.select(text_key(text_of()).alias("key"), element_set(text_of()).alias("elements")).dropDuplicates(["key"])
    members = rows.select(F.lit(1).alias("bucket"), "key", F.col("key").alias("root"))
    pairs = _rare_pairs(members, members, rows.select("key", "elements")).distinct()
    sides = [rows.select(F.col("key").alias(c), F.col("elements").alias(f"_{c}")) for c in ("a", "b")]
    every = sides[0].join(sides[1], F.col("a") < F.col("b"))
    links = every.where(similarity(F.col("_a"), F.col("_b")) >= near_duplicates.SIMILARITY).select("a", "b")
    # One near copy for every sixth text, and one of equal elements for every fortieth; each is like the other.
    found = links.count()
    assert found >= 46
    assert links.join(pairs, ["a", "b"], "left_anti").count() == 0
    # All pairs would be some 40,000.
    assert pairs.count() <= 2 * found


def test_groups_of_one_bucket_are_found_whole(spark):
    texts = _texts(random.Random(5))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    of = {}
    for i, t in enumerate(texts):
        own = next(w for w in t.split() if w.startswith("a")).split("y")[0]
        of.setdefault(own, []).append(i)
    want = Counter((i, min(group)) for group in of.values() for i in group)
    got = near_duplicates.near_duplicates(df).select("doc_id", "class_id").collect()
    assert Counter((r[0], r[1]) for r in got) == want


def test_copies_too_far_apart_make_no_pairs(spark):
    rng, words = random.Random(9), [f"w{i}" for i in range(150)]
    texts = [" ".join(words)]
    for i in range(300):
        edited = list(words)
        for j in range(4 if i % 3 else 6):  # four edits: 0.76 with the original, six: 0.66
            edited[24 * j + rng.randint(5, 20)] = f"x{i}y{j}"
        texts.append(" ".join(edited))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = df.select(text_key(text_of()).alias("key"), element_set(text_of()).alias("elements"))
    members = rows.select(F.lit(1).alias("bucket"), "key", F.col("key").alias("root"))
    # All pairs would be 45,150, and only those of similar texts may be made.
    assert _rare_pairs(members, members, rows).distinct().count() <= 300
    got = near_duplicates.near_duplicates(df)
    assert Counter((r[0], r[1]) for r in got.select("doc_id", "class_id").collect()) == Counter((i, i) for i in range(301))
