"""Token alignment, the hidden Markov model and periodic runs against brute force, through their queries."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from olapkit.llm import hidden_markov as hm, periodic_runs as pr, token_alignment as ta
from olapkit.llm.queries import ALIGNED, QUERIES

SCHEMA = "doc_id BIGINT, text STRING, `_row` INT, n INT, a INT, word STRING, rare STRING, links STRING"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng, n):
    words = ["the", "of", "Königin", "élan", "wörter", "x", "Straße,", "数据", "a▁b", "emoji😀", "IN", "it's", "1,234"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\t", "\xa0 "]) for _ in range(n))


def rows_of(seed=3):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([1, 5, 40, 200]))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\r\n\x0b\x0c"), (None, "no id the the of"), (None, None), (103, "▁")]
    rows += [(104, "<s> </s> <|endoftext|> <0x41> <unk>"), (105, "a\x00b\x85c d ﬁ \U00010ffff"), (-5, "minus")]
    rows += [(106, "spam " * 3000), (107, ("a b c " * 4 + "x ") * 40), (108, prose(rng, 6000)), rows[3], rows[3], (3, "other text")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("docs"))
    full = [(i, t, 1, 2, 3, "clash", "clash", "clash") for i, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(4).write.parquet(f"{at}/documents.parquet")
    return at


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/documents.parquet")
    return at


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# Token alignment


def test_paths_of_any_piece_size_give_all_overlaps():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 200)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}), np.int64) for _ in range(2))
        merged = ta.merge_ends(a, b, rng.choice([1, 2, 3, 7, 64, 1000]))
        start_a, start_b = np.r_[0, a], np.r_[0, b]
        want = sorted(
            (int(max(start_a[i], start_b[j])), i, j)
            for i in range(len(a))
            for j in range(len(b))
            if max(start_a[i], start_b[j]) < min(a[i], b[j])
        )
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert list(zip(merged.a.tolist(), merged.b.tolist(), strict=True)) == [(i, j) for _, i, j in want]
        assert merged.group.tolist() == [sum(c <= at for c in common) for at, _, _ in want]


def test_no_ends_no_links():
    none = np.zeros(0, np.int64)
    assert len(ta.merge_ends(none, none).a) == 0


def test_the_fast_encoder_is_the_tokenizers_own():
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(ALIGNED[0])
    theirs.encode_special_tokens = True
    ours = ta.ByteLevel(ta.Files.read(*ALIGNED).byte_level)
    # Every code point in words, alone, doubled, before digits and spaces.
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 200_000):
        texts = [f" a{c}b {c} {c}{c}1{c}  {c}\n{c}." for c in points[first : first + 200_000 : 7]]
        assert ours.encode(texts) == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert [ours.bytes[i] for i in theirs.encode("é <|endoftext|>").ids][-1] == b">"


def aligned_by_hand(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(ALIGNED[0]), sentencepiece.SentencePieceProcessor(model_file=ALIGNED[1])
    a.encode_special_tokens = True
    letters = ta.byte_letters()
    out, pairs = [], Counter()
    for doc_id, text in rows:
        wanted = f" {text or ''}".encode()
        side_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(f" {text or ''}", add_special_tokens=False).ids]
        side_b = [
            (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text or "")
        ]
        if not text or any(b"".join(x for _, x in side) != wanted for side in (side_a, side_b)):
            out.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (side_a, side_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [[[], []] for _ in cuts]
        for k, side in enumerate((side_a, side_b)):
            for (i, _), e in zip(side, ends[k], strict=True):
                groups[sum(c < e for c in cuts) if len(cuts) < 50 else int(np.searchsorted(cuts, e))][k].append(str(i))
        links, i, j = [], 0, 0
        while i < len(side_a) and j < len(side_b):
            links.append((side_a[i][0], side_b[j][0]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        pairs.update(links)
        out.append((doc_id, len(side_a), len(side_b), len(cuts), links, ";".join("|".join(map(",".join, g)) for g in groups)))
    top = {}
    for (_, y), n in pairs.items():
        top[y] = max(top.get(y, 0), n)
    return Counter(
        (d, na, nb, ng, len(ln), sum(pairs[x] == top[x[1]] for x in ln), sum(pairs[x] for x in ln), sha(g) if g else "")
        for d, na, nb, ng, ln, g in out
    )


def test_alignment_query_is_brute_force(spark, folder, rows):
    assert bag(QUERIES["op11_token_alignment"](spark, folder)) == aligned_by_hand(rows)


@pytest.mark.parametrize("hot", [1, 20])
def test_pairs_joined_by_shuffle_count_the_same(spark, folder, rows, hot):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert bag(ta.align(documents, *ALIGNED, hot=hot).documents.select(*names)) == aligned_by_hand(rows)


def test_groups_are_kept_if_wanted_and_empty_tables_have_none(spark, folder, empty):
    kept = ta.align(spark.read.parquet(f"{folder}/documents.parquet"), *ALIGNED, keep_groups=True).documents
    for r in kept.collect():
        assert r["groups_sha256"] == (sha(r["groups"]) if r["groups"] else "")
    assert QUERIES["op11_token_alignment"](spark, empty).collect() == []


# Hidden Markov model


def ascii_lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def tokens_of(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))


def out_of_training(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def forward_by_hand(model, classes):
    """Log10 probability of one text, by sums of logs without any rescaling."""
    log = np.log(model.start) + np.log(model.emit[classes[0]])
    for c in classes[1:]:
        log = np.logaddexp.reduce(log[:, None] + np.log(model.move), axis=0) + np.log(model.emit[c])
    return np.logaddexp.reduce(log) / math.log(10)


def random_model(rng, classes):
    share = lambda *shape: rng.random(shape) + 0.01
    start, move, emit = share(hm.STATES), share(hm.STATES, hm.STATES), share(classes, hm.STATES)
    return hm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def walks_of(texts):
    import pyarrow as pa

    return hm.walks(pa.array(texts, pa.list_(pa.int32())))


def test_forward_is_exact_for_texts_of_any_length():
    rng = np.random.default_rng(2)
    model = random_model(rng, 9)
    texts = [rng.integers(0, 9, n).tolist() for n in (1, 1, 2, 3, 3, 50, 400, 7)]
    got = np.zeros(len(texts))
    for numbers, walk in walks_of(texts):
        got[numbers] = walk.log10(model)
    np.testing.assert_allclose(got, [forward_by_hand(model, t) for t in texts], rtol=1e-9)


def test_expected_counts_are_those_of_all_ways_through_the_states(monkeypatch):
    import itertools

    monkeypatch.setattr(hm, "STATES", 2)
    rng = np.random.default_rng(4)
    model = random_model(rng, 4)
    texts = [rng.integers(0, 4, n).tolist() for n in (1, 5, 3, 8)]
    want = hm.Counts.none(4)
    for t in texts:
        ways, weights = list(itertools.product(range(2), repeat=len(t))), []
        for way in ways:
            w = model.start[way[0]] * model.emit[t[0], way[0]]
            for k in range(1, len(t)):
                w *= model.move[way[k - 1], way[k]] * model.emit[t[k], way[k]]
            weights.append(w)
        for way, w in zip(ways, np.array(weights) / sum(weights), strict=True):
            want.start[way[0]] += w
            for k, c in enumerate(t):
                want.emit[c, way[k]] += w
                if k:
                    want.move[way[k - 1], way[k]] += w
    got = hm.Counts.none(4)
    for _, walk in walks_of(texts):
        walk.expected(model, got)
    for a, b in ((got.start, want.start), (got.move, want.move), (got.emit, want.emit)):
        np.testing.assert_allclose(a, b, atol=1e-9)


def test_a_round_over_all_parts_raises_the_likelihood():
    rng = np.random.default_rng(8)
    texts = [((rng.integers(0, 3, 30) + 3 * (k % 2)).tolist()) for k in range(40)]
    model, before = hm.Model.first(np.full(6, 200.0)), -math.inf
    for _ in range(8):
        counts, now = hm.Counts.none(6), 0.0
        for _, walk in walks_of(texts):
            now += walk.log10(model).sum()
            walk.expected(model, counts)
        assert now > before - 1e-6
        before, model = now, hm.Model.estimate(counts, np.full(6, 1e-9))


@pytest.fixture(scope="module", params=[(1 << 14, 1 << 19), (4, 1 << 19), (4, 30), (1, 1)], ids=str)
def scored(spark, folder, request):
    """The query's rows and its model, with most words frequent, listed, or joined."""
    kept = {}
    train, sizes = hm.train, (hm.FREQUENT, hm.LISTED)
    hm.FREQUENT, hm.LISTED = request.param

    def spy(stored, v):
        kept["v"], kept["model"] = v, train(stored, v)
        return kept["model"]

    hm.train = spy
    try:
        done = [r.asDict() for r in QUERIES["op12_hidden_markov"](spark, folder).collect()]
        yield done, kept["v"], kept["model"]
    finally:
        hm.train = train
        hm.FREQUENT, hm.LISTED = sizes


def test_model_query_is_brute_force(scored, rows):
    done, v, model = scored
    training = [t for i, t in rows if not out_of_training(i)]
    counts = Counter(w for t in training for w in tokens_of(t))
    total, distinct = sum(counts.values()) + len(training), len(counts) + 1
    assert (v.total, v.distinct) == (total, distinct)
    frequent = sorted((w for w, n in counts.items() if n * hm.FREQUENT >= total), key=str.encode)
    assert [w.decode() for w, own in zip(v.words, v.frequent, strict=True) if own] == frequent
    number = {w: 1 + k for k, w in enumerate(frequent)}
    rare = Counter()
    kinds = Counter()
    for w, n in counts.items():
        if w not in number:
            rare[hm.rare_class(w.encode())] += n
            kinds[hm.rare_class(w.encode())] += 1
    scale = total + 0.1 * (distinct + 1)
    want = []
    for i, t in rows:
        words = tokens_of(t)
        base = math.log10((len(training) + 0.1) / scale) + sum(math.log10((counts[w] + 0.1) / scale) for w in words)
        codes = [number[w] if w in number else 1 + len(number) + hm.rare_class(w.encode()) for w in words] + [0]
        score = forward_by_hand(model, codes)
        for w in words:
            if w not in number:
                c = hm.rare_class(w.encode())
                score += math.log10((counts[w] + 0.1) / (rare[c] + 0.1 * (kinds[c] + 1)))
        want.append((i, out_of_training(i), len(words) + 1, 1 + sum(w in counts for w in words), total, base, score))

    def key(r):
        return (r[0] is None, r[0] or 0, r[2], r[6])

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r[n] for n in names) for r in done), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-7)


def test_probabilities_of_a_model_sum_to_one(scored):
    _, v, model = scored
    assert model.start.sum() == pytest.approx(1) and (model.emit > 0).all()
    np.testing.assert_allclose(model.move.sum(axis=1), 1)
    np.testing.assert_allclose(model.emit.sum(axis=0), 1)


def test_held_out_texts_are_likelier_than_under_single_words(spark):
    done = QUERIES["op12_hidden_markov"](spark, "/root/testdata/sf0.01").where("held_out")
    r = done.agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert r[2] > 50 and r[0] > r[1]


def test_empty_tables_and_tables_without_training_rows(spark, empty, tmp_path):
    assert QUERIES["op12_hidden_markov"](spark, empty).collect() == []
    only = [i for i in range(500) if out_of_training(i)][:5]
    spark.createDataFrame([(i, "some words") for i in only], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op12_hidden_markov"](spark, str(tmp_path)).collect():
        assert (r["n_known"], r["train_tokens"], r["held_out"]) == (0, 0, True)
        assert r["base_score"] == pytest.approx(0) and r["score"] < 0


# Periodic runs


def runs_by_hand(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i > first and i - first + q >= max(12, 2 * q):
                found.setdefault((first - q, i), q)
            i += i == first
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_runs_of_random_words_are_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        words = []
        while len(words) < rng.randint(1, 150):
            root = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 25))]
            words += (root * rng.randint(1, 12))[: rng.randint(1, 80)]
            if rng.random() < 0.3:
                words += words[-rng.randint(1, len(words)) :]
        found = pr.find_runs(np.array(words))
        assert list(zip(found.start.tolist(), found.length.tolist(), found.period.tolist(), strict=True)) == runs_by_hand(words)


def test_blocks_are_short_enough_for_every_lag():
    for octave in range(12):
        for q in range(1 << octave, 2 << octave):
            assert 2 * (1 << pr.block_level(octave)) - 1 <= max(q, 12 - q)


def test_one_word_a_hundred_thousand_times_takes_no_square():
    found = pr.find_runs(np.zeros(100_000, np.int64))
    assert (found.start.tolist(), found.length.tolist(), found.period.tolist()) == ([0], [100_000], [1])
    found = pr.find_runs(np.array(([0] * 3000 + [1]) * 30))
    assert len(found.start) == 31 and (0, 3001 * 30, 3001) in set(zip(found.start, found.length, found.period, strict=True))


def test_runs_query_is_brute_force(spark, folder, rows):
    want = Counter()
    changed = 0
    for i, t in rows:
        import re

        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
            changed += 1
        # Brute force over all lags takes too long for the longest texts; its numbers stand for its words.
        runs = runs_by_hand(words) if n <= 400 else list(zip(*(x.tolist() for x in vars(pr.find_runs(codes(words))).values()), strict=True))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        kept = " ".join(w for k, w in enumerate(words) if k not in drop)
        milli = 1000 * best[1] // best[2] if runs else None
        want[(i, len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))] += 1
    assert changed > 3
    assert bag(QUERIES["op13_periodic_runs"](spark, folder)) == want


def codes(words):
    seen = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def test_runs_and_collapsed_texts_are_kept_if_wanted(spark, empty):
    text = "start " + "la li lu " * 5 + "end"
    got = pr.runs_of_documents(spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING"), keep=True).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 15, 3)]
    assert got["collapsed"] == "start la li lu end"
    assert QUERIES["op13_periodic_runs"](spark, empty).collect() == []
