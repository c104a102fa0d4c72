"""Quality rules as weak supervision: votes, accuracies by expectation-maximisation, a posterior.

Each rule looks at some counts of a text and votes for good or bad, or abstains. What
the rules say is the only evidence: expectation-maximisation over all documents
estimates how often each rule votes which way on good and on bad texts, and how many
texts are good. The posterior probability that a text is good takes the place of
passing every rule. Documents with the same votes have the same posterior, so the
estimate runs on the counts of vote patterns, at most 3 to the number of rules, whatever
the number of documents.

Counts are taken in numpy from Arrow's bytes; equal words, word runs and lines
are told by 64-bit hashes.

Defined results: a null text counts as empty; an empty text has no words, is base_failed and not
kept; equal texts have equal results; rows may repeat, each counts; extra
columns play no part. An empty table has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from olapkit.llm.common import text_of
from olapkit.llm.hashing import line_hashes, shingles, text_blocks, word_hashes

LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
STATS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_digits", "n_stops", "top_word",
]
EM_ROUNDS, SMOOTHING, KEEP = 60, 1.0, 0.5

#: Shares of a text: name, part, whole, voted bad from here on, unremarkable up to here.
SHARES = [
    ("symbols", "n_symbols", "n_words", 0.20, 0.12),
    ("repeated runs", "n_repeat_words", "n_words", 0.30, 0.27),
    ("repeated lines", "n_dup_lines", "n_lines", 0.50, 0.45),
    ("capitals", "n_upper", "n_letters", 0.40, 0.30),
    ("one word", "top_word", "n_words", 0.20, 0.18),
    ("digits", "n_digits", "word_chars", 0.30, 0.25),
    ("long words", "word_chars", "n_words", 15.0, 12.0),
    ("few stops", "n_words", "n_stops", 80.0, 60.0),
]
#: The rules: each share votes bad or abstains; all of them together, the stops, and the length vote good or abstain.
#: A text is bad in one way at a time, so that a share's silence says little for it.
RULES = [*(name for name, *_ in SHARES), "nothing remarkable", "sentences", "length"]


def _per_text(owner: np.ndarray, texts: int, weights=None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=texts).astype(np.int64)


def _repeated(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each item: whether its text holds it more than once, and whether an earlier one is equal."""
    order = np.lexsort((np.arange(len(key)), key, owner))
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = (owner[order][1:] == owner[order][:-1]) & (key[order][1:] == key[order][:-1])
    many, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    many[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return many, later


def block_stats(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """STATS of the texts of a block, one row for each."""
    texts = len(begins) - 1
    out = np.zeros((texts, len(STATS)), np.int64)
    if not len(raw):
        return out
    owner, words = word_hashes(raw, begins)

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[begins[1:]] - total[begins[:-1]]

    kinds = _KINDS[raw]
    out[:, 0] = _per_text(owner, texts)
    out[:, 1] = count((kinds & 1) > 0)
    out[:, 2] = count((kinds & 2) > 0)
    line_owner, lines, worded = line_hashes(raw, begins)
    _, later = _repeated(line_owner[worded], lines[worded])
    out[:, 3] = _per_text(line_owner[worded][later], texts)
    out[:, 4] = _covered(owner, words, texts)
    out[:, 5] = _per_text(line_owner[worded], texts)
    for column, bit in ((6, 4), (7, 8), (8, 16), (9, 32)):
        out[:, column] = count((kinds & bit) > 0)
    out[:, 10] = _most_frequent(owner, words, texts)
    return out


def _covered(owner: np.ndarray, words: np.ndarray, texts: int) -> np.ndarray:
    """Words inside a run of three that its text holds twice or more."""
    counts = np.bincount(owner, minlength=texts)
    own, runs = shingles(owner, words, 3)
    long = counts[own] >= 3
    # Runs start at each word but the last two of a text.
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.flatnonzero((place + 3 <= counts[owner]) & (counts[owner] >= 3))
    many, _ = _repeated(own[long], runs[long])
    inside = np.zeros(len(owner) + 3, dtype=bool)
    for j in range(3):
        inside[starts[many] + j] = True
    return _per_text(owner[inside[: len(owner)]], texts)


def _most_frequent(owner: np.ndarray, words: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((words, owner))
    own, key = owner[order], words[order]
    out = np.zeros(texts, np.int64)
    if len(own):
        first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
        np.maximum.at(out, own[first], np.diff(np.r_[first, len(own)]))
    return out


def _kinds() -> np.ndarray:
    """What each byte counts for: 1 a character of a word, 2 symbol, 4 capital, 8 letter, 16 digit, 32 stop."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        space, inner = b == 0x20 or 0x09 <= b <= 0x0D, 0x80 <= b < 0xC0
        out[b] |= 1 * (not space and not inner) | 2 * (b in SYMBOLS) | 4 * (65 <= b <= 90)
        out[b] |= 8 * (65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0) | 16 * (48 <= b <= 57) | 32 * (b in b".,;:?")
    return out


_KINDS = _kinds()


@F.arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in STATS]))
def text_stats(texts: pa.Array) -> pa.Array:
    parts = [block_stats(raw, begins) for _, raw, begins in text_blocks(texts)]
    rows = np.concatenate(parts) if parts else np.zeros((0, len(STATS)), np.int64)
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATS))], STATS)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def votes() -> list[Column]:
    """The vote of each rule: 0 bad, 1 good, 2 abstains."""
    bad = [F.when(_share(part, whole) >= most, 0).otherwise(2) for _, part, whole, most, _ in SHARES]
    plain = F.lit(True)
    for _, part, whole, _, fine in SHARES:
        plain = plain & (_share(part, whole) <= fine)
    good = [plain, _share("n_stops", "n_words").between(0.05, 0.5), F.col("n_words") >= 2 * LEAST_WORDS]
    return bad + [F.when(g, 1).otherwise(2) for g in good]


def pattern() -> Column:
    """The votes of all rules as one number."""
    out = F.lit(0)
    for i, v in enumerate(votes()):
        out = out + v * 3**i
    return out


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return (pattern[:, None] // 3 ** np.arange(len(RULES))) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern; vote rates by rule, class and vote; share of good."""
    votes = votes_of(patterns)
    shown = np.eye(3)[votes]  # pattern x rule x vote
    # The start that tells the classes apart: one bad vote outweighs the good ones.
    balance = (votes == 1).sum(axis=1) - 4.0 * (votes == 0).sum(axis=1)
    posterior = 1 / (1 + np.exp(-balance.astype(float)))
    rates, share = np.full((len(RULES), 2, 3), 1 / 3), 0.5
    for _ in range(EM_ROUNDS):
        for c, weight in enumerate((1 - posterior, posterior)):
            seen = np.einsum("p,prv->rv", weight * counts, shown) + SMOOTHING
            rates[:, c] = seen / seen.sum(axis=1, keepdims=True)
        share = (posterior @ counts + SMOOTHING) / (counts.sum() + 2 * SMOOTHING)
        score = np.einsum("prv,rcv->pc", shown, np.log(rates)) + np.log([1 - share, share])
        posterior = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))
    return posterior, rates, float(share)


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior) and kept of every document."""
    s = documents.select("doc_id", text_stats(text_of()).alias("s")).select("doc_id", "s.*").withColumn("pattern", pattern())
    spark = documents.sparkSession
    # One row for each pattern that occurs: at most 3 to the number of rules.
    seen = s.groupBy("pattern").count().collect()
    numbers = np.array([r["pattern"] for r in seen], np.int64)
    posterior, _, _ = estimate(numbers, np.array([r["count"] for r in seen], float))
    table = spark.createDataFrame(
        [(int(p), round(float(q), 9)) for p, q in zip(numbers, posterior, strict=True)], "pattern int, quality double"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        s.join(F.broadcast(table), "pattern")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= KEEP))
    )
