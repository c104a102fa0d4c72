"""Hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores.

Tokens are the words of a text with A to Z lower-cased, then one end. A hidden state emits each
token and is followed by another state; the probability of a text is the sum over all ways
through the states, which the forward recursion gives exactly, rescaled at every token.

States emit classes of tokens. The end is a class; so is every word that makes up at least one in
``FREQUENT`` of all training tokens, at most ``FREQUENT`` words by arithmetic. All other words, whose number grows
with the corpus, share ``RARE`` classes by their last two bytes; such a word's share of its class is its
smoothed count over the training documents, with one more word for all unseen ones. Words that make up at least one in
``LISTED`` tokens, at most ``LISTED`` of them, are sent to all tasks with their counts; the counts of all others
are joined to the documents by a shuffle, in which no word has a larger share.

Training is incremental Baum-Welch: the training documents are dealt into ``PARTS``; a round takes one
part's expected counts under the present model, puts them in the place of that part's earlier ones, and
estimates the model anew from the counts of all parts. Every training document is visited
``PASSES`` times. Expected counts are summed in the tasks, then by class in a shuffle; the driver holds states
times classes numbers for each part, whatever the number of documents.

Documents of a block are walked together, one token of each at a time, longest first.

Defined results: a null text counts as empty; an empty text is one end; a null id is not held out; equal texts have
equal scores; repeated rows count each; other columns play no part. Without
training documents every base probability is 1 and the model is uniform. An empty table has no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from olapkit.llm.common import text_of
from olapkit.workspace import materialize

FREQUENT, RARE, STATES = 1 << 14, 64, 12
LISTED = 1 << 19
PARTS, PASSES = 8, 2
#: Added to each count of the base model and of the words of a class.
ADDED = 0.1
#: Expected counts that every state has before it sees a document: transitions, and emissions in all.
SMOOTH_MOVES, SMOOTH_EMITS = 0.1, 10.0
SEED = 7
#: Bytes of text that are cut at once, and tokens that are walked at once; a longer text is alone.
BLOCK_BYTES, BLOCK_TOKENS = 1 << 22, 1 << 18
HELD_OUT_OF = 10


def held_out(doc_id: str) -> Column:
    """Whether a document is only scored; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    """The words; only ASCII letters and white space change, both as asked for."""
    return text.lower().split()


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RARE


def rare_class_of(word: str) -> Column:
    return F.crc32(F.substring(F.encode(F.col(word), "UTF-8"), -2, 2)) % RARE


def slices(texts: list[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > size:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def binary(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.large_binary()).to_pylist()


# Counts


def word_counts(training: DataFrame) -> DataFrame:
    """word, times: every word of the training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary(batch.column(0))
            for first, last in slices(texts):
                seen: Counter = Counter()
                for t in texts[first:last]:
                    seen.update(tokens(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())],
                    ["word", "times"],
                )

    counted = training.select(text_of().alias("text")).mapInArrow(count, "word string, times bigint")
    return counted.groupBy("word").agg(F.sum("times").alias("times"))


@dataclass(frozen=True)
class Vocabulary:
    """Totals over the training documents, the listed words and their counts, and the rare classes' totals.

    Class 0 is the end, then come the frequent words, then the rare classes.
    """

    total: int
    distinct: int
    ends: int
    words: list[bytes]
    times: np.ndarray
    frequent: np.ndarray  # whether each listed word is a class of its own
    rare: dict[int, tuple[int, int]]

    @classmethod
    def of(cls, words: DataFrame, documents: int) -> "Vocabulary":
        met = words.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        total, distinct = met["n"] + documents, met["v"] + (documents > 0)
        listed = words.where(F.col("times") >= total / LISTED).toArrow()
        pairs = sorted(zip(binary(listed.column("word").combine_chunks()), listed.column("times").to_pylist(), strict=True))
        others = words.where(F.col("times") < total / FREQUENT).groupBy(rare_class_of("word").alias("c"))
        rare = {r["c"]: (r["n"], r["v"]) for r in others.agg(F.sum("times").alias("n"), F.count("*").alias("v")).collect()}
        times = np.array([n for _, n in pairs], np.int64)
        return cls(total, distinct, documents, [w for w, _ in pairs], times, times >= total / FREQUENT, rare)

    @property
    def classes(self) -> int:
        return 1 + int(self.frequent.sum()) + RARE

    @property
    def scale(self) -> float:
        """What the base model divides its counts by."""
        return self.total + ADDED * (self.distinct + 1)

    def class_counts(self) -> np.ndarray:
        out = np.zeros(self.classes)
        out[0] = self.ends
        out[1 : -RARE] = self.times[self.frequent]
        for c, (n, _) in self.rare.items():
            out[c - RARE] = n
        return out

    def rare_scales(self) -> list[float]:
        """What the counts of the words of each rare class are divided by."""
        return [n + ADDED * (kinds + 1) for n, kinds in (self.rare.get(c, (0, 0)) for c in range(RARE))]


@dataclass(frozen=True)
class Entries:
    """What is known of the end (entry 0), the listed words, and other words by rare class (the last ``RARE``)."""

    kind: np.ndarray  # class
    known: np.ndarray
    base: np.ndarray  # log10 under the base model; 0 for other words, whose counts come by a join
    within: np.ndarray  # log10 of the share of the class

    @classmethod
    def of(cls, v: Vocabulary) -> "Entries":
        own = v.frequent
        rare = np.array([rare_class(w) for w in v.words], np.int64)
        first_rare, none = v.classes - RARE, np.zeros(RARE)
        kind = np.r_[0, np.where(own, np.cumsum(own), first_rare + rare), first_rare + np.arange(RARE)]
        counts = np.r_[v.ends, v.times] + ADDED
        share = np.where(own, 1.0, counts[1:] / np.array(v.rare_scales())[rare])
        return cls(
            kind.astype(np.int32),
            np.r_[float(v.ends > 0), np.ones(len(rare)), none],
            np.r_[np.log10(counts / v.scale), none],
            np.r_[0.0, np.log10(share), none],
        )


# The model


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # state
    move: np.ndarray  # state x next state
    emit: np.ndarray  # class x state

    @classmethod
    def first(cls, class_counts: np.ndarray) -> "Model":
        """States that differ by seeded noise and mostly stay."""
        shares = (class_counts + ADDED) / (class_counts + ADDED).sum()
        emit = shares[:, None] * np.random.default_rng(SEED).gamma(1.0, 1.0, (len(shares), STATES))
        stay = 0.5 * np.eye(STATES) + 0.5 / STATES
        return cls(np.full(STATES, 1 / STATES), stay, emit / emit.sum(axis=0))

    @classmethod
    def estimate(cls, counts: "Counts", class_counts: np.ndarray) -> "Model":
        shares = (class_counts + ADDED) / (class_counts + ADDED).sum()
        start = counts.start + SMOOTH_MOVES
        move = counts.move + SMOOTH_MOVES
        emit = counts.emit + SMOOTH_EMITS * shares[:, None]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


@dataclass
class Counts:
    """Expected counts of one part or of all."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, classes: int) -> "Counts":
        return cls(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((classes, STATES)))

    def __add__(self, other: "Counts") -> "Counts":
        return Counts(self.start + other.start, self.move + other.move, self.emit + other.emit)


class Walk:
    """Several texts, token by token: at step t the first ``live[t]`` of them, longest first, have a token."""

    def __init__(self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        steps = int(lengths[0])
        self.live = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.at = np.r_[0, np.cumsum(self.live)]
        self.text = np.arange(self.at[-1]) - np.repeat(self.at[:-1], self.live)
        self.token = classes[starts[self.text] + np.repeat(np.arange(steps), self.live)]

    def forward(self, m: Model) -> tuple[np.ndarray, np.ndarray]:
        """State probabilities after each token, and the probability of each token given those before it."""
        given, ones = np.empty(len(self.token)), np.ones(STATES)
        alpha = m.emit[self.token]
        moved = np.empty((len(self.lengths), STATES))
        moved[:] = m.start
        at = self.at.tolist()
        for t in range(len(self.live)):
            first, end = at[t], at[t + 1]
            here, n = alpha[first:end], end - first
            if t:
                np.matmul(alpha[at[t - 1] : at[t - 1] + n], m.move, out=moved[:n])
            np.multiply(here, moved[:n], out=here)
            s = np.matmul(here, ones, out=given[first:end])
            np.divide(here, s[:, None], out=here)
        return alpha, given

    def log10(self, m: Model) -> np.ndarray:
        """Log10 of the probability of each text."""
        _, given = self.forward(m)
        return np.bincount(self.text, np.log10(given), len(self.lengths))

    def expected(self, m: Model, into: Counts) -> None:
        """Add the expected counts of these texts."""
        alpha, given = self.forward(m)
        back = m.move.T.copy()
        # What a token says of the state that emits it, then with all tokens after it.
        later = m.emit[self.token]
        later /= given[:, None]
        beta = np.ones_like(alpha)
        at = self.at.tolist()
        for t in range(len(self.live) - 1, 0, -1):
            first, end, before = at[t], at[t + 1], at[t - 1]
            np.multiply(later[first:end], beta[first:end], out=later[first:end])
            np.matmul(later[first:end], back, out=beta[before : before + end - first])
        second = at[1] if len(at) > 1 else 0
        # The same text's token one step before: as many rows up as texts were live then.
        earlier = self.at[:-1][np.repeat(np.arange(len(self.live)) - 1, self.live)[second:]] + self.text[second:]
        into.move += (alpha[earlier].T @ later[second:]) * m.move
        alpha *= beta
        into.start += alpha[: self.live[0]].sum(axis=0)
        for s in range(STATES):
            into.emit[:, s] += np.bincount(self.token, alpha[:, s], len(into.emit))


def walks(column: pa.Array) -> Iterator[tuple[np.ndarray, Walk]]:
    """Numbers of the texts of a walk, and the walk; texts of similar length go together."""
    classes = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    group = (np.cumsum(lengths[order]) - lengths[order]) // BLOCK_TOKENS
    for texts in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(texts):
            yield texts, Walk(classes, starts[texts], lengths[texts])


# Documents


_SEQUENCE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("base", pa.float64()),
        ("within", pa.float64()),
        ("classes", pa.list_(pa.int32())),
        ("rare", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))),
    ]
)


def sequences(documents: DataFrame, v: Vocabulary) -> DataFrame:
    """Per document its classes, its unlisted words, and what the other tokens add to the scores."""
    shared = documents.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, e = None, Entries.of(shared.value)
        other = len(shared.value.words) + 1
        for batch in batches:
            number = number or {w: 1 + i for i, w in enumerate(shared.value.words)}
            texts = binary(batch.column(2))
            for first, last in slices(texts):
                codes: list[int] = []
                sizes, rare, rare_sizes = [], [], []
                for t in texts[first:last]:
                    words = tokens(t)
                    own = list(map(number.get, words))
                    seen = Counter(w for w, c in zip(words, own, strict=True) if c is None) if None in own else {}
                    if seen:
                        unlisted = {w: other + rare_class(w) for w in seen}
                        own = [unlisted[w] if c is None else c for w, c in zip(words, own, strict=True)]
                        rare += seen.items()
                    rare_sizes.append(len(seen))
                    codes += own
                    codes.append(0)
                    sizes.append(len(own) + 1)
                size, code = np.array(sizes, np.int64), np.array(codes, np.int64)
                ends = np.r_[0, np.cumsum(size)]
                owner = np.repeat(np.arange(len(size)), size)
                listed = pa.StructArray.from_arrays(
                    [
                        pa.array([w for w, _ in rare], pa.binary()).cast(pa.string()),
                        pa.array([n for _, n in rare], pa.int32()),
                    ],
                    ["word", "n"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(size),
                        pa.array(np.bincount(owner, e.known[code], len(size)).astype(np.int64)),
                        pa.array(np.bincount(owner, e.base[code], len(size))),
                        pa.array(np.bincount(owner, e.within[code], len(size))),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(e.kind[code])),
                        pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(rare_sizes)], pa.int32()), listed),
                    ],
                    schema=_SEQUENCE,
                )

    kind = (
        "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, within double, "
        "classes array<int>, rare array<struct<word string, n int>>"
    )
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), text_of().alias("text")
    ).mapInArrow(run, kind)


_SUMS = [f"s{i}" for i in range(STATES)]


def expected_counts(part: DataFrame, m: Model) -> Counts:
    """The expected counts of a part. Rows: a class, or -1 the start, or -2 - i the moves from state i."""
    shared = part.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, own = shared.value, Counts.none(len(shared.value.emit))
        for batch in batches:
            for _, walk in walks(batch.column(0)):
                walk.expected(m, own)
        seen = np.flatnonzero(own.emit.any(axis=1))
        rows = np.r_[own.emit[seen], own.start[None, :], own.move]
        keys = np.r_[seen, -1, -2 - np.arange(STATES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), *(pa.array(rows[:, s]) for s in range(STATES))], ["class", *_SUMS]
        )

    summed = part.select("classes").mapInArrow(run, "class int, " + ", ".join(f"{s} double" for s in _SUMS))
    rows = summed.groupBy("class").agg(*[F.sum(s).alias(s) for s in _SUMS]).collect()
    shared.unpersist()
    out = Counts.none(len(m.emit))
    for r in rows:
        # Sums of tasks come in any order; their last digits must not decide.
        sums = np.round(r[1:], 6)
        if r[0] >= 0:
            out.emit[r[0]] = sums
        elif r[0] == -1:
            out.start = sums
        else:
            out.move[-2 - r[0]] = sums
    return out


def train(stored: DataFrame, v: Vocabulary) -> Model:
    class_counts = v.class_counts()
    model = Model.first(class_counts)
    if not v.ends:
        return model
    parts = [Counts.none(v.classes) for _ in range(PARTS)]
    training = stored.where(~F.col("held_out"))
    for _ in range(PASSES):
        for i in range(PARTS):
            parts[i] = expected_counts(training.where(F.col("_part") == i), model)
            model = Model.estimate(sum(parts, Counts.none(v.classes)), class_counts)
    return model


def forward_scores(stored: DataFrame, m: Model) -> DataFrame:
    """_row and the log10 probability of its classes."""
    shared = stored.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for texts, walk in walks(batch.column(1)):
                out[texts] = walk.log10(shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["_row", "forward"])

    return stored.select("_row", "classes").mapInArrow(run, "_row bigint, forward double")


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = documents.sparkSession
    training = documents.where(~held_out("doc_id"))
    words = materialize(word_counts(training), "word-counts")
    v = Vocabulary.of(words, training.count())
    rows = sequences(documents, v).withColumn("_row", F.monotonically_increasing_id())
    # In order of their parts, so that a round over one part skips the pages of the others.
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(PARTS))).sortWithinPartitions("_part")
    stored = materialize(dealt, "sequences")
    model = train(stored, v)

    # At most RARE rows.
    totals = spark.createDataFrame(list(enumerate(v.rare_scales())), "c bigint, of double")
    times = F.coalesce("times", F.lit(0)) + ADDED
    met = stored.select("_row", F.explode("rare").alias("r")).select("_row", "r.word", "r.n").join(words, "word", "left")
    seldom = (
        met.withColumn("c", rare_class_of("word"))
        .join(F.broadcast(totals), "c")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("times").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10(times / v.scale)).alias("more_base"),
            F.sum(F.col("n") * F.log10(times / F.col("of"))).alias("more_score"),
        )
    )
    whole = stored.drop("classes", "rare", "_part").join(forward_scores(stored, model), "_row").join(seldom, "_row", "left")

    def both(first: Column, more: str) -> Column:
        return first + F.coalesce(more, F.lit(0))

    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        both(F.col("known"), "more_known").alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        both(F.col("base"), "more_base").alias("base_score"),
        both(F.col("forward") + F.col("within"), "more_score").alias("score"),
    )
