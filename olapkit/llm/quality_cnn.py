"""Byte-level convolutional network that scores the quality of a text.

A text is cut into chunks of 256 bytes that overlap by one window, so that the
chunks cover the whole text and no window is lost between two of them. Each
byte is looked up in a small learned embedding; learned filters of eight bytes
slide over a chunk by two bytes; each filter keeps its largest answer in a chunk. A text is
described by the mean and the maximum of these over its chunks, which a
logistic layer turns into one probability.

The network is fitted on the driver with Adam from a bounded sample of labelled
rows (``SAMPLE_PER_CLASS`` rows a class; of a text of more than ``SAMPLE_CHARS`` characters as many, in
``PIECES`` seeded pieces from all of its parts), some of them cut to a passage so that short texts are learned
too. The sample is balanced, so the odds of the classes among all labels are put
back at the end. The weights are some kilobytes and travel with the tasks.
Scoring reads every byte of every text.

Defined results: a null or empty text gets the score of the bias alone; extra
columns are kept and play no part; equal texts get equal scores; repeated
labels of a document count as their least. Without labelled rows of both
classes every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from olapkit.llm.common import text_of

CHUNK, WIDTH, STRIDE = 256, 8, 2
STEP = CHUNK - WIDTH + STRIDE
EMBEDDING, FILTERS = 4, 16
PAD = 256
#: Labelled rows of each class that the network is fitted on, characters of each, and the pieces they come in.
SAMPLE_PER_CLASS, SAMPLE_CHARS, PIECES = 2000, 6000, 8
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7
#: Share of the texts that a training step sees as a short passage only, and its length.
PASSAGES, PASSAGE_BYTES = 0.4, (20, 400)
#: Chunks that are convolved at once.
BLOCK = 128
THRESHOLD = 0.7


@dataclass
class Weights:
    embedding: np.ndarray  # 257 x EMBEDDING, the last row for padding
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.dense, self.offset]


def chunk_starts(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts at ``begin`` with ``size`` bytes: text, start and end of every chunk."""
    chunks = np.where(size > 0, 1 + np.maximum(0, -(-(size - CHUNK) // STEP)), 0)
    owner = np.repeat(np.arange(len(size)), chunks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return owner, begin[owner] + place * STEP, (begin + size)[owner]


def chunk_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The chunks as rows of byte numbers, padded beyond the end of their text."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(PAD))


def windows(chunks: np.ndarray, w: Weights) -> np.ndarray:
    """The embedded windows of each chunk: chunks x places x WIDTH * EMBEDDING."""
    embedded = np.take(w.embedding, chunks, axis=0).reshape(len(chunks), -1)
    places = (CHUNK - WIDTH) // STRIDE + 1
    a, b = embedded.strides
    return np.lib.stride_tricks.as_strided(
        embedded, (len(chunks), places, WIDTH * EMBEDDING), (a, b * STRIDE * EMBEDDING, b)
    )


def pooled(chunks: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """The largest answer of each filter in each chunk, and the window that gave it."""
    views = windows(chunks, w)
    n, places, width = views.shape
    answers = (np.ascontiguousarray(views).reshape(-1, width) @ w.filters).reshape(n, places, -1)
    best = answers.argmax(axis=1)
    return np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0, :], best


def largest(chunks: np.ndarray, w: Weights) -> np.ndarray:
    views = windows(chunks, w)
    n, places, width = views.shape
    answers = np.ascontiguousarray(views).reshape(-1, width) @ w.filters
    return answers.reshape(n, places, -1).max(axis=1)


def describe(active: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Mean and maximum over the chunks of each text; zeros for a text without chunks."""
    out = np.zeros((texts, 2 * active.shape[1]), dtype=np.float32)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        whose, count = owner[first], np.diff(np.r_[first, len(owner)])
        out[whose, : active.shape[1]] = np.add.reduceat(active, first) / count[:, None]
        out[whose, active.shape[1] :] = np.maximum.reduceat(active, first)
    return out


def probabilities(data: np.ndarray, begin: np.ndarray, size: np.ndarray, w: Weights) -> np.ndarray:
    owner, start, end = chunk_starts(begin, size)
    active = np.empty((len(owner), FILTERS), dtype=np.float32)
    for at in range(0, len(owner), BLOCK):
        part = slice(at, at + BLOCK)
        chunks = chunk_bytes(data, start[part], end[part])
        active[part] = np.maximum(largest(chunks, w) + w.bias, 0)
    logit = describe(active, owner, len(size)) @ w.dense + w.offset[0]
    return 1 / (1 + np.exp(-logit.astype(np.float64)))


def as_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw) + b"\0", dtype=np.uint8), np.cumsum(size) - size, size


def initial(rng: np.random.Generator) -> Weights:
    real = np.float32
    return Weights(
        embedding=np.vstack([rng.normal(0, 1, (256, EMBEDDING)), np.zeros((1, EMBEDDING))]).astype(real),
        filters=rng.normal(0, 0.25, (WIDTH * EMBEDDING, FILTERS)).astype(real),
        bias=np.zeros(FILTERS, real),
        dense=rng.normal(0, 0.2, 2 * FILTERS).astype(real),
        offset=np.zeros(1, real),
    )


def gradients(w: Weights, chunks, owner, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss over some texts; only the window kept by a filter passes a gradient."""
    answers, best = pooled(chunks, w)
    active = np.maximum(answers + w.bias, 0)
    doc = describe(active, owner, len(label))
    error = (1 / (1 + np.exp(-(doc @ w.dense + w.offset[0]))) - label) / len(label)
    by_doc = error[:, None] * w.dense[None, :]
    count = np.maximum(np.bincount(owner, minlength=len(label)), 1)
    top = doc[:, FILTERS:]
    flow = (by_doc[:, :FILTERS] / count[:, None])[owner]
    flow = flow + by_doc[:, FILTERS:][owner] * (active == top[owner])
    flow = flow * (active > 0)
    places = best * STRIDE
    at = places[:, :, None] + np.arange(WIDTH)  # chunk x filter x byte of the window
    number = np.take_along_axis(chunks[:, None, :], at, axis=2)
    seen = w.embedding[number]  # chunk x filter x byte x embedding
    kernel = w.filters.T.reshape(FILTERS, WIDTH, EMBEDDING)
    d_kernel = np.einsum("cf,cfbe->fbe", flow, seen)
    d_seen = flow[:, :, None, None] * kernel[None]
    d_embedding = np.zeros_like(w.embedding)
    np.add.at(d_embedding, number.ravel(), d_seen.reshape(-1, EMBEDDING))
    d_embedding[PAD] = 0
    return [
        d_embedding,
        d_kernel.reshape(FILTERS, -1).T,
        flow.sum(axis=0),
        doc.T @ error,
        np.array([error.sum()]),
    ]


def passages(rng: np.random.Generator, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, some of them cut to a passage."""
    length = np.minimum(size, rng.integers(*PASSAGE_BYTES, len(size)))
    shift = (rng.random(len(size)) * (size - length + 1)).astype(np.int64)
    cut = rng.random(len(size)) < PASSAGES
    return np.where(cut, begin + shift, begin), np.where(cut, length, size)


def fit(texts: list[str], labels: list[int], odds: float | None = None) -> Weights:
    """Weights learned from the texts; without both classes a network that answers 0.5.

    ``odds``: how many times label 1 is as frequent as label 0 among all labels.
    """
    rng = np.random.default_rng(SEED)
    w = initial(rng)
    label = np.array(labels, dtype=np.float32)
    if len(label) == 0 or label.min() == label.max():
        w.dense[:], w.offset[:] = 0, 0
        return w
    data, begin, size = as_bytes(texts)
    first = [np.zeros_like(a) for a in w.arrays()]
    second = [np.zeros_like(a) for a in w.arrays()]
    step, steps = 0, EPOCHS * -(-len(label) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            own_begin, own_size = passages(rng, begin[pick], size[pick])
            owner, start, end = chunk_starts(own_begin, own_size)
            if not len(owner):
                continue
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for a, g, m, v in zip(
                w.arrays(),
                gradients(w, chunk_bytes(data, start, end), owner, label[pick]),
                first,
                second,
                strict=True,
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if odds:
        w.offset += np.float32(np.log(odds * (label == 0).sum() / (label == 1).sum()))
    return w


def held_out(doc_id: str) -> Column:
    """Whether a document's label must not be learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def usable_labels(labels: DataFrame) -> DataFrame:
    """One row for each document whose label may be learned from."""
    known = F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")
    return labels.where(known).groupBy("doc_id").agg(F.min("quality").alias("_label"))


def seeded_pieces(text: Column, seed: Column) -> Column:
    """The text, or of a long one a seeded piece from each of ``PIECES`` equal parts."""
    length, part = F.length(text), F.floor(F.length(text) / PIECES)
    size = SAMPLE_CHARS // PIECES
    starts = [part * i + F.pmod(F.xxhash64(F.lit(SEED), seed, F.lit(i)), part - size + 1) for i in range(PIECES)]
    return F.when(length <= SAMPLE_CHARS, text).otherwise(
        F.concat(*[F.substring(text, (s + 1).cast("int"), F.lit(size)) for s in starts])
    )


def training_rows(documents: DataFrame, usable: DataFrame) -> DataFrame:
    """The bounded sample: the label rows of each class with the least hash of their id.

    They are the broadcast side, at most two times ``SAMPLE_PER_CLASS`` rows;
    the texts of other documents never move.
    """
    parts = [
        usable.where(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS)
        for c in (0, 1)
    ]
    return documents.select("doc_id", seeded_pieces(text_of(), F.col("doc_id")).alias("_text")).join(
        F.broadcast(parts[0].unionByName(parts[1])), "doc_id"
    )


def train(documents: DataFrame, labels: DataFrame) -> Weights:
    usable = usable_labels(labels)
    counts = {r["_label"]: r["count"] for r in usable.groupBy("_label").count().collect()}
    # Repeated ids of documents must not pass the bound of the sample.
    sample = training_rows(documents, usable).orderBy(F.xxhash64("doc_id", "_text")).limit(2 * SAMPLE_PER_CLASS)
    rows = sorted((r["_text"], r["_label"]) for r in sample.collect())
    odds = counts[1] / counts[0] if len(counts) == 2 else None
    return fit([r[0] for r in rows], [r[1] for r in rows], odds)


def scorer(w: Weights):
    """A column function from texts to probabilities, straight from Arrow's bytes."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        return pa.array(np.round(probabilities(raw, at[:-1], np.diff(at), w), 6))

    return score


def score_documents(documents: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """The documents with a column ``name``: the probability that their quality is 1."""
    return documents.withColumn(name, scorer(train(documents, labels))(text_of()))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least ``THRESHOLD``, with their own columns whatever their names."""
    return documents.where(scorer(train(documents, labels))(text_of()) >= THRESHOLD)
