"""Runs of repeating words: match lengths along the diagonals of a text against itself.

Diagonal q pairs each word with the one q before it. Along it, the number of words matched in a
row grows with each earlier occurrence at lag q and ends at the first word that differs. A
diagonal that ends with at least q matches, and 12 words in all, is a run of period q, unless a shorter
period spans the same words.

The sparse table keeps only active diagonals, those with an earlier occurrence. A text of one
repeated word would still keep all n of them at each word. So lags are taken by octaves: a run with a lag
in [2^k, 2^(k+1)) matches 2^k words in a row at least, hence contains a whole block of half as many that starts at
a multiple of its own length. Only such blocks look up their earlier occurrences, and
each of these adds a whole block to the active diagonal. A diagonal whose next block
doesn't match ends there; if its length can suffice, its two ends are found to the word, and it
emits its run. At most 2n blocks and lags meet in an octave whatever the text, n log n in all, and few in plain prose.

Blocks are told apart by exact numbers: those of 2^(j+1) words by the numbers of their two halves.
Numbers are per text, so that many texts are searched as one list of words.

Defined results: a null or empty text has no words, no runs, and hashes of the empty string; a
null id alters nothing; equal texts with equal ids have equal results, repeated rows count each; other
columns play no part. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from olapkit.llm.common import text_of

#: Least number of words of a run, and of its periods.
LEAST_WORDS, LEAST_TURNS = 12, 2
#: Bytes of text that are searched at once; a longer text is alone.
BLOCK_BYTES = 1 << 20


def block_level(octave: int) -> int:
    """Log2 of the words of a block that every run with a lag of this octave contains, well aligned.

    A run of lag q matches at least max(q, 12 - q) words; a row of 2b - 1 contains a block of b.
    """
    least = min(max((LEAST_TURNS - 1) * q, LEAST_WORDS - q) for q in range(1 << octave, 2 << octave))
    return max((least + 1) // 2, 1).bit_length() - 1


@dataclass(frozen=True)
class Runs:
    """First word, words, and period of each run; words are numbered over the whole list."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class Blocks:
    """Numbers of the blocks of 2^level words that start at each word; -1 if no other block is equal."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self._add(np.arange(self.n), words)

    def _add(self, at: np.ndarray, key: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        value = key[order]
        new = np.r_[True, value[1:] != value[:-1]] if len(value) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        shared = (np.bincount(number, minlength=1) > 1)[number] if len(value) else new
        names = np.full(self.n, -1, np.int64)
        names[at[order][shared]] = number[shared]
        self.levels.append(names)
        #: Starts of the blocks that occur again, by number and place.
        self.known.append(at[order][shared])

    def level(self, j: int) -> np.ndarray:
        while len(self.levels) <= j:
            half, names = 1 << (len(self.levels) - 1), self.levels[-1]
            at = np.sort(self.known[-1])
            at = at[at + half < self.n]
            at = at[names[at + half] >= 0]
            self._add(at, names[at] * self.n + names[at + half])
        return self.levels[j]

    def same(self, j: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the blocks at a and b are equal; false where they leave the list."""
        fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) + (1 << j) <= self.n)
        out = np.zeros(len(a), bool)
        names = self.level(j)
        x = names[a[fits]]
        out[fits] = (x >= 0) & (x == names[b[fits]])
        return out


def diagonals(blocks: Blocks, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lag, first and last word of each row of matching aligned blocks whose lag is of this octave."""
    j = block_level(octave)
    size, names = 1 << j, blocks.level(j)
    known = blocks.known[j]
    low, high = 1 << octave, (2 << octave) - 1
    # Blocks that occur again, as (number, place) in one growing key.
    keys = names[known] * blocks.n + known
    at = known[known % size == 0]
    first = np.searchsorted(keys, names[at] * blocks.n + np.maximum(at - high, 0))
    last = np.searchsorted(keys, names[at] * blocks.n + (at - low), side="right")
    last = np.where(at >= low, np.maximum(first, last), first)
    met = last - first
    later = np.repeat(at, met)
    earlier = known[np.arange(len(later)) - np.repeat(np.cumsum(met) - met, met) + np.repeat(first, met)]
    lag = later - earlier
    # One diagonal after the other, each from its first word to its last: the counter of a lag goes on
    # while the next block matches too.
    order = np.lexsort((later, lag))
    lag, later = lag[order], later[order]
    new = np.r_[True, (lag[1:] != lag[:-1]) | (later[1:] != later[:-1] + size)] if len(lag) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(lag)] - 1 if len(begin) else begin
    return lag[begin], later[begin], later[end] + size - 1


def find_runs(words: np.ndarray) -> Runs:
    """All runs of a list of word numbers, by start and then period."""
    blocks = Blocks(words)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    octave = 0
    while 1 << octave <= len(words) // LEAST_TURNS:
        j = block_level(octave)
        blocks.level(j)
        if not len(blocks.known[j]):
            break
        lag, first, last = diagonals(blocks, octave)
        near = last - first + 2 * (1 << j) - 1 >= np.maximum((LEAST_TURNS - 1) * lag, LEAST_WORDS - lag)
        lag, first, last = lag[near], first[near], last[near]
        # Less than a block is missing at either end.
        for k in range(j - 1, -1, -1):
            step = 1 << k
            last = last + step * blocks.same(k, last + 1, last + 1 - lag)
            first = first - step * blocks.same(k, first - step, first - step - lag)
        whole = (last - first + 1 >= (LEAST_TURNS - 1) * lag) & (last - first + 1 + lag >= LEAST_WORDS)
        found.append((first[whole] - lag[whole], last[whole], lag[whole]))
        octave += 1
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none)
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # Of the periods of the same words the smallest is the run's.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return Runs(start[order], (end - start + 1)[order], period[order])


def altered(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word stands at each place, for the texts that are altered: from word a on, p words repeat."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each word stays: no run holds it after the run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:n] == 0


_RECORD = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(n, pa.int64()) for n in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")],
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
_ROWS = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start bigint, length bigint, period bigint>>, "
    "collapsed string"
)


def examine(doc_ids: list[int | None], texts: list[bytes], alter: bool, keep: bool) -> pa.RecordBatch:
    """The rows of some texts; their words are searched as one list."""
    words_of, numbers, sizes, base = [], [], [], 0
    for i, t in zip(doc_ids, texts, strict=True):
        words = t.split()
        order = altered(len(words), i) if alter else None
        if order is not None:
            words = list(map(words.__getitem__, order.tolist()))
        seen: dict[bytes, int] = {}
        # Numbers of one text are never those of another.
        numbers += [seen.setdefault(w, len(seen) + base) for w in words]
        base += len(seen)
        words_of.append(words)
        sizes.append(len(words))
    runs = find_runs(np.array(numbers, np.int64))
    ends = np.cumsum(np.array(sizes, np.int64))
    begins = ends - sizes
    place = np.searchsorted(runs.start, np.r_[begins, ends[-1]] if len(ends) else begins)
    rows = []
    for d, (doc_id, words) in enumerate(zip(doc_ids, words_of, strict=True)):
        own = slice(int(place[d]), int(place[d + 1]))
        start, length, period = runs.start[own] - begins[d], runs.length[own], runs.period[own]
        if len(start):
            best = int(np.argmax(length))  # the first of the longest: by start, then period
            top = [int(start[best]), int(length[best]), int(period[best])]
            top.append(1000 * top[1] // top[2])
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
            stays = kept_words(len(words), start, length, period)
            collapsed = b" ".join(map(words.__getitem__, np.flatnonzero(stays).tolist()))
        else:
            top, listed, collapsed = [None] * 4, "", b" ".join(words)
        shown = [{"start": s, "length": n, "period": p} for s, n, p in zip(start, length, period, strict=True)] if keep else None
        rows.append(
            (
                doc_id,
                len(words),
                len(start),
                *top,
                hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(collapsed).hexdigest(),
                shown,
                collapsed.decode() if keep else None,
            )
        )
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _RECORD, strict=True)], schema=_RECORD)


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > BLOCK_BYTES:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def runs_of_documents(documents: DataFrame, alter: bool = False, keep: bool = False) -> DataFrame:
    """Per document the number of runs, the longest, and hashes of all runs and of the text without repeats.

    ``keep`` adds the runs and the collapsed text themselves. ``alter`` first repeats the end of some texts, by a
    rule on the id (see ``altered``), so that long runs are sure to occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            for first, last in slices(texts):
                yield examine(doc_ids[first:last], texts[first:last], alter, keep)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, _ROWS)
