"""Hashes of words and word runs for whole batches of texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from olapkit.llm.common import SPACE_BYTES

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes of text that are hashed at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACE_BYTES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, its block's bytes, and where texts begin in them (and the end)."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_BYTES, side="right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer block comes."""

    size = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, BLOCK_BYTES)
            self.up, self.down = _powers(BASE, self.size), _powers(INVERSE, self.size)
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all words of a block: the number of their text, and a hash of their bytes."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    black = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[begins] = True
    starts = np.flatnonzero(black & (edge[:n] | ~np.r_[False, black[:-1]]))
    ends = np.flatnonzero(black & (edge[1:] | ~np.r_[black[1:], False])) + 1
    up, down = _POWERS.get(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    owner = np.searchsorted(begins, starts, side="right") - 1
    return owner, mix(h + (ends - starts).astype(np.uint64))


def line_hashes(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of a block: the number of their text, a hash, and whether they hold a word."""
    n = len(raw)
    feeds = np.flatnonzero(raw == 0x0A)
    full = np.flatnonzero(np.diff(begins) > 0)
    starts = np.sort(np.r_[begins[full], feeds + 1])
    # A line feed at the end of a text starts an empty line of that text.
    ends = np.sort(np.r_[begins[full + 1], feeds])
    owner = np.searchsorted(begins[full], ends, side="left") - 1
    owner = full[np.maximum(owner, 0)]
    up, down = _POWERS.get(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    black = np.r_[0, np.cumsum(~_SPACE[raw])]
    h = (total[ends] - total[starts]) * down[np.minimum(starts, n)]
    return owner, mix(h + (ends - starts).astype(np.uint64)), black[ends] > black[starts]


def shingles(owner: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of a text; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return owner, words
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    count = np.diff(np.r_[first, n])
    left = np.repeat(count, count) - (np.arange(n) - np.repeat(first, count))  # words from here on
    factor = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    total = words * factor[0]
    for j in range(1, width):
        total[: n - j] += np.where(left[: n - j] > j, words[j:] * factor[j], np.uint64(0))
    whole = left >= width
    whole[first[count < width]] = True
    return owner[whole], mix(total[whole])
