"""Byte-pair encoding with a word lexicon compiled into a minimal acyclic transducer.

The frequent words of the corpus, counted over all documents, are encoded once and
compiled into an acyclic automaton whose equal suffixes are shared. Each edge holds the number
of words that come before those behind it, so that walking a word sums up to the word's
number, which leads to its ids. Tasks get the automaton as one block of bytes, bounded by ``LEXICON_WORDS`` and
``LEXICON_BYTES``, put it into a file of their own without a name and map it into memory.
All distinct words of some texts walk it at once, in numpy. Words it doesn't hold are merged exactly, pair by pair in
the order of the merge table.

The tokenizer file gives normal form, word pattern, merges and ids; special
tokens in a text are found as the library finds them, before the text is normalised.
Decoding gives the tokens of the ids, joined by spaces, as the file names no decoder.

Defined results: a null or empty text has no ids and decodes to the empty text; equal
texts have equal ids; the texts of other columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from olapkit.llm.common import text_of
from olapkit.workspace import materialize

#: Words of the lexicon, and the longest of them in bytes.
LEXICON_WORDS, LEXICON_BYTES = 40_000, 48
STEPS_A_DOUBLING = 64
#: Characters of text whose words are looked up at once, and merged words a task remembers.
SLICE_CHARS, REMEMBERED = 1 << 21, 200_000
#: Code points whose class is asked for at once, on the driver.
BLOCK_POINTS = 1 << 12

# The white space of Unicode, and the endings that the word pattern cuts off.
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ENDINGS = "s|t|re|ve|m|ll|d"


def code_points() -> Iterator[str]:
    """All code points but the surrogates, which no text holds, some at a time: the library takes hundreds of bytes for each."""
    for at in range(0, 0x110000, BLOCK_POINTS):
        if block := "".join(chr(c) for c in range(at, at + BLOCK_POINTS) if not 0xD800 <= c < 0xE000):
            yield block


def class_ranges(name: str) -> list[tuple[int, int]]:
    """The code points of a character class, as the library's regular expressions know it."""
    cut = pre_tokenizers.Split(Regex(rf"\p{{{name}}}+"), "removed", invert=True)
    out: list[tuple[int, int]] = []
    for block in code_points():
        for run, _ in cut.pre_tokenize_str(block):
            # A run may go on from the block before.
            goes_on = out and out[-1][1] + 1 == ord(run[0])
            out.append((out.pop()[0] if goes_on else ord(run[0]), ord(run[-1])))
    return out


def newer_small_letters() -> dict[int, str]:
    """Small letters that the library knows and this Python doesn't know yet."""
    out: dict[int, str] = {}
    for block in code_points():
        if unknown := [c for c in block if unicodedata.category(c) == "Cn"]:
            small = normalizers.Lowercase().normalize_str("\n".join(unknown)).split("\n")
            out |= {ord(a): b for a, b in zip(unknown, small, strict=True) if a != b}
    return out


def word_pattern(classes: dict[str, list[tuple[int, int]]], top: int) -> re.Pattern:
    """The word pattern over code points below ``top``, with the classes L and N written out."""
    letters, numbers = (
        "".join(f"\\U{a:08x}-\\U{min(b, top - 1):08x}" for a, b in classes[c] if a < top) for c in "LN"
    )
    # The alternatives start with different characters, so the commonest may come first.
    return re.compile(f"[{letters}]+|'(?:{ENDINGS})|[{numbers}]|[^{WHITE}{letters}{numbers}]+")


@dataclass
class Tokenizer:
    """What a tokenizer file says: the merges as pair of ids to rank and new id."""

    ranks: dict[tuple[int, int], int]  # of each pair of ids
    made: list[int]  # the id that a pair of this rank becomes
    inner: list[int]  # id of each byte inside a word
    last: list[int]  # and at its end
    names: list[str]  # token of each id
    special: dict[str, int]
    classes: dict[str, list[tuple[int, int]]]  # the code points of letters and numbers
    small: dict[int, str]  # small letters that Python lacks

    def __post_init__(self):
        """The same as arrays."""
        self.inner_ids, self.last_ids, self.made_ids = (np.array(x, np.int64) for x in (self.inner, self.last, self.made))
        keys = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.ranks.values()), np.int64)[order]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of some pairs; the number of merges for a pair that is none."""
        want = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, want), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == want, self.pair_ranks[at], len(self.made))

    @staticmethod
    def read(path: str) -> Tokenizer:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        made = [vocab[a + b] for a, b in pairs]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = [""] * (1 + max([*vocab.values(), *special.values()]))
        for name, i in [*vocab.items(), *special.items()]:
            names[i] = name
        letters = byte_letters()
        return Tokenizer(ranks, made, [vocab[c] for c in letters], [vocab[c + end] for c in letters], names, special, {c: class_ranges(c) for c in "LN"}, newer_small_letters())


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def merge_words(words: list[bytes], t: Tokenizer) -> list[bytes]:
    """The ids of each word, merged exactly; words of like length are merged at once."""
    out = [b""] * len(words)
    size = np.array([len(w) for w in words], np.int64)
    low = 0
    for width in (6, 9, 12, 16, 24, LEXICON_BYTES):
        rows = np.flatnonzero((size > low) & (size <= width))
        for at in range(0, len(rows), 8192):
            _merge_rows([words[i] for i in rows[at : at + 8192]], rows[at : at + 8192], width, t, out)
        low = width
    for i in np.flatnonzero(size > low).tolist():
        ids = [t.inner[b] for b in words[i][:-1]] + [t.last[words[i][-1]]]
        out[i] = np.array(_merged_long(ids, t), "<u4").tobytes()
    return out


def _merge_rows(words: list[bytes], number: np.ndarray, width: int, t: Tokenizer, out: list[bytes]) -> None:
    """In each row the pair of least rank, of those the leftmost, is merged until no row has one."""
    none = len(t.made)
    size = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    ids = np.zeros((len(words), width + 1), np.int64)
    ids[:, :width] = t.inner_ids[letters]
    every = np.arange(len(words))
    ids[every, size - 1] = t.last_ids[letters[every, size - 1]]
    ranks = np.full((len(words), width + 1), none, np.int64)
    ranks[:, :width] = t.rank_of(ids[:, :-1], ids[:, 1:])
    columns = np.arange(width + 1)
    ranks[columns >= (size - 1)[:, None]] = none
    while len(ids):
        best = ranks.argmin(axis=1)
        every = np.arange(len(ids))
        rank = ranks[every, best]
        live = rank < none
        for row in np.flatnonzero(~live).tolist():
            out[number[row]] = ids[row, : size[row]].astype("<u4").tobytes()
        ids, ranks, size, number, best, rank = (x[live] for x in (ids, ranks, size, number, best, rank))
        every = np.arange(len(ids))
        source = np.minimum(columns + (columns > best[:, None]), width)
        ids = np.take_along_axis(ids, source, axis=1)
        # The rank of the merged pair goes, the one behind it is that of the new id.
        ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= best[:, None]), width), axis=1)
        ids[every, best] = t.made_ids[rank]
        size = size - 1
        right = np.flatnonzero(best < size - 1)
        ranks[right, best[right]] = t.rank_of(ids[right, best[right]], ids[right, best[right] + 1])
        left = np.flatnonzero(best > 0)
        ranks[left, best[left] - 1] = t.rank_of(ids[left, best[left] - 1], ids[left, best[left]])


def _merged_long(ids: list[int], t: Tokenizer) -> list[int]:
    """The same with a heap and links, for words of any length."""
    n = len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := t.ranks.get((ids[i], ids[j]))) is not None:
            heapq.heappush(heap, (rank, i, ids[i], ids[j]))

    for i in range(n):
        offer(i)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or (ids[i], ids[j]) != (a, b):
            continue
        ids[i], alive[j], after[i] = t.made[rank], False, after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [x for x, ok in zip(ids, alive, strict=True) if ok]


def compile_lexicon(words: dict[bytes, bytes]) -> bytes:
    """The transducer of some words and their ids as one block of bytes."""
    ordered = sorted(words)
    register: dict[tuple, int] = {}
    below: list[int] = []

    def state(low: int, high: int, depth: int) -> int:
        final = low < high and len(ordered[low]) == depth
        low += final
        edges, count = [], int(final)
        while low < high:
            byte = ordered[low][depth]
            stop = bisect_left(ordered, ordered[low][:depth] + bytes([byte + 1]), low, high) if byte < 255 else high
            target = state(low, stop, depth + 1)
            edges.append((byte, target, count))
            count += below[target]
            low = stop
        found = register.setdefault((final, *edges), len(register))
        if found == len(below):
            below.append(count)
        return found

    root = state(0, len(ordered), 0)
    edges = sorted((s << 8 | b, t, c) for (_, *out), s in register.items() for b, t, c in out)
    ids = [words[w] for w in ordered]
    parts = [
        np.array([e[0] for e in edges], np.int64),
        np.array([e[1] for e in edges], np.int32),
        np.array([e[2] for e in edges], np.int32),
        np.array([key[0] for key in register], np.uint8),
        np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int64),
        np.frombuffer(b"".join(ids), "<u4"),
    ]
    head = struct.pack("<7q", root, *map(len, parts))
    return head + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """The transducer, mapped into memory from a file that has no name."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("<7q", self.map)
        at, parts = 56, []
        for kind, n in zip((np.int64, np.int32, np.int32, np.uint8, np.int64, "<u4"), sizes, strict=True):
            parts.append(np.frombuffer(self.map, kind, n, at))
            at += parts[-1].nbytes + -parts[-1].nbytes % 8
        self.keys, self.targets, self.skips, self.final, self.starts, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if the lexicon doesn't hold it."""
        out = np.full(len(words), -1, np.int64)
        size = np.array([len(w) for w in words])
        short = np.flatnonzero((size > 0) & (size <= LEXICON_BYTES))
        if not len(short) or not len(self.keys):
            return out
        width = int(size[short].max())
        letters = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in short), np.uint8).reshape(-1, width)
        state = np.full(len(short), self.root, np.int64)
        number = np.zeros(len(short), np.int64)
        live = np.arange(len(short))
        for depth in range(width):
            live = live[size[short[live]] > depth]
            want = state[live] << 8 | letters[live, depth]
            edge = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            known = self.keys[edge] == want
            state[live[~known]] = -1
            live, edge = live[known], edge[known]
            number[live] += self.skips[edge]
            state[live] = self.targets[edge]
        whole = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        out[short[whole]] = number[whole]
        return out

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.starts[number] : self.starts[number + 1]].tobytes()


class Splitter:
    """Cuts a text into words as the tokenizer file says; special tokens come as their ids."""

    def __init__(self, special: dict[str, int], classes: dict[str, list[tuple[int, int]]], small: dict[int, str]):
        self.special, self.small = special, small
        self.newer = re.compile("[" + "".join(map(re.escape, map(chr, small))) + "]") if small else None
        names = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if special else None
        # Patterns of more code points are slower; few texts need the last.
        self.plain, self.wide, self.all = (word_pattern(classes, top) for top in (0x80, 0x10000, 0x110000))
        self.marked = re.compile("[\u0300-\U0010ffff]").search
        self.composed = normalizers.NFC().normalize_str
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.plain.findall(text.lower())
        # Beyond the Latin letters the library's tables of marks differ from Python's.
        text = self.composed(text) if self.marked(text) else unicodedata.normalize("NFC", text)
        # Small letters come one by one: a capital sigma never becomes a final one.
        text = text.replace("Σ", "σ").lower()
        if self.newer is not None and self.newer.search(text):
            text = text.translate(self.small)
        return (self.all if self.beyond(text) else self.wide).findall(text)

    def __call__(self, text: str) -> list:
        if self.cut is None or not self.cut.search(text):
            return self.words(text)
        out: list = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.words(part)
        return out


class Encoder:
    def __init__(self, tokenizer: Tokenizer, lexicon: bytes):
        self.t, self.lexicon, self.split = tokenizer, Lexicon(lexicon), Splitter(tokenizer.special, tokenizer.classes, tokenizer.small)
        self.rest: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> dict:
        raw = [w.encode("utf-8") for w in words]
        found: dict = {}
        fresh: list[int] = []
        for i, number in enumerate(self.lexicon.numbers(raw).tolist()):
            if number >= 0:
                found[words[i]] = self.lexicon.ids_of(number)
            elif (ids := self.rest.get(words[i])) is not None:
                found[words[i]] = ids
            else:
                fresh.append(i)
        merged = dict(zip((words[i] for i in fresh), merge_words([raw[i] for i in fresh], self.t), strict=True))
        if len(self.rest) + len(merged) > REMEMBERED:
            self.rest.clear()
        self.rest.update(merged)
        return found | merged

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian numbers of 32 bits."""
        cut = [self.split(t) for t in texts]
        distinct = set().union(*cut)
        found = self.learn([w for w in distinct if isinstance(w, str)])
        found |= {i: struct.pack("<I", i) for i in distinct if isinstance(i, int)}
        for words in cut:
            yield b"".join(map(found.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.t.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def slices(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in runs of some ``SLICE_CHARS`` characters; a longer text is alone."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def frequent_words(documents: DataFrame, t: Tokenizer) -> list[str]:
    """The words that occur most often in all documents, at most ``LEXICON_WORDS``.

    A histogram of the counts tells from which count on words are few enough; only those come to the driver.
    """

    special, classes, small = t.special, t.classes, t.small

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(special, classes, small)
        for batch in batches:
            for part in slices(text.as_py() for text in batch.column(0)):
                seen: Counter = Counter()
                for text in part:
                    seen.update(split(text))
                words = [w for w in seen if isinstance(w, str) and len(w) <= LEXICON_BYTES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], ["word", "times"]
                )

    counts = documents.select(text_of().alias("text")).mapInArrow(count, "word string, times bigint")
    words = materialize(counts.groupBy("word").agg(F.sum("times").alias("times")), "words")
    # Counts of one step differ by one in a hundred or less; some thousand steps hold any count.
    step = F.floor(F.log2("times") * STEPS_A_DOUBLING)
    steps = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("times").alias("least"))
    least, so_far = None, 0
    for r in sorted(steps.collect(), reverse=True):
        so_far += r["words"]
        if so_far > LEXICON_WORDS:
            break
        least = r["least"]
    if least is None:
        return []
    return sorted(r["word"] for r in words.where(F.col("times") >= least).collect())


def lexicon_of(words: list[str], t: Tokenizer) -> bytes:
    raw = [w.encode("utf-8") for w in words]
    short = [w for w in raw if 0 < len(w) <= LEXICON_BYTES]
    return compile_lexicon(dict(zip(short, merge_words(short, t), strict=True)))


_ENCODED = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
    T.StructField("ids", T.BinaryType()),
]


def encode_documents(documents: DataFrame, tokenizer_path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and ids (little-endian, 32 bits each) if they are kept.

    A task hands on its results slice by slice, so it holds the ids of one slice, whatever the size of a batch.
    """
    t = Tokenizer.read(tokenizer_path)
    # Plain values, which workers can load without this library.
    told = {f.name: getattr(t, f.name) for f in fields(t)}
    shared = documents.sparkSession.sparkContext.broadcast((told, lexicon_of(frequent_words(documents, t), t)))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
    outcome = T.StructType([documents.schema["doc_id"], *(_ENCODED if keep_ids else _ENCODED[:-1])])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if own is None:
                told, lexicon = shared.value
                own = Encoder(Tokenizer(**told), lexicon)
            at = 0
            for part in slices(text.as_py() for text in batch.column(1)):
                kept, n, first, second = [], [], [], []
                for ids in own.encode(part):
                    n.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest())
                    second.append(hashlib.sha256(own.decode(ids).encode("utf-8")).hexdigest())
                    if keep_ids:
                        kept.append(ids)
                columns = [n, first, second, *([kept] if keep_ids else [])]
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *made], outcome.names)
                at += len(part)

    return documents.select("doc_id", text_of().alias("text")).mapInArrow(encode, outcome)
