"""Alignment of two tokenizers: the ends of their tokens merged along diagonals.

A text is cut by tokenizer A and by tokenizer B. Merging the two sorted lists of token ends
gives everything: each end that is taken closes a stretch of bytes that lies in exactly one
token of A and one of B, which is a link of the two, and an end that both have closes a group.

The merge runs on merge paths. Diagonal number d of the grid (ends of A, ends of B) is crossed where
i + j = d; a binary search along it tells how many ends of each list are among the first d of the
merge. Diagonals ``PIECE`` apart cut the merge into pieces of equal work, which know nothing of
each other and are walked all at once, one step of every piece at a time. Each emits its links
and the groups that end in it; a group that is open at the end of a piece is continued
by the next one, so that group numbers follow from the running total of the pieces' closed groups.
All texts of a block are merged as one pair of lists, as their ends never meet across texts.

How often two ids are linked is counted over all documents. Pairs that hold at least one in ``HOT``
of all links are at most ``HOT`` by arithmetic: they are broadcast, and all others are
joined by a shuffle, in which no pair has more than that share.

Defined results: a text that is null or empty, or whose tokens do not spell a space and the text,
has no tokens, zeros, and an empty digest; equal texts have equal results; repeated rows count
each; null ids stay null; other columns play no part. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from olapkit.llm.common import text_of
from olapkit.workspace import materialize

#: Ends in a piece of the merge.
PIECE = 64
#: Pairs of this share of all links or more are broadcast, hence at most so many.
HOT = 1 << 18
#: Characters whose tokens are merged at once; a longer text is a block of its own.
BLOCK_CHARS = 1 << 18

_FAR = np.iinfo(np.int64).max

#: What cuts a text into words before the byte-level merges; a fixed value of that scheme.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# Tokenizers


@dataclass(frozen=True)
class Files:
    """The contents of the two vocabulary files."""

    byte_level: bytes
    pieces: bytes

    @classmethod
    def read(cls, byte_level_path: str, pieces_path: str) -> "Files":
        with open(byte_level_path, "rb") as f, open(pieces_path, "rb") as g:
            return cls(f.read(), g.read())


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it can be shown, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer file; special tokens in a text are plain text.

    Where the merges are in the order of their ids, and words are cut in the usual way, the ids are the
    ranks of the merges, and the faster library that wants ranks gives the same tokens.
    """

    def __init__(self, content: bytes):
        told = json.loads(content)
        model, vocabulary = told["model"], told["model"]["vocab"]
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
        for name, i in vocabulary.items():
            if name not in special:
                self.bytes[i] = bytes(letters[c] for c in name)
        for name, i in special.items():
            self.bytes[i] = name.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocabulary.get("".join(m)) for m in merges]
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        cut = told["pre_tokenizer"] or {}
        ranked = ids == sorted(i for i in ids if i is not None) and len(set(ids)) == len(ids)
        plain = all(cut.get(k) == v for k, v in usual.items()) and told["normalizer"] is None
        if ranked and plain:
            import tiktoken

            ranks = {self.bytes[i]: i for n, i in vocabulary.items() if n not in special}
            fast = tiktoken.Encoding("aligned", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_str(content.decode())
            slow.encode_special_tokens = True
            slow.no_truncation()
            slow.no_padding()
            self.encode = lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A piece model, which itself puts a space before a text."""

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes = []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            self.bytes.append(bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode())
        self.encode = lambda texts: model.encode(texts, num_threads=1)


# The merge


def cross(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d of the merge, for each d; of equal ends, a's is first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        first = np.zeros(len(low), bool)
        first[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low


@dataclass(frozen=True)
class Merged:
    """Links as token numbers of A and B, and the group of each link; in the order of the bytes."""

    a: np.ndarray
    b: np.ndarray
    group: np.ndarray


def merge_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Merged:
    """Links and groups of two growing lists of token ends, the last of both being equal."""
    starts = np.arange(0, len(a) + len(b), piece, dtype=np.int64)
    i = cross(a, b, starts)
    j = starts - i
    ends_a, ends_b, before = np.r_[a, _FAR], np.r_[b, _FAR], np.r_[-1, a]
    shape = (piece, len(starts))
    of_a, of_b = np.empty(shape, np.int64), np.empty(shape, np.int64)
    link, closed = np.empty(shape, bool), np.empty(shape, bool)
    for step in range(piece):
        end_a, end_b = ends_a[i], ends_b[j]
        live = np.minimum(end_a, end_b) < _FAR
        takes_a = live & (end_a <= end_b)
        # The other list had this end just before, so that no bytes lie in between.
        both = live & ~takes_a & (end_b == before[i])
        of_a[step], of_b[step], link[step], closed[step] = i, j, live & ~both, both
        i = i + takes_a
        j = j + (live & ~takes_a)
    # Stitching: a piece goes on with the group that the pieces before it left open.
    whole = np.cumsum(closed, axis=0)
    earlier = np.cumsum(whole[-1]) - whole[-1] if len(starts) else np.zeros(0, np.int64)
    group = whole + earlier
    kept = link.T.ravel()
    return Merged(*(x.T.ravel()[kept] for x in (of_a, of_b, group)))


def group_names(bytes_a: list[bytes], bytes_b: list[bytes]) -> list[str]:
    """The parts of a groups' text: ids of A followed by , or |, then ids of B followed by , or ;."""
    return [f"{i}{s}" for n, marks in ((len(bytes_a), ",|"), (len(bytes_b), ",;")) for i in range(n) for s in marks]


_RECORD = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
        ("groups_sha256", pa.string()),
        ("groups", pa.string()),
        ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))),
    ]
)
_ROWS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
    "links array<struct<a int, b int, n int>>"
)


class Aligner:
    def __init__(self, files: Files, keep_groups: bool):
        self.a, self.b = ByteLevel(files.byte_level), Pieces(files.pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.names = group_names(self.a.bytes, self.b.bytes)
        self.keep_groups = keep_groups

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none for a text that they do not spell."""
        all_a, all_b = self.a.encode([f" {t}" for t in texts]), self.b.encode(texts)
        spell_a, spell_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        for i, t in enumerate(texts):
            wanted = f" {t}".encode()
            if not t or b"".join(map(spell_a, all_a[i])) != wanted or b"".join(map(spell_b, all_b[i])) != wanted:
                all_a[i], all_b[i] = [], []
        return all_a, all_b

    def align(self, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        all_a, all_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (all_a, all_b))
        a, b = (
            np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum()))
            for ids, n in ((all_a, n_a), (all_b, n_b))
        )
        merged = merge_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        # The group of a token is that of any of its links.
        group_a, group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        group_a[merged.a], group_b[merged.b] = merged.group, merged.group
        last_a, last_b = (np.r_[g[1:] != g[:-1], True] if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
        codes = np.r_[2 * a + last_a, 2 * (len(self.size_a) + b) + last_b]
        codes = codes[np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")]
        ends = np.cumsum(n_a + n_b)
        written = []
        for start, end in zip((ends - n_a - n_b).tolist(), ends.tolist(), strict=True):
            written.append("".join(map(self.names.__getitem__, codes[start:end].tolist()))[:-1])
        digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]

        texts_of_a = np.repeat(np.arange(len(texts)), n_a)
        owner = texts_of_a[merged.a]
        n_groups = np.bincount(texts_of_a[last_a], minlength=len(texts)) if len(a) else np.zeros(len(texts), np.int64)
        pairs = len(self.size_a) * len(self.size_b)
        key, times = np.unique(owner * pairs + a[merged.a] * len(self.size_b) + b[merged.b], return_counts=True)
        pair = key % pairs
        offsets = np.searchsorted(key, np.arange(len(texts) + 1) * pairs)
        links = pa.StructArray.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (pair // len(self.size_b), pair % len(self.size_b), times)],
            ["a", "b", "n"],
        )
        columns = [
            doc_ids,
            *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, np.bincount(owner, minlength=len(texts)))),
            pa.array(digests, pa.string()),
            pa.array(written if self.keep_groups else [None] * len(texts), pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), links),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_RECORD)


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """First and last (exclusive) number of the texts that are merged at once."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > BLOCK_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def aligned_rows(documents: DataFrame, files: Files, keep_groups: bool) -> DataFrame:
    """Per document its counts, digest and distinct links with their numbers, before anything is counted over all."""
    shared = documents.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            own = own or Aligner(shared.value, keep_groups)
            texts = batch.column(1).to_pylist()
            for first, last in blocks(texts):
                yield own.align(batch.column(0).slice(first, last - first).cast(pa.int64()), texts[first:last])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, _ROWS)


@dataclass(frozen=True)
class Alignment:
    """``documents``: one row each, with n_best and count_sum. ``pairs``: a, b, times, best."""

    documents: DataFrame
    pairs: DataFrame


def align(
    documents: DataFrame, byte_level_path: str, pieces_path: str, keep_groups: bool = False, hot: int = HOT
) -> Alignment:
    """The alignment of every document, and how often each pair of ids is linked over all of them.

    ``groups`` holds the text of a document's groups if they are to be kept, else null.
    """
    rows = aligned_rows(documents, Files.read(byte_level_path, pieces_path), keep_groups)
    stored = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    links = stored.select("_row", F.explode("links").alias("l")).select("_row", "l.a", "l.b", "l.n")
    counted = materialize(links.groupBy("a", "b").agg(F.sum("n").alias("times")), "linked-pairs")
    # One row for an id of B: at most the size of its vocabulary.
    top = counted.groupBy("b").agg(F.max("times").alias("_top"))
    pairs = counted.join(F.broadcast(top), "b").select("a", "b", "times", (F.col("times") == F.col("_top")).alias("best"))
    total = counted.agg(F.sum("times")).first()[0] or 0
    heavy = F.col("times") >= total / hot
    sums = [
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    ]
    known = F.broadcast(pairs.where(heavy))
    often = links.join(known, ["a", "b"]).groupBy("_row").agg(*sums)
    others = links.join(known, ["a", "b"], "left_anti")
    seldom = others.join(pairs.where(~heavy), ["a", "b"]).groupBy("_row").agg(*sums)
    scored = often.unionByName(seldom).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    done = stored.drop("links").join(scored, "_row", "left").drop("_row").fillna(0, ["n_best", "count_sum"])
    return Alignment(done, pairs)
