"""Chat formatting: a machine over roles checks the turn order, a template gives segments with loss flags.

A template names its control strings and, for each role, whether its text is learned.
A turn becomes a header, its text and a footer; only the text of a learned role is
under the loss mask. Control strings and the escape character inside texts
and roles are preceded by the escape character, so that what is read back is what was written.

The machine of a template maps a state and a role to the next state; a role without
an entry leads to the state ``bad``, which is never left. Every conversation is formatted; ``valid`` says whether the machine
accepts it, from the start to one of its final states.

The turns of a conversation are put side by side by a shuffle and a sort, and pass through a task as a stream:
a conversation of any length needs the memory of one Arrow batch. Their digest runs over
all turns in order, which no split of a conversation could compute.

Defined results: null texts and roles count as empty; turns are ordered by number
(null first), then role, then text, and repeated rows are turns of their own; rows of a
null conversation id are one conversation; extra columns play no part; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "### "
    separator: str = ": "
    end: str = " </turn>\n"
    escape: str = "\\"
    #: What a text must not hold bare: the cores of the marks above.
    guarded: tuple[str, ...] = ("###", "</turn>")
    learned: tuple[str, ...] = ("assistant",)
    #: (state, role) -> state.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "opened",
            ("start", "user"): "asked",
            ("opened", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def shown(self, role: str) -> str:
        return role[:1].upper() + role[1:] if role in self.names else role

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(sorted({r for _, r in self.moves}))


class Formatter:
    """Writes turns as segments, and reads turns back from the formatted text."""

    def __init__(self, template: Template):
        t = self.t = template
        guarded = [t.escape, *t.guarded]
        self.in_text = re.compile("|".join(map(re.escape, guarded)))
        self.in_role = re.compile("|".join(map(re.escape, [*guarded, t.separator])))
        escaped = re.escape(t.escape) + "(" + "|".join(map(re.escape, [*guarded, t.separator])) + ")"
        self.bare = re.compile(escaped)
        self.mark = re.compile(f"{escaped}|(?P<end>{re.escape(t.end)})")
        self.colon = re.compile(f"{escaped}|(?P<separator>{re.escape(t.separator)})")
        self.shown = {r: t.shown(r) for r in t.names}
        self.role_of = {shown: r for r, shown in self.shown.items()}

    def _escaped(self, text: str, pattern: re.Pattern) -> str:
        return pattern.sub(lambda m: self.t.escape + m[0], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Header, text and footer of a turn with their loss flags."""
        # A role that only looks like the shown name of another is escaped to stay apart.
        name = self.shown.get(role) or (self.t.escape + self.t.escape + role if role in self.role_of else self._escaped(role, self.in_role))
        header = self.t.begin + name + self.t.separator
        return [(header, False), (self._escaped(text, self.in_text), role in self.t.learned), (self.t.end, False)]

    def unescaped(self, text: str) -> str:
        return self.bare.sub(lambda m: m[1], text)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted text."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.t.begin, at):
                raise ValueError(f"no turn begins at {at}")
            at += len(self.t.begin)
            colon = next(m for m in self.colon.finditer(formatted, at) if m["separator"])
            end = next(m for m in self.mark.finditer(formatted, colon.end()) if m["end"])
            turns.append((self._role(formatted[at : colon.start()]), self.unescaped(formatted[colon.end() : end.start()])))
            at = end.end()
        return turns

    def _role(self, name: str) -> str:
        if name in self.role_of:
            return self.role_of[name]
        twice = self.t.escape * 2
        if name.startswith(twice) and name[len(twice) :] in self.role_of:
            return name[len(twice) :]
        return self.unescaped(name)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text), the turns of a conversation side by side and in order."""
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """The segments of all turns: (conv_id, turn, part, segment, loss), part 0 to 2 of each turn."""
    template = template or Template()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        conv, at = object(), 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for c, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                conv, at = c, at + 1 if c == conv else 0
                for part, (segment, loss) in enumerate(formatter.segments(role, text)):
                    for column, value in zip(out, (c, at, part, segment, loss), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["conv_id", "turn", "part", "segment", "loss"]
            )

    return ordered_turns(conversations).mapInArrow(work, "conv_id bigint, turn bigint, part int, segment string, loss boolean")


_SUMMARY = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"


class _Reading:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id, formatter: Formatter):
        self.conv_id, self.f = conv_id, formatter
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.state = "start"

    def add(self, segments: list[tuple[str, bool]]) -> None:
        formatted = "".join(s for s, _ in segments)
        self.chars += len(formatted)
        for role, text in self.f.read(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            self.state = self.f.t.moves.get((self.state, role), "bad")
        for segment, flag in segments:
            if flag:
                plain = self.f.unescaped(segment)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())

    def row(self) -> tuple:
        accepted = self.state in self.f.t.final
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, accepted


def read_back(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row for each conversation, read back from its formatted segments."""
    template = template or Template()
    names = [part.split()[0] for part in _SUMMARY.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        now: _Reading | None = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            done = []
            for c, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if now is None or now.conv_id != c:
                    if now is not None:
                        done.append(now.row())
                    now = _Reading(c, formatter)
                now.add(formatter.segments(role, text))
            yield batch_of(done)
        if now is not None:
            yield batch_of([now.row()])

    return ordered_turns(conversations).mapInArrow(work, _SUMMARY)
