"""Chat formatting (operator 2).

A finite-state machine over the roles of a conversation checks the order of its turns; a declarative template
turns each turn into text segments, each with a loss flag. Control strings of the template inside a text are
escaped by one backslash behind their first character (`</s>` to `<\\/s>`, `<\\/s>` to `<\\\\/s>`), which is undone
on reading; so a control string in the output always is a control. `read_back` parses formatted text again.

Rows are spread by conv_id and sorted inside partitions; both passes stream over them and hold one turn at a time,
with the state of the machine and of two SHA-256 digests. A digest of a conversation is sequential by nature, so a
conversation of very many turns is read by one task, in constant memory.

Cases: a null text or role counts as empty; a role the template doesn't know gets the marked form with its name;
an order that the machine refuses is formatted too, with valid = false and the number of the first bad turn;
equal (conv_id, turn) are ordered by role and text; a null conv_id is a conversation of its own, null turns come
first; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around each role's text, the roles whose text is learned from, and the allowed order of roles."""

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("[ANS]", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    learned: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a conversation is complete in one of `final`
    order: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"},
        "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})
    final: tuple[str, ...] = ("asked", "answered")
    controls: tuple[str, ...] = ("<<SYS>>", "<</SYS>>", "<s>", "[INST]", "[/INST]", "[ANS]", "</s>", "[ROLE]", "[/ROLE]",
                                 "[/TURN]")

    def __post_init__(self):
        one = lambda n: "|".join(rf"{re.escape(c[0])}{n}{re.escape(c[1:])}" for c in self.controls)
        object.__setattr__(self, "_escape", re.compile(f"(?:{one(r'\\*')})"))
        object.__setattr__(self, "_unescape", re.compile(f"(?:{one(r'\\+')})"))
        opens = "|".join(f"(?P<r{i}>{re.escape(a)})" for i, (a, _) in enumerate(self.roles.values()))
        object.__setattr__(self, "_open", re.compile(f"{opens}|{re.escape(self.other[0])}"))

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(lambda m: m[0][0] + m[0][2:], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss flag) of one turn, in order."""
        if role in self.roles:
            before, after = self.roles[role]
            return [(before, False), (self.escape(text), role in self.learned), (after, False)]
        a, b, c = self.other
        return [(a + self.escape(role) + b, False), (self.escape(text), role in self.learned), (c, False)]

    def step(self, state: str, role: str) -> str | None:
        return self.order.get(state, {}).get(role)

    def parse(self, formatted: str) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, first and last place of the text) of each turn of a formatted text."""
        at, names = 0, list(self.roles)
        while at < len(formatted):
            m = self._open.match(formatted, at)
            if not m:
                raise ValueError(f"no turn begins at {at}")
            if m.lastgroup:
                role, first, close = names[int(m.lastgroup[1:])], m.end(), self.roles[names[int(m.lastgroup[1:])]][1]
            else:
                mid = formatted.index(self.other[1], m.end())
                role, first, close = self.unescape(formatted[m.end():mid]), mid + len(self.other[1]), self.other[2]
            last = formatted.index(close, first)
            yield role, self.unescape(formatted[first:last]), first, last
            at = last + len(close)


DEFAULT = Template()

_SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("segments", pa.list_(_SEGMENT)),
                        ("state", pa.string()), ("valid", pa.bool_())])


def format_chat(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), segments (text, loss), state after it (null once refused), valid."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, no = object(), None, 0
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, state, no = conv, "start", 0
                state = template.step(state, role) if state else None
                seg = [{"text": t, "loss": x} for t, x in template.segments(role, text)]
                for col, v in zip(out, (conv, no, seg, state, state is not None)):
                    col.append(v)
                no += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FORMATTED)], schema=_FORMATTED)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, turn_no long, segments array<struct<text: string, loss: boolean>>, state string, valid boolean")


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                   ("valid", pa.bool_()), ("first_bad_turn", pa.int64())])


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation, from the formatted text and its loss flags alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = object(), None

        def result() -> list:
            conv, n, turns, chars, loss, size, state, bad = held
            good = bad is None and state in template.final
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, good, bad]

        done: list[list] = []
        for b in batches:
            for conv, segs, state, valid in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segments", "state", "valid"))):
                if held is None or conv != now:
                    if held:
                        done.append(result())
                    now, held = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, None, None]
                text = "".join(s["text"] for s in segs)
                for role, said, _, _ in template.parse(text):
                    held[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    if not valid and held[7] is None:
                        held[7] = held[1]
                    held[1] += 1
                masked = template.unescape("".join(s["text"] for s in segs if s["loss"]))
                held[3] += len(masked)
                held[4].update(masked.encode("utf-8", "surrogatepass"))
                held[5] += len(text)
                held[6] = state
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _READ)], schema=_READ)
                done = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(result(), _READ)], schema=_READ)

    rows = formatted.select("conv_id", "turn_no", "segments", "state", "valid")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, valid boolean, first_bad_turn long")
