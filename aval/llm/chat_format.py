"""Conversations as marked text: a machine over roles, a declarative template, loss flags.

``format_conversations`` streams every partition in (conversation, turn) order: one row per
segment, a marker or an escaped text, with its loss flag and the verdict of the machine on the
order so far. ``read_back`` parses the joined segments. Neither holds a conversation in memory.

Edge cases: null texts are empty, null roles are the empty role. Turns out of order, and roles
the machine has no move for, are formatted like others, with ``in_order`` false from there on.
Roles without markers of their own are written between the generic ones, name included. Equal
turn numbers are ordered by role, then text; repeated rows are repeated turns. A null
conversation id is a conversation of its own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = ("conv_id long, turn_number long, part string, segment string, loss boolean, "
            "in_order boolean")
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, in_order boolean")


@dataclass(frozen=True)
class Template:
    """Markers around each role's text, the roles that carry loss, and the allowed moves.

    Every marker starts with ``[`` or ``<`` and has neither further on. So no control string can
    begin in a text and end in the marker behind it, and escaping those inside texts is enough.
    """

    markers: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<SYS>", "</SYS>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    named: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    loss_roles: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}),
        "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})

    def __post_init__(self) -> None:
        controls = self.controls()
        if len(set(controls)) != len(controls):
            raise ValueError("each marker may be used once")
        for marker in controls:
            if not re.fullmatch(r"[\[<][^\[<\\]+", marker):
                raise ValueError(f"marker {marker!r} must start with [ or < and hold no more of them")

    def controls(self) -> list[str]:
        return [m for pair in self.markers.values() for m in pair] + list(self.named)

    def _any(self) -> str:
        return "|".join(re.escape(m) for m in sorted(self.controls(), key=len, reverse=True))

    def escaper(self):
        r"""Doubles ``\`` and puts one behind the first character of every control string."""
        inside = re.compile(rf"(?=(?:{self._any()}))(.)")
        return lambda text: inside.sub(r"\1\\", text.replace("\\", "\\\\"))

    def segments(self, role: str, text: str, escape) -> list[tuple[str, str, bool]]:
        """Parts, strings and loss flags of one turn."""
        told = role in self.loss_roles
        if role in self.markers:
            before, after = self.markers[role]
            return [("open", before, False), ("text", escape(text), told), ("close", after, False)]
        before, between, after = self.named
        return [("open", before, False), ("role", escape(role), False), ("between", between, False),
                ("text", escape(text), told), ("close", after, False)]


unescape = re.compile(r"\\(.)", re.DOTALL).sub


def _by_conversation(df: DataFrame) -> DataFrame:
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(df: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of every turn, in order inside each partition; one shuffle by conversation."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = template.escaper()
        current, state, right, number = object(), "", True, 0
        for batch in batches:
            out: list[tuple] = []
            ids, roles, texts = (batch.column(n) for n in ("conv_id", "role", "text"))
            for conv, role, text in zip(ids, roles, texts):
                conv, role = conv.as_py(), role.as_py()
                if conv != current:
                    current, state, right, number = conv, "", True, 0
                right = right and role in template.moves.get(state, ())
                state, number = role, number + 1
                out += [(conv, number, *part, right)
                        for part in template.segments(role, text.as_py(), escape)]
                if len(out) >= 4096:
                    yield _batch(out, SEGMENTS_ARROW)
                    out = []
            if out:
                yield _batch(out, SEGMENTS_ARROW)

    return _by_conversation(df).mapInArrow(run, SEGMENTS)


SEGMENTS_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("turn_number", pa.int64()), ("part", pa.string()),
    ("segment", pa.string()), ("loss", pa.bool_()), ("in_order", pa.bool_())])
DIGESTS_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("in_order", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, f.type) for values, f in zip(columns, schema)], schema=schema)


class _Reader:
    """Reads one conversation back from its formatted string, turn by turn."""

    def __init__(self, template: Template, conv: int | None) -> None:
        self.template, self.conv = template, conv
        self.opens = {pair[0]: (role, pair[1]) for role, pair in template.markers.items()}
        self.split = re.compile(f"({template._any()})").split
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.pending, self.marked, self.right = "", [], True

    def add(self, segment: str, loss: bool, closes: bool, right: bool) -> None:
        self.pending += segment
        self.chars += len(segment)
        self.right = right
        if loss:
            self.marked.append(segment)
        if closes:
            self._turn()

    def _turn(self) -> None:
        empty, first, *rest = self.split(self.pending)
        if first in self.opens and len(rest) == 3:
            role, (raw, last, tail) = self.opens[first][0], rest
            right = last == self.opens[first][1]
        elif first == self.template.named[0] and len(rest) == 5:
            role, between, raw, last, tail = rest
            role, right = unescape(r"\1", role), (between, last) == self.template.named[1:]
        else:
            right = False
        if not right or empty or tail:
            raise ValueError(f"conversation {self.conv}: turn {self.n_turns + 1} cannot be read back")
        self.turns.update(f"{role}\n{unescape(r'\1', raw)}\n".encode())
        said = unescape(r"\1", "".join(self.marked))
        self.loss.update(said.encode())
        self.loss_chars += len(said)
        self.n_turns += 1
        self.pending, self.marked = "", []

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars, self.right)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation the digests of what the formatted string says, parsed by the template.

    ``segments`` must come straight from ``format_conversations``: the rows of a conversation lie
    together and in order, so this adds no shuffle.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, out = None, []
        for batch in batches:
            names = ("conv_id", "part", "segment", "loss", "in_order")
            for conv, part, segment, loss, right in zip(*(batch.column(n).to_pylist() for n in names)):
                if reader is None or conv != reader.conv:
                    if reader:
                        out.append(reader.row())
                    reader = _Reader(template, conv)
                reader.add(segment, loss, part == "close", right)
            if len(out) >= 4096:
                yield _batch(out, DIGESTS_ARROW)
                out = []
        if reader:
            out.append(reader.row())
        if out:
            yield _batch(out, DIGESTS_ARROW)

    return segments.mapInArrow(run, DIGESTS)
