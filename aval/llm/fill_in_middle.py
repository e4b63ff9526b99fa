"""Fill-in-middle transformation by secondary sort: pieces keyed by row and output position.

A text is cut into units (runs of letters A-Z, a-z, and single other characters) and at two
places into prefix, middle and suffix. Tasks over the texts emit chunks of units as pieces with their
place in the output. One shuffle by row, sorted within partitions by (row, place), streams them
into incremental digests, or into texts. Restoration reads that stream: the sentinels in it say which part a
piece belongs to, so the pieces get their places in the original and are sorted again inside the same
partition, without a second shuffle. A digest needs one piece at a time, however long a text is.

Edge cases: null texts are empty; empty texts, and texts that contain a sentinel, stay plain.
A null id draws as the empty string. Rows that repeat, or share an id, are transformed each, since pieces go
by row number; a row number holds as long as ``docs`` gives the same partitions when it is read
again, as a stored table does. A column named like a result is replaced by it. Empty tables
give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULTS = StructType([
    StructField("n", LongType()), StructField("form", StringType()),
    StructField("prefix_chars", LongType()), StructField("middle_chars", LongType())])
_HEAD, _LAST = -1, 1 << 62  # places of the row's description: before its output, behind its original
_PART = 1 << 40  # more pieces than a part can have
_FLUSH = 1 << 20  # characters of a batch of pieces


@dataclass(frozen=True)
class FillInMiddle:
    """Sentinels, the seed and the shares of the forms, in percent."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 1
    transformed: int = 90
    suffix_first: int = 20
    chunk_units: int = 4096

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.middle, self.suffix

    def plan(self, doc_id: object, text: str) -> tuple[int, str, int, int, np.ndarray]:
        """Units, form, the two cuts in units, and where units start (code points)."""
        starts = unit_starts(text)
        n = len(starts)
        drawn = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
        if not text or any(s in text for s in self.sentinels) or h3 % 100 >= self.transformed:
            form = PLAIN
        else:
            form = SPM if h4 % 100 < self.suffix_first else PSM
        return n, form, *sorted((h1 % (n + 1), h2 % (n + 1))), starts

    def pieces(self, text: str, form: str, one: int, two: int, starts: np.ndarray) -> Iterator[str]:
        """The output, chunk by chunk."""
        n = len(starts)

        def chunks(first: int, end: int) -> Iterator[str]:
            for at in range(first, end, self.chunk_units):
                to = min(at + self.chunk_units, end)
                yield text[starts[at] : starts[to] if to < n else len(text)]

        parts = {self.prefix: (0, one), self.middle: (one, two), self.suffix: (two, n)}
        if form == PLAIN:
            yield from chunks(0, n)
            return
        for sentinel in ((self.prefix, self.suffix, self.middle) if form == PSM
                         else (self.suffix, self.prefix, self.middle)):
            yield sentinel
            yield from chunks(*parts[sentinel])


def unit_starts(text: str) -> np.ndarray:
    """Where the units ``[A-Za-z]+|[^A-Za-z]`` of a text start, in code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - np.uint32(97)) < 26
    begins = np.ones(len(points), bool)
    begins[1:] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def fim_pieces(docs: DataFrame, keep: list[str], rule: FillInMiddle = FillInMiddle()) -> DataFrame:
    """Pieces (``row``, ``place``, ``piece``) of every output, and one row of place -1 per text.

    That row has ``head``: the ``keep`` columns, ``n``, ``form``, ``prefix_chars`` and ``middle_chars``.
    A projection; batches of pieces are flushed at about a million characters.
    """
    keep = [c for c in dict.fromkeys(keep) if c not in RESULTS.names]
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("text"),
        F.struct(*keep, F.lit(0).alias("_")).alias("kept"))
    head = StructType([docs.schema[c] for c in keep] + RESULTS.fields)
    schema = StructType([
        StructField("row", LongType()), StructField("place", LongType()),
        StructField("piece", StringType()), StructField("head", head)])
    arrow = to_arrow_schema(schema)
    head_type = arrow.field("head").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, rows, places, pieces, size = batch.column("row").to_pylist(), [], [], [], 0
            described = []
            for number, doc_id, value in zip(numbers, batch.column("id"), batch.column("text")):
                text = value.as_py() or ""
                n, form, one, two, starts = rule.plan(doc_id.as_py(), text)
                ends = np.append(starts, len(text))
                described.append((n, form, None, None) if form == PLAIN else (
                    n, form, int(ends[one]), int(ends[two] - ends[one])))
                for place, piece in enumerate(rule.pieces(text, form, one, two, starts)):
                    rows.append(number)
                    places.append(place)
                    pieces.append(piece)
                    size += len(piece)
                    if size > _FLUSH:
                        yield _batch(arrow, rows, places, pieces)
                        rows, places, pieces, size = [], [], [], 0
            if rows:
                yield _batch(arrow, rows, places, pieces)
            if numbers:
                columns = [pa.array(values, head_type.field(name).type)
                           for name, values in zip(RESULTS.names, zip(*described))]
                kept = batch.column("kept").flatten()[: len(keep)]
                heads = pa.StructArray.from_arrays(kept + columns, fields=list(head_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array([_HEAD] * len(numbers), pa.int64()),
                     pa.nulls(len(numbers), pa.string()), heads], schema=arrow)

    return source.mapInArrow(run, schema)


def _batch(schema: pa.Schema, rows: list, places: list, pieces: list, *more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(places, pa.int64()), pa.array(pieces, pa.string()),
         pa.nulls(len(rows), schema.field("head").type), *more], schema=schema)


def _streamed(pieces: DataFrame) -> DataFrame:
    """Pieces by row, in the order of the output: one shuffle, sorted within partitions."""
    return pieces.repartition("row").sortWithinPartitions("row", "place")


def output_texts(pieces: DataFrame) -> DataFrame:
    """The columns of ``head`` and ``output``, the assembled text of every row."""
    schema = StructType(pieces.schema["head"].dataType.fields + [StructField("output", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            for i, piece in enumerate(batch.column("piece").to_pylist()):
                if piece is not None:
                    parts.append(piece)
                    continue
                if held is not None:
                    yield _described(arrow, held, ["".join(parts)])
                held, parts = batch.column("head").slice(i, 1), []
        if held is not None:
            yield _described(arrow, held, ["".join(parts)])

    return _streamed(pieces).mapInArrow(run, schema)


def _described(schema: pa.Schema, heads: pa.StructArray, *values: list) -> pa.RecordBatch:
    fields = heads.flatten()
    added = [pa.array(v, pa.string()) for v in values]
    return pa.RecordBatch.from_arrays(fields + added, schema=schema)


def digests(pieces: DataFrame, rule: FillInMiddle = FillInMiddle()) -> DataFrame:
    """The columns of ``head``, ``output_sha256`` and ``restored_sha256`` (lowercase hex, UTF-8).

    The restored text is put together from the output pieces and the form alone.
    """
    head = pieces.schema["head"].dataType
    middle_schema = StructType(pieces.schema.fields + [StructField("output_sha256", StringType())])
    last_schema = StructType(head.fields + [
        StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())])
    middle_arrow, last_arrow = to_arrow_schema(middle_schema), to_arrow_schema(last_schema)
    part_of = {s: i for i, s in enumerate(rule.sentinels)}

    def read_output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that is being read: number, form, digest, head
        part = count = 0
        for batch in batches:
            rows, places, found, ended = [], [], [], []
            heads = batch.column("head")
            forms = heads.field("form").to_pylist()
            for i, (row, piece) in enumerate(zip(
                    batch.column("row").to_pylist(), batch.column("piece").to_pylist())):
                if piece is None:
                    if held:
                        ended.append(held)
                    held, part, count = (row, forms[i], hashlib.sha256(), heads.slice(i, 1)), 0, 0
                    continue
                held[2].update(piece.encode("utf-8", "surrogatepass"))
                if held[1] != PLAIN and piece in part_of:
                    part = part_of[piece]
                    continue
                rows.append(row)
                places.append(part * _PART + count)
                found.append(piece)
                count += 1
            if rows:
                yield _batch(middle_arrow, rows, places, found, pa.nulls(len(rows), pa.string()))
            if ended:
                yield _ended(middle_arrow, ended)
        if held:
            yield _ended(middle_arrow, [held])

    def read_original(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256()
        for batch in batches:
            at, restored = [], []
            for i, piece in enumerate(batch.column("piece").to_pylist()):
                if piece is not None:
                    digest.update(piece.encode("utf-8", "surrogatepass"))
                    continue
                at.append(i)
                restored.append(digest.hexdigest())
                digest = hashlib.sha256()
            if at:
                picked = pa.array(at, pa.int64())
                fields = batch.column("head").take(picked).flatten()
                yield pa.RecordBatch.from_arrays(
                    fields + [batch.column("output_sha256").take(picked), pa.array(restored, pa.string())],
                    schema=last_arrow)

    placed = _streamed(pieces).mapInArrow(read_output, middle_schema)
    return placed.sortWithinPartitions("row", "place").mapInArrow(read_original, last_schema)


def _ended(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([_LAST] * len(rows), pa.int64()),
         pa.nulls(len(rows), pa.string()), pa.concat_arrays([r[3] for r in rows]),
         pa.array([r[2].hexdigest() for r in rows], pa.string())], schema=schema)
