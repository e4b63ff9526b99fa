"""What the text operators share: words, the checksum that divides rows, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall
find_letters = re.compile(r"[^\W\d_]+").findall


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))), F.lit(0)).cast(
        "long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def hash_share(doc_id: Column) -> Column:
    """A number from 0 to 1 that depends on the id only, evenly spread over ids."""
    return F.shiftrightunsigned(F.xxhash64(doc_id), 11) / float(1 << 53)


def smallest_hashes(rows: DataFrame, limit: int, *ties: str) -> DataFrame:
    """The ``limit`` rows of ``rows`` (with ``doc_id``) whose ids have the smallest hashes.

    Twice as many as needed pass a threshold on the hash first, so the sort behind it gets a bounded
    number of rows however many partitions there are. Should the hashes of a small table fall so
    unevenly that fewer pass, fewer are returned.
    """
    most = 2 * limit / max(rows.count(), 1)
    near = rows if most >= 1 else rows.where(hash_share(F.col("doc_id")) < most)
    return near.orderBy(hash_share(F.col("doc_id")), "doc_id", *ties).limit(limit)


def per_text(
    df: DataFrame, keep: list[str], schema: str, work: Callable[[str | None], tuple], text: str = "text"
) -> DataFrame:
    """``keep`` columns and, per row, the values ``work(text)`` returns, named by ``schema``.

    ``keep`` may have the text itself; a column with the name of a result is replaced by it. One
    Arrow batch is in memory at a time; texts are decoded one by one.
    """
    added = StructType.fromDDL(schema)
    keep = [c for c in dict.fromkeys(keep) if c not in added.names]
    source = df.select(*(c for c in keep if c != text), text)
    at = {c: i for i, c in enumerate(source.columns)}
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(value.as_py()) for value in batch.column(at[text])]
            columns = list(zip(*rows)) if rows else [()] * len(arrow)
            arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(at[c]) for c in keep] + arrays, keep + arrow.names)

    return source.mapInArrow(run, StructType([source.schema[c] for c in keep] + added.fields))


def numbered(words: list[str]) -> np.ndarray:
    """Words as numbers, equal words by equal numbers, within one text."""
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def window_ranks(numbers: np.ndarray, length: int) -> np.ndarray:
    """For every window of ``length`` numbers a rank that is equal for equal windows only."""
    ranks, span = numbers, 1
    while span < length:
        step = min(span, length - span)
        left, right = ranks[: len(ranks) - step], ranks[step:]
        _, ranks = np.unique(left * (int(ranks.max()) + 1) + right, return_inverse=True)
        span += step
    return ranks


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Mask of the places that windows of ``length`` at ``starts`` cover."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + length, -1)
    return np.cumsum(marks[:size]) > 0
