"""SimHash near duplicates: exact tiled comparison of all distinct fingerprints.

Distinct fingerprints are cut into tiles by their number of set bits. Only tile pairs whose bit
counts differ by at most the radius can hold links; those are compared with numpy exclusive-or and
bit counts. Tiles are dealt in groups, so that a task compares all tiles of two groups and the
shuffle follows the groups, not the pairs of tiles. Inside a pair of groups the rows are sorted by
the bit count of their upper half, which skips tiles whose upper halves alone differ beyond the
radius. Of the links of a pair only a spanning forest leaves the task: the components stay the same.

Edge cases: null, empty and wordless texts have fingerprint 0 and link like any other. Fewer
words than a shingle: the whole sequence is the only shingle. Repeated rows keep one row each.
A component without a non-null id has a null id. A bit set in exactly half the shingles is not set.
Texts of any length are read whole, one at a time. Empty tables give no rows. Extra columns are
carried along; columns with names of the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval.llm.components import connected_components
from aval.llm.words import per_text
from aval.session import discard, materialise

_find = re.compile(rb"[^\x20\x09-\x0D]+").findall
SEED = 42
MOST_TASKS = 10_000  # of the comparison; beyond it a task gets several pairs of groups


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of the shingles of a text, repeats included."""
    words = _find((text or "").encode().lower())  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    bits, values = np.zeros(64, np.int64), np.array(hashes, np.uint64)
    for at in range(0, len(values), 1 << 15):
        part = np.unpackbits(values[at : at + (1 << 15)].view(np.uint8), bitorder="little")
        bits += part.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(values), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 4, result: str = "fp") -> DataFrame:
    """``keep`` and ``result`` (long) for every whole text; a projection."""
    return per_text(docs, keep, f"`{result}` long", lambda text: (text_fingerprint(text, shingle),))


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _top(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The root of every node."""
    while not np.array_equal(up := parent[nodes], nodes):
        nodes = up
    return nodes


def _join(parent: np.ndarray, links: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Join the links in ``parent``; those that connected something new."""
    used = []
    for i, j in links:
        a, b = i, j
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            used.append((i, j))
    return used


def linked(
    left: np.ndarray, right: np.ndarray | None, radius: int, rows: int = 256, columns: int = 4096,
) -> list[tuple[int, int]]:
    """Spanning forest of the links between two sides of fingerprints (uint64).

    Tiles of ``rows`` by ``columns`` are compared at once. ``right`` is None for the links within
    one side, of which each pair is met once.
    """
    same = right is None
    sides = []
    for side in [left] if same else [left, right]:
        upper = np.bitwise_count(side >> np.uint64(32)).astype(np.int64)
        order = np.argsort(upper, kind="stable")
        sides.append((side[order], upper[order]))
    (left, mine_upper), (right, upper) = sides[0], sides[-1]
    offset = 0 if same else len(left)
    parent = np.arange(offset + len(right))
    out: list[tuple[int, int]] = []
    for at in range(0, len(left), rows):
        mine = left[at : at + rows]
        low = at if same else np.searchsorted(upper, mine_upper[at] - radius, "left")
        high = np.searchsorted(upper, mine_upper[at + len(mine) - 1] + radius, "right")
        for to in range(low, high, columns):
            theirs = right[to : min(to + columns, high)]
            i, j = np.nonzero(np.bitwise_count(mine[:, None] ^ theirs[None, :]) <= radius)
            if len(i):
                a, b = i + at, j + to + offset
                fresh = _top(parent, a) != _top(parent, b)
                used = _join(parent, zip(a[fresh].tolist(), b[fresh].tolist()))
                out += [(int(left[x]), int(right[y - offset])) for x, y in used]
    return out


def _compare(radius: int):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            names = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
            for pair, upper, fps in zip(names, batch.column("upper").to_pylist(), batch.column("fps")):
                yield pair, upper, fps.values.to_numpy(zero_copy_only=False).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (low, high), tiles in groupby(rows(batches), key=lambda row: row[0]):
            sides: tuple[list, list] = ([], [])
            for _, upper, fps in tiles:
                sides[upper].append(fps)
            one, two = (np.concatenate(side) if side else np.empty(0, np.uint64) for side in sides)
            found = linked(one, None if low == high else two, radius)
            found = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return run


def dealt_tiles(
    distinct: DataFrame, radius: int = 4, tile_rows: int = 1024, group_rows: int = 1 << 18,
) -> DataFrame:
    """Tiles (``fps``) of ``distinct.fp``, once for each pair of groups they belong to.

    Tiles of about ``tile_rows`` fingerprints of one bit count form groups of about ``group_rows``.
    A pair of groups (``low``, ``high``) is the work of one task, which holds both; ``upper`` tells
    the sides apart. So a fingerprint is shuffled once per group within the radius of its bit count,
    which is 2 * radius + 1 times at most as long as a bit count fills one group. A tile is one row,
    8 KB, so an Arrow batch of 10 000 rows stays under 100 MB.
    """
    ones = distinct.select("fp", F.bit_count("fp").alias("ones"))
    sizes = {r["ones"]: r["count"] for r in ones.groupBy("ones").count().collect()}  # at most 65

    def parts(rows: int) -> list[int]:
        return [-(-sizes.get(k, 0) // rows) for k in range(65)]

    groups = parts(group_rows)
    pairs = sum(groups[k] * sum(groups[k : k + radius + 1]) for k in range(65))
    tasks = max(distinct.sparkSession.sparkContext.defaultParallelism, min(pairs, MOST_TASKS))
    tile_count, group_count = (F.array(*map(F.lit, n)) for n in (parts(tile_rows), groups))

    def name(bits: Column, group: Column) -> Column:
        return F.shiftleft(bits.cast("long"), 32) + group

    tiles = ones.groupBy(
        "ones", F.pmod(F.xxhash64("fp"), F.get(tile_count, F.col("ones"))).alias("tile"),
    ).agg(F.collect_list("fp").alias("fps"))
    named = tiles.select(
        name(F.col("ones"), F.pmod("tile", F.get(group_count, F.col("ones")))).alias("mine"), "fps",
        F.explode(F.sequence(
            F.greatest(F.col("ones") - radius, F.lit(0)), F.least(F.col("ones") + radius, F.lit(64)))
        ).alias("bits"))
    met = named.withColumn("groups", F.get(group_count, F.col("bits"))).where("groups > 0").select(
        "mine", "fps", "bits", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")
    ).withColumn("other", name(F.col("bits"), F.col("group")))
    return met.select(
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).alias("upper"), "fps",
    ).repartition(tasks, "low", "high")


def fingerprint_links(
    distinct: DataFrame, radius: int = 4, tile_rows: int = 1024, group_rows: int = 1 << 18,
) -> DataFrame:
    """Links (``a``, ``b``) that connect all of ``distinct.fp`` within ``radius`` bits."""
    dealt = dealt_tiles(distinct, radius, tile_rows, group_rows)
    return dealt.sortWithinPartitions("low", "high").mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(
    table: DataFrame, radius: int = 4, id_column: str = "doc_id", root: str | None = None,
) -> DataFrame:
    """``table`` (with ``fp``) and ``component_id``, the smallest id its fingerprint reaches.

    The id does not name a class: classes without any id share the null, and a repeated id can be
    the smallest of several. ``root`` asks for a column of that name with a fingerprint that does.
    """
    smallest = table.groupBy("fp").agg(F.min(id_column).alias("_least"))
    links = materialise(fingerprint_links(smallest.select("fp"), radius), "links")
    roots = connected_components(links).toDF("fp", "_root")
    classes = smallest.join(roots, "fp", "left").withColumn(
        "_root", F.coalesce("_root", "fp"))
    least = classes.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = [F.col("_root").alias(root)] if root else []
    ids = materialise(
        classes.select("fp", "_root").join(least, "_root", "left")
        .select("fp", "component_id", *named), "classes")
    discard(links)
    return table.drop("component_id", *([root] if root else [])).join(ids, "fp")
