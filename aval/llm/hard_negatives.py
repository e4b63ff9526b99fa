"""Hard negatives by best-first search in STR-packed R-trees.

Rows are dealt evenly over shards by number, whatever their vectors, labels or ids. The queries (the
anchors, a small stated share of the rows) go to every shard; one shuffle, sorted within partitions,
brings a shard's rows first and its queries behind them, so a task holds one shard's tree and one batch of
queries. The tree is packed by sort-tile-recursion: labels first, then the widest coordinates. A node's
minimum bounding box gives each coordinate's product with the query an interval, their sums an interval for
the score. A best-first queue takes the nodes by their upper bounds and prunes those that lie
outside all score windows, have only labels that do not count, or are strictly below the k-th score found.
Each shard returns at most k rows per window; the k best of all shards are exact.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of
different lengths do not meet. An empty vector has score 0 with others of its kind. Rows that repeat, or
share an id, are rows of their own; ties go by id (null first), then by row. An anchor without a positive, or a
positive whose window is empty (a negative score has an empty one), gives no rows. Scores are exact: in
floating point while every sum stays below 2^53, otherwise in Python's integers; components whose integer
does not fit a long are an error. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aval.session import materialise

LEAF_ROWS, FAN_OUT, WIDEST = 128, 16, 4
_EXACT = 1 << 53


def clean_vectors(
    table: DataFrame, vec_id: Column, label: Column, embedding: Column, scale: int = 256
) -> DataFrame:
    """``row``, ``vec_id``, ``label`` and ``v``, the components as integers: floor(scale * x)."""
    doubles = embedding.cast("array<double>")
    usable = label.isNotNull() & embedding.isNotNull() & F.forall(
        doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = table.where(usable).select(
        vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), doubles.alias("x"))
    return chosen.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


@dataclass
class Boxes:
    """One level of the tree: boxes, their range of labels, and the range of what lies below each."""

    low: np.ndarray
    high: np.ndarray
    labels: np.ndarray  # least and greatest
    spans: np.ndarray  # first and end


class RTree:
    """Rows of one vector length, packed into leaves of ``LEAF_ROWS`` rows and nodes of ``FAN_OUT``."""

    def __init__(self, rows: np.ndarray, ids: list, labels: np.ndarray, points: np.ndarray):
        order = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        order = np.concatenate([_tiled(part, points, LEAF_ROWS) for part in np.split(order, cuts)])
        self.rows, self.labels = rows[order], labels[order]
        self.ids = [ids[i] for i in order.tolist()]
        self.largest = int(max(points.max(initial=0), -points.min(initial=0)))
        self.points = points[order]
        self.floats = self.points.astype(np.float64)
        self.levels = [self._above(
            self.points, self.points, np.stack([self.labels, self.labels], 1), LEAF_ROWS)]
        while len(self.levels[-1].low) > FAN_OUT:
            top = self.levels[-1]
            self.levels.append(self._above(top.low, top.high, top.labels, FAN_OUT))
        self._as_floats = [(x.low.astype(np.float64), x.high.astype(np.float64)) for x in self.levels]

    @staticmethod
    def _above(low: np.ndarray, high: np.ndarray, labels: np.ndarray, size: int) -> Boxes:
        starts = np.arange(0, len(low), size)
        ends = np.minimum(starts + size, len(low))
        return Boxes(
            np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
            np.stack([np.minimum.reduceat(labels[:, 0], starts), np.maximum.reduceat(labels[:, 1], starts)], 1),
            np.stack([starts, ends], 1))

    def search(
        self, query: np.ndarray, row: int, label: int, same: bool, windows: list[tuple], k: int
    ) -> list[list[tuple]]:
        """Per window the k best (-score, id is there, id, row) with the same, or another, label.

        A window is (least score, greatest score), both included.
        """
        largest = int(max(query.max(initial=0), -query.min(initial=0)))
        exact = len(query) * largest * self.largest < _EXACT
        if exact:
            query, points, boxes = query.astype(np.float64), self.floats, self._as_floats
        else:
            query, points = query.astype(object), self.points.astype(object)
            boxes = [(x.low.astype(object), x.high.astype(object)) for x in self.levels]
        rising, falling = np.maximum(query, 0), np.minimum(query, 0)
        best: list[list[tuple]] = [[] for _ in windows]
        floors = [low for low, _ in windows]
        top_score = max(high for _, high in windows)
        heap: list[tuple] = []

        def offer(level: int, first: int, end: int) -> None:
            low, high = (x[first:end] for x in boxes[level])
            upper = high @ rising + low @ falling
            lower = low @ rising + high @ falling
            labels = self.levels[level].labels[first:end]
            mine = (labels[:, 0] <= label) & (label <= labels[:, 1])
            counts = mine if same else ~mine | (labels[:, 0] < labels[:, 1])
            counts &= (upper >= min(floors)) & (lower <= top_score)
            for i in np.flatnonzero(counts).tolist():
                if any(upper[i] >= f and lower[i] <= w[1] for f, w in zip(floors, windows)):
                    heapq.heappush(heap, (-upper[i], level, first + i, lower[i]))

        offer(len(self.levels) - 1, 0, len(self.levels[-1].low))
        while heap:
            negative, level, node, lower = heapq.heappop(heap)
            if -negative < min(floors):
                break
            if not any(-negative >= f and lower <= w[1] for f, w in zip(floors, windows)):
                continue
            first, end = self.levels[level].spans[node].tolist()
            if level:
                offer(level - 1, first, end)
                continue
            scores = points[first:end] @ query
            counts = (self.labels[first:end] == label) == same
            counts &= (self.rows[first:end] != row) & (scores >= min(floors)) & (scores <= top_score)
            for w, (_, high) in enumerate(windows):
                found = np.flatnonzero(counts & (scores >= floors[w]) & (scores <= high)).tolist()
                if not found:
                    continue
                best[w] = heapq.nsmallest(k, best[w] + [
                    (-int(scores[i]), (n := self.ids[first + i]) is not None, n or 0,
                     int(self.rows[first + i])) for i in found])
                if len(best[w]) == k:
                    floors[w] = max(floors[w], -best[w][-1][0])
        return best


def _tiled(order: np.ndarray, points: np.ndarray, leaf: int) -> np.ndarray:
    """``order`` so that runs of ``leaf`` rows are tiles: sorted by one wide coordinate after the other."""
    if len(order) <= leaf or not points.shape[1]:
        return order
    spread = points[order].astype(np.float64).std(0)
    widest = np.argsort(-spread, kind="stable")[:WIDEST].tolist()

    def tile(part: np.ndarray, axes: list[int]) -> np.ndarray:
        if len(part) <= leaf or not axes:
            return part
        part = part[np.argsort(points[part, axes[0]], kind="stable")]
        leaves = -(-len(part) // leaf)
        slabs = int(np.ceil(leaves ** (1 / len(axes))))
        rows = -(-leaves // slabs) * leaf
        return np.concatenate([tile(part[i : i + rows], axes[1:]) for i in range(0, len(part), rows)])

    return tile(order, widest)


def _windows(scores: list[int] | None, low_percent: int, high_percent: int) -> list[tuple]:
    """Least and greatest score per positive score; everything where no scores are given."""
    if scores is None:
        return [(-float("inf"), float("inf"))]
    return [(-(-low_percent * s // 100), high_percent * s // 100) for s in scores]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch and vectors as a matrix, per length of vector."""
    column = batch.column("v")
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield at, values[offsets[at][:, None] + np.arange(length)].reshape(len(at), length)


def _search_shards(same: bool, k: int, low_percent: int, high_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trees, gathered = None, None, {}
        for whole in batches:
            shards = whole.column("shard").to_numpy()
            asks = whole.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            turns = np.flatnonzero((np.diff(shards) != 0) | (asks[1:] != asks[:-1])) + 1
            for first, end in zip([0, *turns.tolist()], [*turns.tolist(), len(shards)]):
                if first == end:
                    continue
                batch = whole.slice(first, end - first)
                if shards[first] != shard:
                    shard, trees, gathered = shards[first], None, {}
                rows = batch.column("row").to_numpy()
                labels = batch.column("label").to_numpy()
                if not asks[first]:
                    ids = batch.column("vec_id").to_pylist()
                    for at, points in _vectors(batch):
                        gathered.setdefault(points.shape[1], []).append(
                            (rows[at], [ids[i] for i in at.tolist()], labels[at], points))
                    continue
                if trees is None:
                    trees = {n: RTree(
                        np.concatenate([p[0] for p in parts]), [i for p in parts for i in p[1]],
                        np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]))
                        for n, parts in gathered.items()}
                    gathered = {}
                wanted = batch.column("scores").to_pylist()
                found: list[tuple] = []
                for at, queries in _vectors(batch):
                    tree = trees.get(queries.shape[1])
                    for i, query in zip(at.tolist(), queries):
                        windows = _windows(wanted[i], low_percent, high_percent)
                        listed = [w for w, (low, high) in enumerate(windows) if low <= high]
                        if tree is None or not listed:
                            continue
                        best = tree.search(
                            query, int(rows[i]), int(labels[i]), same, [windows[w] for w in listed], k)
                        found += [
                            (int(rows[i]), w + 1, -score, n if there else None, other)
                            for w, results in zip(listed, best) for score, there, n, other in results]
                columns = list(zip(*found)) if found else [()] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["row", "at", "score", "other_id", "other"])

    return run


def best_rows(
    vectors: DataFrame, queries: DataFrame, shards: int, same: bool, k: int,
    low_percent: int = 0, high_percent: int = 100,
) -> DataFrame:
    """For each query the k best rows of the same, or another, label, exact over all shards.

    ``queries`` has the columns of ``vectors`` and ``scores``: null for no window, or the scores whose
    windows count. Result: ``row`` of the query, ``at`` (place in ``scores``, from 1), ``rank``,
    ``score``, ``other_id`` and ``other`` (the row found).
    """
    dealt = vectors.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"),
        "row", "vec_id", "label", "v", F.lit(None).cast("array<long>").alias("scores"))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"),
        "row", "vec_id", "label", "v", "scores")
    found = (
        dealt.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "asks")
        .mapInArrow(_search_shards(same, k, low_percent, high_percent),
                    "row long, at int, score long, other_id long, other long"))
    order = Window.partitionBy("row", "at").orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5,
    low_percent: int = 80, high_percent: int = 100, shard_rows: int = 100_000, least_rows: int = 2_048,
) -> DataFrame:
    """The best ``negatives`` rows of other labels per anchor and positive, within the positive's window.

    ``vectors`` comes from ``clean_vectors``; ``anchor`` is a condition on its columns. An anchor's
    positives are its best other rows of the same label. A negative's score lies between
    ``low_percent`` and ``high_percent`` of the positive's. A shard has about ``shard_rows`` rows, fewer in small
    tables so that all cores work; the number of shards changes no result.
    """
    vectors = materialise(vectors, "vectors")
    count = vectors.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(-(-count // shard_rows), min(cores, -(-count // least_rows)), 1)
    asked = vectors.where(anchor)
    none = asked.withColumn("scores", F.lit(None).cast("array<long>"))
    found = materialise(best_rows(vectors, none, shards, True, positives), "positives")
    listed = found.groupBy("row").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("scores"))
    windows = asked.join(listed, "row")
    mined = best_rows(vectors, windows, shards, False, negatives, low_percent, high_percent)
    by_positive = found.select(
        "row", F.col("rank").alias("at"), F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    return (
        mined.join(by_positive, ["row", "at"])
        .join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score")))
