"""Segmentation: k-means, assignment, silhouettes, profiles and the two-component map."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, InvalidTrainingDataError
from aval.functions.values import col
from aval.session import discard, materialise
from aval.operators.features import assemble, check_inputs


def squared_distance(columns: list[Column], centre: list[float]) -> Column:
    """Squared Euclidean distance to a literal point, as plain arithmetic."""
    terms = [(x - F.lit(float(v))) * (x - F.lit(float(v))) for x, v in zip(columns, centre)]
    return reduce(lambda a, b: a + b, terms)


def array_squared_distance(vector: Column, centre: Column) -> Column:
    """Squared Euclidean distance between two array columns."""
    gaps = F.zip_with(vector, centre, lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g)


def nearest_centre(df: DataFrame, vector: str, centres: list[tuple[int, list[float]]],
                   name: str = c.SEGMENT) -> DataFrame:
    """Assign each array to the closest of ``centres``; the smallest number wins a tie.

    The centres are literals of the projection: no join and no shuffle.
    """
    values = col(vector).cast("array<double>")
    candidates = [
        F.struct(
            array_squared_distance(values, F.array(*[F.lit(float(v)) for v in centre])).alias("d"),
            F.lit(int(i)).alias("i"),
        )
        for i, centre in centres
    ]
    return df.withColumn(name, F.array_min(F.array(*candidates))["i"])


@dataclass(frozen=True)
class SegmentModel:
    """Centres of the segments in the scale of the prepared variables."""

    variables: list[str]
    centres: list[list[float]]
    cost: float

    @property
    def k(self) -> int:
        return len(self.centres)

    def assign(self, df: DataFrame, name: str = c.SEGMENT) -> DataFrame:
        """Add the number of the nearest centre: a projection of plain arithmetic."""
        columns = [col(n).cast("double") for n in self.variables]
        candidates = [
            F.struct(squared_distance(columns, centre).alias("d"), F.lit(i).alias("i"))
            for i, centre in enumerate(self.centres)
        ]
        return df.withColumn(name, F.array_min(F.array(*candidates))["i"])

    def centres_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, n, float(v))
            for i, centre in enumerate(self.centres) for n, v in zip(self.variables, centre)
        ]
        return spark.createDataFrame(rows, f"{c.SEGMENT} int, variable string, centro double")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(asdict(self), ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SegmentModel":
        return SegmentModel(**json.loads(spark.read.text(path).first()["value"]))


def fit_segments(train: DataFrame, variables: list[str], k: int = 3, starts: int = 10,
                 iterations: int = 300, seed: int = 42, parallel: int = 4,
                 checked: bool = False) -> SegmentModel:
    """K-means without the label: best of several seeded starts, numbered by centre order."""
    return fit_segments_by_k(
        train, variables, [k], starts, iterations, seed, parallel, checked)[k]


def fit_segments_by_k(train: DataFrame, variables: list[str], ks: list[int], starts: int = 10,
                      iterations: int = 300, seed: int = 42, parallel: int = 4,
                      checked: bool = False) -> dict[int, SegmentModel]:
    """For each k what ``fit_segments`` finds; all starts of all k move in the same scans.

    ``train`` should be cached by the caller. MLlib seeds each start; then one scan per iteration
    serves every start that still moves, so the scans follow the longest start, not their number.
    """
    if not checked:
        check_inputs(train, variables)
        rows = train.count()
        if max(ks, default=0) > rows:
            raise InvalidTrainingDataError(f"cannot form {max(ks)} segments from {rows} rows")
    if not ks:
        return {}
    numbers = train.select(*[col(n).cast("double").alias(f"x{i}") for i, n in enumerate(variables)])
    data = assemble(numbers, numbers.columns).select("features").persist()
    blocks = numbers.mapInArrow(_as_blocks(), "rows binary").persist()
    jobs = [(k, start) for k in ks for start in range(starts)]

    def seeded(job: tuple[int, int]) -> np.ndarray:
        """Where MLlib would start: its model before the first iteration.

        Either solver starts from the same centres. Blocks spare a scan per start that would only
        choose the solver, and the norms that the other keeps of every row.
        """
        k, start = job
        model = KMeans(k=k, maxIter=0, seed=seed + start, initSteps=2, solver="block").fit(data)
        return np.array(model.clusterCenters(), np.float64)

    try:
        with ThreadPoolExecutor(parallel) as pool:
            first = list(pool.map(seeded, jobs))
        data.unpersist()
        results = _moved_centres(blocks, first, iterations)
    finally:
        data.unpersist()
        blocks.unpersist()
    models = {}
    for k in ks:
        cost, centres = min((r for r, job in zip(results, jobs) if job[0] == k), key=lambda r: r[0])
        models[k] = SegmentModel(list(variables), sorted(centres.tolist()), cost)
    return models


def _as_blocks(most: int = 2**17):
    """The numbers of some rows as one value of at most ``most`` numbers, which later scans need not convert."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([x.to_numpy(zero_copy_only=False) for x in batch.columns]).astype(np.float64)
            step = max(1, most // rows.shape[1])
            for at in range(0, len(rows), step):
                block = pa.array([rows[at : at + step].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([block], ["rows"])

    return run


def _moved_centres(blocks: DataFrame, first: list[np.ndarray], iterations: int,
                   tolerance: float = 1e-4) -> list[tuple[float, np.ndarray]]:
    """``(cost, centres)`` of each start, moved until no centre goes further than ``tolerance``.

    As MLlib does it: a centre without rows stays, and the cost is that of the last assignment.
    The driver gets one row of sums per task and scan.
    """
    middle = np.concatenate(first).mean(0)  # distances stay the same, their squares lose less
    centres, costs = [c - middle for c in first], [0.0] * len(first)
    moving = sorted(range(len(first)), key=lambda i: -len(first[i]))
    for _ in range(iterations):
        if not moving:
            break
        deepest = len(centres[moving[0]])
        found = blocks.mapInArrow(
            _centre_sums([centres[i] for i in moving], middle), "sums array<double>").collect()
        sums = np.sum([r["sums"] for r in found], axis=0)
        cells = sums[len(moving):].reshape(deepest, len(moving), -1)
        still = []
        for place, i in enumerate(moving):
            old = centres[i]
            total, size = cells[: len(old), place, :-1], cells[: len(old), place, -1:]
            centres[i] = np.where(size > 0, total / np.maximum(size, 1), old)
            costs[i] = float(sums[place])
            if (((centres[i] - old) ** 2).sum(1) > tolerance ** 2).any():
                still.append(i)
        moving = still
    return [(cost, c + middle) for cost, c in zip(costs, centres)]


def _centre_sums(centres: list[np.ndarray], middle: np.ndarray, step: int = 2_048):
    """Per task: the cost of each start, and per centre the sum of its rows and their number.

    ``centres`` come with the largest k first, so those with a further centre stand in front.
    """
    depth, width = len(centres[0]), len(middle)
    reach = [sum(len(c) > j for c in centres) for j in range(depth)]
    points = [np.stack([c[j] for c in centres[:n]]) for j, n in enumerate(reach)]
    norms = [(p * p).sum(1) for p in points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, cells = np.zeros(len(centres)), np.zeros((depth, len(centres), width + 1))
        for block in (block for batch in batches for block in batch.column("rows")):
            numbers = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width)
            whole = np.ones((len(numbers), width + 1))
            whole[:, :-1] = numbers - middle
            for at in range(0, len(whole), step):
                rows = whole[at : at + step]
                x = rows[:, :-1]
                best = norms[0] - 2 * (x @ points[0].T)
                label = np.zeros(best.shape, np.int32)
                for j in range(1, depth):
                    other = norms[j] - 2 * (x @ points[j].T)
                    nearer = other < best[:, : reach[j]]  # the first one wins a tie
                    np.copyto(best[:, : reach[j]], other, where=nearer)
                    np.copyto(label[:, : reach[j]], j, where=nearer)
                best += (x * x).sum(1)[:, None]
                costs += np.maximum(best, 0.0).sum(0)
                for j, n in enumerate(reach):
                    cells[j, :n] += (label[:, :n] == j).astype(np.float64).T @ rows
        sums = np.concatenate([costs, cells.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


# --- Silhouette ----------------------------------------------------------------------------


def _measurable(df: DataFrame, vector: str, segment: str, key: str, kind: str = "int") -> DataFrame:
    """Rows of a cluster as ``(id, s, v)``; a missing vector or value raises when read."""
    values = col(vector).cast("array<double>")
    broken = values.isNull() | F.exists(values, lambda x: x.isNull() | F.isnan(x))
    absent = F.raise_error(F.lit("a silhouette needs a complete vector in every row"))
    return df.select(
        col(key).alias("id"), col(segment).cast(kind).alias("s"),
        F.when(broken, absent.cast("array<double>")).otherwise(values).alias("v"),
    ).filter(F.col("s").isNotNull())


def _cluster_sizes(rows: DataFrame, max_segments: int) -> dict[int, int]:
    counted = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).limit(max_segments + 1).collect()
    if len(counted) > max_segments:
        raise EvaluationError(f"more than {max_segments} clusters: the column holds no segments")
    if len(counted) < 2:
        raise EvaluationError("a silhouette needs at least two clusters")
    return {r["s"]: r["n"] for r in counted}


def silhouette_euclidean(df: DataFrame, vector: str, segment: str, key: str,
                         block: int = 2_000, max_segments: int = 1_000,
                         group_rows: int = 16_384) -> DataFrame:
    """Exact Euclidean silhouette of every row: ``(key, segment, silueta)``.

    ``silhouettes_euclidean`` of one grouping. ``silhouette_squared`` is the linear variant.
    """
    return silhouettes_euclidean(
        df, vector, [segment], key, block, max_segments, group_rows, segment).drop(GROUPING)


GROUPING = "agrupacion"


def silhouettes_euclidean(df: DataFrame, vector: str, segments: list[str], key: str,
                          block: int = 2_000, max_segments: int = 1_000, group_rows: int = 16_384,
                          segment: str = c.SEGMENT) -> DataFrame:
    """Exact Euclidean silhouette of every row in each of several groupings of the same vectors.

    The result is ``(agrupacion, key, segment, silueta)``, the first naming one of the columns
    ``segments``; a row without a segment takes no part in that grouping. Euclidean distances have no
    closed form over a cluster, so all pairs are needed, but once for all groupings. Rows are
    packed into tiles of about ``block`` rows, and tiles are dealt in groups of at most about ``group_rows``
    rows. A task holds two groups and meets each pair of tiles once, as one matrix product that
    serves both sides; it returns one sum per row and cluster, never pairs. Cost is quadratic,
    memory per task is not, and a row is shuffled once per group, not once per tile.
    """
    labels = F.array(*[col(n).cast("int") for n in segments])
    rows = materialise(
        _measurable(df.withColumn("_s", labels), vector, "_s", key, "array<int>")
        .filter(F.exists("s", lambda x: x.isNotNull()))
        .withColumn("r", F.monotonically_increasing_id()), "silhouette-rows")
    sizes = [_cluster_sizes(rows.select(F.col("s")[i].alias("s")).filter("s IS NOT NULL"), max_segments)
             for i in range(len(segments))]
    clusters = sum(map(len, sizes))
    n = rows.count()
    tiles = max(1, math.ceil(n / block))
    cores = df.sparkSession.sparkContext.defaultParallelism
    group_rows = min(group_rows, max(1, 4_000_000 // clusters))  # a row has a sum per cluster
    # Enough pairs of groups for all cores, as long as a group has a tile.
    groups = max(math.ceil(n / group_rows), min(tiles, math.ceil(math.sqrt(8 * cores))))
    # By row number, so that repeated and missing ids are rows like others.
    packed = rows.withColumn("tile", F.pmod(F.xxhash64("r"), F.lit(max(tiles, groups)))).groupBy("tile").agg(
        F.collect_list(F.struct("r", "s", "v")).alias("rows"))
    mine = F.pmod("tile", F.lit(groups))
    dealt = packed.select(
        mine.alias("mine"), "rows", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other")
    ).select(
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).alias("upper"), "rows")
    tasks = max(cores, min(groups * (groups + 1) // 2, _MOST_TASKS))
    sums = (
        dealt.repartition(tasks, "low", "high").sortWithinPartitions("low", "high")
        .mapInArrow(_pair_sums([sorted(s) for s in sizes]), "r long, g int, s int, t int, total double")
        .groupBy("r", "g", "s", "t").agg(F.sum("total").alias("total"))
    )
    # One row per cluster, at most ``max_segments`` in each grouping.
    size_rows = df.sparkSession.createDataFrame(
        [(g, t, size) for g, found in enumerate(sizes) for t, size in sorted(found.items())],
        "g int, t int, size long")
    own = F.col("s") == F.col("t")
    per_row = sums.join(F.broadcast(size_rows), ["g", "t"]).groupBy("r", "g", "s").agg(
        F.max(F.when(own, F.col("size"))).alias("own_size"),
        F.max(F.when(own, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    named = F.array(*[F.lit(n) for n in segments])[F.col("g")]
    return _silhouette_value(
        per_row.join(rows.select("r", "id"), "r"), key, segment, named.alias(GROUPING))


_MOST_TASKS = 10_000  # of a silhouette; beyond it a task gets several pairs of groups


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs, from a matrix product."""
    left, right = (x * x).sum(1), (y * y).sum(1)
    with np.errstate(all="ignore"):
        scale = left[:, None] + right[None, :]
        squares = x @ y.T
        squares *= -2
        squares += scale
        scale *= 1e-6
        # What is lost in the differences of squares of near points is computed anew, and infinities.
        near = np.argwhere(~(squares >= scale))
        for at in range(0, len(near), 10_000):
            i, j = near[at : at + 10_000].T
            squares[i, j] = ((x[i] - y[j]) ** 2).sum(1)
        return np.sqrt(squares, out=squares)


def _pair_sums(groupings: list[list[int]], step: int = 1_024):
    """Per row and cluster, the sum of the distances to the rows of the other group (or of its own).

    ``groupings`` holds the clusters of each grouping; a row has one number per grouping or none.
    """
    clusters = sum(map(len, groupings))

    def unpacked(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            pairs = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
            for pair, upper, tile in zip(pairs, batch.column("upper").to_pylist(), batch.column("rows")):
                fields = tile.values
                vectors = fields.field("v")
                if len(set(np.diff(vectors.offsets.to_numpy()).tolist())) > 1:
                    raise ValueError("the vectors of a silhouette must have one length")
                points = vectors.flatten().to_numpy().astype(np.float64).reshape(len(fields), -1)
                numbers = fields.field("s").flatten().to_numpy(zero_copy_only=False)  # missing ones are NaN
                yield pair, upper, fields.field("r").to_numpy(), numbers.reshape(len(fields), -1), points

    def side(tiles: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, clusters and points of a group."""
        return tuple(np.concatenate(part) for part in zip(*tiles))

    def membership(s: np.ndarray) -> np.ndarray:
        return np.concatenate([
            s[:, g, None] == np.array(segments)[None, :] for g, segments in enumerate(groupings)
        ], 1).astype(np.float64)

    def added(total: np.ndarray, distances: np.ndarray, member: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            part = distances @ member
        if not np.isfinite(part).all():  # an infinite distance belongs to its own cluster only
            part = np.stack([distances[:, m > 0].sum(1) for m in member.T], 1)
        total += part

    def sums(r: np.ndarray, s: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        for g, segments in enumerate(groupings):
            part, at = total[:, at : at + len(segments)], at + len(segments)
            there = ~np.isnan(s[:, g].astype(np.float64))
            if there.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(r[there], len(segments))),
                     pa.array(np.full(there.sum() * len(segments), g, np.int32)),
                     pa.array(np.repeat(s[there, g].astype(np.int32), len(segments))),
                     pa.array(np.tile(np.array(segments, np.int32), there.sum())),
                     pa.array(part[there].ravel())], ["r", "g", "s", "t", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (low, high), tiles in groupby(unpacked(batches), key=lambda tile: tile[0]):
            parts: tuple[list, list] = ([], [])
            for _, upper, *part in tiles:
                parts[upper].append(part)
            if not parts[0] or (low != high and not parts[1]):
                continue
            one = side(parts[0])
            two = one if low == high else side(parts[1])
            middle = one[2].mean(0)  # distances stay the same, their squares lose less
            middle = np.where(np.isfinite(middle), middle, 0.0)
            x, y = one[2] - middle, two[2] - middle
            members = membership(one[1]), membership(two[1])
            totals = np.zeros(members[0].shape), np.zeros(members[1].shape)
            for at in range(0, len(x), step):
                mine = slice(at, at + step)
                for to in range(at if low == high else 0, len(y), step):
                    theirs = slice(to, to + step)
                    found = _distances(x[mine], y[theirs])
                    if low == high and to == at:
                        np.fill_diagonal(found, 0.0)
                        added(totals[0][mine], found, members[1][theirs])
                        continue
                    added(totals[0][mine], found, members[1][theirs])
                    added((totals[0] if low == high else totals[1])[theirs], found.T, members[0][mine])
            for (r, s, _), total in zip((one, two)[: 1 if low == high else 2], totals):
                most = max(1, 100_000 // clusters)
                for at in range(0, len(r), most):
                    yield from sums(r[at : at + most], s[at : at + most], total[at : at + most])

    return run


def _silhouette_value(per_row: DataFrame, key: str, segment: str, *also: Column) -> DataFrame:
    """A lone member scores 0; so do rows at equal, zero distance from both clusters."""
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return per_row.select(
        *also, F.col("id").alias(key), F.col("s").alias(segment),
        F.when(F.col("own_size") == 1, 0.0).otherwise(value).alias("silueta"),
    )


@dataclass(frozen=True)
class Silhouette:
    """A mean silhouette, its standard error, and how many rows it is the mean of."""

    value: float
    error: float
    rows: int


def silhouette_by_anchors(df: DataFrame, vector: str, segment: str, key: str, anchors: int = 1_000,
                          max_segments: int = 1_000, max_anchors: int = 20_000) -> Silhouette:
    """Mean Euclidean silhouette from distances to anchors, in linear time.

    A cluster's anchors are its ``anchors`` rows (fewer with many clusters: ``max_anchors`` in all) whose keys
    have the smallest md5. The mean distance of a row to a cluster is that to the cluster's anchors, so all rows
    are measured and one matrix product per Arrow batch gives their distances. Where a cluster has no
    more rows than anchors its distances are exact; with all clusters so small the result is the exact
    silhouette and the error 0. Otherwise the error is a jackknife's: the anchors are dealt in ten groups, and
    the mean is taken again without each, scaled by the share of rows that are no anchors. What the driver sees is
    the anchors and eleven sums per task.
    """
    rows = materialise(_measurable(df, vector, segment, key).withColumn(
        "r", F.monotonically_increasing_id()), "silhouette-rows")
    sizes = _cluster_sizes(rows, max_segments)
    each = max(2, min(anchors, max_anchors // len(sizes)))
    order = Window.partitionBy("s").orderBy(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), "r")
    chosen = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).orderBy(
        "s", "n").select("r", "s", "n", "v").collect()
    segments = sorted(sizes)
    chosen.sort(key=lambda a: (a["s"], (a["n"] - 1) % _GROUPS))  # those of a cell side by side
    points = np.array([a["v"] for a in chosen], np.float64)
    owner = np.array([segments.index(a["s"]) for a in chosen])
    group = np.array([(a["n"] - 1) % _GROUPS for a in chosen])
    anchor_rows = {a["r"]: i for i, a in enumerate(chosen)}
    cells = owner * _GROUPS + group
    measured = rows.select("r", "s", "v").mapInArrow(
        _anchor_sums(points, cells, anchor_rows, segments, [sizes[s] for s in segments]),
        "n long, sums array<double>").collect()
    n = sum(r["n"] for r in measured)
    means = np.sum([r["sums"] for r in measured], axis=0) / n
    without = means[1:]
    free = max(0.0, 1 - len(chosen) / n)
    spread = (_GROUPS - 1) / _GROUPS * float(((without - without.mean()) ** 2).sum())
    discard(rows)
    return Silhouette(float(means[0]), math.sqrt(spread * free), n)


_GROUPS = 10


def _anchor_sums(points: np.ndarray, cells: np.ndarray, anchor_rows: dict[int, int], segments: list[int],
                 sizes: list[int]):
    """Per task: rows, and the sums of their silhouettes with all anchors and without each group."""
    clusters = len(segments)
    middle = points.mean(0)  # distances stay the same, their squares lose less
    points = points - middle
    norms = (points * points).sum(1)
    counts = np.bincount(cells, minlength=clusters * _GROUPS).reshape(clusters, _GROUPS).astype(np.float64)
    filled, first_of = np.unique(cells, return_index=True)  # anchors are sorted by cell

    def cell_sums(x: np.ndarray, step: int) -> np.ndarray:
        """Sums of the distances of each row to the anchors of each cell."""
        found = np.zeros((len(x), clusters * _GROUPS))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            squares = part @ points.T
            squares *= -2
            squares += (part * part).sum(1)[:, None]
            squares += norms
            # What is lost in the differences of squares of near points is computed anew.
            near = np.argwhere(squares < 1e-6 * norms)
            for of in range(0, len(near), 10_000):
                i, j = near[of : of + 10_000].T
                squares[i, j] = ((part[i] - points[j]) ** 2).sum(1)
            np.maximum(squares, 0.0, out=squares)
            np.sqrt(squares, out=squares)
            found[at : at + step, filled] = np.add.reduceat(squares, first_of, axis=1)
        return found.reshape(len(x), clusters, _GROUPS)

    def silhouettes(total: np.ndarray, count: np.ndarray, own: np.ndarray, is_anchor: np.ndarray) -> float:
        """Sums of distances and numbers of anchors per cluster; an anchor's distance to itself does not count."""
        at = np.arange(len(own))
        number = np.repeat(count[None, :], len(own), 0).astype(np.float64)
        number[at, own] -= is_anchor
        with np.errstate(all="ignore"):
            mean = total / number
        a = mean[at, own].copy()
        mean[at, own] = np.inf
        b = np.nanmin(mean, 1)
        with np.errstate(all="ignore"):
            value = (b - a) / np.maximum(a, b)
        alone = np.array(sizes)[own] == 1
        return float(np.where(alone | ~np.isfinite(value), 0.0, value).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, np.zeros(_GROUPS + 1)
        step = max(1, 2_000_000 // (clusters * _GROUPS))
        for whole in batches:
            for first in range(0, len(whole), step):
                batch = whole.slice(first, step)
                vectors = batch.column("v")
                if set(np.diff(vectors.offsets.to_numpy()).tolist()) - {points.shape[1]}:
                    raise ValueError("the vectors of a silhouette must have one length")
                x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) - middle
                own = np.searchsorted(segments, batch.column("s").to_numpy())
                numbers = batch.column("r").to_pylist()
                place = np.array([anchor_rows.get(r, -1) for r in numbers])
                by_cell = cell_sums(x, max(1, 250_000 // len(points)))
                mine = np.where(place >= 0, cells[place] % _GROUPS, -1)
                whole_sum = by_cell.sum(2)
                rows += len(x)
                sums[0] += silhouettes(whole_sum, counts.sum(1), own, place >= 0)
                for g in range(_GROUPS):
                    kept = counts.sum(1) - counts[:, g]
                    enough = kept > 1  # a cluster whose few anchors are all in the group keeps them
                    total = np.where(enough, whole_sum - by_cell[:, :, g], whole_sum)
                    number = np.where(enough, kept, counts.sum(1))
                    counted = (place >= 0) & ~(enough[own] & (mine == g))
                    sums[g + 1] += silhouettes(total, number, own, counted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["n", "sums"])

    return run


def silhouette_squared(df: DataFrame, vector: str, segment: str, key: str,
                       max_segments: int = 1_000) -> DataFrame:
    """Silhouette of every row under squared Euclidean distance, in linear time.

    The mean squared distance from a row to a cluster follows from the cluster's size, mean
    vector and mean squared norm: one aggregation, then a projection against one row per
    cluster. It is a different number from the Euclidean silhouette.
    """
    rows = _measurable(df, vector, segment, key)
    _cluster_sizes(rows, max_segments)
    norm = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
    moments = (
        rows.withColumn("q", norm)
        .select("s", "q", F.posexplode("v").alias("i", "x"))
        .groupBy("s", "i")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.avg("q").alias("q"))
    ).collect()
    clusters: dict[int, dict] = {}
    for r in moments:
        entry = clusters.setdefault(r["s"], {"n": r["n"], "q": r["q"], "m": {}})
        entry["m"][r["i"]] = r["m"]
    parts = []
    for s, e in sorted(clusters.items()):
        mean = F.array(*[F.lit(e["m"][i]) for i in range(len(e["m"]))])
        dot = F.aggregate(F.zip_with("v", mean, lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        average = F.greatest(F.col("q") - 2 * dot + F.lit(e["q"]), F.lit(0.0))
        parts.append(F.struct(
            F.lit(s).alias("t"), F.lit(e["n"]).cast("long").alias("size"), average.alias("avg")
        ))
    measured = rows.withColumn("q", norm).withColumn("c", F.array(*parts))
    own = F.filter("c", lambda e: e["t"] == F.col("s"))[0]
    other = F.array_min(F.transform(F.filter("c", lambda e: e["t"] != F.col("s")), lambda e: e["avg"]))
    per_row = measured.select(
        "id", "s", own["size"].alias("own_size"),
        F.try_divide(own["avg"] * own["size"], own["size"] - 1).alias("a"), other.alias("b"),
    )
    return _silhouette_value(per_row, key, segment)


def mean_silhouette(per_row: DataFrame, *groupings: str) -> DataFrame:
    return per_row.groupBy(*groupings).agg(F.avg("silueta").alias("silueta"), F.count(F.lit(1)).alias("filas"))


def silhouette_by_k(train: DataFrame, variables: list[str], key: str,
                    config: c.EvaluationConfig | None = None,
                    training: c.TrainingConfig | None = None,
                    thresholds: c.ChartThresholds | None = None,
                    fitted: SegmentModel | None = None,
                    fitted_silhouette: Silhouette | None = None,
                    others: dict[int, SegmentModel] | None = None) -> DataFrame:
    """Silhouette of k-means for several k, the model's own k and the suggested one marked.

    The models are fitted together on the cached training rows, except for the k of ``fitted`` and of
    ``others``, whose fits would be repeated with the same seeds; ``fitted_silhouette`` is what
    ``model_silhouette`` measured of the first. The result has one row per k.
    """
    config = config or c.EvaluationConfig()
    training = training or c.TrainingConfig()
    n = train.count()
    metric = config.silhouette_metric
    spark = train.sparkSession
    own = {fitted.k: fitted} if fitted is not None and training.seed == config.seed else {}
    known = (others or {}) | own
    counts = [k for k in config.segment_counts if k < n]
    models = known | fit_segments_by_k(
        train, variables, sorted({k for k in counts if k not in known}), training.segment_starts,
        training.segment_iterations, config.seed, config.parallel_fits, checked=True,
    )

    def measured(k: int) -> Silhouette:
        if k in own and fitted_silhouette is not None:
            return fitted_silhouette
        return model_silhouette(
            train, models[k], key, metric, config.silhouette_block, config.silhouette_anchors)

    with ThreadPoolExecutor(config.parallel_fits) as pool:
        found = list(pool.map(measured, counts))
    rows = [(k, s.value, s.error, k == training.segments, metric) for k, s in zip(counts, found)]
    table = spark.createDataFrame(
        rows, "k int, silueta double, error_estandar double, es_el_modelo boolean, metrica string"
    )
    return with_suggestion(table, thresholds)


EUCLIDEAN, SQUARED = "euclidean", "squaredEuclidean"


def model_silhouette(df: DataFrame, model: SegmentModel, key: str, metric: str = EUCLIDEAN,
                     block: int = 2_000, anchors: int | None = 1_000) -> Silhouette:
    """Mean silhouette of the model's segments over ``df``; Euclidean from all pairs without ``anchors``."""
    vector = F.array(*[col(n).cast("double") for n in model.variables])
    assigned = model.assign(df).select(col(key), c.SEGMENT, vector.alias("_v"))
    if metric == EUCLIDEAN and anchors is not None:
        return silhouette_by_anchors(assigned, "_v", c.SEGMENT, key, anchors)
    if metric == EUCLIDEAN:
        per_row = silhouette_euclidean(assigned, "_v", c.SEGMENT, key, block)
    elif metric == SQUARED:
        per_row = silhouette_squared(assigned, "_v", c.SEGMENT, key)
    else:
        raise EvaluationError(f"unknown silhouette metric '{metric}'")
    mean = mean_silhouette(per_row).first()
    return Silhouette(float(mean["silueta"]), 0.0, mean["filas"])


def with_suggestion(table: DataFrame, thresholds: c.ChartThresholds | None = None) -> DataFrame:
    """Mark the k with the highest silhouette (smallest on a tie) and name the structure.

    The limits of the structure levels are meant for the Euclidean silhouette; under another
    ``metrica`` the structure has no name. With a standard error, ``estructura_segura`` says whether
    two of them around the value stay within the level.
    """
    thresholds = thresholds or c.ChartThresholds()
    best = table.agg(
        F.max_by("k", F.struct("silueta", -F.col("k"))).alias("k")
    ).withColumn("sugerido", F.lit(True))
    # The names of the structure levels.
    strength = (
        F.when(F.col("metrica") != EUCLIDEAN, None)
        .when(F.col("silueta") >= thresholds.strong_silhouette, "fuerte")
        .when(F.col("silueta") >= thresholds.moderate_silhouette, "moderada")
        .otherwise("débil")
    )
    marked = table.join(F.broadcast(best), "k", "left").withColumns({
        "sugerido": F.coalesce("sugerido", F.lit(False)), "estructura": strength,
    })
    if "error_estandar" not in table.columns:
        return marked
    reach = 2 * F.col("error_estandar")
    apart = [F.abs(F.col("silueta") - limit) >= reach
             for limit in (thresholds.strong_silhouette, thresholds.moderate_silhouette)]
    return marked.withColumn(
        "estructura_segura", F.when(F.col("estructura").isNotNull(), apart[0] & apart[1]))


# --- Describing segments -------------------------------------------------------------------


def segment_sizes(df: DataFrame, k: int, segment: str = c.SEGMENT) -> DataFrame:
    """Rows per segment, including empty segments."""
    numbers = df.sparkSession.range(k).select(F.col("id").cast("int").alias(segment))
    counts = df.groupBy(col(segment).cast("int").alias(segment)).agg(
        F.count(F.lit(1)).alias("n_clientes")
    )
    return numbers.join(counts, segment, "left").select(
        segment, F.coalesce("n_clientes", F.lit(0)).alias("n_clientes")
    )


def segment_profiles(df: DataFrame, variables: list[str],
                     scaling: dict[str, tuple[float, float]], segment: str = c.SEGMENT,
                     target: str = c.TARGET) -> DataFrame:
    """Size, mean of each variable in its original scale and approval rate, per segment."""
    means = []
    for n in variables:
        mean, deviation = scaling.get(n, (0.0, 1.0))
        value = col(n) * F.lit(deviation) + F.lit(mean) if n in scaling else col(n)
        means.append(F.avg(value).alias(n))
    return df.groupBy(col(segment)).agg(
        F.count(F.lit(1)).alias("n_clientes"), *means,
        F.avg(col(target)).alias("tasa_aprobacion"),
    )


@dataclass(frozen=True)
class PlaneProjection:
    """Two principal components of the variables."""

    variables: list[str]
    mean: list[float]
    components: list[list[float]]
    explained: list[float]

    @property
    def below_half(self) -> bool:
        return sum(self.explained) < 0.5

    def project(self, df: DataFrame) -> DataFrame:
        """Add ``c1`` and ``c2``: centred scores, as plain arithmetic."""
        return df.withColumns({
            f"c{j + 1}": reduce(lambda a, b: a + b, [
                (col(n).cast("double") - F.lit(m)) * F.lit(w)
                for n, m, w in zip(self.variables, self.mean, component)
            ])
            for j, component in enumerate(self.components)
        })

    def explained_table(self, spark: SparkSession) -> DataFrame:
        rows = [(j + 1, float(v), self.below_half) for j, v in enumerate(self.explained)]
        return spark.createDataFrame(
            rows, "componente int, varianza_explicada double, menos_de_la_mitad boolean"
        )


def fit_plane(df: DataFrame, variables: list[str]) -> PlaneProjection:
    """Principal components from the distributed covariance; the largest loading is positive."""
    data = assemble(df, variables).select("features")
    mean = data.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    model = PCA(k=min(2, len(variables)), inputCol="features", outputCol="scores").fit(data)
    components = []
    for weights in model.pc.toArray().T:
        sign = 1.0 if weights[np.argmax(np.abs(weights))] >= 0 else -1.0
        components.append([float(w * sign) for w in weights])
    return PlaneProjection(
        list(variables), [float(v) for v in mean], components,
        [float(v) for v in model.explainedVariance],
    )


def plane_centres(projected: DataFrame, segment: str = c.SEGMENT) -> DataFrame:
    """Mean position of each segment on the map."""
    names = [n for n in ("c1", "c2") if n in projected.columns]
    return projected.groupBy(col(segment)).agg(
        F.count(F.lit(1)).alias("n_clientes"), *[F.avg(n).alias(n) for n in names]
    )


def vector_column(df: DataFrame, name: str) -> Column:
    """An MLlib vector column as an array."""
    return vector_to_array(col(name))
