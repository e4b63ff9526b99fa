"""Exact stratified assignment to train/test and to folds, without ranking whole classes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, PreparationError
from aval.functions.values import col

#: Rows that one task may have to sort when a cut is located.
_ROWS_PER_BUCKET = 1_000_000


def split_key(id_column: Column, seed: int) -> Column:
    """Pseudo-random order of the ids, the same on any cluster and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), id_column.cast("string")))


def class_counts(df: DataFrame, label: str,
                 max_classes: int = c.PreparationConfig.max_classes) -> dict:
    """Rows per class. The driver receives one row per class, so a column with more than
    ``max_classes`` values (an id, a measurement) is refused as a label, as is a missing one."""
    counted = df.groupBy(col(label).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise PreparationError(f"'{label}' has more than {max_classes} values: it is not a class")
    if any(r["k"] is None for r in rows):
        raise PreparationError(f"'{label}' is missing in some rows: they belong to no class")
    return {r["k"]: r["n"] for r in sorted(rows, key=lambda r: r["k"])}


def keys_at_ranks(df: DataFrame, label: str, key: Column,
                  ranks: dict[object, list[int]], counts: dict) -> dict[object, list[str]]:
    """The key found at each 0-based rank of each class, in key order.

    Keys are counted by their leading hex digits; running totals over that small table name
    the bucket of each rank, and only those buckets are sorted. A class of any size, or one
    holding most rows, never meets in one task.
    """
    targets = [(k, int(r)) for k, rs in ranks.items() for r in rs]
    if not targets:
        return {k: [] for k in ranks}
    largest = max(counts.values())
    digits = min(6, max(2, math.ceil(math.log(max(largest / _ROWS_PER_BUCKET, 1), 16))))
    keyed = df.select(col(label).alias("k"), key.alias("key")).withColumn(
        "bucket", F.substring("key", 1, digits)
    )
    per_bucket = keyed.groupBy("k", "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = W.partitionBy("k").orderBy("bucket")
    before = F.sum("n").over(running) - F.col("n")
    wanted = df.sparkSession.createDataFrame(
        targets, f"k {df.schema[label].dataType.simpleString()}, rank bigint"
    )
    # One row per class and rank, on the order of the number of folds.
    located = (
        per_bucket.withColumn("before", before)
        .join(F.broadcast(wanted), "k")
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("k", "bucket", "rank", (F.col("rank") - F.col("before")).alias("offset"))
    )
    in_bucket = F.row_number().over(W.partitionBy("k", "bucket").orderBy("key")) - 1
    boundaries = F.broadcast(located.select("k", "bucket").distinct())
    ranked = keyed.join(boundaries, ["k", "bucket"]).withColumn("offset", in_bucket)
    rows = ranked.join(F.broadcast(located), ["k", "bucket", "offset"]).select("k", "rank", "key")
    found = {(r["k"], r["rank"]): r["key"] for r in rows.collect()}
    return {k: [found[(k, int(r))] for r in rs] for k, rs in ranks.items()}


def quotas_for_test(counts: dict, test_size: float) -> dict:
    """Rows of each class that go to test: their total is the rounded-up share of all rows,
    handed out by largest remainder (smaller class value first on a tie)."""
    total = sum(counts.values())
    wanted = math.ceil(round(test_size * total, 9))
    floors = {k: wanted * n // total for k, n in counts.items()}
    left = wanted - sum(floors.values())
    by_remainder = sorted(counts, key=lambda k: (-(wanted * counts[k] % total), k))
    return {k: floors[k] + (k in by_remainder[:left]) for k in counts}


def stratified_split(df: DataFrame, label: str = c.TARGET, key: str = c.ID,
                     test_size: float = 0.2, seed: int = 42,
                     max_classes: int = c.PreparationConfig.max_classes) -> DataFrame:
    """Add ``split``: exactly the class's quota of rows, in pseudo-random order, is ``test``.

    Learning the cuts takes two aggregations; applying them is a projection. Ids must be unique:
    rows that share one always fall on the same side, so repeated ids can exceed the quota.
    """
    counts = class_counts(df, label, max_classes)
    for value, n in counts.items():
        if n < 2:
            raise PreparationError(
                f"cannot keep class proportions: class {value} has {n} row(s), at least 2 needed"
            )
    quotas = quotas_for_test(counts, test_size)
    order = split_key(col(key), seed)
    cuts = keys_at_ranks(
        df, label, order, {k: [q - 1] for k, q in quotas.items() if q > 0}, counts
    )
    in_test = [(col(label) == F.lit(k)) & (order <= F.lit(cut[0])) for k, cut in cuts.items()]
    chosen = reduce(lambda a, b: a | b, in_test, F.lit(False))
    return df.withColumn(c.SPLIT, F.when(chosen, c.TEST).otherwise(c.TRAIN))


def assign_folds(df: DataFrame, k: int = 5, label: str = c.TARGET, key: str = c.ID,
                 seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..k-1: each class is cut, in pseudo-random order, into k near-equal runs."""
    counts = class_counts(df, label)
    for value, n in counts.items():
        if n < k:
            raise EvaluationError(
                f"cannot cross-validate with {k} folds: class {value} has {n} rows"
            )
    order = split_key(col(key), seed)
    # Fold f of a class of n rows starts at rank ceil(f * n / k).
    starts = {value: [-(-f * n // k) for f in range(1, k)] for value, n in counts.items()}
    cuts = keys_at_ranks(df, label, order, starts, counts)
    fold = F.lit(None).cast("int")
    for value, bounds in cuts.items():
        passed = [F.when(order >= F.lit(b), 1).otherwise(0) for b in bounds]
        fold = F.when(
            col(label) == F.lit(value), reduce(lambda a, b: a + b, passed, F.lit(0))
        ).otherwise(fold)
    return df.withColumn(c.FOLD, fold)
