"""Connected components as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aval.session import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """Every node of ``edges`` (``a``, ``b``; longs) with the smallest node it can reach.

    Alternates the large-star and small-star steps: every node hands its larger, then its smaller
    neighbours to the smallest of them, until nothing changes; about log(nodes) rounds. Minima
    are combined before they are shuffled and the joins back are plain equi-joins, which adaptive
    execution can split, so a node with very many links is no single task. Each round is stored,
    so a lost executor repeats one round at most. No edges: no rows.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    current = materialise(pairs, "star")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select("low", "high")).toDF("node", "near")
        least = both.groupBy("node").agg(F.min("near").alias("least")).select(
            "node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").where("near > node").select("near", "least").distinct()
        stored = materialise(large, "star")
        down = stored.groupBy("near").agg(F.min("least").alias("root"))
        small = stored.join(down, "near").select(
            F.explode(F.array("near", "least")).alias("high"), F.col("root").alias("low"))
        following = materialise(small.where("high <> low").distinct(), "star")
        discard(current, stored)
        current, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        current.select("low", "low").distinct())


def _mark(pairs: DataFrame) -> tuple:
    """Number of pairs and an order-free checksum."""
    return tuple(pairs.agg(
        F.count("*"), F.bit_xor(F.xxhash64("high", "low")),
        F.sum(F.xxhash64("low", "high") % 1_000_003)).first())
