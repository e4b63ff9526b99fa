"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every row gets a key from a keyed hash. Keys are cut into equal ranges, so the rows of one source,
also of one that holds most rows, lie in many ranges. Sums per source and range are cumulated;
the range in which a source's budget ends is found from them, then the group of equal key and size in
that range, then the place in the group. All other rows are decided by a projection. Only DataFrame
operations are used.

Edge cases: null sizes count as 0. A null source is a source of its own, last in the order. Rows
with equal keys, as those that share an id or have none, are ordered by size, rows equal in both by a
hash of their other columns; such a group may be any part of the table, since its rows are counted and then
numbered in ranges. A source of size 0 has target 0. Empty tables give no rows. Texts are not read here, so
their length is of no account. Extra columns are carried along, whatever they are called; columns with
names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aval.session import discard, materialise
from aval.sources.order import running_totals

_BROADCAST_SOURCES = 10_000
RESULTS = ("size", "source_size", "target", "taken")


def mix_key(identity: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], total_share: float, most_epochs: int
) -> DataFrame:
    """``sizes`` (``source``, ``source_size``; one row per source) with ``target``.

    Sources in code point order, null last, weigh as ``weights`` says, repeating. Together they
    get ``total_share`` of all sizes; none gets over ``most_epochs`` times its own size. Sorted by
    cap per unit of weight, the sources before some place are at their cap and the rest share
    what is left by weight; that place is where the level first stays within the next cap.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("_rank") % len(weights) + 1)
    ranked = sizes.withColumn("_rank", (F.row_number().over(everything) - 1).cast("int")).withColumns(
        {"_weight": weight.cast("long"), "_cap": F.col("source_size") * most_epochs})
    order = Window.orderBy((F.col("_cap") / F.col("_weight")), "_rank")
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = Window.partitionBy()
    levels = ranked.withColumns({
        "_place": F.row_number().over(order),
        "_level": (F.lit(total_share) * F.sum("source_size").over(whole) - before)
        / F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    fits = F.col("_level") <= F.col("_cap") / F.col("_weight")
    level = F.min_by("_level", F.when(fits, F.col("_place"))).over(whole)
    return levels.select(
        "source", "source_size",
        F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_weight") * level),
                   F.col("_cap").cast("double")).alias("target"))


def _cut_groups(keys: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the group of rows of equal key and size in which its budget ends, and what is left for it.

    Only the range with the cut is looked at, and its rows count as groups: an id that many rows share has
    one group per size, so no window gets the rows themselves.
    """
    inside = keys.join(plan, F.col("source").eqNullSafe(F.col("mix_source"))).where("range = cut")
    groups = inside.groupBy("source", "key", "size", "rest", "before").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy("key", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = F.col("n") * F.col("size")
    left = F.col("rest") - F.col("before") - (F.sum(whole).over(order) - whole)
    open_groups = groups.withColumn("left", left).where(F.col("left") < whole)
    return open_groups.groupBy("source").agg(F.min(F.struct("key", "size", "left")).alias("edge"))


def mix_sources(
    docs: DataFrame, size: Column, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5,
    most_epochs: int = 2, seed: int = 7, rows_per_range: int = 10_000,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` is how much of the row the mix takes, repeats counted: every whole epoch that
    fits, and from the last epoch the rows before the cut, the row at the cut in part.
    """
    own = "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own = "_" + own
    key, at = f"{own}_key", f"{own}_range"
    keyed = docs.drop(*(r for r in RESULTS if r != "size")).withColumns({
        "size": F.coalesce(size.cast("long"), F.lit(0)), key: mix_key(F.col("doc_id"), seed)})
    narrow = materialise(keyed.select("source", F.col(key).alias("key"), "size"), "mix-keys")
    ranges = max(1, -(-narrow.count() // rows_per_range))

    def range_of(name: str) -> Column:
        place = F.conv(F.substring(name, 1, 8), 16, 10).cast("long")
        return F.shiftright(place * ranges, 32)

    narrow_ranges = narrow.withColumn("range", range_of("key"))
    sums = materialise(
        narrow_ranges.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("range_size").alias("source_size")),
        weights, total_share, most_epochs)
    budget = F.floor("target")
    full = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    targets = targets.withColumn("full", full).withColumn(
        "rest", budget - F.col("full") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("end", F.sum("range_size").over(upto)).withColumnRenamed("source", "s")
    plan = materialise(
        targets.join(ends, F.col("source").eqNullSafe(F.col("s")))
        .groupBy(F.col("source").alias("mix_source"), "source_size", "target", "full", "rest")
        .agg(F.min(F.when(F.col("end") > F.col("rest"), F.col("range"))).alias("cut"),
             F.coalesce(F.max(F.when(F.col("end") <= F.col("rest"), F.col("end"))), F.lit(0)).alias("before")),
        "mix-plan")
    few = plan.count() <= _BROADCAST_SOURCES
    edges = _cut_groups(
        narrow_ranges, F.broadcast(plan.drop("source_size")) if few else plan.drop("source_size"))
    cuts = materialise(plan.join(edges, F.col("mix_source").eqNullSafe(F.col("source")), "left").select(
        F.struct("mix_source", "full", "cut", "edge").alias(own), "source_size", "target"), "mix-cuts")
    discard(narrow, sums, plan)

    planned = keyed.withColumn(at, range_of(key)).join(
        F.broadcast(cuts) if few else cuts, F.col("source").eqNullSafe(F.col(f"{own}.mix_source")))
    edge, mine = F.col(f"{own}.edge"), F.struct(F.col(key).alias("key"), "size")
    border = F.struct(edge["key"].alias("key"), edge["size"].alias("size"))
    on_edge = F.coalesce((F.col(at) == F.col(f"{own}.cut")) & (mine == border), F.lit(False))
    before = F.col(f"{own}.cut").isNull() | (F.col(at) < F.col(f"{own}.cut")) | (
        (F.col(at) == F.col(f"{own}.cut")) & (mine < border))
    again = f"{own}_again"
    outside = planned.where(~on_edge).withColumn(again, F.when(before, F.col("size")).otherwise(0))
    # Rows of the cut group are alike to the mix; those with the smallest hashes are taken.
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and c in planned.columns]
    alike = planned.where(on_edge).select(
        F.struct("*").alias("row"), "source", F.xxhash64(*hashed).alias("hash"),
        F.monotonically_increasing_id().alias("id"), F.lit(1).alias("one"))
    placed = running_totals(alike, ["source", "hash", "id"], "one", "place")
    first = placed.groupBy(F.col("source").alias("s")).agg(F.min("place").alias("first"))  # a row per source
    inside = placed.join(F.broadcast(first) if few else first, F.col("source").eqNullSafe(F.col("s"))).select(
        "row.*", (F.col("place") - F.col("first")).alias(f"{own}_place"))
    left = edge["left"] - F.col(f"{own}_place") * F.col("size")
    inside = inside.withColumn(again, F.greatest(F.lit(0), F.least(F.col("size"), left))).drop(f"{own}_place")
    mixed = outside.unionByName(inside).withColumn(
        "taken", F.col(f"{own}.full") * F.col("size") + F.col(again))
    return mixed.drop(own, key, at, again)
