"""Where rows stand in their files, and consecutive numbers in that order.

Spark deals the splits of files to tasks by size, so the order of a scan follows the number of cores and
the split size. The place used here does not: file path, then where the split starts in the file,
then the place within the split.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aval import config as c
from aval.session import materialise

PLACE = "_at"


def with_place(df: DataFrame, name: str = PLACE) -> DataFrame:
    """``name``: a struct that sorts rows by file, split and place in it. Call it right on a scan.

    Projections and filters in between are fine. Rows that come from no file are taken in the
    order of their partitions.
    """
    if name in df.columns:
        return df
    place = F.monotonically_increasing_id().alias("place")
    try:
        scan = df.select("*", F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            place).alias(name))
        scan.schema  # resolves the hidden column
        return scan
    except AnalysisException:
        return df.withColumn(name, F.struct(
            F.lit("").alias("file"), F.shiftright(F.monotonically_increasing_id(), 33).alias("block"), place))


def with_sequence(df: DataFrame, name: str = c.SEQ) -> DataFrame:
    """Rows with their place as ``name``, unless they have such a column. Unique and stable.

    It orders rows as they stand in their files, whatever the splits; use ``numbered`` for numbers.
    """
    if name in df.columns:
        return df
    return df.withColumnRenamed(PLACE, name) if PLACE in df.columns else with_place(df, name)


def running_totals(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` and ``name``, the sum of ``value`` over all rows before, in the order of ``order``.

    Rows are dealt in ranges of the order; a range knows the total of those before it from one row per range,
    so no task gets all rows and what the driver sees is bounded by the number of shuffle partitions.
    """
    ranges = materialise(
        rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("total")).collect()
    starts, total = {}, 0
    for r in sorted(totals, key=lambda r: r["_range"]):
        starts[r["_range"]], total = total, total + r["total"]
    begin = rows.sparkSession.createDataFrame(
        list(starts.items()), "_range int, _begin long")  # one row per shuffle partition
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(begin), "_range")
        .withColumn(name, F.col("_begin") + F.col("_inside")).drop("_range", "_begin", "_inside"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows with their numbers 1, 2, 3… in the order of their files as ``name``.

    The rows are stored with their places, since a second scan may be divided otherwise once executors
    are lost or added. Splits are counted, their counts summed up in order, and joined back by
    file and split; Spark broadcasts them only while their measured size allows it. The rows
    of a split are ranked where they are not consecutive already.
    """
    stored = materialise(with_place(df), "places")
    split = stored.select("*", F.col(f"{PLACE}.file").alias("_file"), F.col(f"{PLACE}.block").alias("_block"),
                          F.col(f"{PLACE}.place").alias("_place"))
    blocks = split.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_least"), F.max("_place").alias("_most"))
    dense = blocks.agg(F.bool_and(F.col("_most") - F.col("_least") + 1 == F.col("_n"))).first()[0]
    starts = running_totals(blocks, ["_file", "_block"], "_n", "_start")
    if dense is False:
        rank = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_place"))
        split = split.withColumn("_rank", rank)
    else:
        split = split.withColumn("_rank", F.lit(1))
    inside = F.col("_rank") if dense is False else F.col("_place") - F.col("_least") + 1
    return (
        split.join(starts, ["_file", "_block"]).withColumn(name, (F.col("_start") + inside).cast("long"))
        .drop(PLACE, "_file", "_block", "_place", "_rank", "_start", "_n", "_least", "_most"))
