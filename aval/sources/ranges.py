"""Records of files whose structure no line shows: JSON lists, and CSV with line breaks in quotes.

Spark's text reader cuts a file, in as many tasks as it has splits, at every closing brace (JSON) or line
feed (CSV), also at those inside strings. What state a piece begins in follows from all text before it:

1. Within a split, running sums give the parity of the quotes so far and the change of depth, once
   for a split that begins outside a string and once for one that begins inside.
2. Per file these maps of the splits are composed in order: a prefix sum of parities says how
   each begins, which selects its change of depth, whose prefix sum is its depth.
3. A piece that closes at the depth of a record ends one; pieces go to the next end, also of a later split.

No file is read as one string and no task holds more than a split or a record, so lists of any length
are read by as many tasks as their size gives. A record keeps the place where it ends, which
orders records as in the file. The pieces are stored once. Running sums are taken of them without their text
first; the text is shuffled once, by split, where most records end in the split they begin in. Only what
is before the first end of a split, and behind its last, goes on to another task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from aval.session import materialise
from aval.sources.order import PLACE

JSON_CLOSE, LINE_FEED = "}", "\n"


def _in_split() -> WindowSpec:
    return Window.partitionBy("file", "block").orderBy("place")


def _in_file() -> WindowSpec:
    return Window.partitionBy("file").orderBy("block")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _before(value: Column, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _json_depths(piece: Column) -> tuple[Column, Column, Column]:
    """Quotes of a piece, and its change of depth when it begins outside and inside a string."""
    bare = F.regexp_replace(piece, r"(?s)\\.", "")
    quotes = _count(bare, '"')
    inside = F.regexp_replace(F.concat(F.lit('"'), bare), '"[^"]*("|$)', "")
    outside = F.regexp_replace(bare, '"[^"]*("|$)', "")

    def change(rest: Column, ends_outside: Column) -> Column:
        return _count(rest, "{[") - _count(rest, "]") - F.when(ends_outside, 1).otherwise(0)

    return quotes, change(outside, quotes % 2 == 0), change(inside, quotes % 2 == 1)


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Stored pieces with their quotes and their change of depth for both beginnings."""
    scan = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("piece"))
    quotes, outside, inside = _json_depths(F.col("piece")) if separator == JSON_CLOSE else (
        _count(F.col("piece"), '"'), F.lit(0), F.lit(0))
    head = F.substring(F.regexp_replace("piece", r"^[\s\x{FEFF}]+", ""), 1, 1)
    return materialise(scan.withColumns({
        "quotes": quotes, "outside": outside, "inside": inside, "head": head,
        "bytes": F.octet_length("piece") + 1}), "pieces")


def _running(pieces: DataFrame) -> DataFrame:
    """``parity`` after each piece and its depth for both beginnings of the split."""
    begun = pieces.withColumn("begins", _before(F.col("quotes"), _in_split()) % 2)
    so_far = _in_split().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def depth(first: int) -> Column:
        change = F.when(F.col("begins") == first, F.col("outside")).otherwise(F.col("inside"))
        return F.sum(change).over(so_far)

    return begun.withColumns({
        "parity": (F.col("begins") + F.col("quotes")) % 2, "depth_outside": depth(0), "depth_inside": depth(1),
    }).drop("begins", "quotes", "outside", "inside")


def _entries(pieces: DataFrame) -> DataFrame:
    """Per split: parity and depth it begins with, its file's first character, and a last piece that nothing closes."""
    def last(name: str) -> Column:
        return F.max_by(name, "place").alias(name)

    splits = pieces.groupBy("file", "block").agg(
        last("parity"), last("depth_outside"), last("depth_inside"), F.max("place").alias("last"), F.min("place").alias("least"),
        F.min_by("head", "place").alias("opening"), F.max("file_size").alias("file_size"), F.sum("bytes").alias("bytes"))
    begun = splits.withColumn("entry", _before(F.col("parity"), _in_file()) % 2)
    change = F.when(F.col("entry") == 0, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    whole = Window.partitionBy("file")
    # Every piece was counted with a separator. Without one behind the last piece the file is a byte
    # shorter (a byte order mark is not in the pieces); packed files only tell by their depth.
    over = F.sum("bytes").over(whole) - F.max("file_size").over(whole)
    end_depth = F.sum("change").over(whole)
    is_last = F.lead("block").over(_in_file()).isNull()
    first = F.min(F.struct("block", F.col("least").alias("place"))).over(whole)
    return begun.withColumn("change", change).select(
        "file", "block", "entry", _before(F.col("change"), _in_file()).alias("entry_depth"),
        F.first("opening").over(_in_file().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("opening"),
        F.when(is_last & (over.isin(1, -2) | (end_depth < 0)), F.col("last")).alias("open_place"),
        first.alias("first_place"), (end_depth >= 0).alias("unclosed"))


def cut_records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``value`` (the whole text), ``opening`` (the file's first character) and ``_at`` of every record.

    ``first`` marks the one a file begins with; ``unclosed``, where the last brace of a file is followed by
    nothing (JSON). Text behind the last record of a file is a row of its own with a null place in ``_at``.
    """
    pieces = _pieces(spark, path, separator)
    is_json = separator == JSON_CLOSE
    light = materialise(_running(pieces.drop("piece")), "depths")
    entries = materialise(_entries(light), "splits")
    outside = (F.col("entry") + F.col("parity")) % 2 == 0
    depth = F.col("entry_depth") + F.when(F.col("entry") == 0, F.col("depth_outside")).otherwise(
        F.col("depth_inside"))
    base = F.when(F.col("opening") == "[", 1).otherwise(0)
    closed = ~F.coalesce(F.col("place") == F.col("open_place"), F.lit(False))
    ends = outside & (depth == base) & closed if is_json else outside

    def marked(rows: DataFrame) -> DataFrame:
        return rows.join(entries, ["file", "block"]).withColumn("end", F.when(ends, F.col("place")))

    # Backwards, since a frame that ends with the partition is computed anew for every row.
    following = Window.partitionBy("file", "block").orderBy(F.desc("place")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    first_ends = marked(light).groupBy("file", "block").agg(F.min("end").alias("first_end")).select(
        "file", "block", "first_end", F.last(F.when(F.col("first_end").isNotNull(), F.struct("block", "first_end")),
                                ignorenulls=True).over(later).alias("next"))
    running = _running(pieces.drop("file_size", "head", "bytes"))
    placed = marked(running).withColumn("here", F.last("end", ignorenulls=True).over(following)).join(
        first_ends, ["file", "block"])
    split = F.when(F.col("here").isNotNull(), F.col("block")).otherwise(F.col("next.block"))
    record = ["file", "opening", "first_place", "unclosed", "end_block", "end_place"]
    keyed = placed.select(
        "file", "opening", "first_place", "unclosed", split.alias("end_block"), F.coalesce("here", "next.first_end").alias("end_place"),
        "block", "first_end", F.struct("place", "piece").alias("part"))

    def joined(parts: str, text: str) -> Column:
        in_order = F.array_sort(F.collect_list(parts))
        return F.array_join(F.transform(in_order, lambda p: p[text]), separator).alias("value")

    # The rows of a split are in one task already; of a record that begins in it and ends in it, all pieces are.
    local = keyed.groupBy(*record, "block", "first_end").agg(
        joined("part", "piece"), F.min("part.place").alias("least"))
    whole = F.coalesce((F.col("end_block") == F.col("block")) & (F.col("end_place") != F.col("first_end")), F.lit(False))
    begins = F.struct("block", F.col("least").alias("place"))
    crossing = local.where(~whole).select(*record, begins.alias("begins"), F.struct("block", "value").alias("part"))
    records = local.where(whole).select(*record, "value", begins.alias("begins")).unionByName(
        crossing.groupBy(*record).agg(joined("part", "value"), F.min("begins").alias("begins")))
    return records.select(
        F.struct("file", F.col("end_block").alias("block"), F.col("end_place").alias("place")).alias(PLACE),
        "opening", "value", "unclosed", (F.col("begins") == F.col("first_place")).alias("first"))


def _refused(condition: Column, message: str, text: Column) -> Column:
    shown = F.concat(F.lit(message), F.lit(": "), F.substring(text, 1, 200))
    return F.when(condition, F.raise_error(shown).cast("boolean")).otherwise(F.lit(True))


def json_records(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``value``, the text of every object, and ``_at``, its place.

    A file is a list of objects or one object. What else it has between or behind the objects, and a second value,
    is an error when the data are read, or, unless ``strict``, a row with that text.
    """
    cut = cut_records(spark, path, JSON_CLOSE)
    is_list, found = F.col("opening") == "[", F.col(f"{PLACE}.place").isNotNull()
    text = F.regexp_replace("value", r"^\x{FEFF}", "")
    before = F.when(~is_list, r"^\s*(?=\{)").when(F.col("first"), r"^\s*\[\s*(?=\{)").otherwise(r"^\s*,\s*(?=\{)")
    record = F.concat(F.regexp_replace(text, before, F.lit("")), F.lit("}"))
    rest = F.when(~is_list, text.rlike(r"^\s*$")).when(
        F.col("first"), text.rlike(r"^\s*\[\s*\]\s*$")).otherwise(text.rlike(r"^\s*\]\s*$"))
    sound = F.when(found, F.startswith(record, F.lit("{")) & (is_list | F.col("first"))).otherwise(rest)
    rows = cut.select(PLACE, F.when(found, record).otherwise(text).alias("value"), sound.alias("sound"),
                      found.alias("found"), (~is_list & found & ~F.col("first")).alias("again"),
                      (is_list & F.col("unclosed")).alias("endless"))
    if strict:
        rows = rows.where(_refused(F.col("endless"), "a list without an end", F.col("value")))
        rows = rows.where(_refused(~F.col("sound") & ~F.col("again"), "neither a list of objects nor one object",
                                   F.col("value")))
        rows = rows.where(_refused(F.col("again"), "more than one value", F.col("value")))
    return rows.where(F.col("found") | ~F.col("sound")).select(PLACE, "value")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``, the text of every row but the header of each file, and ``_at``, its place.

    Quotes inside quoted fields are doubled; a field that does not begin with a quote has none. An open quote at the
    end of a file is an error when the data are read. Empty rows are left out.
    """
    cut = cut_records(spark, path, LINE_FEED).withColumn("value", F.regexp_replace("value", r"\r$", ""))
    whole = cut.where(_refused(
        F.col(f"{PLACE}.place").isNull(), "a quote is open at the end of the file", F.col("value")))
    return whole.where(~F.col("first") & (F.trim("value") != "")).select(PLACE, "value")
