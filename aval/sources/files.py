"""Loading sources by extension and writing results."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval import config as c
from aval.errors import MissingPathError, ParseError, SourceNotFoundError, UnsupportedFormatError
from aval.functions.values import col, nan_to_null, normalise_null_tokens
from aval.session import materialise
from aval.sources.order import PLACE, with_place, with_sequence
from aval.sources.ranges import csv_records, json_records
from aval.sources.workbook import read_workbooks, read_workbooks_checked

CORRUPT = "_corrupt_record"
BROKEN = "_broken"


def _quoted_rows(records: DataFrame, schema: T.StructType, place: bool) -> DataFrame:
    """The fields of CSV records that may have line breaks; as ``read_csv`` in all else."""
    fields = [f"f{i}" for i in range(len(schema) + 1)]
    parsed = records.withColumn("r", F.from_csv(
        "value", ", ".join(f"{n} string" for n in fields), {"escape": '"'}))
    message = F.concat(F.lit("malformed row: "), F.substring("value", 1, 200))
    checked = parsed.where(F.when(F.col("r")[fields[-1]].isNotNull(), F.raise_error(message).cast("boolean"))
                           .otherwise(F.lit(True)))
    kept = [F.col(PLACE)] if place else []
    return normalise_null_tokens(checked.select(
        *kept, *(F.col("r")[n].cast(f.dataType).alias(f.name) for n, f in zip(fields, schema))))


def _permissive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows with their whole text in ``CORRUPT`` where the number of fields is not the header's."""
    whole = with_corrupt(schema)
    return spark.read.options(
        header=True, mode="PERMISSIVE", escape='"',
        columnNameOfCorruptRecord=CORRUPT, enforceSchema=True,
        columnPruning=False,  # otherwise the fields of a line are not all counted
    ).schema(whole).csv(path)


def _too_long(schema: T.StructType) -> Column:
    """The line has more fields than the header; a line with fewer only lacks values."""
    fields = ", ".join(f"f{i} string" for i in range(len(schema) + 1))
    extra = F.from_csv(F.col(CORRUPT), fields, {"escape": '"'})[f"f{len(schema)}"]
    return F.col(CORRUPT).isNotNull() & extra.isNotNull()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multiline: bool = False, place: bool = False) -> DataFrame:
    """CSV with a header, as text; textual spellings of "missing" become NULL.

    Lines with fewer fields than the header are completed with NULL; a line with more raises
    when the data is read. ``multiline`` allows line breaks inside quotes: the ends of rows are
    found by the parity of the quotes before them, in as many tasks as the file has splits.
    ``place`` adds where each row stands (``_at``).
    """
    if schema is None:
        schema = spark.read.options(header=True, escape='"', multiLine=multiline).csv(path).schema
    if multiline:
        return _quoted_rows(csv_records(spark, path), schema, place)
    rows = _permissive(spark, path, schema)
    if place:
        rows = with_place(rows)
    # The message reads a second column because Spark refuses to read CORRUPT alone.
    message = F.concat_ws(" ", F.lit("malformed line:"), CORRUPT,
                          F.substring(col(schema[0].name), 1, 0))
    checked = rows.filter(
        F.when(_too_long(schema), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )
    return normalise_null_tokens(checked.drop(CORRUPT))


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType
                        ) -> tuple[DataFrame, DataFrame]:
    """``(good rows, malformed rows)`` instead of stopping at the first malformed line.

    Malformed rows keep what could be parsed next to the whole text in ``linea``; Spark does
    not allow reading that text alone from the file.
    """
    rows = _permissive(spark, path, schema)
    malformed = F.coalesce(_too_long(schema), F.lit(False))
    good = normalise_null_tokens(rows.filter(~malformed).drop(CORRUPT))
    bad = rows.filter(malformed).withColumnRenamed(CORRUPT, "linea")
    return good, bad


def json_is_lines(spark: SparkSession, path: str) -> bool:
    """Whether JSON at ``path`` is read as one record per line.

    Folders, globs and the extensions of JSON Lines are. A single other file is if its first
    line with text holds a whole value.
    """
    if _extension(path) != "json" or "*" in path:
        return True
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    try:
        json.loads(first[0][0] if first else "{}")
    except ValueError:
        return False
    return True


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              lines: bool | None = None, place: bool = False) -> DataFrame:
    """One record per line (``lines``), or a JSON list of objects, or one object, per file.

    Without ``lines`` the layout is recognised. All are read in as many tasks as the files have splits; a
    file that goes on after its value is an error when the data are read. Without ``schema`` the types are
    inferred from all records. ``place`` adds where each record stands (``_at``).
    """
    lines = json_is_lines(spark, path) if lines is None else lines
    if lines:
        reader = spark.read.options(mode="FAILFAST")
        rows = (reader if schema is None else reader.schema(schema)).json(path)
        return nan_to_null(with_place(rows) if place else rows)
    records = json_records(spark, path)
    if schema is None:
        records = materialise(records, "records")  # read for the types and for the values
        schema = spark.read.json(records.select("value").rdd.map(lambda r: r[0])).schema
    kept = [F.col(PLACE)] if place else []
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")
    return nan_to_null(records.select(*kept, parsed).select(*kept, "r.*"))


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def parsed_lines(lines: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """One row per line (``value``) with text; ``CORRUPT`` has those that are no such record."""
    record = F.from_json("value", with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(F.trim("value") != "").select(*keep, record.alias("r")).select(*keep, "r.*")


def read_json_quarantine(spark: SparkSession, path: str, schema: T.StructType, lines: bool = True,
                         place: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good rows, malformed ones)`` of JSON Lines, or of the objects of lists; malformed text is in ``linea``.

    Of a list, elements that are no such object are malformed, and so is text behind its end.
    """
    source = with_place(spark.read.text(path)) if lines else materialise(
        json_records(spark, path, strict=False), "records")
    rows = parsed_lines(source, schema, PLACE)
    kept = rows if place else rows.drop(PLACE)
    good = nan_to_null(kept.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return good, kept.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "linea")


def read_workbooks_quarantine(spark: SparkSession, path: str, schema: T.StructType | None = None
                              ) -> tuple[DataFrame, DataFrame]:
    """``(rows of good workbooks, broken ones)`` instead of stopping at the first broken workbook.

    A broken workbook gives no rows but one of ``ruta``, ``fila`` (the row of the sheet at which reading
    stopped, 0 before the first) and ``motivo``. Every workbook is parsed once; both tables read the result.
    """
    checked = materialise(read_workbooks_checked(spark, path, schema), "workbooks")
    good = normalise_null_tokens(checked.filter(F.col(BROKEN).isNull()).drop(BROKEN))
    return good, checked.filter(F.col(BROKEN).isNotNull()).select(f"{BROKEN}.*")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.parquet(path))


#: Extension -> reader. Add an entry to support another format.
READERS = {"csv": read_csv, "json": read_json, "jsonl": read_json, "xlsx": read_workbooks, "parquet": read_parquet}


def _extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/*"))[1].lstrip(".").lower()


def load_source(spark: SparkSession, path: str, fmt: str | None = None, sequence: bool = False,
                **options) -> DataFrame:
    """Load a file, folder or glob with the reader of its extension (or of ``fmt``).

    ``sequence`` adds ``_seq``, which orders rows as they stand in their files, whatever the splits.
    Checked in this order: empty path, nothing there, no reader.
    """
    if not path:
        raise MissingPathError("a path is required to load a source")
    try:
        # Resolving a listing reads no content.
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        raise SourceNotFoundError(f"nothing found at '{path}'") from error
    kind = (fmt or _extension(path)).lower()
    if kind not in READERS:
        known = ", ".join(sorted(READERS))
        raise UnsupportedFormatError(f"format '.{kind}' of '{path}' has no reader; known: {known}")
    try:
        if sequence and kind in ("csv", "json", "jsonl"):
            options["place"] = True
        rows = READERS[kind](spark, path, **options)
        return with_sequence(rows) if sequence else rows
    except Exception as error:
        raise ParseError(f"cannot read '{path}' as {kind}: {error}") from error


def check_readable(df: DataFrame, path: str) -> DataFrame:
    """Read everything once and raise :class:`ParseError` on malformed content.

    Spark reads lazily, so malformed content otherwise surfaces in the first job.
    """
    try:
        df.write.format("noop").mode("overwrite").save()
    except Exception as error:
        raise ParseError(f"cannot read '{path}': {error}") from error
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), mode: str = "overwrite",
                rebalance: bool | None = None) -> None:
    """Write as Parquet (optionally partitioned) or as CSV with a header.

    Rows of a partitioned table are rebalanced by its columns first: adaptive execution gives a light
    partition to one task, and so one file, and splits a heavy one at
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``; a light one that shares a shuffle partition with a
    heavy one is split with it, so ``spark.sql.shuffle.partitions`` should exceed their number. ``rebalance`` asks for that without partition
    columns too, where it evens out the files and loses the order of the rows.
    """
    if bool(partition_by) if rebalance is None else rebalance:
        df = df.hint("rebalance", *[col(n) for n in partition_by])
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise UnsupportedFormatError(f"no writer for '{fmt}'")


def source_schema(source: str) -> T.StructType:
    """The all-text schema of a source, for reading without inference."""
    return T.StructType([T.StructField(n, T.StringType()) for n in c.SOURCE_COLUMNS[source]])
