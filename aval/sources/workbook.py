"""XLSX workbooks: every task parses whole workbooks, whose size the format itself limits."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval.functions.values import normalise_null_tokens

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_ROWS_PER_FRAME = 10_000
#: What a file that is no workbook, or a damaged one, makes the parser raise.
PARSE_ERRORS = (zipfile.BadZipFile, zlib.error, ET.ParseError, KeyError, IndexError, ValueError, AttributeError,
                StopIteration, EOFError, NotImplementedError, RuntimeError)
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _first_sheet(archive: zipfile.ZipFile) -> str:
    sheet = next(ET.fromstring(archive.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
    links = ET.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    target = next(link.get("Target") for link in links if link.get("Id") == sheet.get(_REL))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cell(cell: ET.Element, shared: list[str]) -> str | None:
    if cell.get("t") == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    raw = cell.findtext(f"{_MAIN}v")
    if raw is None or cell.get("t") == "e":
        return None
    if cell.get("t") == "s":
        return shared[int(raw)]
    return {"1": "true", "0": "false"}[raw] if cell.get("t") == "b" else raw


def _elements(archive: zipfile.ZipFile, part: str, tag: str) -> Iterator[ET.Element]:
    """The elements of one tag, each emptied once the next is asked for."""
    with archive.open(part) as stream:
        parents: list[ET.Element] = []
        for event, element in ET.iterparse(stream, ("start", "end")):
            if event == "start":
                parents.append(element)
                continue
            parents.pop()
            if element.tag == f"{_MAIN}{tag}":
                yield element
                parents[-1].remove(element)


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as texts; one row of the sheet is in memory at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in archive.namelist():
            for item in _elements(archive, "xl/sharedStrings.xml", "si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        for row in _elements(archive, _first_sheet(archive), "row"):
            values: list[str | None] = []
            for position, cell in enumerate(row.iter(f"{_MAIN}c")):
                place = _column_number(cell.get("r")) if cell.get("r") else position
                values += [None] * (place + 1 - len(values))
                values[place] = _cell(cell, shared)
            yield values


def _header_columns(files: DataFrame, tolerant: bool) -> T.StructType:
    """The header names of all workbooks; only column names reach the driver."""
    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                try:
                    names = next(sheet_rows(content), [])
                except PARSE_ERRORS:
                    if not tolerant:
                        raise
                    names = []
                yield pd.DataFrame({"i": range(len(names)), "name": [n or "" for n in names]})

    found = files.mapInPandas(headers, "i int, name string").filter("name <> ''")
    ordered = found.groupBy("name").agg(F.min("i").alias("i")).orderBy("i", "name").collect()
    return T.StructType([T.StructField(r["name"], T.StringType()) for r in ordered])


def _frames(content: bytes, columns: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of a workbook below its header, some thousands at a time."""
    lines = sheet_rows(content)
    header = next(lines, [])
    places = [header.index(n) if n in header else -1 for n in columns]
    records = (
        [line[p] if 0 <= p < len(line) else None for p in places]
        for line in lines if any(v is not None for v in line)
    )
    while part := list(islice(records, _ROWS_PER_FRAME)):
        yield pd.DataFrame(part, columns=columns, dtype=object)


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """First sheet of every workbook at ``path`` as text columns, matched by header name.

    Without a schema the headers are read in a first pass.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    if schema is None:
        schema = _header_columns(files, tolerant=False)
    columns = schema.fieldNames()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield from _frames(content, columns)

    return normalise_null_tokens(files.mapInPandas(rows, schema))


def read_workbooks_checked(spark: SparkSession, path: str, schema: T.StructType | None = None,
                           name: str = "_broken") -> DataFrame:
    """As ``read_workbooks``, with one row per broken workbook that has only ``name``: path, row, reason.

    The sheet is walked through once before its rows are given out, so a workbook counts wholly or not
    at all while no more than some thousands of its rows are in memory.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    if schema is None:
        schema = _header_columns(files.select("content"), tolerant=True)
    columns = schema.fieldNames()
    parts = ["ruta", "fila", "motivo"]
    flat = T.StructType([*schema.fields, T.StructField("ruta", T.StringType()),
                         T.StructField("fila", T.LongType()), T.StructField("motivo", T.StringType())])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["path"], batch["content"]):
                row = 0
                try:
                    for _ in sheet_rows(content):
                        row += 1
                except PARSE_ERRORS as error:
                    reason = f"{type(error).__name__}: {error}"
                    yield pd.DataFrame([[*[None] * len(columns), place, row, reason]],
                                       columns=[*columns, *parts])
                    continue
                for frame in _frames(content, columns):
                    yield frame.assign(ruta=None, fila=pd.array([None] * len(frame), "Int64"), motivo=None)

    broken = F.when(F.col("ruta").isNotNull(), F.struct(*parts)).alias(name)
    return files.mapInPandas(rows, flat).select(*[f"`{n}`" for n in columns], broken)
