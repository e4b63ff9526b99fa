"""WARC archives: written by tasks, indexed first, read back by coalesced byte ranges.

``write_archives`` appends one gzip member per record to archives in a folder that all executors
share and returns the index: archive, offset, length, URL and digest of every record. A task
writes archives under fresh names and their index rows are its output, so a repeated task leaves
an unreferenced file, never a wrong record. ``read_records`` sorts the chosen index rows by
place, reads neighbouring ranges in one go and parses the members.

Edge cases: a null page is an empty payload, a null URL is left out. Pages with equal payloads
are revisits of the one with the smallest id; rows that repeat that id and payload are responses,
too; a null id is never smallest unless there is no other. Line breaks in URLs are
percent-encoded. Other columns are not read; empty tables give an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aval.session import materialise

INDEX = ("archive string, offset long, length long, url string, payload_digest string, "
         "page_id long, record_type string")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary")
_INDEX = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
_RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("payload", pa.binary())])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One uncompressed record; a revisit has the HTTP headers of the full payload, but no body."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The fields of ``RECORD``; digest and size of a response come from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
    if fields["WARC-Type"] == "revisit":
        said, size, payload = fields["WARC-Payload-Digest"][5:], int(whole["Content-Length"]), None
    else:
        said, size = digest(payload), len(payload)
        if (f"sha1:{said}", str(size)) != (fields["WARC-Payload-Digest"], whole["Content-Length"]):
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return (number["X-Page-ID"], fields.get("WARC-Target-URI"), fields["WARC-Type"],
            number["X-Refers-To-Page-ID"], said, size, payload)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _writer(folder: str, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        name, stream, offset = None, None, 0
        for batch in batches:
            rows = []
            for page, url, html, refers in zip(*(
                    batch.column(n) for n in ("page_id", "url", "html", "refers_to"))):
                if stream is None or offset >= archive_bytes:
                    if stream is not None:
                        stream.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = files.open_output_stream(f"{base}/{name}", compression=None)
                page, url, refers = page.as_py(), url.as_py(), refers.as_py()
                payload = (html.as_py() or "").encode()
                member = gzip.compress(record(page, url, payload, refers, date), 6, mtime=0)
                stream.write(member)
                rows.append((name, offset, len(member), url, digest(payload), page,
                             "response" if refers is None else "revisit"))
                offset += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)]
                if rows else [pa.array([], f.type) for f in _INDEX], schema=_INDEX)
        if stream is not None:
            stream.close()

    return run


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = 0, archive_bytes: int = 256 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``); the stored index.

    ``folder`` is a path or URI of a store that every executor reaches and pyarrow can open.
    """
    files, base = _filesystem(folder)
    files.create_dir(base, recursive=True)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html.cast("binary")).alias("_sha"), F.octet_length(html).alias("_bytes"))
    first = materialise(
        rows.where(F.col("_bytes") >= min_revisit_bytes).groupBy("_sha", "_bytes")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
        .select("_sha", "_bytes", "_first"), "warc-copies")
    known = rows.join(first, ["_sha", "_bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    records = known.select("page_id", "url", "html", refers.alias("refers_to"))
    return materialise(records.mapInArrow(_writer(folder, archive_bytes, date), INDEX), "warc-index")


def _reader(folder: str, gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)

        def ranges(batch):
            """(archive, start, end, members): neighbours at most ``gap`` apart, ``most`` bytes."""
            now = None
            for name, at, size in zip(*(batch.column(n).to_pylist() for n in ("archive", "offset", "length"))):
                if now and name == now[0] and 0 <= at - now[2] <= gap and at + size - now[1] <= most:
                    now[2] = at + size
                    now[3].append((at, size))
                else:
                    if now:
                        yield now
                    now = [name, at, at + size, [(at, size)]]
            if now:
                yield now

        opened = (None, None)
        for batch in batches:
            for name, start, end, members in ranges(batch):
                if opened[0] != name:
                    if opened[1] is not None:
                        opened[1].close()
                    opened = (name, files.open_input_file(f"{base}/{name}"))
                raw = opened[1].read_at(end - start, start)
                rows = [parse(gzip.decompress(raw[at - start : at - start + size]))
                        for at, size in members]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)
        if opened[1] is not None:
            opened[1].close()

    return run


def read_records(
    index: DataFrame, folder: str, max_gap: int = 64 << 10, max_read: int = 4 << 20,
    task_bytes: int = 32 << 20,
) -> DataFrame:
    """The records that ``index`` names, read in sorted byte ranges of up to ``max_read`` bytes.

    The index rows are small, but each stands for the bytes of its record: the number of tasks
    follows those, ``task_bytes`` for each, and at least one task per core.
    """
    chosen = index.select("archive", "offset", "length")
    total = chosen.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(-(-total // task_bytes), index.sparkSession.sparkContext.defaultParallelism)
    chosen = chosen.repartitionByRange(tasks, "archive", "offset")
    return chosen.sortWithinPartitions("archive", "offset").mapInArrow(
        _reader(folder, max_gap, max_read), RECORD)
