"""Session-level helpers: where durable intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from aval.errors import PreparationError

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_FALLBACK: dict[str, str] = {}
_GATHERED: ContextVar[list[DataFrame] | None] = ContextVar("gathered", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in a single process only.

    On a cluster, also one of several processes on one machine, a machine-local folder would be
    lost with its executor, so an unset setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_KEY
    )
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise PreparationError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="aval-")
    return _LOCAL_FALLBACK[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the scan of it.

    This cuts the lineage before iterative work: a lost executor re-reads files instead of
    replaying the joins, and later stages still get column pruning and pushed-down filters.
    The caller owns the table and may ``discard`` it once nothing reads it any more.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    if (gathered := _GATHERED.get()) is not None:
        gathered.append(stored)
    return stored


def spread(df: DataFrame, rows: int, least: int = 5_000, most: int = 250_000) -> DataFrame:
    """``df``, which has ``rows``, dealt evenly over the cores, for iterative work that caches it.

    A stored table comes back in as many parts as its files give, often fewer than there are cores. A part
    gets at least ``least`` rows, so up to that many stay as they are, and at most ``most``.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(max(cores, -(-rows // most)), -(-rows // least))
    return df.repartition(parts) if parts > 1 else df


@contextmanager
def gathered_tables() -> Iterator[list[DataFrame]]:
    """The tables that are materialised inside, by this thread, for the caller to discard."""
    tables: list[DataFrame] = []
    token = _GATHERED.set(tables)
    try:
        yield tables
    finally:
        _GATHERED.reset(token)


def discard(*stored: DataFrame) -> None:
    """Delete tables that ``materialise`` returned; others are left alone."""
    for df in stored:
        path = getattr(df, "_stored_at", None)
        if path:
            delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
