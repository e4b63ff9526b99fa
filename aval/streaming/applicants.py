"""Scoring applicant documents as files arrive.

A document carries its whole history, so scoring it is stateless: no shuffle, watermark or
state store. The stream runs the very projection that the batch runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aval import config as c
from aval.plans.scoring import Scorer
from aval.sources.applicants import APPLICANT_SCHEMA
from aval.sources.files import CORRUPT, parsed_lines


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """Documents, one per line, from files that appear under ``path``.

    Lines that are no document, and documents without an id, are left to ``read_rejected``.
    """
    rows = _lines(spark, path, files_per_batch)
    return rows.filter(~_rejected()).drop(CORRUPT)


def read_rejected(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """The text (``linea``) of the lines that ``read_stream`` leaves out, as a stream."""
    rows = _lines(spark, path, files_per_batch).filter(_rejected())
    whole = F.to_json(F.struct(*APPLICANT_SCHEMA.names))
    return rows.select(F.coalesce(F.col(CORRUPT), whole).alias("linea"))


def _rejected() -> Column:
    return F.col(CORRUPT).isNotNull() | F.col(c.ID).isNull()


def _lines(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return parsed_lines(lines, APPLICANT_SCHEMA)


def score_stream(scorer: Scorer, docs: DataFrame, out: str, checkpoint: str,
                 once: bool = True) -> StreamingQuery:
    """Append scored documents to Parquet at ``out``; ``once`` stops after what is there."""
    writer = (
        scorer.score_documents(docs).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start(out)
