"""Documents through five stages of the operators in ``aval.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes every stage's
result as Parquet in the shared folder and hands the stored rows to the next. All stages but the last
return the columns of ``documents``. They accept empty tables, repeated rows and nulls in any
column as the operators define them; extra columns are carried along, whatever they are called:
the columns that a stage works with get names that are free. What a stage stored besides its result
is deleted once the result is written.

The pseudonyms' key is the session setting ``spark.aval.pseudonymKey``, for ``run`` also its argument;
the key written in the code serves development only, since it lets every reader undo the pseudonyms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aval.llm import decontaminate, mixing, pii, simhash, toxicity
from aval.llm.queries import PSEUDONYM_KEY_SETTING, pseudonym_key
from aval.llm.words import free_name, remainder, word_count
from aval.session import discard, gathered_tables, materialise

ORACLE_SQL = None  # learned scores, bit distances and keyed permutations have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; learned from the labels the toxicity query learns from."""
    model = toxicity.learn_toxicity(
        docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), remainder(F.col("doc_id"), 5) != 0)
    score = free_name(docs, "_toxicity")
    scored = toxicity.score_toxicity(docs, model, docs.columns, score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, that with the smallest id.

    Of the rows of a class that share this id, one stays. Each class without any id keeps one row
    of its own, and so does each of several classes whose smallest id is the same. Rows are
    numbered in the table that is stored with the fingerprints, so the numbers hold whatever
    executors are lost or added between its scans. What is kept is a bit per row, 64 to a row of the
    table to join, so that it stays small enough to broadcast and the texts need no shuffle.
    """
    row, fp = free_name(docs, "_row"), free_name(docs, "_fp")
    word, bits = free_name(docs, "_word"), free_name(docs, "_bits")
    marked = docs.withColumn(row, F.monotonically_increasing_id())
    table = materialise(simhash.fingerprints(marked, marked.columns, result=fp), "fingerprints")
    classes = simhash.near_duplicates(
        table.select("doc_id", F.col(row).alias("_row"), F.col(fp).alias("fp")), root="_class")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    grouped = classes.groupBy("_class").agg(best.alias("_best"))
    number = F.col("_best._row")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))
    kept = materialise(
        grouped.groupBy(F.shiftright(number, 6).alias(word)).agg(F.bit_or(bit).alias(bits)), "kept")
    return (
        table.withColumn(word, F.shiftright(row, 6)).join(kept, word)
        .where(F.getbit(bits, F.col(row).bitwiseAND(63).cast("int")) == 1).select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item within its error budget."""
    matches = free_name(docs, "_matches")
    found = decontaminate.find_items(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), docs.columns, result=matches)
    return found.where(F.size(matches) == 0).select(*docs.columns)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal values replaced by pseudonyms of the same format.

    ``n_chars`` follows the text, since addresses may change their length.
    """
    changed = pii.pseudonymise(docs, pseudonym_key(spark))
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words of, with ``size``, ``source_size``, ``target`` and ``taken``."""
    return mixing.mix_sources(docs, word_count(F.col("text"))).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str, key: str | None = None) -> DataFrame:
    """All stages over ``documents``; ``key`` takes the place of the session's for this run."""
    before = spark.conf.get(PSEUDONYM_KEY_SETTING, None)
    if key is not None:
        spark.conf.set(PSEUDONYM_KEY_SETTING, key)
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    try:
        for number, (_, stage) in enumerate(STAGES, 1):
            with gathered_tables() as made:
                docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
            discard(*stored, *(table for table in made if table is not docs))
            stored = [docs]
    finally:
        if key is not None and before is None:
            spark.conf.unset(PSEUDONYM_KEY_SETTING)
        elif key is not None:
            spark.conf.set(PSEUDONYM_KEY_SETTING, before)
    return docs
