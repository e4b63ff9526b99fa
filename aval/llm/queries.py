"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aval.llm import bpe, chat_format, decontaminate, fill_in_middle, hard_negatives, language_id, mixing
from aval.llm import pii, quality_rules, simhash, substring_dedup, toxicity, warc
from aval.llm.words import remainder, word_count
from aval.session import materialise, shared_folder

PSEUDONYM_KEY_SETTING = "spark.aval.pseudonymKey"
DEVELOPMENT_KEY = "aval-development-key"


def pseudonym_key(spark: SparkSession) -> str:
    """The key that the session names; the one for development where it names none."""
    return spark.conf.get(PSEUDONYM_KEY_SETTING, None) or DEVELOPMENT_KEY


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialise(
        quality_rules.text_statistics(_read(spark, sf_dir, "documents"), ["doc_id"]), "text-statistics")
    rules = quality_rules.learn_rules(counts, _read(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & rules.verdict()).alias("kept"),
        rules.rule_number().alias("rule"))


def chat_format_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.sql(f"""
        SELECT -1L AS conv_id, turn, role, '{said}' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    template = chat_format.Template()
    segments = chat_format.format_conversations(rows.unionByName(added), template)
    return chat_format.read_back(segments, template)


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").withColumn(
        "held_out", remainder(F.col("doc_id"), 3) == 1)
    model = language_id.learn_languages(docs.where(~F.col("held_out")))
    return language_id.predict_languages(docs, model, ["doc_id", "held_out"])


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = materialise(
        simhash.fingerprints(_read(spark, sf_dir, "documents"), ["doc_id"]), "fingerprints")
    return simhash.near_duplicates(table).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    index = warc.write_archives(_read(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pseudonym_key(spark))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialise(
        _read(spark, sf_dir, "documents").select(
            "doc_id", "source", word_count(F.col("text")).alias("n_words")), "sizes")
    return mixing.mix_sources(sizes, F.col("n_words")).select(
        "doc_id", "size", "source_size", "target", "taken")


def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeated(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").withColumn(
        "held_out", remainder(F.col("doc_id"), 5) == 0)
    model = toxicity.learn_toxicity(
        docs, _read(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    return toxicity.score_toxicity(docs, model, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"),
        F.col("matches.item_id").alias("item_ids"), F.col("matches.distance").alias("distances"))


def fill_in_middle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = fill_in_middle.fim_pieces(_read(spark, sf_dir, "documents"), ["doc_id"])
    return fill_in_middle.digests(pieces)


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.clean_vectors(
        _read(spark, sf_dir, "embeddings"), F.col("vec_id"), label, F.col("embedding"))
    return hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def bpe_query(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode_texts(_read(spark, sf_dir, "documents"), path, ["doc_id"])
    return bpe.decode_ids(encoded, path, ["doc_id", "n_tokens", "ids"]).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {
    "op1_quality_rules": quality_rules_query,
    "op2_chat_format": chat_format_query,
    "op3_language_id": language_id_query,
    "op4_simhash": simhash_query,
    "op5_warc": warc_query,
    "op6_pii": pii_query,
    "op7_mixing": mixing_query,
    "op8_substring_dedup": substring_dedup_query,
    "op9_toxicity": toxicity_query,
    "op10_decontaminate": decontaminate_query,
    "op11_fill_in_middle": fill_in_middle_query,
    "op12_hard_negatives": hard_negatives_query,
    "op13_bpe": bpe_query,
}
