"""Applicant sources derived from the star-schema test tables.

The tables are clean, so the dirt that the pipeline must cope with is a function of the keys:
copies, missing and malformed values, clients known to one source only, missing ids. Every
row of the tables is used; a row is relabelled rather than left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aval import config as c


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, some of them twice, with an explicit ingest sequence."""
    key, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = table(spark, sf_dir, "customer").withColumn("copy", F.explode(copies))
    copy = F.col("copy")
    income = F.when(balance >= 0, balance)
    return rows.select(
        (key * 2 + copy).alias(c.SEQ),
        F.when(key % 499 != 0, _text("CLI-", key)).alias(c.ID),
        F.when(key % 17 == 0, "ND").otherwise((key % 80).cast("string")).alias(c.AGE),
        F.when((copy == 1) & (key % 100 == 0), income + 1).otherwise(income).alias(c.INCOME),
        F.when(key % 19 != 0, (key % 41).cast("double")).alias(c.SENIORITY),
        F.when(segment == "HOUSEHOLD", " Propia ").when(segment == "BUILDING", "PROPIA")
        .otherwise(F.lower(segment)).alias(c.HOUSING),
    )


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, some of them twice; some ids are unknown to the profile or missing."""
    order, client = F.col("o_orderkey"), F.col("o_custkey")
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    copies = F.when(order % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "orders").withColumn("copy", F.explode(copies)).select(
        F.when(order % 97 == 0, None).when(client % 10 == 0, _text("SUC-", client))
        .otherwise(_text("CLI-", client)).alias(c.ID),
        F.when(order % 29 != 0, price).alias(c.AMOUNT),
        F.when(priority == "5-LOW", " usd ").when(priority == "4-NOT SPECIFIED", None)
        .otherwise("MXN").alias(c.CURRENCY),
        F.when(order % 23 != 0, price / 10).alias(c.BALANCE),
        (order % 9).cast("double").alias(c.FREQUENCY),
    )


def raw_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; some ids are unknown to the profile or missing."""
    key = F.col("c_custkey")
    answers = ["SI", " no ", "Sí", "NO", "no"]
    answer = F.lit(None).cast("string")
    for i, text in enumerate(answers):
        answer = F.when(key % 6 == i, text).otherwise(answer)
    return table(spark, sf_dir, "customer").select(
        key.alias(c.SEQ),
        F.when(key % 503 == 0, None).when(key % 11 == 0, _text("EXT-", key))
        .when(key % 2 == 0, _text("CLIENTE_", key)).otherwise(_text("Cliente_", key)).alias(c.ID),
        (F.lit(400) + (key * 37) % 451).cast("double").alias(c.SCORE),
        (key % 7).cast("double").alias(c.CREDITS),
        answer.alias(c.DELINQUENCY),
    )


def raw_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_profile(spark, sf_dir), raw_history(spark, sf_dir), raw_bureau(spark, sf_dir)


def document_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: numeric and text inputs, some missing, one constant."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.alias(c.ID),
        F.when(doc % 13 != 0, F.col("n_chars").cast("double")).alias("n_chars"),
        F.when(doc % 7 != 0, F.col("lang")).alias("lang"),
        F.col("source"),
        F.lit("es-MX").alias("region"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a quality label: what a preparation can be learned from."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias(c.ID), "toxic", F.col("quality").alias(c.TARGET))
    return document_inputs(spark, sf_dir).join(labels, c.ID)


def applicant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested applicant per order, some sections and ids absent."""
    order, price = F.col("o_orderkey"), F.col("o_totalprice")
    movement = F.struct(
        price.alias(c.AMOUNT),
        F.when(F.col("o_orderpriority") == "5-LOW", "USD").otherwise("MXN").alias(c.CURRENCY),
        (price / 10).alias(c.BALANCE), (order % 9).alias(c.FREQUENCY),
    )
    return table(spark, sf_dir, "orders").select(
        order.alias(c.SEQ),
        F.when(order % 5 != 0, _text("SOL-", order)).alias(c.ID),
        F.when(order % 8 != 0, F.struct(
            (order % 80).alias(c.AGE), price.alias(c.INCOME),
            F.when(order % 3 != 0, order % 41).alias(c.SENIORITY),
            F.when(order % 2 == 0, "Propia").otherwise("Rentada").alias(c.HOUSING),
        )).alias("perfil"),
        F.when(order % 4 == 0, F.array().cast(f"array<{_MOVEMENT}>"))
        .when(order % 4 == 1, F.array(movement)).otherwise(F.array(movement, movement))
        .alias("historial"),
        F.when(order % 6 != 0, F.struct(
            (F.lit(400) + (order * 37) % 451).alias(c.SCORE), (order % 7).alias(c.CREDITS),
            F.when(order % 5 == 1, "SI").otherwise("NO").alias(c.DELINQUENCY),
        )).alias("buro"),
    )


def applicant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same applicants as JSON texts."""
    document = F.to_json(F.struct(c.ID, "perfil", "historial", "buro"))
    return applicant_records(spark, sf_dir).select(c.SEQ, document.alias("documento"))


_MOVEMENT = (
    f"struct<{c.AMOUNT}:double,{c.CURRENCY}:string,{c.BALANCE}:double,{c.FREQUENCY}:bigint>"
)
