"""The business rule that labels clients, and why a client fails it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import RuleColumnsError
from aval.functions.values import col, tolerant_number


def _require(df: DataFrame, names: tuple[str, ...]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise RuleColumnsError(f"columns needed by the approval rule are absent: {', '.join(absent)}")


def profile_conditions(age: Column, score: Column, delinquency: Column,
                       rule: c.ApprovalRule) -> Column:
    """The three conditions on one row; missing values never satisfy them."""
    met = (
        age.between(rule.min_age, rule.max_age)
        & (score > rule.score_above)
        & (delinquency == 0)
    )
    return F.coalesce(met, F.lit(False))


def client_labels(df: DataFrame, rule: c.ApprovalRule | None = None) -> DataFrame:
    """``(id, label)`` per client: every row meets the conditions and some row has deposits."""
    rule = rule or c.ApprovalRule()
    _require(df, c.RULE_COLUMNS)
    met = profile_conditions(
        tolerant_number(df, c.AGE), tolerant_number(df, c.SCORE),
        tolerant_number(df, c.DELINQUENCY), rule,
    )
    deposits = F.coalesce(tolerant_number(df, c.FREQUENCY) > 0, F.lit(False))
    return (
        df.filter(col(c.ID).isNotNull())
        .groupBy(col(c.ID))
        .agg(F.bool_and(met).alias("_all"), F.bool_or(deposits).alias("_any"))
        .select(col(c.ID), (F.col("_all") & F.col("_any")).cast("int").alias(c.TARGET))
    )


def label_approval(df: DataFrame, rule: c.ApprovalRule | None = None) -> DataFrame:
    """Label every row with its client's outcome; rows without an id get 0.

    The decision is an aggregate with map-side combine, joined back on the id. A window over
    the id would hold all rows of a heavy client in one task; the join can be split by AQE.
    """
    labels = client_labels(df, rule)
    rows = df.drop(c.TARGET).join(labels, c.ID, "left")
    order = [n for n in df.columns if n != c.TARGET] + [c.TARGET]
    return rows.withColumn(c.TARGET, F.coalesce(col(c.TARGET), F.lit(0))).select(
        *[col(n) for n in order]
    )


def approval_summary(df: DataFrame) -> DataFrame:
    """Distinct clients per class, with both classes always present."""
    _require(df, (c.ID, c.TARGET))
    # A missing id counts as one client, as it does when rows are de-duplicated by id.
    per_client = df.groupBy(col(c.ID)).agg(F.max(col(c.TARGET)).alias("clase"))
    both = df.sparkSession.range(2).select(F.col("id").cast("int").alias("clase"))
    counts = per_client.groupBy("clase").agg(F.count(F.lit(1)).alias("clientes"))
    return both.join(counts, "clase", "left").select(
        "clase", F.coalesce("clientes", F.lit(0)).alias("clientes")
    )


def rejection_reasons(df: DataFrame, rule: c.ApprovalRule | None = None) -> DataFrame:
    """Add ``motivos``: the conditions each client fails, in rule order; empty when approved."""
    rule = rule or c.ApprovalRule()
    age, score = tolerant_number(df, c.AGE), tolerant_number(df, c.SCORE)
    late, deposits = tolerant_number(df, c.DELINQUENCY), tolerant_number(df, c.MAX_FREQUENCY)
    # The wording of each reason.
    reasons = [
        (age.between(rule.min_age, rule.max_age),
         f"edad fuera de {rule.min_age:g}-{rule.max_age:g} o no válida"),
        (score > rule.score_above, f"score de buró no mayor a {rule.score_above:g} o faltante"),
        (late == 0, "tiene morosidad previa"),
        (deposits > 0, "sin depósitos registrados"),
    ]
    return df.withColumn(
        "motivos",
        F.array_compact(
            F.array(*[
                F.when(~F.coalesce(met, F.lit(False)), F.lit(text)) for met, text in reasons
            ])
        ),
    )
