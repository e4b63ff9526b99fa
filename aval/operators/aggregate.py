"""One row per client, and the descriptive aggregates over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import PreparationError
from aval.functions.values import col, is_numeric, nan_to_null, without_nan
from aval.operators.cleaning import drop_identical, first_identical
from aval.operators.target import profile_conditions


def _first_present(name: str, order: str | None) -> Column:
    """First non-missing value. Values repeated on all rows of a client need no order."""
    if order is None:
        return F.max(col(name))
    return F.min_by(col(name), F.when(col(name).isNotNull(), F.col(order)))


#: What a history column becomes in the client's row; any other column keeps its first value.
#: The names of the results.
SUMMARIES = {
    c.CURRENCY: {},
    c.AMOUNT: {c.TOTAL_AMOUNT: F.sum},
    c.BALANCE: {c.BALANCE: F.avg},
    c.FREQUENCY: {c.MAX_FREQUENCY: F.max, c.N_TRANSACTIONS: F.count},
}


def _summaries(names: list[str], order: str | None) -> list[Column]:
    """The aggregates of the columns, in their order."""
    made = []
    for name in names:
        known = SUMMARIES.get(name)
        made += ([_first_present(name, order).alias(name)] if known is None else
                 [how(col(name)).alias(result) for result, how in known.items()])
    return made


def aggregate_by_client(df: DataFrame, order: str | None = None) -> DataFrame:
    """Summarise the combined table to one row per client; rows without an id are dropped.

    ``SUMMARIES`` says what becomes of the history. Other columns take their first non-missing
    value by ``order``; without one they are taken as constant within the client, which holds
    after the merge.
    """
    if c.ID not in df.columns:
        raise PreparationError(f"cannot summarise by client: column {c.ID} is absent")
    df = nan_to_null(df)
    summary = _summaries([n for n in df.columns if n not in (c.ID, order)], order)
    return df.filter(col(c.ID).isNotNull()).groupBy(col(c.ID)).agg(*summary)


def _stacked(profile: DataFrame, history: DataFrame, bureau: DataFrame) -> DataFrame:
    """Rows of the three sources with an id, one under another; absent columns are NULL."""
    present = col(c.ID).isNotNull()
    return (
        profile.filter(present).withColumnRenamed(c.SEQ, "_profile")
        .unionByName(
            bureau.filter(present).withColumnRenamed(c.SEQ, "_bureau"), allowMissingColumns=True
        )
        .unionByName(
            history.filter(present).withColumnRenamed(c.SEQ, "_history"), allowMissingColumns=True
        )
    )


def _own_columns(df: DataFrame) -> list[str]:
    return [n for n in df.columns if n not in (c.ID, c.SEQ)]


def _first_rows(profile: list[str], bureau: list[str]) -> list[Column]:
    """First profile and bureau row of a client: min_by skips rows whose order is missing,
    which are the rows of the other sources."""
    return [
        F.min_by(col(n), F.col(order)).alias(n)
        for order, names in (("_profile", profile), ("_bureau", bureau)) for n in names
    ]


def _approved(rule: c.ApprovalRule) -> Column:
    met = profile_conditions(col(c.AGE), col(c.SCORE), col(c.DELINQUENCY), rule)
    return (met & F.coalesce(col(c.MAX_FREQUENCY) > 0, F.lit(False))).cast("int")


def client_table(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                 rule: c.ApprovalRule | None = None) -> DataFrame:
    """The labelled per-client table straight from normalised sources, in two shuffles.

    Merging, labelling and summarising give the same rows through five shuffles. Here the
    history is de-duplicated, the three sources are stacked, and one aggregation on the id
    (with map-side combine) does the rest: first profile and bureau row of each client by
    ``_seq``, history totals, and the rule. Columns beyond the contract keep their first
    non-missing value by ``_seq``, which the history must have then.
    """
    about, credit = _own_columns(profile), _own_columns(bureau)
    extra = [n for n in _own_columns(history) if n not in c.HISTORY_COLUMNS]
    distinct = first_identical(history) if extra else drop_identical(history)
    transactions = distinct.drop(c.CURRENCY)
    per_client = _stacked(profile, transactions, bureau).groupBy(col(c.ID)).agg(
        *_first_rows(about, credit),
        *_summaries([c.AMOUNT, c.BALANCE, c.FREQUENCY, *extra], "_history"),
    )
    return per_client.withColumn(c.TARGET, _approved(rule or c.ApprovalRule())).select(
        *[col(n) for n in [c.ID, *about, c.TOTAL_AMOUNT, c.BALANCE, c.MAX_FREQUENCY,
                           c.N_TRANSACTIONS, *extra, *credit, c.TARGET]]
    )


def client_outcomes(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                    rule: c.ApprovalRule | None = None) -> DataFrame:
    """Only ``(id, label)`` per client from normalised sources, in one shuffle.

    The rule reads the history's largest frequency, which repeated rows do not change, so the
    history is neither de-duplicated nor read beyond two columns.
    """
    about, credit = (c.AGE,), (c.SCORE, c.DELINQUENCY)
    stacked = _stacked(
        profile.select(col(c.ID), c.SEQ, *about), history.select(col(c.ID), col(c.FREQUENCY)),
        bureau.select(col(c.ID), c.SEQ, *credit),
    )
    per_client = stacked.groupBy(col(c.ID)).agg(
        *_first_rows(about, credit), F.max(col(c.FREQUENCY)).alias(c.MAX_FREQUENCY)
    )
    return per_client.select(col(c.ID), _approved(rule or c.ApprovalRule()).alias(c.TARGET))


def count_clients(df: DataFrame) -> DataFrame:
    """Distinct non-missing ids."""
    return df.agg(F.count_distinct(col(c.ID)).alias("clientes"))


def class_distribution(per_client: DataFrame,
                       thresholds: c.ChartThresholds | None = None) -> DataFrame:
    """Clients per class with share, minority share and whether the classes are unbalanced."""
    thresholds = thresholds or c.ChartThresholds()
    label = col(c.TARGET)
    counts = per_client.agg(
        F.count_if(label == 0).alias("no"), F.count_if(label == 1).alias("si")
    )
    total = F.col("no") + F.col("si")
    minority = F.try_divide(F.least("no", "si"), total)
    # The class names shown in the report.
    classes = [(0, "No aprobado", F.col("no")), (1, "Aprobado", F.col("si"))]
    return counts.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(code).alias("codigo"), F.lit(name).alias("clase"),
                n.alias("clientes"), F.try_divide(n, total).alias("proporcion"),
            ) for code, name, n in classes
        ])),
        minority.alias("proporcion_minoritaria"),
        (minority < thresholds.imbalance).alias("desbalanceada"),
    )


def housing_counts(profile: DataFrame) -> DataFrame:
    """Applicants per housing type, labelled."""
    # The labels shown in the report.
    label = F.when(col(c.HOUSING) == 1, "Vivienda propia").when(
        col(c.HOUSING) == 0, "Otro tipo de vivienda"
    )
    return (
        profile.select(label.alias("tipo")).filter(F.col("tipo").isNotNull())
        .groupBy("tipo").agg(F.count(F.lit(1)).alias("solicitantes"))
    )


def column_facts(df: DataFrame, names: list[str]) -> dict[str, tuple[int, bool]]:
    """``(non-missing values, whether two of them differ)`` per column, in one aggregation.

    Minimum below maximum answers the second without counting distinct values.
    """
    if not names:
        return {}
    clean = [without_nan(col(n), df.schema[n].dataType) for n in names]
    measures = []
    for i, value in enumerate(clean):
        measures += [F.count(value).alias(f"n{i}"), (F.min(value) < F.max(value)).alias(f"v{i}")]
    row = df.agg(*measures).first()
    return {n: (row[f"n{i}"], bool(row[f"v{i}"])) for i, n in enumerate(names)}


def varying_columns(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """Split ``names`` into ``(varying, constant)``; constant means at most one distinct value."""
    facts = column_facts(df, names)
    varying = [n for n in names if facts[n][1]]
    return varying, [n for n in names if not facts[n][1]]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = (c.ID,)) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType) and f.name not in exclude]


def _pairwise(df: DataFrame, lefts: list[str], rights: list[str], upper: bool) -> DataFrame:
    """Long ``(variable_1, variable_2, r)`` for every left with every right column, in one scan of the data.

    A pair counts the rows where both are present. Per Arrow batch numpy multiplies the matrices of values, of
    squares and of presence; a task returns one row of sums per left column, whatever its rows. The sums
    of tasks are added in two steps, so no reducer reads more than about the square root of their number for
    a column. Values are centred at the columns' means, which keeps the sums small. ``upper`` keeps pairs
    whose right column stands behind the left one. A pair that is constant on its shared rows (its variance under
    1e-12 of its mean square) has no correlation (NULL).
    """
    names = list(dict.fromkeys([*lefts, *rights]))
    values = df.select(*[
        without_nan(col(n).cast("double"), df.schema[n].dataType).alias(n) for n in names])
    means = values.agg(*[F.avg(col(n)).alias(n) for n in names]).first()
    centre = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    left, right = [names.index(n) for n in lefts], [names.index(n) for n in rights]

    sums = values.mapInArrow(_masked_products(centre, left, right), _SUMS)
    grouped = sums.withColumn("task", F.col("task") % _ADDERS).repartition("i", "task")
    grouped = grouped.sortWithinPartitions("i", "task").mapInArrow(_added, _SUMS)
    measured = grouped.repartition("i").sortWithinPartitions("i").mapInArrow(
        _correlations, "i int, j int, r double")
    labels = df.sparkSession.createDataFrame(list(enumerate(names)), "n int, name string")
    places = {"i": left, "j": right}
    for key, title in (("i", "variable_1"), ("j", "variable_2")):
        place = df.sparkSession.createDataFrame(list(enumerate(places[key])), f"{key} int, n int")
        # One row per column of the input.
        measured = measured.join(F.broadcast(place.join(labels, "n").select(
            key, F.col("n").alias(f"{key}_n"), F.col("name").alias(title))), key)
    kept = measured.where("j_n > i_n") if upper else measured
    return kept.select("variable_1", "variable_2", "r")


_SUMS = "i int, task long, sums array<double>"
_ADDERS = 64  # groups of tasks whose sums are added first
_CELLS = 1 << 20  # values of a batch multiplied together


def _masked_products(centre: np.ndarray, left: list[int], right: list[int]):
    """Per left column: counts, sums of either side, sums of squares of either, sums of products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((6, len(left), len(right)))
        step = max(1, _CELLS // len(centre))
        for whole in batches:
            for first in range(0, len(whole), step):
                batch = whole.slice(first, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                there = ~np.isnan(x)
                x = np.where(there, x - centre, 0.0)
                a, b, p, q = x[:, left], x[:, right], there[:, left] * 1.0, there[:, right] * 1.0
                totals += np.stack([p.T @ q, a.T @ q, p.T @ b, (a * a).T @ q, p.T @ (b * b), a.T @ b])
        task = TaskContext.get().partitionId()
        rows = totals.transpose(1, 0, 2).reshape(len(left), -1)
        for i, row in enumerate(rows):
            yield _sum_row(i, task, row)

    return run


def _sum_row(i: int, task: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i], pa.int32()), pa.array([task], pa.int64()),
         pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums))], ["i", "task", "sums"])


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    for batch in batches:
        for i, task, sums in zip(batch.column("i").to_pylist(), batch.column("task").to_pylist(),
                                 batch.column("sums")):
            yield (i, task), sums.values.to_numpy()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that follow each other with the same keys as one."""
    key, total = None, None
    for found, sums in _sum_rows(batches):
        if found == key:
            total = total + sums
            continue
        if key is not None:
            yield _sum_row(*key, total)
        key, total = found, sums
    if key is not None:
        yield _sum_row(*key, total)


def _correlations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Up to ``_ADDERS`` rows of a column follow each other.
    column, total = None, None
    for (i, _), sums in _sum_rows(batches):
        if column is not None and i != column:
            yield _correlation_rows(column, total)
            total = None
        column, total = i, sums if total is None else total + sums
    if column is not None:
        yield _correlation_rows(column, total)


def _correlation_rows(i: int, sums: np.ndarray) -> pa.RecordBatch:
    n, a, b, aa, bb, ab = sums.reshape(6, -1)
    with np.errstate(all="ignore"):
        spread_a, spread_b = aa / n - (a / n) ** 2, bb / n - (b / n) ** 2
        r = (ab / n - (a / n) * (b / n)) / np.sqrt(spread_a * spread_b)
        known = (n > 0) & (spread_a > 1e-12 * (aa / n)) & (spread_b > 1e-12 * (bb / n))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(n), i), pa.int32()), pa.array(np.arange(len(n)), pa.int32()),
         pa.array(r, mask=~known)], ["i", "j", "r"])


def correlation_matrix(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of varying numeric columns, pairwise complete.

    Only one triangle is computed; the other and the diagonal follow from it.
    """
    varying, _ = varying_columns(df, names or numeric_columns(df))
    if not varying:
        raise PreparationError("no numeric column varies: there is nothing to correlate")
    diagonal = df.sparkSession.createDataFrame(
        [(n, n, 1.0) for n in varying], "variable_1 string, variable_2 string, r double"
    )
    if len(varying) < 2:
        return diagonal
    upper = _pairwise(df, varying, varying, upper=True)
    both = upper.select(F.inline(F.array(
        F.struct("variable_1", "variable_2", "r"),
        F.struct(F.col("variable_2").alias("variable_1"),
                 F.col("variable_1").alias("variable_2"), "r"),
    )))
    return both.unionByName(diagonal)


def uncorrelated_columns(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The numeric columns that the correlations leave out, because they do not vary."""
    _, constant = varying_columns(df, names or numeric_columns(df))
    return df.sparkSession.createDataFrame([(n,) for n in constant], "variable string")


def correlation_with_target(df: DataFrame, target: str = c.TARGET,
                            thresholds: c.ChartThresholds | None = None) -> DataFrame:
    """Correlation of each varying column with the target, with sign and strength flags."""
    thresholds = thresholds or c.ChartThresholds()
    varying, _ = varying_columns(df, numeric_columns(df))
    others = [n for n in varying if n != target]
    if target not in varying or not others:
        raise PreparationError("the target does not vary, or no other column does")
    size = F.abs(F.col("r"))
    return (
        _pairwise(df, others, [target], upper=False)
        .filter(F.col("r").isNotNull())
        .select(
            F.col("variable_1").alias("variable"), "r",
            (F.col("r") > 0).alias("positiva"),
            (size >= thresholds.moderate_correlation).alias("moderada"),
            (size < thresholds.weak_correlation).alias("nula"),
        )
    )


def correlation_extremes(correlations: DataFrame) -> DataFrame:
    """The most positive and the most negative variable, and how many are moderate or null."""
    return correlations.agg(
        F.max_by("variable", "r").alias("mas_positiva"), F.max("r").alias("r_maxima"),
        F.min_by("variable", "r").alias("mas_negativa"), F.min("r").alias("r_minima"),
        F.count_if("moderada").alias("moderadas"), F.count_if("nula").alias("nulas"),
        F.count(F.lit(1)).alias("variables"),
    )


def top_correlations(correlations: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` variables most correlated with the target, by magnitude."""
    return correlations.orderBy(F.abs(F.col("r")).desc(), "variable").limit(n)
