"""Queries the driver runs, each over its whole tables, and the SQL that checks them.

``queries()`` maps a name to a function of ``(spark, sf_dir)``; ``oracle_sql()`` gives the
DuckDB statement with the same result wherever one can be written. Queries that fit models
have no SQL form; their tests are in ``tests/``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow as pa  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from aval import config as c  # noqa: E402
from aval.functions.statistics import exact_medians, modes, value_counts  # noqa: E402
from aval.functions.values import (  # noqa: E402
    col,
    display_missing,
    normalise_null_tokens,
    tolerant_number,
)
from aval.operators import aggregate as ag  # noqa: E402
from aval.operators import cleaning as cl  # noqa: E402
from aval.operators import features as ft  # noqa: E402
from aval.operators import merge as mg  # noqa: E402
from aval.operators import metrics as mt  # noqa: E402
from aval.operators import quality as q  # noqa: E402
from aval.operators import segments as sg  # noqa: E402
from aval.operators import split as sp  # noqa: E402
from aval.operators import target as tg  # noqa: E402
from aval.operators.folds import fit_features_by_fold  # noqa: E402
from aval.operators.models import fit_classifiers, importances, logistic_regression, top_importances  # noqa: E402
from aval.operators.sparse import fit_sparse_features  # noqa: E402
from aval.plans import pipeline as pl  # noqa: E402
from aval.plans import report as rp  # noqa: E402
from aval.plans.scoring import Scorer, document_clients  # noqa: E402
from aval.session import materialise, shared_folder  # noqa: E402
from aval.sources import derived as dv  # noqa: E402
from aval.sources.applicants import (  # noqa: E402
    APPLICANT_SCHEMA,
    flatten_applicants,
    read_applicants,
    with_default_ids,
)
from aval.sources.derived import table  # noqa: E402
from aval.sources.files import load_source, write_table  # noqa: E402
from aval.sources.order import numbered  # noqa: E402
from oracle_queries import FIXED_INTERCEPT, FIXED_WEIGHTS, statements  # noqa: E402

try:  # the text operators may be left out of an installation
    import corpus_pipeline
    from aval.llm.oracle import ORACLES
    from aval.llm.queries import QUERIES
except ImportError:  # also where a library that only they need is missing
    corpus_pipeline, ORACLES, QUERIES = None, {}, {}

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

_RAW = {
    "profile": (c.PROFILE_SOURCE, dv.raw_profile, cl.clean_profile),
    "history": (c.HISTORY_SOURCE, dv.raw_history, cl.clean_history),
    "bureau": (c.BUREAU_SOURCE, dv.raw_bureau, cl.clean_bureau),
}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _REGISTRY[name] = function
        return function

    return register


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({n: F.round(col(n), d) for n, d in digits.items()})


def _all_rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return _rounded(df, {n: digits for n, t in df.dtypes if t == "double"})


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled per-client rows; queries that read them several times write them once."""
    return pl.client_rows(*dv.raw_sources(spark, sf_dir))


def _stored_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(_clients(spark, sf_dir), "clients")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.combined_table(*dv.raw_sources(spark, sf_dir))


# --- Flagship ------------------------------------------------------------------------------


@_query("approval_summary")
def approval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.approval_summary(pl.client_labels(*dv.raw_sources(spark, sf_dir)))


# --- Cleaning and quality ------------------------------------------------------------------


def _register_source(short: str) -> None:
    source, raw, clean = _RAW[short]

    @_query(f"clean_{short}")
    def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
        money = {c.AMOUNT: 4, c.BALANCE: 4} if short == "history" else {}
        return _rounded(clean(raw(spark, sf_dir)), money)

    @_query(f"quality_report_{short}")
    def report(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = q.quality_report(raw(spark, sf_dir), source).indicators().drop("orden")
        return found.filter(F.col("valor").isNotNull())

    @_query(f"quality_compare_{short}")
    def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.compare_quality(*_reports(short, spark, sf_dir)).drop("orden").withColumnRenamed(
            "después", "despues")


def _reports(short: str, spark: SparkSession, sf_dir: str) -> tuple:
    source, raw, clean = _RAW[short]
    df = raw(spark, sf_dir)
    return q.quality_report(df, source), q.quality_report(clean(df), source)


for _short in _RAW:
    _register_source(_short)


@_query("quality_by_column")
def quality_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.quality_report(dv.raw_profile(spark, sf_dir), c.PROFILE_SOURCE).by_column().drop("tipo")


def _changed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile without one column of the contract and with one beyond it."""
    return dv.raw_profile(spark, sf_dir).drop(c.SENIORITY).withColumn("Canal", F.lit(7))


@_query("quality_structure")
def quality_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = q.quality_report(_changed_profile(spark, sf_dir), c.PROFILE_SOURCE)
    return report.frame.select(
        "rows", "duplicates", F.array_join("missing_columns", "; ").alias("faltan"),
        F.array_join("extra_columns", "; ").alias("sobran"), "valid_structure")


@_query("quality_column_types")
def quality_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.quality_report(_changed_profile(spark, sf_dir), c.PROFILE_SOURCE).by_column()


@_query("quality_missing_by_stage")
def quality_missing_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.missing_by_stage(*_reports("profile", spark, sf_dir))


@_query("quality_problems_by_stage")
def quality_problems_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.problems_by_stage(*_reports("profile", spark, sf_dir))


@_query("quality_totals")
def quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.quality_totals(*_reports("profile", spark, sf_dir))


@_query("null_tokens")
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 7
    text = (
        F.when(kind == 0, "").when(kind == 1, "N/A").when(kind == 2, "nan").when(kind == 3, "ND")
        .when(kind == 4, "None").otherwise(F.col("p_name"))
    )
    return normalise_null_tokens(table(spark, sf_dir, "part").select("p_partkey", text.alias("texto")))


@_query("tolerant_number")
def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = F.col("p_partkey") % 9, F.col("p_size").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == 1, F.concat(size, F.lit("e2"))).when(kind == 2, F.concat(size, F.lit("d")))
        .when(kind == 3, F.concat(size, F.lit("_000"))).when(kind == 4, "").when(kind == 5, "inf")
        .when(kind == 6, F.concat(F.lit("-"), size, F.lit(".")))
        .when(kind == 7, F.concat(F.lit("."), size)).otherwise(F.col("p_name"))
    )
    texts = table(spark, sf_dir, "part").select("p_partkey", text.alias("t"))
    return texts.select("p_partkey", tolerant_number(texts, "t").alias("numero"))


@_query("display_missing")
def shown_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cl.clean_profile(dv.raw_profile(spark, sf_dir))
    return display_missing(clean.select(
        c.ID, col(c.AGE).cast("int").alias(c.AGE), col(c.SENIORITY).cast("int").alias(c.SENIORITY),
        c.HOUSING))


@_query("keep_first_lineitem")
def keep_first_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity").alias(c.SEQ))
    return cl.keep_first(rows, ["l_orderkey", "l_linenumber"])


@_query("keep_first_event")
def keep_first_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", F.col("event_id").alias(c.SEQ))
    return cl.keep_first(rows, ["user_id"])


@_query("distinct_documents")
def distinct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.drop_identical(table(spark, sf_dir, "documents").select("text", "lang", "source"))


# --- Joins, rule, aggregation --------------------------------------------------------------


@_query("merge_sources")
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_merged(spark, sf_dir), {c.AMOUNT: 2, c.BALANCE: 4})


@_query("approval_label")
def approval_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tg.label_approval(_merged(spark, sf_dir)), {c.AMOUNT: 2, c.BALANCE: 4})


@_query("labelled_table")
def labelled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = pl.labelled_table(*dv.raw_sources(spark, sf_dir))
    return _rounded(labelled, {c.AMOUNT: 2, c.BALANCE: 4})


@_query("score_vs_income")
def score_vs_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mg.score_vs_income(
        cl.clean_bureau(dv.raw_bureau(spark, sf_dir)), cl.clean_profile(dv.raw_profile(spark, sf_dir)))


@_query("credits_vs_score")
def credits_vs_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = cl.clean_profile(dv.raw_profile(spark, sf_dir))
    return rp.scatter_tables(profile, cl.clean_bureau(dv.raw_bureau(spark, sf_dir)))[
        "creditos_vs_score"]


@_query("rejection_reasons")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tg.rejection_reasons(_clients(spark, sf_dir)).select(
        c.ID, F.array_join("motivos", "; ").alias("motivos"))


def _client_values(df: DataFrame) -> DataFrame:
    """Totals to the cent, averages to the sixth decimal. Averages of few decimals fall on exact
    rounding ties, where the order of summation would show, so both sides add a little that moves
    them off (for values of four decimals all but those of a multiple of 10 000 rows)."""
    off_ties = df.withColumn(c.BALANCE, F.col(c.BALANCE) + 3e-8)
    return _rounded(off_ties, {c.TOTAL_AMOUNT: 2, c.BALANCE: 6})


@_query("aggregate_by_client")
def aggregate_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _client_values(pl.client_rows_from_combined(_merged(spark, sf_dir)))


def _history_with_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history with a column beyond the contract that varies within a client."""
    price = F.floor(F.coalesce(c.AMOUNT, F.lit(0)) * 100).cast("long")
    return dv.raw_history(spark, sf_dir).withColumns({
        c.SEQ: price * 10 + F.col(c.FREQUENCY).cast("long"),
        "Canal": F.when(price % 3 != 0, F.concat(F.lit("canal-"), (price % 7).cast("string"))),
    })


@_query("first_channel")
def first_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-missing value of an extra history column, by the short way."""
    sources = dv.raw_profile(spark, sf_dir), _history_with_channel(spark, sf_dir), dv.raw_bureau(
        spark, sf_dir)
    return pl.client_rows(*sources).select(c.ID, "Canal")


@_query("first_channel_from_combined")
def first_channel_from_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the merged table."""
    sources = dv.raw_profile(spark, sf_dir), _history_with_channel(spark, sf_dir), dv.raw_bureau(
        spark, sf_dir)
    combined = pl.combined_table(*sources, keep_sequence=True)
    return pl.client_rows_from_combined(combined).select(c.ID, "Canal")


@_query("client_table")
def client_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _client_values(_clients(spark, sf_dir))


@_query("aggregate_events")
def aggregate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias(c.ID), F.col("value").alias(c.AMOUNT), "event_type",
        F.col("event_id").alias(c.SEQ))
    return _rounded(ag.aggregate_by_client(events, order=c.SEQ), {c.TOTAL_AMOUNT: 2})


@_query("count_clients")
def count_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.count_clients(_merged(spark, sf_dir))


@_query("class_distribution")
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(ag.class_distribution(_clients(spark, sf_dir)))


@_query("housing_counts")
def housing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.housing_counts(cl.clean_profile(dv.raw_profile(spark, sf_dir)))


@_query("correlation_matrix")
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(ag.correlation_matrix(_stored_clients(spark, sf_dir)))


@_query("correlation_lineitem")
def correlation_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _all_rounded(ag.correlation_matrix(table(spark, sf_dir, "lineitem"), names))


@_query("correlation_target")
def correlation_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(ag.correlation_with_target(_stored_clients(spark, sf_dir)))


@_query("correlation_top3")
def correlation_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ag.top_correlations(ag.correlation_with_target(_stored_clients(spark, sf_dir)))
    return _all_rounded(top.select("variable", "r"))


@_query("correlation_extremes")
def correlation_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(ag.correlation_extremes(ag.correlation_with_target(_stored_clients(spark, sf_dir))))


# --- Preparation ---------------------------------------------------------------------------


def _split_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.stratified_split(_stored_clients(spark, sf_dir))


def _split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.stratified_split(materialise(dv.labelled_documents(spark, sf_dir), "documents"))


@_query("stratified_split")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_clients(spark, sf_dir).select(c.ID, c.TARGET, c.SPLIT)


@_query("stratified_split_documents")
def stratified_split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_documents(spark, sf_dir).select(c.ID, c.TARGET, c.SPLIT)


@_query("kfold_assign")
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = _stored_clients(spark, sf_dir)
    return sp.assign_folds(clients).select(c.ID, c.TARGET, c.FOLD)


def _train(divided: DataFrame) -> DataFrame:
    return divided.filter(F.col(c.SPLIT) == c.TRAIN)


@_query("constant_columns")
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_chars", "lang", "source", "toxic", "region"]
    varying, constant = ag.varying_columns(_train(_split_documents(spark, sf_dir)), names)
    rows = [(n, False) for n in varying] + [(n, True) for n in constant]
    return spark.createDataFrame(rows, "columna string, constante boolean")


@_query("impute_params")
def impute_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ft.fit_features(_split_clients(spark, sf_dir))
    rows = [(n, round(float(v), 6)) for n, v in model.fills.items()]
    return spark.createDataFrame(rows, "columna string, mediana double")


@_query("impute_params_documents")
def impute_params_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _train(_split_documents(spark, sf_dir))
    fills, _ = ft.learn_imputation(train, ["n_chars", "lang", "source"])
    return spark.createDataFrame(
        [(n, str(v)) for n, v in fills.items()], "columna string, valor string")


def _filled_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labelled documents with their split, and all documents, filled by what train tells."""
    divided = _split_documents(spark, sf_dir)
    fills, _ = ft.learn_imputation(_train(divided), ["n_chars", "lang", "source"])
    return ft.impute(divided, fills), ft.impute(dv.document_inputs(spark, sf_dir), fills)


@_query("impute_apply")
def impute_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled_documents(spark, sf_dir)[1].select(c.ID, "n_chars", "lang", "source")


def _document_categories(filled: DataFrame) -> dict[str, list[str]]:
    return ft.learn_categories(_train(filled), ["lang", "source"])


@_query("onehot_categories")
def onehot_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _document_categories(_filled_documents(spark, sf_dir)[0])
    rows = [(n, v) for n, values in found.items() for v in values]
    return spark.createDataFrame(rows, "columna string, categoria string")


@_query("onehot_apply")
def onehot_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned, filled = _filled_documents(spark, sf_dir)
    categories = _document_categories(learned)
    encoded = ft.one_hot(filled.select(c.ID, "lang", "source"), categories)
    return encoded.select(c.ID, F.inline(F.array(*[
        F.struct(F.lit(n).alias("columna"), F.lit(v).alias("categoria"),
                 col(f"{n}_{v}").alias("valor"))
        for n, values in categories.items() for v in values])))


@_query("scale_params")
def scale_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ft.fit_features(_split_clients(spark, sf_dir))
    rows = [(n, round(m, 4), round(s, 4)) for n, (m, s) in model.scaling.items()]
    return spark.createDataFrame(rows, "variable string, media double, desviacion double")


@_query("prepare_clients")
def prepare_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    divided = _split_clients(spark, sf_dir)
    return _all_rounded(ft.fit_features(divided).transform(divided))


@_query("fold_preparation")
def fold_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, mean and deviation of each variable outside of each fold, learned in the same scans."""
    learned = fit_features_by_fold(sp.assign_folds(_stored_clients(spark, sf_dir)))
    rows = [(f, n, round(float(model.fills[n]), 6), round(m, 4), round(s, 4))
            for f, model in learned.items() for n, (m, s) in model.scaling.items()]
    return spark.createDataFrame(
        rows, "fold int, variable string, mediana double, media double, desviacion double")


@_query("onehot_wide")
def onehot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the ones that two text columns give, one of them with a category per customer."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("prioridad"),
        F.col("o_custkey").cast("string").alias("cliente"),
        F.when(F.col("o_orderkey") % 5 == 0, c.TEST).otherwise(c.TRAIN).alias(c.SPLIT))
    learned = fit_sparse_features(rows, dropped={"o_orderkey": "identificador"})
    return learned.pairs(rows, "o_orderkey")


@_query("imputed_flags")
def imputed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    divided = _split_clients(spark, sf_dir)
    flagged = ft.fit_features(divided).imputed_flags(divided)
    return flagged.select(c.ID, F.array_join("imputados", "; ").alias("imputados"))


@_query("exact_medians")
def exact_median_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    counts = lines.agg(*[F.count(n).alias(n) for n in names]).first().asDict()
    # The low limit takes the bracket search, as a table too large for one buffer would.
    found = exact_medians(lines, counts, direct_rows=1_000)
    return spark.createDataFrame(list(found.items()), "columna string, mediana double")


@_query("value_modes")
def value_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes(value_counts(table(spark, sf_dir, "events"), ["event_type", "props"]))


# --- Evaluation ----------------------------------------------------------------------------


_MODEL_ORDER = [c.LOGISTIC, c.FOREST]


def _scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed scores per order, so the metric operators have an SQL counterpart."""
    scores = F.array(
        F.struct(F.lit(c.LOGISTIC).alias(c.MODEL),
                 (F.floor("o_totalprice") / 1_000_000).alias(c.PROBABILITY)),
        F.struct(F.lit(c.FOREST).alias(c.MODEL),
                 ((F.col("o_orderkey") % 100).cast("double") / 100).alias(c.PROBABILITY)),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias(c.TARGET),
        F.inline(scores),
    ).withColumn(c.PREDICTION, (F.col(c.PROBABILITY) > 0.5).cast("int"))


def _fold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed decisions per client with their fold."""
    folds = sp.assign_folds(_stored_clients(spark, sf_dir))
    good = col(c.SCORE) > 600
    decisions = F.array(
        F.struct(F.lit(c.LOGISTIC).alias(c.MODEL), (good & (col(c.MAX_FREQUENCY) > 0)).alias("d")),
        F.struct(F.lit(c.FOREST).alias(c.MODEL), (good & (col(c.DELINQUENCY) == 0)).alias("d")),
    )
    return folds.select(c.FOLD, c.TARGET, F.inline(decisions)).withColumn(
        c.PREDICTION, F.coalesce(F.col("d"), F.lit(False)).cast("int"))


@_query("confusion_metrics")
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = mt.classification_metrics(_scored_orders(spark, sf_dir))
    return _all_rounded(metrics.withColumn("notas", F.array_join("notas", "; ")))


@_query("confusion_cells")
def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = mt.confusion(_scored_orders(spark, sf_dir), [c.MODEL])
    return _all_rounded(mt.confusion_cells(metrics))


@_query("auc_exact")
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(mt.auc(_scored_orders(spark, sf_dir)), 9)


@_query("roc_points")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(mt.roc_points(_scored_orders(spark, sf_dir)),
                    {"tasa_falsos_positivos": 6, "tasa_verdaderos_positivos": 6})


@_query("roc_curve")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve within an area of 0.01."""
    return _rounded(mt.roc_curve(_scored_orders(spark, sf_dir), 0.01),
                    {"tasa_falsos_positivos": 6, "tasa_verdaderos_positivos": 6})


@_query("fewest_false_positives")
def fewest_false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mt.confusion(_scored_orders(spark, sf_dir), [c.MODEL])
    return mt.fewest_false_positives(mt.with_position(counts, _MODEL_ORDER), mt.POSITION)


@_query("fewest_false_positives_tied")
def fewest_false_positives_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models with the same predictions: the first trained one wins, whatever its name."""
    scored = _scored_orders(spark, sf_dir).where(col(c.MODEL) == _MODEL_ORDER[0])
    copy = scored.withColumn(c.MODEL, F.lit("A"))
    counts = mt.confusion(scored.unionByName(copy), [c.MODEL])
    return mt.fewest_false_positives(mt.with_position(counts, [_MODEL_ORDER[0], "A"]), mt.POSITION)


@_query("fold_summary")
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(mt.fold_summary(_fold_predictions(spark, sf_dir)))


@_query("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = _fold_predictions(spark, sf_dir)
    metrics = mt.classification_metrics(predictions, score=None)
    compared = mt.compare_models(metrics, mt.fold_summary(predictions))
    return _all_rounded(compared.drop("auc_prueba"))


@_query("model_recommendation")
def model_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(mt.recommend(mt.fold_summary(_fold_predictions(spark, sf_dir))))


# --- Segments ------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias(c.SEGMENT),
        F.col("embedding").cast("array<double>").alias("v"))


@_query("silhouette_euclidean")
def silhouette_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(
        sg.silhouette_euclidean(_vectors(spark, sf_dir), "v", c.SEGMENT, "vec_id", block=250))


@_query("silhouette_mean")
def silhouette_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_row = sg.silhouette_euclidean(_vectors(spark, sf_dir), "v", c.SEGMENT, "vec_id")
    return _all_rounded(sg.mean_silhouette(per_row))


@_query("silhouette_by_anchors")
def silhouette_by_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, with error 0, while no cluster has more than the 1,000 anchors; an estimate beyond."""
    found = sg.silhouette_by_anchors(_vectors(spark, sf_dir), "v", c.SEGMENT, "vec_id")
    return spark.createDataFrame(
        [(round(found.value, 6), found.error, found.rows)], "silueta double, error_estandar double, filas long")


@_query("silhouette_squared")
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(sg.silhouette_squared(_vectors(spark, sf_dir), "v", c.SEGMENT, "vec_id"))


@_query("nearest_centre")
def nearest_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    means = (
        vectors.select(c.SEGMENT, F.posexplode("v").alias("i", "x"))
        .groupBy(c.SEGMENT, "i").agg(F.avg("x").alias("m"))
        .groupBy(c.SEGMENT).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("m"))
    )
    centres = [(r[c.SEGMENT], [e["m"] for e in r["m"]]) for r in means.orderBy(c.SEGMENT).collect()]
    return sg.nearest_centre(vectors, "v", centres, "asignado").select("vec_id", "asignado")


@_query("segment_sizes")
def segment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    # Two numbers beyond the last label have no rows.
    return sg.segment_sizes(vectors, vectors.agg(F.max(c.SEGMENT)).first()[0] + 3)


def _profiled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    divided = _split_clients(spark, sf_dir)
    model = ft.fit_features(divided)
    rows = model.transform(divided).withColumn(c.SEGMENT, col(c.HOUSING).cast("int"))
    return rows, sg.segment_profiles(rows, [c.AGE, c.INCOME, c.SCORE], model.scaling)


@_query("segment_profiles")
def segment_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _profiled(spark, sf_dir)[1]
    return _rounded(profiles, {c.AGE: 4, c.INCOME: 4, c.SCORE: 4, "tasa_aprobacion": 6})


@_query("segment_lookup")
def segment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, profiles = _profiled(spark, sf_dir)
    typical = profiles.select(
        c.SEGMENT, F.col("n_clientes").alias("segmento_n_clientes"),
        F.round(col(c.AGE), 2).alias("segmento_Edad"))
    return mg.attach_by_key(rows.select(c.ID, c.SEGMENT), typical, c.SEGMENT, few_keys=True)


@_query("suggested_k")
def suggested_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouettes of given clusterings under both metrics, with the suggestion and the level."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    counts = {f"k{k}": k for k in (2, 3, 4, 5)}
    numbered = vectors.withColumns({n: (F.col("vec_id") % k).cast("int") for n, k in counts.items()})

    def marked(mean: DataFrame, k: Column, metric: str) -> DataFrame:
        return mean.select(
            k.alias("k"), "silueta", (k == 3).alias("es_el_modelo"), F.lit(metric).alias("metrica"))

    # One pass over all pairs serves the four clusterings.
    euclidean = marked(
        sg.mean_silhouette(
            sg.silhouettes_euclidean(numbered, "v", list(counts), "vec_id"), sg.GROUPING),
        F.substring(sg.GROUPING, 2, 9).cast("int"), sg.EUCLIDEAN)
    squared = None
    for n, k in counts.items():
        mean = marked(
            sg.mean_silhouette(sg.silhouette_squared(numbered, "v", n, "vec_id")), F.lit(k), sg.SQUARED)
        squared = mean if squared is None else squared.unionByName(mean)
    found = [sg.with_suggestion(materialise(rows, "silhouettes")) for rows in (euclidean, squared)]
    return _all_rounded(found[0].unionByName(found[1]))


def _plane_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("int").alias(c.SEGMENT),
        F.col("l_quantity").cast("double").alias("cantidad"),
        (F.col("l_extendedprice").cast("double") / 1000).alias("precio"))


@_query("pca_two_columns")
def pca_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal components of two columns; SQL has the closed form."""
    plane = sg.fit_plane(_plane_inputs(spark, sf_dir), ["cantidad", "precio"])
    loadings = spark.createDataFrame(
        [(j + 1, *map(float, w)) for j, w in enumerate(plane.components)],
        "componente int, carga_cantidad double, carga_precio double")
    return _all_rounded(plane.explained_table(spark).join(loadings, "componente"), 5)


@_query("pca_projection_fixed")
def pca_projection_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    plane = sg.PlaneProjection(
        ["cantidad", "precio"], [25.0, 38.0], [[0.6, 0.8], [0.8, -0.6]], [0.9, 0.1])
    return _all_rounded(sg.plane_centres(plane.project(_plane_inputs(spark, sf_dir))), 4)


@_query("kmeans_fixed_point")
def kmeans_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted segmentation checked by its definition: every order at its nearest centre, every
    centre the mean of its orders."""
    names = ["precio", "mes"]
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(c.ID), (F.col("o_totalprice").cast("double") / 100_000).alias("precio"),
        (F.month("o_orderdate") / 6).alias("mes")).persist()
    model = sg.fit_segments(rows, names, k=3, starts=3)
    assigned = materialise(model.assign(rows), "assigned")
    rows.unpersist()
    centres = model.centres_table(spark)
    long = assigned.select(c.ID, F.col(c.SEGMENT).alias("propio"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("variable"), F.col(n).alias("x")) for n in names])))
    distances = long.join(F.broadcast(centres), "variable").groupBy(c.ID, "propio", c.SEGMENT).agg(
        F.sum((F.col("x") - F.col("centro")) ** 2).alias("d"))
    nearest = distances.groupBy(c.ID, "propio").agg(
        F.min("d").alias("menor"), F.min(F.when(F.col(c.SEGMENT) == F.col("propio"), F.col("d"))).alias("suya"))
    counted = nearest.agg(
        F.count("*").alias("filas"), F.count_if(F.col("suya") > F.col("menor") + 1e-9).alias("lejos"))
    shifts = (
        long.groupBy(F.col("propio").alias(c.SEGMENT), "variable").agg(F.avg("x").alias("media"))
        .join(F.broadcast(centres), [c.SEGMENT, "variable"])
        .agg(F.count("*").alias("centros"),
             F.round(F.max(F.abs(F.col("media") - F.col("centro"))), 3).alias("desvio")))
    return counted.crossJoin(F.broadcast(shifts))  # one row each


@_query("logistic_gradient")
def logistic_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regularised gradient of a fitted regression per variable, which is 0 at the optimum."""
    lines = table(spark, sf_dir, "lineitem").select(
        ((F.col("l_quantity").cast("double") - 25) / 15).alias("cantidad"),
        (F.col("l_discount").cast("double") * 20 - 1).alias("descuento"),
        (F.col("l_tax").cast("double") * 20 - 1).alias("impuesto"),
        (F.col("l_quantity") + F.col("l_linenumber") * 5 > 40).cast("int").alias(c.TARGET)).persist()
    names = ["cantidad", "descuento", "impuesto"]
    fitted = fit_classifiers(lines, names, classifiers={c.LOGISTIC: logistic_regression})
    model = fitted.models[c.LOGISTIC]
    weights = dict(zip(names, map(float, model.coefficients)))
    data = materialise(lines.select(*names, c.TARGET), "lines")
    lines.unpersist()
    margin = F.lit(float(model.intercept))
    for n, w in weights.items():
        margin = margin + F.lit(w) * F.col(n)
    error = 1 / (1 + F.exp(-margin)) - F.col(c.TARGET)
    sums = data.agg(
        F.count("*").alias("filas"), *[F.sum(error * F.col(n)).alias(n) for n in names])
    return sums.select("filas", F.inline(F.array(*[
        F.struct(F.lit(n).alias("variable"),
                 F.round(F.abs((F.col(n) + F.lit(w)) / F.col("filas")), 4).alias("gradiente"))
        for n, w in weights.items()])))


@_query("importance_top_fixed")
def importance_top_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading variables of an importance table that the line items give."""
    line = F.col("l_linenumber").cast("int")
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias(c.MODEL), line.alias("posicion")).agg(
        F.count("*").cast("double").alias("magnitud"))
    rows = rows.withColumns({
        "variable": F.concat(F.lit("linea-"), F.col("posicion").cast("string")),
        "de_la_regla": F.col("posicion") % 2 == 0})
    return top_importances(rows).withColumn("principales", F.array_join("principales", "; "))


@_query("correlation_excluded")
def correlation_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = _clients(spark, sf_dir).withColumn("Constante", F.lit(4.0))
    return ag.uncorrelated_columns(clients)


# --- Applicants ----------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dv.applicant_documents(spark, sf_dir)
    return texts.select(c.SEQ, F.from_json("documento", APPLICANT_SCHEMA).alias("d")).select(
        c.SEQ, "d.*")


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants with an id and every field as text, as the document reader gives them."""
    default = F.concat(F.lit("DOC-"), F.col(c.SEQ).cast("string"))
    return dv.applicant_records(spark, sf_dir).select(
        c.SEQ, F.coalesce(col(c.ID), default).alias(c.ID),
        *[col(n).cast(APPLICANT_SCHEMA[n].dataType).alias(n) for n in ("perfil", "historial", "buro")])


@_query("nested_profile")
def nested_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_applicants(_documents(spark, sf_dir))[0].select(
        c.ID, c.AGE, F.round(col(c.INCOME).cast("double"), 2).alias(c.INCOME), c.SENIORITY, c.HOUSING)


@_query("nested_history")
def nested_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_applicants(_documents(spark, sf_dir))[1].select(
        c.ID, F.round(col(c.AMOUNT).cast("double"), 2).alias(c.AMOUNT), c.CURRENCY,
        F.round(col(c.BALANCE).cast("double"), 1).alias(c.BALANCE), c.FREQUENCY)


@_query("nested_bureau")
def nested_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_applicants(_documents(spark, sf_dir))[2].select(
        c.ID, c.SCORE, c.CREDITS, c.DELINQUENCY)


@_query("default_ids")
def default_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumnRenamed(c.SEQ, "seq")
    return with_default_ids(docs).select("seq", c.ID)


@_query("applicant_clients")
def applicant_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _client_values(pl.client_rows(*flatten_applicants(_identified(spark, sf_dir))))


@_query("document_clients")
def document_client_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _client_values(document_clients(_identified(spark, sf_dir)))


@_query("score_batch_fixed")
def score_batch_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    divided = _split_clients(spark, sf_dir)
    model = ft.fit_features(divided)
    reasons = tg.rejection_reasons(divided).withColumn(
        "motivos", F.when(col(c.TARGET) == 0, F.array_join("motivos", "; ")).otherwise(""))
    inputs = model.transform(reasons, (c.ID, c.TARGET, "motivos"))
    margin = F.lit(FIXED_INTERCEPT)
    for name, weight in FIXED_WEIGHTS.items():
        margin = margin + F.lit(weight) * col(name)
    return inputs.select(
        c.ID, col(c.TARGET).alias("regla_negocio"), (margin > 0).cast("int").alias("prediccion"),
        F.round(1 / (1 + F.exp(-margin)), 6).alias("probabilidad"), "motivos")


@_query("preview_rows")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = dv.raw_profile(spark, sf_dir).orderBy(c.SEQ).limit(5)
    return first.select(F.col(c.SEQ).alias("seq"), c.ID, c.AGE, c.HOUSING)


@_query("combined_by_split")
def combined_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined table with the split of its clients, written by split and read back."""
    splits = _split_clients(spark, sf_dir).select(c.ID, c.SPLIT)
    rows = _merged(spark, sf_dir).join(splits, c.ID, "left")
    path = f"{shared_folder(spark)}/combined-{uuid.uuid4().hex}.parquet"
    write_table(rows, path, partition_by=(c.SPLIT,))
    return _rounded(load_source(spark, path), {c.AMOUNT: 2, c.BALANCE: 4})


@_query("json_lines_orders")
def json_lines_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as JSON Lines to the shared folder and read back with the layout recognised."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}.jsonl"
    orders.write.json(path)
    return load_source(spark, path, schema=orders.schema)


def _as_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The JSON texts of a task as the lines of one list."""
    begin = "["
    for batch in batches:
        lines = []
        for text in batch.column(0).to_pylist():
            lines.append(begin + text)
            begin = ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if begin == "[" else "]"])], ["value"])


def _write_lists(spark: SparkSession, rows: DataFrame, files: int, *order: str,
                 file_rows: int = 250_000) -> str:
    """``rows`` as a folder of JSON lists that follow each other in ``order``.

    A task sorts and writes a file, so there are more than ``files`` where they would get more than
    about ``file_rows`` rows.
    """
    files = max(files, -(-rows.count() // file_rows))
    path = f"{shared_folder(spark)}/lists-{uuid.uuid4().hex}.json"
    placed = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    placed.select(F.to_json(F.struct(*rows.columns)).alias("value")).mapInArrow(
        _as_lists, "value string").write.text(path)
    return path


def _noted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a text that holds quotes, braces, backslashes and, for every third, line breaks."""
    key = F.col("o_orderkey").cast("string")
    note = F.concat(F.lit('said "'), key, F.lit('}, {[\\", '), F.when(
        F.col("o_orderkey") % 3 == 0, F.lit('"new\nline"\n')).otherwise(F.lit("")), F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), note.alias("note"))


@_query("json_list_orders")
def json_list_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as JSON lists and read back by splits, with their numbers in the order of the files."""
    path = _write_lists(spark, _noted_orders(spark, sf_dir), 3, "o_orderkey")
    schema = "o_orderkey long, o_custkey long, o_totalprice double, note string"
    return numbered(load_source(spark, path, schema=T.StructType.fromDDL(schema), place=True), "place")


@_query("csv_quoted_orders")
def csv_quoted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose text breaks lines inside quotes, written as CSV and read back by splits."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}.csv"
    orders = _noted_orders(spark, sf_dir)
    orders.repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey").write.options(
        header=True, escape='"').csv(path)
    rows = numbered(load_source(spark, path, multiline=True, place=True), "place")
    return rows.select(
        "place", F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"), "note")


@_query("first_order_by_file")
def first_order_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer as the rows stand in several CSV files."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}.csv"
    orders = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 3).alias("turn"), "o_orderkey", "o_custkey")
    orders.repartitionByRange(5, "turn", "o_orderkey").sortWithinPartitions("turn", "o_orderkey").write.option(
        "header", True).csv(path)
    rows = load_source(spark, path, sequence=True)
    return cl.keep_first(rows, ["o_custkey"]).select(
        F.col("o_custkey").cast("long").alias("o_custkey"), F.col("o_orderkey").cast("long").alias("o_orderkey"))


@_query("default_ids_by_file")
def default_ids_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicant documents in several JSON lists; those without an id get one from their position."""
    docs = _documents(spark, sf_dir).withColumn("_key", F.col(c.SEQ)).drop(c.SEQ)
    path = _write_lists(spark, docs, 4, "_key")
    return read_applicants(spark, path).select(F.col(c.SEQ).alias("seq"), c.ID)


# --- Queries that fit models: no SQL form --------------------------------------------------

_SEGMENT_TABLES: dict[tuple[str, str], dict[str, DataFrame]] = {}
_FITTED: dict[tuple[str, str], tuple[pl.Trained, pl.Evaluation]] = {}


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[pl.Trained, pl.Evaluation]:
    """The pipeline run once per session and scale; the queries below read its tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = pl.run(*dv.raw_sources(spark, sf_dir))
    return _FITTED[key]


@_query("model_predictions")
def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _ = _fitted(spark, sf_dir)
    return trained.classifiers.prediction_table(trained.prepared.test)


@_query("model_metrics")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[1].metrics


@_query("model_cross_validation")
def model_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[1].comparison


@_query("model_choice")
def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[1].recommendation


@_query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importances(_fitted(spark, sf_dir)[0].classifiers, spark)


@_query("feature_importance_top")
def feature_importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_importances(importances(_fitted(spark, sf_dir)[0].classifiers, spark))


@_query("forest_importance_sum")
def forest_importance_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of the fitted forest: none negative, together 1."""
    found = importances(_fitted(spark, sf_dir)[0].classifiers, spark)
    return found.where(F.col(c.MODEL) == c.FOREST).groupBy(c.MODEL).agg(
        F.round(F.sum("valor"), 6).alias("suma"), F.count_if(F.col("valor") < 0).alias("negativas"))


@_query("score_explanations")
def score_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What scoring says about each document besides the models' answers."""
    summary = Scorer.of(*_fitted(spark, sf_dir)).score_documents(_identified(spark, sf_dir))
    return summary.select(
        c.ID, "regla_negocio", F.array_join("motivos", "; ").alias("motivos"),
        F.array_join("imputados", "; ").alias("imputados"))


@_query("client_segments")
def client_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[0].segments.select(c.ID, c.SPLIT, c.SEGMENT)


@_query("silhouette_by_k")
def silhouette_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[1].silhouette


@_query("fitted_segment_profiles")
def fitted_segment_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir)[1].profiles


def _segment_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The plane is fitted once for the queries that show it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEGMENT_TABLES:
        _SEGMENT_TABLES[key] = rp.segment_tables(*_fitted(spark, sf_dir))
    return _SEGMENT_TABLES[key]


@_query("pca_segments")
def pca_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segment_tables(spark, sf_dir)["pca_segmentos"]


@_query("pca_centres")
def pca_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segment_tables(spark, sf_dir)["pca_centros"]


@_query("score_applicants")
def score_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = Scorer.of(*_fitted(spark, sf_dir))
    return scorer.with_typical_profile(scorer.score_documents(_identified(spark, sf_dir)))




def entry(spark: SparkSession) -> DataFrame:
    """How many clients the rule approves, per class, from the three dirty sources."""
    return approval_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    text = dict(QUERIES)
    if corpus_pipeline:
        text["pipeline"] = corpus_pipeline.run
    return {**_REGISTRY, **text}


def oracle_sql() -> dict[str, str]:
    known = {name: sql for name, sql in statements().items() if name in _REGISTRY}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**known, **ORACLES}
