"""The training pipeline: sources to labelled clients to models to evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import PreparationError
from aval.functions.values import col
from aval.operators import metrics as mt
from aval.operators import segments as sg
from aval.operators.aggregate import aggregate_by_client, client_outcomes, client_table
from aval.operators.cleaning import (
    clean_bureau,
    clean_history,
    clean_profile,
    normalise_bureau,
    normalise_history,
    normalise_profile,
)
from aval.operators.features import SINGLE_CURRENCY, FeatureModel, fit_features
from aval.operators.folds import fit_features_by_fold
from aval.operators.merge import merge_sources
from aval.operators.models import Classifiers, cross_validate, fit_classifiers, importances
from aval.operators.split import stratified_split
from aval.operators.target import label_approval
from aval.session import materialise, spread
from aval.sources.order import with_sequence


def combined_table(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                   config: c.PipelineConfig | None = None,
                   keep_sequence: bool = False) -> DataFrame:
    """Raw sources to the merged table, one row per transaction.

    ``keep_sequence`` keeps the place of each transaction (``_seq``) for the summary by client.
    """
    config = config or c.PipelineConfig()
    return merge_sources(
        clean_profile(profile, config.cleaning),
        clean_history(history, config.cleaning, keep_sequence),
        clean_bureau(bureau),
    )


def labelled_table(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                   config: c.PipelineConfig | None = None) -> DataFrame:
    """The merged table with its label, the transactions being joined once.

    The label belongs to the client and only clients with a profile can be approved, so it
    rides on the profile row into the merge. ``label_approval`` does the same from any
    combined table, at the price of shuffling its rows again.
    """
    config = config or c.PipelineConfig()
    profile, bureau = with_sequence(profile), with_sequence(bureau)
    labels = client_labels(profile, history, bureau, config)
    labelled = clean_profile(profile, config.cleaning).join(labels, c.ID, "left")
    merged = merge_sources(
        labelled, clean_history(history, config.cleaning), clean_bureau(bureau), target=None
    )
    order = [n for n in merged.columns if n != c.TARGET]
    return merged.select(*[col(n) for n in order],
                         F.coalesce(col(c.TARGET), F.lit(0)).alias(c.TARGET))


def client_labels(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                  config: c.PipelineConfig | None = None) -> DataFrame:
    """Raw sources to ``(id, label)`` per client, in one shuffle."""
    config = config or c.PipelineConfig()
    return client_outcomes(
        normalise_profile(with_sequence(profile), config.cleaning),
        normalise_history(history, config.cleaning),
        normalise_bureau(with_sequence(bureau)),
        config.rule,
    )


def client_rows(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                config: c.PipelineConfig | None = None) -> DataFrame:
    """Raw sources to one labelled row per client, in two shuffles."""
    config = config or c.PipelineConfig()
    return client_table(
        normalise_profile(with_sequence(profile), config.cleaning),
        normalise_history(with_sequence(history), config.cleaning),
        normalise_bureau(with_sequence(bureau)),
        config.rule,
    )


def client_rows_from_combined(combined: DataFrame, rule: c.ApprovalRule | None = None) -> DataFrame:
    """The same table by the long way: label the merged rows, then summarise them.

    With columns beyond the contract, ``combined`` needs ``_seq`` to tell their first value.
    """
    order = c.SEQ if c.SEQ in combined.columns else None
    return aggregate_by_client(label_approval(combined, rule), order)


@dataclass(frozen=True)
class Prepared:
    """Per-client rows with their split, the learned preparation and the model inputs."""

    clients: DataFrame
    features: FeatureModel
    table: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.table.filter(col(c.SPLIT) == c.TRAIN)

    @property
    def test(self) -> DataFrame:
        return self.table.filter(col(c.SPLIT) == c.TEST)

    def spread_train(self) -> DataFrame:
        """The training rows in parts of even size, for fits that read them many times."""
        return spread(self.train, self.train.count())


def _preparation(config: c.PipelineConfig) -> Callable[[DataFrame], FeatureModel]:
    return partial(fit_features, config=config.preparation, dropped={c.CURRENCY: SINGLE_CURRENCY})


def prepare(clients: DataFrame, config: c.PipelineConfig | None = None) -> Prepared:
    """Split, learn the preparation on train and apply it to both parts.

    The per-client rows are written once to the shared folder: learning, training and
    evaluation read them many times.
    """
    config = config or c.PipelineConfig()
    absent = [n for n in (c.ID, c.TARGET) if n not in clients.columns]
    if absent:
        raise PreparationError(f"cannot prepare model inputs: columns absent: {', '.join(absent)}")
    stored = materialise(clients, "clients")
    if stored.isEmpty():
        raise PreparationError("cannot prepare model inputs: the table is empty")
    options = config.preparation
    divided = stratified_split(stored, test_size=options.test_size, seed=options.seed,
                               max_classes=options.max_classes)
    features = _preparation(config)(divided)
    return Prepared(divided, features, features.transform(divided))


@dataclass(frozen=True)
class Trained:
    """Fitted models and, for every client of both parts, its segment."""

    prepared: Prepared
    classifiers: Classifiers
    segmentation: sg.SegmentModel
    segments: DataFrame


def train(prepared: Prepared, config: c.PipelineConfig | None = None,
          classifiers: dict | None = None) -> Trained:
    """Fit the classifiers and the segmentation on train; assign segments to everyone."""
    with _training_rows(prepared) as rows:
        return _trained(prepared, rows, config or c.PipelineConfig(), classifiers)


@contextmanager
def _training_rows(prepared: Prepared) -> Iterator[DataFrame]:
    """The spread training rows, cached while fits read them."""
    rows = prepared.spread_train().persist()
    try:
        rows.count()  # fits that begin together would each cache the rows they miss
        yield rows
    finally:
        rows.unpersist()


def _trained(prepared: Prepared, rows: DataFrame, config: c.PipelineConfig,
             classifiers: dict | None, models: Future | None = None) -> Trained:
    """The segmentation, one of ``models``, is fitted while the classifiers are: neither keeps all
    cores busy by itself."""
    variables = prepared.features.variables
    with ThreadPoolExecutor(1) as pool:
        models = models or pool.submit(_segmentations, rows, variables, config, ())
        fitted = fit_classifiers(rows, variables, config.training, classifiers)
        segmentation = models.result()[config.training.segments]
    return Trained(prepared, fitted, segmentation, segmentation.assign(prepared.table))


def _segmentations(rows: DataFrame, variables: list[str], config: c.PipelineConfig,
                   others: tuple[int, ...]) -> dict[int, sg.SegmentModel]:
    """The segmentation and those of other k, all moved in the same scans."""
    options, n = config.training, rows.count()
    return sg.fit_segments_by_k(
        rows, variables, sorted({options.segments, *(k for k in others if k < n)}), options.segment_starts,
        options.segment_iterations, options.seed, config.evaluation.parallel_fits)


@dataclass(frozen=True)
class Evaluation:
    """Everything the report reads; all tables are small except the predictions."""

    predictions: DataFrame
    metrics: DataFrame
    cross_validation: DataFrame
    comparison: DataFrame
    recommendation: DataFrame
    importances: DataFrame
    silhouette: DataFrame
    model_silhouette: float
    profiles: DataFrame

    def close(self) -> None:
        """Release the tables kept in memory; they can still be read."""
        for table in (self.predictions, self.metrics, self.silhouette, self.profiles):
            table.unpersist()


def evaluate(trained: Trained, config: c.PipelineConfig | None = None,
             classifiers: dict | None = None) -> Evaluation:
    """Test metrics, cross-validation, recommendation, importances and segment quality."""
    config = config or c.PipelineConfig()
    mt.require_models(trained.classifiers.models)
    with _training_rows(trained.prepared) as rows, ThreadPoolExecutor(1) as pool:
        validated = pool.submit(_validated, trained.prepared, rows, config, classifiers)
        return _evaluated(trained, rows, validated, config)


def _validated(prepared: Prepared, rows: DataFrame, config: c.PipelineConfig,
               classifiers: dict | None) -> DataFrame:
    """The cross-validation's metrics per model, stored. It needs no trained model."""
    options, variables = config.evaluation, prepared.features.variables
    folds = (
        cross_validate(prepared.clients.filter(col(c.SPLIT) == c.TRAIN), variables, options,
                       config.training, classifiers, learn_folds=partial(
                           fit_features_by_fold, config=config.preparation,
                           dropped={c.CURRENCY: SINGLE_CURRENCY}))
        if options.prepare_folds
        else cross_validate(rows, variables, options, config.training, classifiers))
    return materialise(mt.fold_summary(folds), "cross-validation")


def _evaluated(trained: Trained, rows: DataFrame, validated: Future, config: c.PipelineConfig,
               models: dict[int, sg.SegmentModel] | None = None) -> Evaluation:
    """The silhouettes are measured while the cross-validation runs; ``models`` are fitted for them already."""
    prepared, options = trained.prepared, config.evaluation
    variables = prepared.features.variables
    predictions = trained.classifiers.predict(prepared.test).persist()
    metrics = mt.classification_metrics(predictions).persist()
    own = sg.model_silhouette(rows, trained.segmentation, c.ID, options.silhouette_metric,
                              options.silhouette_block, options.silhouette_anchors)
    silhouette = sg.silhouette_by_k(rows, variables, c.ID, options, config.training,
                                    config.charts, trained.segmentation, own, models).persist()
    summary = validated.result()
    names = list(trained.classifiers.models)
    comparison = mt.compare_models(metrics, summary)
    return Evaluation(
        predictions, metrics, summary, comparison,
        mt.recommend(mt.with_position(comparison, names), position=mt.POSITION,
                     thresholds=config.charts),
        importances(trained.classifiers, prepared.table.sparkSession), silhouette, own.value,
        sg.segment_profiles(trained.segments, variables, prepared.features.scaling).persist(),
    )


def run(profile: DataFrame, history: DataFrame, bureau: DataFrame,
        config: c.PipelineConfig | None = None, classifiers: dict | None = None
        ) -> tuple[Trained, Evaluation]:
    """The whole pipeline from raw sources, with other ``classifiers`` if given.

    ``train`` and ``evaluate`` in one go: the training rows are dealt and cached once, the
    cross-validation begins with the training, so that the fits fill each other's gaps, and k-means
    is fitted for all k together where the seeds are the same.
    """
    config = config or c.PipelineConfig()
    options = config.evaluation
    others = options.segment_counts if options.seed == config.training.seed else ()
    prepared = prepare(client_rows(profile, history, bureau, config), config)
    with _training_rows(prepared) as rows, ThreadPoolExecutor(2) as pool:
        models = pool.submit(_segmentations, rows, prepared.features.variables, config, others)
        validated = pool.submit(_validated, prepared, rows, config, classifiers)
        trained = _trained(prepared, rows, config, classifiers, models)
        mt.require_models(trained.classifiers.models)
        return trained, _evaluated(trained, rows, validated, config, models.result())
