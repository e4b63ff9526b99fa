"""The whole pipeline, its models, scoring, report and stream, on derived sources."""

import json
import time
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, InvalidTrainingDataError, NotTrainedError, PreparationError, SourceNotFoundError
from aval.operators import models as md
from aval.operators import segments as sg
from aval.operators.features import fit_features
from aval.operators.metrics import require_models
from aval.plans import pipeline as pl
from aval.plans import report as rp
from aval.plans.scoring import Scorer, document_clients
from aval.session import spread
from aval.sources import derived as dv
from aval.sources.applicants import APPLICANT_SCHEMA, flatten_applicants
from aval.streaming.applicants import read_stream, score_stream

CONFIG = c.PipelineConfig(
    training=c.TrainingConfig(trees=20, segment_starts=2),
    evaluation=c.EvaluationConfig(folds=3, segment_counts=(2, 3)),
)


@pytest.fixture(scope="module")
def sources(spark, sf_dir):
    return dv.raw_sources(spark, sf_dir)


@pytest.fixture(scope="module")
def fitted(sources):
    return pl.run(*sources, CONFIG)


def test_logistic_regression_is_at_the_optimum(fitted):
    trained, _ = fitted
    variables = trained.prepared.features.variables
    pdf = trained.prepared.train.toPandas()
    x, y = pdf[variables].to_numpy(float), pdf[c.TARGET].to_numpy(float)
    model = trained.classifiers.models[c.LOGISTIC]
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # Gradient of |w|^2 / 2 + sum of log losses (strength C = 1, intercept not penalised).
    assert np.abs(w + x.T @ (p - y)).max() < 1e-2 and abs((p - y).sum()) < 1e-2


def test_predictions_agree_in_both_forms(fitted):
    trained, evaluation = fitted
    wide = trained.classifiers.prediction_table(trained.prepared.test)
    assert wide.columns == [c.ID, "real", f"{c.LOGISTIC} (pred)", f"{c.LOGISTIC} (prob)",
                            f"{c.FOREST} (pred)", f"{c.FOREST} (prob)"]
    n = trained.prepared.test.count()
    assert wide.count() == n and evaluation.predictions.count() == 2 * n
    bad = evaluation.predictions.filter(
        (F.col("probabilidad") < 0) | (F.col("probabilidad") > 1) | ~F.col("prediccion").isin(0, 1))
    assert bad.count() == 0


def test_importances(fitted, spark):
    trained, evaluation = fitted
    rows = evaluation.importances.collect()
    forest = [r for r in rows if r["modelo"] == c.FOREST]
    assert abs(sum(r["valor"] for r in forest) - 1) < 1e-9
    assert [r["magnitud"] for r in forest] == sorted((r["magnitud"] for r in forest), reverse=True)
    assert {r["variable"] for r in forest if r["de_la_regla"]} <= set(c.RULE_FEATURES)
    with pytest.raises(EvaluationError):
        md.feature_importance("otro", object(), ["x"], spark)


def test_everyone_has_one_segment(fitted):
    trained, evaluation = fitted
    ids = trained.prepared.clients.select(c.ID).distinct().count()
    assert trained.segments.count() == ids == trained.segments.select(c.ID).distinct().count()
    assert evaluation.profiles.agg(F.sum("n_clientes")).first()[0] == ids
    assert -1 <= evaluation.model_silhouette <= 1


def test_recommendation_names_a_model(fitted):
    row = fitted[1].recommendation.first()
    assert row["modelo"] in (c.LOGISTIC, c.FOREST)
    assert fitted[1].comparison.count() == 2


def test_forest_learns_the_rule(fitted):
    rows = {r["modelo"]: r for r in fitted[1].metrics.collect()}
    assert rows[c.FOREST]["auc_roc"] > 0.8
    total = sum(rows[c.FOREST][n] for n in ("verdaderos_negativos", "falsos_positivos",
                                            "falsos_negativos", "verdaderos_positivos"))
    assert total == fitted[0].prepared.test.count()


def test_training_errors(fitted, spark):
    trained, _ = fitted
    variables = trained.prepared.features.variables
    train = trained.prepared.train
    with pytest.raises(InvalidTrainingDataError, match="two classes"):
        md.fit_classifiers(train.filter("credito_aprobado = 0"), variables)
    with pytest.raises(NotTrainedError):
        md.Classifiers().predict(train)
    with pytest.raises(InvalidTrainingDataError):
        trained.classifiers.predict(train.drop(variables[0]))
    with pytest.raises(EvaluationError):
        require_models({})
    with pytest.raises(PreparationError, match="empty"):
        pl.prepare(trained.prepared.clients.filter("1 = 0").drop(c.SPLIT))
    with pytest.raises(PreparationError, match="credito_aprobado"):
        pl.prepare(trained.prepared.clients.drop(c.SPLIT, c.TARGET))


def test_another_classifier_can_be_added(fitted):
    from pyspark.ml.classification import DecisionTreeClassifier

    trained, _ = fitted
    extra = {"Árbol": lambda rows, config: DecisionTreeClassifier(
        featuresCol="features", labelCol=c.TARGET, seed=config.seed)}
    model = md.fit_classifiers(trained.prepared.train, trained.prepared.features.variables, classifiers=extra)
    assert model.predict(trained.prepared.test).select("modelo").distinct().first()[0] == "Árbol"


def test_preparation_can_be_learned_in_each_fold(fitted):
    trained, _ = fitted
    clients = trained.prepared.clients.filter(F.col(c.SPLIT) == c.TRAIN)
    learned = []

    def learn(rows):
        learned.append(fit_features(rows))
        return learned[-1]

    config = c.EvaluationConfig(folds=3)
    only = {c.LOGISTIC: md.logistic_regression}
    whole = md.cross_validate(clients, [], config, classifiers=only, learn=learn)
    fixed = md.cross_validate(trained.prepared.train, trained.prepared.features.variables, config, classifiers=only)
    assert len(learned) == 3 and len({repr(m.scaling) for m in learned}) == 3
    assert whole.count() == clients.count() and whole.columns == fixed.columns
    sizes = [{tuple(r) for r in t.groupBy(c.FOLD, c.TARGET).count().collect()} for t in (whole, fixed)]
    assert sizes[0] == sizes[1]
    options = c.PipelineConfig(training=CONFIG.training, evaluation=c.EvaluationConfig(
        folds=2, segment_counts=(2,), prepare_folds=True))
    assert pl.evaluate(trained, options).comparison.count() == 2


def _document(number, perfil=None, historial=None, buro=None):
    parts = {"ID_Cliente": f"NUEVO-{number:03d}", "perfil": perfil, "historial": historial, "buro": buro}
    return json.dumps({k: v for k, v in parts.items() if v is not None})


def _movement(amount, currency, balance, frequency):
    return {c.AMOUNT: amount, c.CURRENCY: currency, c.BALANCE: balance, c.FREQUENCY: frequency}


# Complies; fails score and delinquency, in dollars; incomplete without history; only an id.
DOCS = [
    _document(1, {c.AGE: 41, c.INCOME: 27500.5, c.SENIORITY: 9, c.HOUSING: "PROPIA "},
              [_movement(2100, "MXN", 12500, 6), _movement(730.25, None, 12500, 0),
               _movement(140, "usd", 900, 2), _movement(2100, "MXN", 12500, 6)],
              {c.SCORE: 688, c.CREDITS: 2, c.DELINQUENCY: "no"}),
    _document(2, {c.AGE: 63, c.INCOME: 15250, c.SENIORITY: 31, c.HOUSING: "renta"},
              [_movement(75, "USD", 410, 3)], {c.SCORE: 600, c.CREDITS: 4, c.DELINQUENCY: "Sí"}),
    _document(3, {c.AGE: 22, c.HOUSING: "con familia"}, [], {c.SCORE: 701, c.CREDITS: 0, c.DELINQUENCY: "NO"}),
    _document(4),
]


@pytest.fixture(scope="module")
def docs(spark):
    raw = spark.createDataFrame([(d,) for d in DOCS], "t string")
    return raw.select(F.from_json("t", APPLICANT_SCHEMA).alias("d")).select("d.*")


def test_applicants_are_scored(fitted, docs):
    scorer = Scorer.of(*fitted, CONFIG)
    rows = {r[c.ID]: r for r in scorer.score_applicants(docs).collect()}
    assert [rows[f"NUEVO-00{i}"]["regla_negocio"] for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert rows["NUEVO-001"]["motivos"] == [] and len(rows["NUEVO-002"]["motivos"]) == 2
    assert rows["NUEVO-003"]["motivos"] == ["sin depósitos registrados"]
    assert "Ingreso_Declarado" in rows["NUEVO-003"]["imputados"] and not rows["NUEVO-001"]["imputados"]
    assert len(rows["NUEVO-004"]["motivos"]) == 3  # delinquency counts as none
    typical = scorer.with_typical_profile(scorer.score_applicants(docs)).first()
    assert typical["segmento_n_clientes"] > 0


def test_array_form_equals_the_general_form(fitted, docs):
    scorer = Scorer.of(*fitted, CONFIG)
    general = sorted(map(repr, scorer.score_applicants(docs).collect()))
    assert sorted(map(repr, scorer.score_documents(docs).collect())) == general
    config = c.CleaningConfig()
    flat = pl.client_rows(*flatten_applicants(docs))
    nested = document_clients(docs, config).select(*flat.columns)
    assert sorted(map(repr, flat.collect())) == sorted(map(repr, nested.collect()))


def test_stopped_or_damaged_saves_are_not_loaded(fitted, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scorer")
    with pytest.raises(SourceNotFoundError):
        Scorer.load(spark, path)
    first = Scorer.of(*fitted, CONFIG)
    first.save(spark, path)
    other = replace(first, recommended="otro")
    with monkeypatch.context() as stopping:
        def stop(*_):
            raise RuntimeError("stopped")

        stopping.setattr(type(first.segmentation), "save", stop)  # features are written by then
        with pytest.raises(RuntimeError, match="stopped"):
            other.save(spark, path)
    assert Scorer.load(spark, path).recommended == first.recommended
    second = other.save(spark, path)
    assert Scorer.load(spark, path).recommended == "otro"
    damaged = next(f for f in Path(second, "features").glob("part-*"))
    damaged.write_bytes(damaged.read_bytes() + b" ")
    Path(damaged.parent, f".{damaged.name}.crc").unlink(missing_ok=True)
    assert Scorer.load(spark, path).recommended == first.recommended


def test_saved_scorer_gives_the_same_scores(fitted, docs, spark, tmp_path):
    scorer = Scorer.of(*fitted, CONFIG)
    scorer.save(spark, str(tmp_path / "scorer"))
    loaded = Scorer.load(spark, str(tmp_path / "scorer"))
    before = sorted(map(repr, scorer.score_applicants(docs).collect()))
    assert sorted(map(repr, loaded.score_applicants(docs).collect())) == before


def test_stream_equals_batch(fitted, docs, spark, tmp_path):
    scorer = Scorer.of(*fitted, CONFIG)
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.repartition(2).write.json(inbox)
    query = score_stream(scorer, read_stream(spark, inbox, 1), out, str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    scored = spark.read.parquet(out)
    batch = scorer.score_documents(docs).select(*scored.columns)
    assert sorted(map(repr, scored.collect())) == sorted(map(repr, batch.collect()))


def test_report_is_written_whole(fitted, sources, spark, tmp_path):
    tables = rp.report_tables(*sources, *fitted, CONFIG)
    folders = rp.write_report(tables, str(tmp_path / "report"))
    assert len(folders) == len(tables) == 9 + 3 + 6 + 9 + 7
    assert "correlaciones_excluidas" in tables
    for folder in folders:
        assert spark.read.parquet(folder).columns
    sizes = spark.read.parquet(f"{tmp_path}/report/tamanos_segmentos")
    assert sizes.agg(F.sum("n_clientes")).first()[0] == fitted[0].segments.count()
    rp.write_report({"importancia_principales": tables["importancia_principales"]}, str(tmp_path / "csv"), "csv")
    assert spark.read.csv(f"{tmp_path}/csv/importancia_principales", header=True).count() == 2


def test_training_rows_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(40_000).coalesce(1)
    dealt = [len(p) for p in spread(rows, 40_000).rdd.glom().collect()]
    assert len(dealt) == min(cores, 8) and sum(dealt) == 40_000 and max(dealt) < 1.1 * min(dealt)
    assert spread(rows, 5_000) is rows
    assert len(spread(rows, 40_000, most=1_000, least=1).rdd.glom().collect()) == max(cores, 40)


def test_forest_rows_keep_their_nodes(spark):
    assert md.random_forest(10, c.TrainingConfig()).getCacheNodeIds()


def test_each_folds_scores_are_stored_when_its_model_is_fitted(spark):
    rows = spark.range(120).selectExpr(
        "id", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 5 AS DOUBLE) AS y", f"CAST(id % 2 AS INT) AS {c.TARGET}",
        f"CAST(id % 3 AS INT) AS {c.FOLD}").persist()
    found = md.cross_validate(rows, ["x", "y"], c.EvaluationConfig(folds=3), c.TrainingConfig(trees=2))
    assert found.inputFiles() and all("/fold-scores-" in f for f in found.inputFiles())
    counted = {(r[c.MODEL], r[c.FOLD]): r["count"] for r in found.groupBy(c.MODEL, c.FOLD).count().collect()}
    assert counted == {(m, f): 40 for m in (c.LOGISTIC, c.FOREST) for f in range(3)}


def _overlapping(calls):
    """Names of the calls that began before another one had ended."""
    return {a for a, since, to in calls for b, begin, end in calls if a != b and since < end and begin < to}


def test_a_run_fits_side_by_side_and_k_means_once(sources, monkeypatch):
    calls, ks = [], []

    def timed(module, name):
        whole = getattr(module, name)

        def call(*args, **kwargs):
            since = time.monotonic()
            try:
                return whole(*args, **kwargs)
            finally:
                calls.append((name, since, time.monotonic()))
        monkeypatch.setattr(module, name, call)

    by_k = sg.fit_segments_by_k
    monkeypatch.setattr(sg, "fit_segments_by_k", lambda r, v, k, *a, **o: ks.append(k) or by_k(r, v, k, *a, **o))
    for module, name in ((pl, "fit_classifiers"), (pl, "cross_validate"), (sg, "fit_segments_by_k")):
        timed(module, name)
    config = replace(CONFIG, training=c.TrainingConfig(trees=3, segment_starts=2))
    trained, evaluation = pl.run(*sources, config)
    assert _overlapping(calls) == {"fit_classifiers", "cross_validate", "fit_segments_by_k"}
    assert [k for k in ks if k] == [[2, 3]]
    apart = pl.train(trained.prepared, config)
    assert np.allclose(apart.segmentation.centres, trained.segmentation.centres, rtol=0, atol=1e-9)
    again = pl.evaluate(apart, config)
    for one, two in ((evaluation.comparison, again.comparison), (evaluation.silhouette, again.silhouette)):
        columns = [n for n, t in one.dtypes if t != "double"]
        assert one.select(columns).exceptAll(two.select(columns)).isEmpty()
    for k, found in {r["k"]: r["silueta"] for r in evaluation.silhouette.collect()}.items():
        assert abs(found - again.silhouette.where(F.col("k") == k).first()["silueta"]) < 1e-9


def test_large_tables_are_validated_with_fewer_fits_at_once(spark, monkeypatch):
    rows = spark.range(120).selectExpr(
        "id", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 5 AS DOUBLE) AS y", f"CAST(id % 2 AS INT) AS {c.TARGET}",
        f"CAST(id % 4 AS INT) AS {c.FOLD}").persist()
    workers, pool = [], md.ThreadPoolExecutor
    monkeypatch.setattr(md, "ThreadPoolExecutor", lambda n: workers.append(n) or pool(n))
    only, config = {c.LOGISTIC: md.logistic_regression}, c.EvaluationConfig(folds=4)
    found = []
    for most in (md._ROWS_AT_ONCE, 360, 1):
        monkeypatch.setattr(md, "_ROWS_AT_ONCE", most)
        scored = md.cross_validate(rows, ["x", "y"], config, classifiers=only)
        found.append(sorted(map(tuple, scored.collect())))
    assert workers == [8, 3, 2] and found[0] == found[1] == found[2]
