import math
import random

import pytest

from aval import config as c
from aval.errors import EvaluationError
from aval.operators import metrics as mt

SCHEMA = "modelo string, credito_aprobado int, prediccion int, probabilidad double"


def frame(spark, model, triples):
    return spark.createDataFrame([(model, y, p, s) for y, p, s in triples], SCHEMA)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [2, 3, 50])
def test_auc_with_ties_and_skew_equals_brute_force(spark, buckets):
    rng = random.Random(5)
    data = {}
    for model in ("m1", "m2"):
        # A third of the rows share one score; the others crowd into a narrow range.
        scores = [0.5 if i % 3 == 0 else round(1e-4 * rng.random(), 6) for i in range(300)]
        data[model] = [(rng.randint(0, 1), s) for s in scores]
    df = frame(spark, "m1", [(y, 0, s) for y, s in data["m1"]]).union(
        frame(spark, "m2", [(y, 0, s) for y, s in data["m2"]])).repartition(4)
    found = {r["modelo"]: r["auc_roc"] for r in mt.auc(df, buckets=buckets).collect()}
    for model, pairs in data.items():
        assert math.isclose(found[model], brute_auc(pairs), rel_tol=1e-12)
    points = mt.roc_points(df.filter("modelo = 'm1'"), buckets=buckets).orderBy(
        "tasa_falsos_positivos", "tasa_verdaderos_positivos").collect()
    area = sum((b[2] - a[2]) * (a[3] + b[3]) / 2 for a, b in zip(points, points[1:]))
    assert math.isclose(area, found["m1"], rel_tol=1e-12)
    assert len(points) == len({s for _, s in data["m1"]}) + 1


@pytest.mark.parametrize("tolerance", [0.25, 0.01, 0.001])
def test_short_curve_keeps_the_area(spark, tolerance):
    rng = random.Random(3)
    # A long tie in the middle, a steep start and many different scores.
    rows = [(int(rng.random() < 0.9), 0, 2 + rng.random()) for _ in range(1500)] + [
        (i % 2, 0, 1.5) for i in range(700)] + [(int(rng.random() < 0.2), 0, rng.random()) for _ in range(1500)]
    df = frame(spark, "m", rows)
    exact = mt.auc(df).first()["auc_roc"]
    points = sorted((r[2], r[3], -r[1]) for r in mt.roc_curve(df, tolerance).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert abs(area - exact) < tolerance and len(points) <= 1 / tolerance + 3
    assert points[0] == (0.0, 0.0, -math.inf) and points[-1][:2] == (1.0, 1.0)
    assert set(points) <= {(r[2], r[3], -r[1]) for r in mt.roc_points(df).collect()}


def test_curve_without_a_model_or_tolerance(spark):
    assert mt.roc_curve(frame(spark, "m", [(1, 1, 0.9)]).limit(0)).count() == 0
    with pytest.raises(EvaluationError):
        mt.roc_curve(frame(spark, "m", [(1, 1, 0.9)]), 0)


def test_metrics_and_notes(spark):
    df = frame(spark, "a", [(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)]).union(
        frame(spark, "b", [(1, 0, 0.2), (0, 0, 0.1)])).union(frame(spark, "c", [(1, 1, 0.9), (1, 1, 0.8)]))
    rows = {r["modelo"]: r for r in mt.classification_metrics(df).collect()}
    a, b, one = rows["a"], rows["b"], rows["c"]
    assert (a["exactitud"], a["precision"], a["recall"], a["f1"], a["auc_roc"]) == (0.5, 0.5, 0.5, 0.5, 0.75)
    assert a["notas"] == [] and b["precision"] == 0.0 and b["notas"] == [mt.NO_APPROVALS]
    assert one["auc_roc"] is None and one["notas"] == [mt.ONE_CLASS] and one["precision"] == 1.0
    assert mt.roc_points(df.filter("modelo = 'c'")).count() == 0
    assert mt.fewest_false_positives(mt.classification_metrics(df)).first()["modelo"] == "b"
    cells = {(r["real"], r["predicho"]): r["clientes"] for r in
             mt.confusion_cells(mt.classification_metrics(df)).filter("modelo = 'a'").collect()}
    assert set(cells.values()) == {1}


def test_unpaired_rows_are_an_error(spark):
    df = frame(spark, "a", [(1, None, 0.9)])
    with pytest.raises(Exception, match="paired"):
        mt.confusion(df, ["modelo"]).collect()


def comparison(spark, rows):
    return spark.createDataFrame(
        rows, "modelo string, precision_cv double, f1_cv double, precision_cv_std double, recall_cv double, pos int")


def choose(spark, rows):
    return mt.recommend(comparison(spark, rows), position="pos").first()


def test_recommendation_criteria(spark):
    row = choose(spark, [(c.LOGISTIC, 0.6, 0.9, 0.05, 0.4, 0), (c.FOREST, 0.8, 0.1, 0.1, 0.4, 1)])
    assert (row["modelo"], row["criterio"], row["diferencia_significativa"], row["segundo"], row["recall_bajo"]) == (
        c.FOREST, "precision_cv", True, c.LOGISTIC, True)
    row = choose(spark, [(c.LOGISTIC, 0.8, 0.5, 0.05, 0.6, 0), (c.FOREST, 0.8, 0.6, 0.1, 0.6, 1)])
    assert (row["modelo"], row["criterio"], row["diferencia_significativa"]) == (c.FOREST, "f1_cv", False)
    row = choose(spark, [(c.FOREST, 0.8, 0.5, 0.0, 0.6, 0), (c.LOGISTIC, 0.8, 0.5, 0.0, 0.6, 1)])
    assert (row["modelo"], row["criterio"], row["diferencia_significativa"]) == (c.LOGISTIC, "simplicidad", True)
    row = choose(spark, [(c.FOREST, 0.8, 0.5, 0.0, 0.6, 0)])
    assert (row["criterio"], row["diferencia_significativa"], row["segundo"]) == ("unico_modelo", False, None)


def test_ranking_is_exact_but_criterion_is_tolerant(spark):
    """A difference below the tolerance still ranks first, yet is not named as the criterion."""
    row = choose(spark, [(c.LOGISTIC, 0.8, 0.5, 0.0, 0.6, 0), (c.FOREST, 0.8 + 1e-12, 0.4, 0.0, 0.6, 1)])
    assert (row["modelo"], row["criterio"]) == (c.FOREST, "f1_cv")


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame(
        [("m", 0, 1, 1), ("m", 0, 0, 0), ("m", 1, 1, 0), ("m", 1, 0, 0)],
        "modelo string, fold int, credito_aprobado int, prediccion int")
    row = mt.fold_summary(df).first()
    assert (row["exactitud_cv"], row["exactitud_cv_std"]) == (0.75, 0.25)
    assert (row["precision_cv"], row["recall_cv_std"]) == (0.5, 0.5)


def test_missing_scores_and_labels_are_an_error(spark):
    for row in ((1, 1, None), (None, 1, 0.5)):
        df = frame(spark, "a", [(1, 1, 0.9), (0, 0, 0.1), row])
        with pytest.raises(Exception, match="label and a score"):
            mt.auc(df).collect()


def test_ties_go_to_the_model_trained_first(spark):
    df = frame(spark, "z", [(1, 1, 0.9), (0, 1, 0.8)]).union(frame(spark, "a", [(1, 1, 0.9), (0, 1, 0.8)]))
    placed = mt.with_position(mt.classification_metrics(df), ["z", "a"])
    assert mt.fewest_false_positives(placed, mt.POSITION).first()["modelo"] == "z"
