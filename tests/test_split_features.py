import math

import pytest
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, InvalidTrainingDataError, PreparationError
from aval.operators import features as ft
from aval.operators import split as sp


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(135).selectExpr(
        "concat('C', id) as ID_Cliente", "if(id % 3 = 0, 1, 0) as credito_aprobado")


def sides(df):
    return {(r["ID_Cliente"], r["split"]) for r in df.collect()}


def test_split_is_exact_and_stratified(people):
    counts = {(r[0], r[1]): r[2] for r in
              sp.stratified_split(people).groupBy("credito_aprobado", "split").count().collect()}
    assert counts == {(1, "test"): 9, (0, "test"): 18, (1, "train"): 36, (0, "train"): 72}


def test_split_does_not_depend_on_layout(people):
    one = sides(sp.stratified_split(people.coalesce(1)))
    many = sides(sp.stratified_split(people.repartition(8, F.rand(3))))
    assert one == many != sides(sp.stratified_split(people, seed=7))


@pytest.mark.parametrize("counts, size", [({0: 88, 1: 47}, 0.2), ({0: 5, 1: 5, 2: 5}, 0.33), ({0: 2, 1: 999}, 0.1)])
def test_quotas_add_up(counts, size):
    quotas = sp.quotas_for_test(counts, size)
    total = sum(counts.values())
    wanted = math.ceil(round(size * total, 9))
    assert sum(quotas.values()) == wanted
    assert all(abs(quotas[k] - wanted * n / total) < 1 for k, n in counts.items())


def test_folds_are_disjoint_covering_and_even(people):
    folds = sp.assign_folds(people.repartition(5), 5)
    counts = {(r[0], r[1]): r[2] for r in folds.groupBy("credito_aprobado", "fold").count().collect()}
    assert set(counts) == {(k, f) for k in (0, 1) for f in range(5)}
    assert {counts[(0, f)] for f in range(5)} == {18} and {counts[(1, f)] for f in range(5)} == {9}


def test_small_classes_are_errors(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "ID_Cliente string, credito_aprobado int")
    with pytest.raises(PreparationError, match="class 1"):
        sp.stratified_split(df)
    with pytest.raises(EvaluationError):
        sp.assign_folds(df, 2)


def test_a_measurement_is_not_a_class(spark):
    df = spark.range(3000).selectExpr("id as ID_Cliente", "id as credito_aprobado")
    with pytest.raises(PreparationError, match="not a class"):
        sp.stratified_split(df)


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame([
        ("1", "train", 1, 1.0, 0, "b", "k", 5.0, None), ("2", "train", 0, None, 1, "a", "k", 5.0, None),
        ("3", "train", 1, 3.0, 1, None, "k", None, None), ("4", "train", 0, 8.0, 0, "a", "k", 5.0, None),
        ("5", "test", 0, 100.0, 1, "zzz", "other", 9.0, 4.0), ("6", "test", 1, float("nan"), None, None, "k", 5.0, 1.0)],
        "ID_Cliente string, split string, credito_aprobado int, x double, flag int, word string, "
        "fixed string, same double, empty double")


def test_preparation_learns_from_train_only(mixed):
    model = ft.fit_features(mixed, dropped={"Moneda": "moneda única (MXN)"})
    assert model.dropped == {"Moneda": "moneda única (MXN)", "fixed": "constante", "same": "constante",
                             "empty": "constante"}
    assert model.fills == {"x": 3.0, "flag": 0.5, "word": "a"}
    assert model.categories == {"word": ["a", "b"]}
    assert model.variables == ["x", "flag", "word_a", "word_b"]
    mean, deviation = model.scaling["x"]
    assert mean == 3.75 and abs(deviation - math.sqrt(((1 - 3.75) ** 2 + 2 * 0.75 ** 2 + 4.25 ** 2) / 4)) < 1e-12
    assert "flag" not in model.scaling  # binary columns keep their scale
    rows = {r["ID_Cliente"]: r for r in model.transform(mixed).collect()}
    assert (rows["5"]["word_a"], rows["5"]["word_b"]) == (0.0, 0.0)  # unseen category
    assert rows["6"]["x"] == (3.0 - mean) / deviation and rows["6"]["word_a"] == 1.0
    flags = {r["ID_Cliente"]: r["imputados"] for r in model.imputed_flags(mixed).collect()}
    assert flags["6"] == ["x", "flag", "word"] and flags["1"] == [] and flags["3"] == ["word"]


def test_absent_input_columns_are_imputed(mixed):
    model = ft.fit_features(mixed)
    row = model.transform(mixed.drop("x", "word").filter("ID_Cliente = '1'")).first()
    mean, deviation = model.scaling["x"]
    assert row["x"] == (3.0 - mean) / deviation and row["word_a"] == 1.0


def test_saved_preparation_is_the_same(spark, mixed, tmp_path):
    model = ft.fit_features(mixed)
    model.save(spark, str(tmp_path / "features"))
    assert ft.FeatureModel.load(spark, str(tmp_path / "features")) == model


def test_standalone_steps(mixed):
    train = mixed.filter("split = 'train'")
    fills, empty = ft.learn_imputation(train, ["x", "word", "empty"])
    assert fills == {"x": 3.0, "word": "a"} and empty == ["empty"]
    filled = ft.impute(mixed.select("ID_Cliente", "x", "word"), fills)
    assert filled.filter("x is null or word is null").count() == 0
    encoded = ft.one_hot(filled, {"word": ["a", "b"]})
    assert encoded.columns == ["ID_Cliente", "x", "word_a", "word_b"]
    scaled = ft.scale(filled, {"x": (3.0, 2.0)}).filter("ID_Cliente = '4'").first()
    assert scaled["x"] == 2.5
    with pytest.raises(PreparationError, match="word has 2"):
        ft.learn_categories(train, ["word"], limit=1)


def test_inputs_are_checked(spark):
    ok = spark.createDataFrame([(1.0, 2)], "a double, b int")
    ft.check_inputs(ok, ["a", "b"])
    cases = [(ok.filter("a > 9"), "empty"), (ok.withColumn("b", F.lit("t")), "not numeric"),
             (ok.withColumn("a", F.lit(float("nan"))), "missing"), (ok.drop("a"), "absent")]
    for df, message in cases:
        with pytest.raises(InvalidTrainingDataError, match=message):
            ft.check_inputs(df, ["a", "b"])
    with pytest.raises(InvalidTrainingDataError):
        ft.check_same_columns(["b", "a"], ["a", "b"])
