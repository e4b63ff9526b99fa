import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import PreparationError
from aval.operators import features as ft
from aval.operators import models as md
from aval.operators.folds import fit_features_by_fold
from aval.operators.sparse import SparseFeatures, category_index, fit_sparse_features

SCHEMA = ("ID_Cliente string, credito_aprobado int, fold int, x double, whole long, flag int, word string, "
          "once string, held double, empty double")


def table(spark, folds, rows=240):
    rng = random.Random(folds)
    data = []
    for i in range(rows):
        f = i % folds
        data.append((
            f"C{i}", i % 2, f,
            None if rng.random() < 0.2 else float("nan") if rng.random() < 0.05 else rng.gauss(1e6, 3),
            rng.randint(0, 9) if rng.random() < 0.7 else None,
            rng.choice([0, 1, None]), rng.choice(["a", "b", "ñ", None]),
            "only here" if i == 3 else "k", 1.0 if f == 1 else 2.0, None))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("folds, direct", [(2, 1_000_000), (3, 1_000_000), (4, 300)])
def test_folds_at_once_equal_folds_one_by_one(spark, folds, direct):
    df = table(spark, folds)
    config = c.PreparationConfig(exact_median_rows=direct)
    learned = fit_features_by_fold(df, config=config, dropped={"Moneda": "m"})
    assert sorted(learned) == list(range(folds))
    for f, model in learned.items():
        alone = ft.fit_features(df.filter(F.col("fold") != f), dropped={"Moneda": "m"})
        assert (model.numbers, model.texts, model.variables) == (alone.numbers, alone.texts, alone.variables)
        assert model.fills == alone.fills and model.categories == alone.categories
        assert model.dropped == alone.dropped and list(model.scaling) == list(alone.scaling)
        for n, pair in model.scaling.items():
            assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(pair, alone.scaling[n]))


def test_jobs_do_not_grow_with_the_folds(spark):
    used = []
    for folds in (3, 12):
        df = table(spark, folds).repartition(4)
        spark.sparkContext.setJobGroup(f"folds-{folds}", "")
        fit_features_by_fold(df)
        used.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{folds}")))
    spark.sparkContext.setJobGroup("rest", "")
    assert used[0] == used[1] > 0


def test_rows_without_a_fold_and_too_many_folds(spark):
    df = table(spark, 3)
    more = df.union(df.limit(5).withColumn("fold", F.lit(None).cast("int")).withColumn("x", F.lit(-1e9)))
    assert fit_features_by_fold(more)[0].fills == fit_features_by_fold(df)[0].fills
    with pytest.raises(PreparationError, match="no folds"):
        fit_features_by_fold(df, "ID_Cliente", c.PreparationConfig(max_classes=100))
    with pytest.raises(PreparationError, match="word has 3"):
        fit_features_by_fold(df, config=c.PreparationConfig(max_categories=2))
    assert fit_features_by_fold(df.limit(0)) == {}


def test_sparse_vectors_equal_the_columns(spark):
    df = table(spark, 5).withColumn("split", F.when(F.col("fold") == 4, "test").otherwise("train"))
    df = df.withColumn("word", F.when(F.col("ID_Cliente") == "C4", "unseen").otherwise(F.col("word")))
    wide = ft.fit_features(df)
    sparse = fit_sparse_features(df)
    assert sparse.size == len(wide.variables)
    names = [F.col(f"`{n}`") for n in wide.variables]
    want = {r[0]: list(r[1]) for r in wide.transform(df).select("ID_Cliente", F.array(*names)).collect()}
    got = sparse.transform(df)
    assert got.columns == ["ID_Cliente", "credito_aprobado", "split", "features"]
    assert {r[0]: r[1] for r in got.select("ID_Cliente", vector_to_array("features")).collect()} == want
    unseen = [r for r in sparse.pairs(df, "ID_Cliente").collect() if r[0] == "C4"]
    assert len(unseen) == len(sparse.texts) - 1


def test_index_is_consecutive_on_any_layout(spark):
    df = table(spark, 5)
    rows = [tuple(r) for r in category_index(df, ["word", "once"], 3).orderBy("indice").collect()]
    assert rows == [("word", "a", 3), ("word", "b", 4), ("word", "ñ", 5), ("once", "k", 6), ("once", "only here", 7)]
    again = category_index(df.repartition(7), ["word", "once"], 3).orderBy("indice").collect()
    assert [tuple(r) for r in again] == rows
    assert category_index(df.limit(0), ["word"]).count() == 0


def test_fifty_thousand_categories_train_a_regression(spark, tmp_path):
    df = spark.range(100_000).selectExpr(
        "concat('C', id) as ID_Cliente", "if(id % 50000 < 20000, 1, 0) as credito_aprobado",
        "cast(id % 7 as double) as x", "concat('k', id % 50000) as code")
    learned = fit_sparse_features(df)
    assert learned.size == 50_001
    learned.save(str(tmp_path / "sparse"))
    loaded = SparseFeatures.load(spark, str(tmp_path / "sparse"))
    assert (loaded.fills, loaded.scaling, loaded.size) == (learned.fills, learned.scaling, learned.size)
    data = loaded.transform(df).persist()
    estimator = md.logistic_regression(100_000, c.TrainingConfig(inverse_regularisation=100.0, max_iterations=15))
    model = estimator.fit(data)
    assert model.coefficients.size == 50_001
    answers = md.apply_model(model, data, "p", "q")
    assert answers.filter("p = credito_aprobado").count() > 99_000
    data.unpersist()
