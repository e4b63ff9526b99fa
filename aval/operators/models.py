"""The two classifiers: fitting, prediction, cross-validation and importance."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, InvalidTrainingDataError, NotTrainedError
from aval.functions.values import col
from aval.operators.features import FeatureModel, assemble, check_inputs, check_same_columns
from aval.operators.forest import PackedForest
from aval.operators.split import assign_folds, class_counts
from aval.session import materialise


def logistic_regression(rows: int, config: c.TrainingConfig) -> LogisticRegression:
    """L2-regularised logistic regression.

    MLlib averages the loss over rows, so an inverse strength C on the summed loss becomes
    ``1 / (C * rows)``; inputs are already scaled, so MLlib must not standardise again.
    """
    return LogisticRegression(
        featuresCol="features", labelCol=c.TARGET, maxIter=config.max_iterations, tol=1e-8,
        regParam=1.0 / (config.inverse_regularisation * rows), elasticNetParam=0.0,
        standardization=False,
    )


def random_forest(rows: int, config: c.TrainingConfig) -> PackedForest:
    """Random forest with the usual square-root feature sampling.

    ``PackedForest`` grows the trees with a few scans; ``cacheNodeIds`` says how MLlib itself would.
    """
    return PackedForest(
        featuresCol="features", labelCol=c.TARGET, numTrees=config.trees,
        maxDepth=config.tree_depth, maxBins=config.tree_bins, featureSubsetStrategy="sqrt",
        minInstancesPerNode=config.min_instances_per_node, seed=config.seed, maxMemoryInMB=1024,
        cacheNodeIds=True,
    )


#: Name -> function(rows, config) -> Estimator. Add an entry to train another MLlib classifier.
CLASSIFIERS = {c.LOGISTIC: logistic_regression, c.FOREST: random_forest}

@dataclass
class Classifiers:
    """Fitted classifiers over the same variables."""

    variables: list[str] = field(default_factory=list)
    models: dict[str, Model] = field(default_factory=dict)
    estimators: dict[str, Estimator] = field(default_factory=dict)

    def _ready(self, df: DataFrame) -> DataFrame:
        if not self.models:
            raise NotTrainedError("fit the classifiers before predicting")
        found = [n for n in df.columns if n in self.variables]
        check_same_columns(found, self.variables)
        return assemble(df, self.variables)

    def predict_wide(self, df: DataFrame) -> DataFrame:
        """``df`` plus, per model, its prediction and probability of approval. A projection."""
        scored = self._ready(df)
        for i, model in enumerate(self.models.values()):
            scored = apply_model(model, scored, f"_prediction{i}", f"_probability{i}")
        return scored.drop("features")

    def predict(self, df: DataFrame, keep: tuple[str, ...] = (c.ID, c.TARGET)) -> DataFrame:
        """Long form, one row per input row and model; the input is read once."""
        scored = self.predict_wide(df)
        kept = [n for n in keep if n in df.columns]
        return scored.select(*[col(n) for n in kept], F.inline(F.array(*[
            F.struct(
                F.lit(name).alias(c.MODEL),
                F.col(f"_prediction{i}").alias(c.PREDICTION),
                F.col(f"_probability{i}").alias(c.PROBABILITY),
            ) for i, name in enumerate(self.models)
        ])))

    def prediction_table(self, df: DataFrame) -> DataFrame:
        """One row per client: id, real label and each model's prediction and probability."""
        scored = self.predict_wide(df)
        columns = [
            part for i, name in enumerate(self.models) for part in (
                F.col(f"_prediction{i}").alias(f"{name} (pred)"),
                F.col(f"_probability{i}").alias(f"{name} (prob)"),
            )
        ]
        return scored.select(col(c.ID), col(c.TARGET).alias("real"), *columns)

    def save(self, path: str) -> None:
        for i, model in enumerate(self.models.values()):
            model.write().overwrite().save(f"{path}/model-{i}")

    @staticmethod
    def load(path: str, names: list[str], variables: list[str]) -> "Classifiers":
        """Any saved MLlib classifier: its own metadata name the class."""
        session = SparkSession.getActiveSession()
        models = {
            name: DefaultParamsReader.loadParamsInstance(f"{path}/model-{i}", session)
            for i, name in enumerate(names)
        }
        return Classifiers(variables, models)


def apply_model(model: Model, df: DataFrame, prediction: str, probability: str) -> DataFrame:
    """Add a 0/1 prediction and the probability of class 1."""
    model = model.copy()
    model.setPredictionCol("_p").setProbabilityCol("_v").setRawPredictionCol("")
    return model.transform(df).withColumns({
        prediction: F.col("_p").cast("int"), probability: vector_to_array("_v")[1],
    }).drop("_p", "_v")


def fit_classifiers(train: DataFrame, variables: list[str], config: c.TrainingConfig | None = None,
                    classifiers: dict | None = None, parallel: int = 2) -> Classifiers:
    """Fit every classifier on the (cached) prepared training rows."""
    config = config or c.TrainingConfig()
    check_inputs(train, variables)
    counts = class_counts(train.filter(col(c.TARGET).isNotNull()), c.TARGET)
    rows = sum(counts.values())
    if len(counts) < 2:
        raise InvalidTrainingDataError(f"two classes are needed to train, found {sorted(counts)}")
    if rows != train.count():
        raise InvalidTrainingDataError("some training rows have no label")
    data = assemble(train, variables).select("features", c.TARGET)
    makers = classifiers or CLASSIFIERS
    estimators = {name: make(rows, config) for name, make in makers.items()}
    with ThreadPoolExecutor(parallel) as pool:
        fitted = list(pool.map(lambda e: e.fit(data), estimators.values()))
    return Classifiers(list(variables), dict(zip(estimators, fitted)), estimators)


_ROWS_AT_ONCE = 3_000_000  # of all fits of a cross-validation that run together


def cross_validate(train: DataFrame, variables: list[str], config: c.EvaluationConfig | None = None,
                   training: c.TrainingConfig | None = None, classifiers: dict | None = None,
                   learn: Callable[[DataFrame], FeatureModel] | None = None,
                   learn_folds: Callable[[DataFrame], dict[int, FeatureModel]] | None = None
                   ) -> DataFrame:
    """Out-of-fold predictions of freshly fitted copies: long ``(modelo, fold, label, prediccion)``.

    Folds are a column of the one cached table; each fit is a distributed job on a filter of
    it, a few at a time (fewer of large tables), and its held-out rows are scored and stored as soon as it ends.
    With ``learn``, ``train`` holds rows before their preparation, and every fold applies the
    preparation that ``learn`` makes of its training part to both of its parts; ``learn_folds``
    makes those of all folds from the table with its folds at once.
    """
    config = config or c.EvaluationConfig()
    training = training or c.TrainingConfig()
    if c.FOLD not in train.columns:
        train = assign_folds(train, config.folds, seed=config.seed)
    # Each MLlib fit caches its own input; here the (cached) rows are only projected.
    learned = learn_folds(train) if learn_folds else {}
    if learn is None and not learned:
        train = assemble(train, variables).select("features", c.TARGET, c.FOLD)
    sizes = class_counts(train, c.FOLD)
    rows = sum(sizes.values())
    makers = classifiers or CLASSIFIERS

    def parts_of(f: int) -> tuple[DataFrame, DataFrame]:
        parts = train.filter(F.col(c.FOLD) != f), train.filter(F.col(c.FOLD) == f)
        if learn is None and not learned:
            return parts
        features = learned[f] if learned else learn(parts[0])
        return tuple(
            assemble(features.transform(part, (c.TARGET, c.FOLD)), features.variables)
            .select("features", c.TARGET, c.FOLD) for part in parts)

    def fit(job):
        name, make, f = job
        fitted_on, held_out = divided[f]
        model = make(rows - sizes.get(f, 0), training).fit(fitted_on)
        # A task gets one model; scored together, each task would get those of all folds.
        return materialise(apply_model(model, held_out, c.PREDICTION, c.PROBABILITY).select(
            F.lit(name).alias(c.MODEL), c.FOLD, c.TARGET, c.PREDICTION, c.PROBABILITY
        ), "fold-scores")

    jobs = [(name, make, f) for name, make in makers.items() for f in range(config.folds)]
    # Every fit keeps its own form of its rows, so there are fewer at once of large tables.
    at_once = min(config.parallel_fits, max(2, _ROWS_AT_ONCE // max(1, rows)))
    with ThreadPoolExecutor(at_once) as pool:
        divided = list(pool.map(parts_of, range(config.folds)))
        parts = list(pool.map(fit, jobs))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def feature_importance(name: str, model: Model, variables: list[str],
                       spark: SparkSession) -> DataFrame:
    """Signed coefficient or impurity importance per variable: one row per variable."""
    if hasattr(model, "coefficients"):
        values = model.coefficients.toArray()
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        raise EvaluationError(f"model '{name}' exposes neither coefficients nor importances")
    rows = [
        (name, i, n, float(v), abs(float(v)), n in c.RULE_FEATURES)
        for i, (n, v) in enumerate(zip(variables, values))
    ]
    return spark.createDataFrame(
        rows, f"{c.MODEL} string, posicion int, variable string, valor double, "
              "magnitud double, de_la_regla boolean"
    )


def importances(fitted: Classifiers, spark: SparkSession) -> DataFrame:
    """All models' importances, largest magnitude first, original order on a tie."""
    tables = [
        feature_importance(name, model, fitted.variables, spark)
        for name, model in fitted.models.items()
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result.orderBy(c.MODEL, F.desc("magnitud"), "posicion")


def top_importances(table: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` leading variables per model and how many of them belong to the rule.

    The table has one row per model and variable.
    """
    entry = F.struct((-F.col("magnitud")).alias("m"), "posicion", "variable", "de_la_regla")
    top = F.slice(F.sort_array(F.collect_list(entry)), 1, n)
    ranked = table.groupBy(c.MODEL).agg(top.alias("t"))
    return ranked.select(
        c.MODEL, F.transform("t", lambda e: e["variable"]).alias("principales"),
        F.size(F.filter("t", lambda e: e["de_la_regla"])).alias("de_la_regla"),
    )
