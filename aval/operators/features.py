"""Feature preparation learned on the training rows only and applied as projections."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval import config as c
from aval.errors import InvalidTrainingDataError, PreparationError
from aval.functions.statistics import exact_medians, modes, value_counts
from aval.functions.values import col, is_numeric, nan_to_null, without_nan
from aval.operators.aggregate import column_facts

_NOT_FEATURES = (c.ID, c.TARGET, c.SPLIT, c.FOLD, c.SEQ)

# Why a column is not a model input.
CONSTANT = "constante"
EMPTY = "sin valores en entrenamiento"
SINGLE_CURRENCY = "moneda única (MXN)"


def _number(df: DataFrame, name: str) -> Column:
    return without_nan(col(name).cast("double"), T.DoubleType())


# --- Learning ------------------------------------------------------------------------------


def learn_imputation(train: DataFrame, names: list[str],
                     config: c.PreparationConfig | None = None,
                     counts: dict[str, int] | None = None
                     ) -> tuple[dict[str, object], list[str]]:
    """``(fill values, columns without any value)``: median of numbers, mode of texts.

    ``counts`` saves a scan when the non-missing values per column are already known.
    """
    config = config or c.PreparationConfig()
    if counts is None:
        counts = {n: found for n, (found, _) in column_facts(train, names).items()}
    filled = [n for n in names if counts[n]]
    numbers = {n: counts[n] for n in filled if is_numeric(train.schema[n].dataType)}
    texts = [n for n in filled if n not in numbers]
    fills: dict[str, object] = exact_medians(train, numbers, config.exact_median_rows)
    if texts:
        fills.update({r["columna"]: r["moda"] for r in modes(value_counts(train, texts)).collect()})
    return {n: fills[n] for n in filled}, [n for n in names if not counts[n]]


def learn_categories(train: DataFrame, texts: list[str], limit: int = 1_000) -> dict[str, list[str]]:
    """Sorted categories of each text column; one that exceeds ``limit`` is an error.

    Each category becomes a column, so the count is checked before anything is fetched.
    """
    if not texts:
        return {}
    counts = value_counts(train, texts)
    sizes = {r["columna"]: r["categorias"] for r in modes(counts).collect()}
    wide = [n for n in texts if sizes.get(n, 0) > limit]
    if wide:
        raise PreparationError(
            f"too many categories to encode as columns (limit {limit}): "
            + ", ".join(f"{n} has {sizes[n]}" for n in wide)
        )
    found: dict[str, list[str]] = {n: [] for n in texts}
    for r in counts.select("columna", "valor").collect():
        found[r["columna"]].append(r["valor"])
    return {n: sorted(v) for n, v in found.items()}


def learn_scaling(train: DataFrame, numbers: list[str],
                  fills: dict[str, object]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each non-binary column, on imputed values; zero
    deviation becomes 1. One aggregation for all columns."""
    if not numbers:
        return {}
    measures = []
    for i, n in enumerate(numbers):
        raw = _number(train, n)
        value = F.coalesce(raw, F.lit(fills[n])) if n in fills else raw
        measures += [
            F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}"),
            F.coalesce(F.bool_and(value.isin(0.0, 1.0)), F.lit(True)).alias(f"b{i}"),
        ]
    row = train.agg(*measures).first()
    return {
        n: (row[f"m{i}"], row[f"s{i}"] or 1.0)
        for i, n in enumerate(numbers) if not row[f"b{i}"]
    }


# --- Applying ------------------------------------------------------------------------------


def impute(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Fill missing values with the learned ones."""
    return nan_to_null(df).withColumns({
        n: F.coalesce(col(n), F.lit(v)) for n, v in fills.items()
    })


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """Replace each text column by ``<column>_<category>`` 0/1 columns, after the others.

    A category not seen in training gives 0 everywhere.
    """
    rest = [col(n) for n in df.columns if n not in categories]
    encoded = [
        col(n).eqNullSafe(F.lit(value)).cast("int").alias(f"{n}_{value}")
        for n, values in categories.items() for value in values
    ]
    return df.select(*rest, *encoded)


def scale(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / deviation`` with the learned parameters."""
    return df.withColumns({n: (col(n) - F.lit(m)) / F.lit(s) for n, (m, s) in scaling.items()})


@dataclass(frozen=True)
class FeatureModel:
    """Learned parameters of the preparation: a few values per column."""

    numbers: list[str]
    texts: list[str]
    dropped: dict[str, str]
    fills: dict[str, object]
    categories: dict[str, list[str]]
    scaling: dict[str, tuple[float, float]]
    variables: list[str] = field(default_factory=list)

    @property
    def inputs(self) -> list[str]:
        return [*self.numbers, *self.texts]

    def _complete(self, df: DataFrame) -> DataFrame:
        """Absent input columns become missing ones."""
        absent = {
            n: F.lit(None).cast("double" if n in self.numbers else "string")
            for n in self.inputs if n not in df.columns
        }
        return df.withColumns(absent) if absent else df

    def transform(self, df: DataFrame, keep: tuple[str, ...] = (c.ID, c.TARGET, c.SPLIT)) -> DataFrame:
        """The model variables, in training order, next to the ``keep`` columns present."""
        df = self._complete(df)
        columns = []
        for n in self.numbers:
            value = F.coalesce(_number(df, n), F.lit(float(self.fills[n])))
            if n in self.scaling:
                mean, deviation = self.scaling[n]
                value = (value - F.lit(mean)) / F.lit(deviation)
            columns.append(value.alias(n))
        for n in self.texts:
            value = F.coalesce(col(n).cast("string"), F.lit(self.fills[n]))
            columns += [
                F.when(value == F.lit(v), 1.0).otherwise(0.0).alias(f"{n}_{v}")
                for v in self.categories[n]
            ]
        return df.select(*[col(n) for n in keep if n in df.columns], *columns)

    def imputed_flags(self, df: DataFrame) -> DataFrame:
        """Add ``imputados``: which inputs of the row were missing, in input order."""
        df = self._complete(df)
        missing = [
            F.when(without_nan(col(n), df.schema[n].dataType).isNull(), F.lit(n))
            for n in self.inputs
        ]
        return df.withColumn(
            "imputados", F.array_compact(F.array(*missing)).cast("array<string>")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the parameters as one JSON line."""
        text = json.dumps(asdict(self), ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        raw = json.loads(spark.read.text(path).first()["value"])
        raw["scaling"] = {n: tuple(v) for n, v in raw["scaling"].items()}
        return FeatureModel(**raw)


def fit_features(df: DataFrame, config: c.PreparationConfig | None = None,
                 dropped: dict[str, str] | None = None) -> FeatureModel:
    """Learn the whole preparation from the rows whose ``split`` is train (all if absent).

    Three aggregations when every column is a number: counts and variation, medians, moments.
    """
    config = config or c.PreparationConfig()
    train = df.filter(col(c.SPLIT) == c.TRAIN) if c.SPLIT in df.columns else df
    train = nan_to_null(train)
    candidates = [n for n in train.columns if n not in _NOT_FEATURES]
    facts = column_facts(train, candidates)
    varying = [n for n in candidates if facts[n][1]]
    removed = {**(dropped or {}), **{n: CONSTANT for n in candidates if not facts[n][1]}}
    fills, empty = learn_imputation(train, varying, config, {n: facts[n][0] for n in varying})
    removed.update({n: EMPTY for n in empty})
    used = [n for n in varying if n in fills]
    numbers = [n for n in used if is_numeric(train.schema[n].dataType)]
    texts = [n for n in used if n not in numbers]
    categories = learn_categories(train, texts, config.max_categories)
    scaling = learn_scaling(train, numbers, fills)
    variables = numbers + [f"{n}_{v}" for n in texts for v in categories[n]]
    return FeatureModel(numbers, texts, removed, fills, categories, scaling, variables)


# --- Model inputs --------------------------------------------------------------------------


def check_inputs(df: DataFrame, variables: list[str]) -> None:
    """Fail unless the variables exist, are numeric, complete and there is at least one row."""
    absent = [n for n in variables if n not in df.columns]
    if absent:
        raise InvalidTrainingDataError(f"columns differ from training: {', '.join(absent)} absent")
    for n in variables:
        if not is_numeric(df.schema[n].dataType):
            raise InvalidTrainingDataError(f"column '{n}' is not numeric")
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count(without_nan(col(n), df.schema[n].dataType)).alias(f"n{i}")
            for i, n in enumerate(variables)
        ],
    ).first()
    if not row["rows"]:
        raise InvalidTrainingDataError("the table is empty")
    for i, n in enumerate(variables):
        if row[f"n{i}"] < row["rows"]:
            raise InvalidTrainingDataError(f"column '{n}' has missing values")


def check_same_columns(found: list[str], variables: list[str]) -> None:
    """Fail unless both lists have the same names in the same order."""
    if list(found) != list(variables):
        raise InvalidTrainingDataError("columns differ from those used in training")


def assemble(df: DataFrame, variables: list[str], name: str = "features") -> DataFrame:
    """Add the feature vector that MLlib reads."""
    return df.withColumn(
        name, array_to_vector(F.array(*[col(n).cast("double") for n in variables]))
    )
