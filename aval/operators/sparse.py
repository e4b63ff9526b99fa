"""One-hot encoding without a column per category: a table of indexes and sparse vectors."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aval import config as c
from aval.functions.statistics import value_counts
from aval.functions.values import col, is_numeric, nan_to_null, without_nan
from aval.operators.aggregate import column_facts
from aval.operators.features import _NOT_FEATURES, learn_imputation, learn_scaling
from aval.session import materialise
from aval.sources.order import running_totals

_HOLDER = T.StructType([T.StructField("v", VectorUDT())])


def category_index(train: DataFrame, texts: list[str], first: int = 0) -> DataFrame:
    """``(columna, valor, indice)``: the categories of all columns numbered from ``first`` on.

    In the order of ``texts`` and of the values. Categories are counted, dealt in ranges and numbered
    from the totals of ranges, so neither a task nor the driver ever holds them all.
    """
    place = F.array_position(F.array(*map(F.lit, texts)), F.col("columna"))
    found = value_counts(train, texts).select(
        "columna", "valor", place.alias("_place"), F.lit(1).alias("_one"))
    return running_totals(found, ["_place", "valor"], "_one", "_before").select(
        "columna", "valor", (F.col("_before") + first).cast("int").alias("indice"))


@dataclass(frozen=True)
class SparseFeatures:
    """What ``fit_sparse_features`` learned: a few numbers per column and the stored index."""

    numbers: list[str]
    texts: list[str]
    fills: dict[str, object]
    scaling: dict[str, tuple[float, float]]
    index: DataFrame
    size: int

    def _indexed(self, df: DataFrame) -> DataFrame:
        """Add ``_indices``: where a 1 stands for each text column, in the columns' order.

        One join per text column, from the rows' side; Spark broadcasts a column's index while its
        measured size allows it and splits a category that holds many rows otherwise. An unseen
        category has no place.
        """
        for i, n in enumerate(self.texts):
            places = self.index.filter(F.col("columna") == n).select(
                F.col("valor").alias(f"_v{i}"), F.col("indice").alias(f"_i{i}"))
            value = F.coalesce(col(n).cast("string"), F.lit(self.fills[n]))
            df = df.join(places, value == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        found = F.array_compact(F.array(*[F.col(f"_i{i}") for i in range(len(self.texts))]))
        return df.withColumn("_indices", found.cast("array<int>")).drop(
            *[f"_i{i}" for i in range(len(self.texts))])

    def pairs(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and ``indice``: one row per 1 that the categories of a row give."""
        return self._indexed(df).select(*[col(n) for n in keep], F.explode("_indices").alias("indice"))

    def transform(self, df: DataFrame, keep: tuple[str, ...] = (c.ID, c.TARGET, c.SPLIT),
                  name: str = "features") -> DataFrame:
        """The ``keep`` columns present and the sparse vector of numbers, then categories."""
        numbers = []
        for n in self.numbers:
            raw = without_nan(col(n).cast("double"), T.DoubleType())
            value = F.coalesce(raw, F.lit(float(self.fills[n])))
            mean, deviation = self.scaling.get(n, (0.0, 1.0))
            numbers.append((value - F.lit(mean)) / F.lit(deviation))
        rows = self._indexed(df)
        head = F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>")
        vector = F.struct(F.struct(
            F.lit(0).alias("type"), F.lit(self.size).alias("size"),
            F.concat(head, F.col("_indices")).alias("indices"),
            F.concat(F.array(*numbers).cast("array<double>"),
                     F.transform("_indices", lambda _: F.lit(1.0))).alias("values")).alias("v"))
        # The vector type can be read from its fields, which no function builds it from.
        return rows.select(*[col(n) for n in keep if n in df.columns],
                           F.from_json(F.to_json(vector), _HOLDER)["v"].alias(name))

    def save(self, path: str) -> None:
        """Write the parameters and the index."""
        settings = {"numbers": self.numbers, "texts": self.texts, "fills": self.fills,
                    "scaling": self.scaling, "size": self.size}
        spark = self.index.sparkSession
        spark.createDataFrame([(json.dumps(settings, ensure_ascii=False),)], "value string").coalesce(
            1).write.mode("overwrite").text(f"{path}/settings")
        self.index.write.mode("overwrite").parquet(f"{path}/index")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SparseFeatures":
        raw = json.loads(spark.read.text(f"{path}/settings").first()["value"])
        raw["scaling"] = {n: tuple(v) for n, v in raw["scaling"].items()}
        return SparseFeatures(**raw, index=spark.read.parquet(f"{path}/index"))


def fit_sparse_features(df: DataFrame, config: c.PreparationConfig | None = None,
                        dropped: dict[str, str] | None = None) -> SparseFeatures:
    """Learn from the rows whose ``split`` is train (all if absent), as ``fit_features`` does.

    There is no limit on categories: they are a table, not columns.
    """
    config = config or c.PreparationConfig()
    train = nan_to_null(df.filter(col(c.SPLIT) == c.TRAIN) if c.SPLIT in df.columns else df)
    candidates = [n for n in train.columns if n not in _NOT_FEATURES and n not in (dropped or {})]
    facts = column_facts(train, candidates)
    used = [n for n in candidates if facts[n][1]]
    fills, _ = learn_imputation(train, used, config, {n: facts[n][0] for n in used})
    numbers = [n for n in used if is_numeric(train.schema[n].dataType)]
    texts = [n for n in used if n not in numbers]
    scaling = learn_scaling(train, numbers, fills)
    if texts:
        index = materialise(category_index(train, texts, len(numbers)), "category-index")
    else:
        index = df.sparkSession.createDataFrame([], "columna string, valor string, indice int")
    return SparseFeatures(numbers, texts, fills, scaling, index, len(numbers) + index.count())
