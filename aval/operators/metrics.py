"""Classification metrics over a long table ``(modelo, real, prediccion, probabilidad)``.

Every function takes all models at once: one scan, whatever the number of models.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError
from aval.functions.values import col

# The notes attached to special cases: no approval predicted (precision is 0), one class only (no AUC).
NO_APPROVALS = "sin_aprobaciones"
ONE_CLASS = "una_clase"


def confusion(df: DataFrame, keys: list[str], label: str = c.TARGET,
              prediction: str = c.PREDICTION) -> DataFrame:
    """True/false negatives and positives per key. Rows without a label or prediction are
    an error, as unequal lengths are: they cannot be compared."""
    real, said = col(label), col(prediction)
    unpaired = F.raise_error(F.lit("labels and predictions must be paired for every row"))
    said = F.when(real.isNull() | said.isNull(), unpaired.cast("int")).otherwise(said)
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.count_if((real == 0) & (said == 0)).alias("verdaderos_negativos"),
        F.count_if((real == 0) & (said == 1)).alias("falsos_positivos"),
        F.count_if((real == 1) & (said == 0)).alias("falsos_negativos"),
        F.count_if((real == 1) & (said == 1)).alias("verdaderos_positivos"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0/0 is 0."""
    tn, fp = F.col("verdaderos_negativos"), F.col("falsos_positivos")
    fn, tp = F.col("falsos_negativos"), F.col("verdaderos_positivos")

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return counts.withColumns({
        "exactitud": share(tn + tp, tn + fp + fn + tp),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    })


def _score_cuts(df: DataFrame, score: str, buckets: int) -> list[float]:
    """Quantiles that split the scores into runs of similar size: at most ``buckets`` numbers."""
    steps = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(col(score), steps, 10_000).alias("q")).first()
    return sorted(set(row["q"] or []))


def _bucketed(df: DataFrame, score: str, cuts: list[float], name: str) -> DataFrame:
    """Number the run of scores that each row falls in."""
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=score, outputCol=name).transform(df)


def score_steps(df: DataFrame, label: str = c.TARGET, score: str = c.PROBABILITY,
                model: str = c.MODEL, buckets: int | None = None) -> DataFrame:
    """Per model and distinct score: its positives and negatives, and those scored higher.

    The running totals of a ranking normally need one ordered task per model. Scores are cut
    at their quantiles instead; totals per bucket are cumulated over a table of at most
    models x buckets rows, and each bucket is then ordered on its own. Equal scores are
    counted together first, so a score shared by most rows is one row here. A missing score or
    label is an error: leaving the row out would change the area silently.
    """
    # A cut list of this length stays a small literal at any number of rows.
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(buckets, 2), 5_000)
    unranked = F.raise_error(F.lit("every row needs a label and a score to be ranked"))
    absent = col(label).isNull() | col(score).isNull()
    scored = df.select(
        col(model).alias("m"),
        F.when(absent, unranked.cast("double")).otherwise(col(score).cast("double")).alias("s"),
        col(label).alias("y"),
    )
    scored = _bucketed(scored, "s", _score_cuts(scored, "s", buckets), "b")
    counts = [F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n")]
    steps = scored.groupBy("m", "b", "s").agg(*counts)
    higher = W.partitionBy("m").orderBy(F.desc("b"))
    whole = W.partitionBy("m")
    # Summed from the steps, so both branches read the same shuffle.
    per_bucket = steps.groupBy("m", "b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    totals = per_bucket.select(
        "m", "b",
        (F.sum("p").over(higher) - F.col("p")).alias("p_before"),
        (F.sum("n").over(higher) - F.col("n")).alias("n_before"),
        F.sum("p").over(whole).alias("p_total"), F.sum("n").over(whole).alias("n_total"),
    )
    inside = W.partitionBy("m", "b").orderBy(F.desc("s"))
    return steps.join(F.broadcast(totals), ["m", "b"]).select(
        F.col("m").alias(model), F.col("s").alias("umbral"),
        F.col("p").alias("positivos"), F.col("n").alias("negativos"),
        (F.col("p_before") + F.sum("p").over(inside)).alias("positivos_acumulados"),
        (F.col("n_before") + F.sum("n").over(inside)).alias("negativos_acumulados"),
        "p_total", "n_total",
    )


def auc(df: DataFrame, label: str = c.TARGET, score: str = c.PROBABILITY,
        model: str = c.MODEL, buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per model, ties sharing their rank; NULL if one class."""
    above = F.col("positivos_acumulados") - F.col("positivos")
    won = F.col("negativos") * (above + F.col("positivos") / 2)
    possible = F.max("p_total").cast("double") * F.max("n_total")
    return score_steps(df, label, score, model, buckets).groupBy(model).agg(
        F.try_divide(F.sum(won.cast("double")), possible).alias("auc_roc")
    )


def roc_points(df: DataFrame, label: str = c.TARGET, score: str = c.PROBABILITY,
               model: str = c.MODEL, buckets: int | None = None) -> DataFrame:
    """ROC curve per model: one point per distinct score plus the origin; none if one class."""
    steps = score_steps(df, label, score, model, buckets).filter(
        (F.col("p_total") > 0) & (F.col("n_total") > 0)
    )
    points = steps.select(
        model, "umbral",
        (F.col("negativos_acumulados") / F.col("n_total")).alias("tasa_falsos_positivos"),
        (F.col("positivos_acumulados") / F.col("p_total")).alias("tasa_verdaderos_positivos"),
    )
    origin = points.select(model).distinct().select(
        model, F.lit(float("inf")).alias("umbral"),
        F.lit(0.0).alias("tasa_falsos_positivos"), F.lit(0.0).alias("tasa_verdaderos_positivos"),
    )
    return points.unionByName(origin)


def roc_curve(df: DataFrame, tolerance: float = 0.001, label: str = c.TARGET,
              score: str = c.PROBABILITY, model: str = c.MODEL,
              buckets: int | None = None) -> DataFrame:
    """ROC curve per model in a number of points that does not follow the scores.

    The way along the curve, both rates together, is cut into ``1 / (2 * tolerance)`` cells; the
    first and the last point of each stay. What is left out of a cell lies in the rectangle between
    these two, so the area under the curve changes by less than ``tolerance`` and no point of the
    exact curve is farther from the kept one than four times that. At most ``1 / tolerance + 3`` points a model.
    """
    if not 0 < tolerance <= 0.5:
        raise EvaluationError("the tolerance of a ROC curve lies above 0 and up to 0.5")
    cells = math.ceil(1 / (2 * tolerance))
    way = F.col("tasa_falsos_positivos") + F.col("tasa_verdaderos_positivos")
    point = F.struct("umbral", "tasa_falsos_positivos", "tasa_verdaderos_positivos")
    ends = roc_points(df, label, score, model, buckets).groupBy(
        model, F.floor(way * F.lit(cells / 2)).alias("celda")
    ).agg(F.max_by(point, "umbral").alias("first"), F.min_by(point, "umbral").alias("last"))
    return ends.select(model, F.inline(F.array_distinct(F.array("first", "last"))))


def classification_metrics(df: DataFrame, label: str = c.TARGET, prediction: str = c.PREDICTION,
                           score: str | None = c.PROBABILITY, model: str = c.MODEL,
                           buckets: int | None = None) -> DataFrame:
    """One row per model: the four rates, AUC, confusion counts and notes on special cases."""
    result = rates(confusion(df, [model], label, prediction))
    one_class = (
        (F.col("verdaderos_positivos") + F.col("falsos_negativos") == 0)
        | (F.col("verdaderos_negativos") + F.col("falsos_positivos") == 0)
    )
    notes = [F.when(
        F.col("verdaderos_positivos") + F.col("falsos_positivos") == 0, F.lit(NO_APPROVALS)
    )]
    if score is not None:
        # Two tables with one row per model.
        result = result.join(F.broadcast(auc(df, label, score, model, buckets)), model, "left")
        notes.append(F.when(one_class, F.lit(ONE_CLASS)))
    else:
        result = result.withColumn("auc_roc", F.lit(None).cast("double"))
    return result.withColumn("notas", F.array_compact(F.array(*notes))).select(
        model, *c.METRICS, "auc_roc", "verdaderos_negativos", "falsos_positivos",
        "falsos_negativos", "verdaderos_positivos", "notas",
    )


def confusion_cells(metrics: DataFrame, model: str = c.MODEL) -> DataFrame:
    """Report table: the four cells per model with their share of all rows."""
    # Class names of the cells.
    no, yes = "No aprobado", "Aprobado"
    cells = [
        (no, no, "verdaderos_negativos"), (no, yes, "falsos_positivos"),
        (yes, no, "falsos_negativos"), (yes, yes, "verdaderos_positivos"),
    ]
    total = reduce(lambda a, b: a + b, [F.col(n) for _, _, n in cells])
    return metrics.select(model, F.inline(F.array(*[
        F.struct(
            F.lit(real).alias("real"), F.lit(said).alias("predicho"), F.col(n).alias("clientes"),
            F.try_divide(F.col(n).cast("double"), total).alias("proporcion"),
        ) for real, said, n in cells
    ])))


POSITION = "posicion"


def with_position(df: DataFrame, names: list[str], model: str = c.MODEL) -> DataFrame:
    """Add the place of each model in ``names``, the order of training: it decides ties."""
    places = F.array(*map(F.lit, names)).cast("array<string>")
    return df.withColumn(POSITION, F.array_position(places, F.col(model)))


def fewest_false_positives(metrics: DataFrame, position: str | None = None,
                           model: str = c.MODEL) -> DataFrame:
    """The model with the fewest false positives; the first one on a tie."""
    tie = F.col(position) if position else F.col(model)
    return metrics.agg(
        F.min_by(model, F.struct(F.col("falsos_positivos"), tie)).alias(model),
        F.min("falsos_positivos").alias("falsos_positivos"),
    )


def fold_summary(df: DataFrame, label: str = c.TARGET, prediction: str = c.PREDICTION,
                 model: str = c.MODEL, fold: str = c.FOLD) -> DataFrame:
    """Mean and population deviation of the four rates over folds: one row per model."""
    per_fold = rates(confusion(df, [model, fold], label, prediction))
    measures = []
    for m in c.METRICS:
        measures += [F.avg(m).alias(f"{m}_cv"), F.stddev_pop(m).alias(f"{m}_cv_std")]
    return per_fold.groupBy(model).agg(*measures)


def compare_models(metrics: DataFrame, summary: DataFrame, model: str = c.MODEL) -> DataFrame:
    """Test and cross-validation results side by side, one row per model."""
    test = metrics.select(
        model, *[F.col(m).alias(f"{m}_prueba") for m in c.METRICS],
        F.col("auc_roc").alias("auc_prueba"),
    )
    return test.join(summary, model)


# The criterion names are fixed values.
def recommend(comparison: DataFrame, simplest: str = c.LOGISTIC, position: str | None = None,
              thresholds: c.ChartThresholds | None = None, model: str = c.MODEL) -> DataFrame:
    """The recommended model, what decided it and how firm the choice is.

    Highest cross-validated precision, then F1, then the simplest model. The ranking compares
    exact values while the stated criterion uses a tie tolerance. The list holds one entry
    per model.
    """
    thresholds = thresholds or c.ChartThresholds()
    order = -F.col(position) if position else F.lit(0)
    candidate = F.struct(
        F.col("precision_cv"), F.col("f1_cv"), (F.col(model) == simplest).alias("simple"),
        order.alias("orden"), F.col(model).alias("nombre"), F.col("precision_cv_std"),
        F.col("recall_cv"),
    )
    ranked = comparison.agg(F.sort_array(F.collect_list(candidate), asc=False).alias("r"))
    best, second = F.get(F.col("r"), F.lit(0)), F.get(F.col("r"), F.lit(1))
    alone = F.size("r") == 1
    gap = F.abs(best["precision_cv"] - second["precision_cv"])
    return ranked.select(
        best["nombre"].alias(model),
        F.when(alone, "unico_modelo")
        .when(gap > thresholds.tie, "precision_cv")
        .when(F.abs(best["f1_cv"] - second["f1_cv"]) > thresholds.tie, "f1_cv")
        .otherwise("simplicidad").alias("criterio"),
        F.when(alone, False).otherwise(
            gap >= F.greatest(best["precision_cv_std"], second["precision_cv_std"])
        ).alias("diferencia_significativa"),
        second["nombre"].alias("segundo"),
        best["precision_cv"].alias("precision_cv"),
        (best["recall_cv"] < thresholds.low_recall).alias("recall_bajo"),
    )


def require_models(models: dict) -> None:
    if not models:
        raise EvaluationError("there are no classifiers to evaluate")
