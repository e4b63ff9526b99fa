"""The tables behind the report, in report order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aval import config as c
from aval.functions.values import col
from aval.operators import aggregate as ag
from aval.operators import metrics as mt
from aval.operators import quality as q
from aval.operators import segments as sg
from aval.operators.cleaning import clean_bureau, clean_history, clean_profile
from aval.operators.merge import score_vs_income
from aval.operators.models import top_importances
from aval.plans.pipeline import Evaluation, Trained
from aval.sources.files import write_table


def quality_tables(profile: DataFrame, history: DataFrame, bureau: DataFrame,
                   config: c.PipelineConfig | None = None) -> dict[str, DataFrame]:
    """Missing values, problems and totals of each source, before and after cleaning."""
    config = config or c.PipelineConfig()
    stages = {
        c.PROFILE_SOURCE: (profile, clean_profile(profile, config.cleaning)),
        c.HISTORY_SOURCE: (history, clean_history(history, config.cleaning)),
        c.BUREAU_SOURCE: (bureau, clean_bureau(bureau)),
    }
    tables = {}
    for source, (raw, clean) in stages.items():
        before = q.quality_report(raw, source, config.cleaning)
        after = q.quality_report(clean, source, config.cleaning)
        tables[f"calidad_{source}_faltantes"] = q.missing_by_stage(before, after)
        tables[f"calidad_{source}_problemas"] = q.problems_by_stage(before, after)
        tables[f"calidad_{source}_totales"] = q.quality_totals(before, after)
    return tables


def scatter_tables(profile: DataFrame, bureau: DataFrame) -> dict[str, DataFrame]:
    """Point tables of clean sources: credits against score, score against income, housing."""
    return {
        "creditos_vs_score": bureau.select(col(c.CREDITS), col(c.SCORE)),
        "score_vs_ingreso": score_vs_income(bureau, profile),
        "tipo_vivienda": ag.housing_counts(profile),
    }


def exploratory_tables(clients: DataFrame,
                       config: c.PipelineConfig | None = None) -> dict[str, DataFrame]:
    config = config or c.PipelineConfig()
    with_target = ag.correlation_with_target(clients, thresholds=config.charts)
    return {
        "distribucion_clases": ag.class_distribution(clients, config.charts),
        "correlaciones": ag.correlation_matrix(clients),
        "correlaciones_excluidas": ag.uncorrelated_columns(clients),
        "correlaciones_principales": ag.top_correlations(with_target),
        "correlacion_aprobacion": with_target.orderBy("r", "variable"),
        "correlacion_extremos": ag.correlation_extremes(with_target),
    }


def model_tables(trained: Trained, evaluation: Evaluation,
                 config: c.PipelineConfig | None = None) -> dict[str, DataFrame]:
    tolerance = (config or c.PipelineConfig()).evaluation.roc_tolerance
    return {
        "metricas": evaluation.metrics,
        "comparacion": evaluation.comparison,
        "recomendacion": evaluation.recommendation,
        "matriz_confusion": mt.confusion_cells(evaluation.metrics),
        "menos_falsos_positivos": mt.fewest_false_positives(
            mt.with_position(evaluation.metrics, list(trained.classifiers.models)), mt.POSITION),
        "curva_roc": (mt.roc_curve(evaluation.predictions, tolerance) if tolerance
                      else mt.roc_points(evaluation.predictions)),
        "importancia": evaluation.importances,
        "importancia_principales": top_importances(evaluation.importances),
        "predicciones_prueba": trained.classifiers.prediction_table(trained.prepared.test),
    }


def segment_tables(trained: Trained, evaluation: Evaluation) -> dict[str, DataFrame]:
    spark = trained.segments.sparkSession
    plane = sg.fit_plane(trained.segments, trained.segmentation.variables)
    mapped = plane.project(trained.segments).select(
        c.ID, c.SEGMENT, *[f"c{j + 1}" for j in range(len(plane.components))]
    )
    return {
        "silueta": evaluation.silhouette,
        "perfiles_segmentos": evaluation.profiles,
        "centros_segmentos": trained.segmentation.centres_table(spark),
        "tamanos_segmentos": sg.segment_sizes(trained.segments, trained.segmentation.k),
        "pca_segmentos": mapped,
        "pca_centros": sg.plane_centres(mapped),
        "pca_varianza": plane.explained_table(spark),
    }


def report_tables(profile: DataFrame, history: DataFrame, bureau: DataFrame, trained: Trained,
                  evaluation: Evaluation, config: c.PipelineConfig | None = None
                  ) -> dict[str, DataFrame]:
    """All report tables by name."""
    config = config or c.PipelineConfig()
    clients = trained.prepared.clients.drop(c.SPLIT)
    return {
        **quality_tables(profile, history, bureau, config),
        **scatter_tables(clean_profile(profile, config.cleaning), clean_bureau(bureau)),
        **exploratory_tables(clients, config),
        **model_tables(trained, evaluation, config),
        **segment_tables(trained, evaluation),
    }


def write_report(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Write every table under its own folder, in order, and return the folders."""
    written = []
    for name, table in tables.items():
        target = f"{path}/{name}"
        flat = table
        if fmt == "csv":
            nested = [n for n, t in table.dtypes if t.startswith(("array", "map", "struct"))]
            flat = table.withColumns({n: F.to_json(col(n)) for n in nested}) if nested else table
        write_table(flat, target, fmt)
        written.append(target)
    return written
