"""Data-quality profiling of a source, before or after cleaning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import MissingColumnsError, UnknownSourceError, ValidationError
from aval.functions.values import col, nan_to_null, tolerant_number

# The indicator names of the comparison table.
ROWS = "Filas"
DUPLICATES = "Duplicados"
REPEATED_IDS = "IDs repetidos"
ATYPICAL_AGES = "Edades atípicas"
MISSING_COLUMNS = "Columnas faltantes"
MISSING_PREFIX = "Faltantes: "


def require_columns(df: DataFrame, source: str) -> DataFrame:
    """Fail when expected columns of ``source`` are absent, naming them in contract order."""
    absent = [name for name in _expected(source) if name not in df.columns]
    if absent:
        raise MissingColumnsError(f"source '{source}' lacks columns: {', '.join(absent)}")
    return df


def _expected(source: str) -> tuple[str, ...]:
    if source not in c.SOURCE_COLUMNS:
        known = ", ".join(c.SOURCE_COLUMNS)
        raise UnknownSourceError(f"unknown source '{source}'; known sources: {known}")
    return c.SOURCE_COLUMNS[source]


@dataclass(frozen=True)
class QualityReport:
    """A lazy one-row report of one source.

    ``frame`` has ``rows``, ``duplicates``, ``repeated_ids`` and ``atypical_ages`` (NULL where
    they do not apply), ``missing_columns``, ``extra_columns``, ``valid_structure``, and one
    ``missing`` map with the missing count of every column present.
    """

    source: str
    columns: tuple[str, ...]
    types: dict[str, str]
    frame: DataFrame

    def by_column(self) -> DataFrame:
        """One row per column present: position, name, type and missing count."""
        types = F.map_from_arrays(
            F.array(*[F.lit(n) for n in self.types]),
            F.array(*[F.lit(t) for t in self.types.values()]),
        )
        names = F.array(*[F.lit(n) for n in self.types])
        return self.frame.select(
            F.posexplode(names).alias("posicion", "columna"), "missing"
        ).select(
            "posicion",
            "columna",
            types[F.col("columna")].alias("tipo"),
            F.col("missing")[F.col("columna")].alias("faltantes"),
        )

    def indicators(self) -> DataFrame:
        """Long form: one row per indicator, missing counts included."""
        single = [
            (ROWS, F.col("rows")),
            (DUPLICATES, F.col("duplicates")),
            (REPEATED_IDS, F.col("repeated_ids")),
            (ATYPICAL_AGES, F.col("atypical_ages")),
            (MISSING_COLUMNS, F.size("missing_columns").cast("long")),
        ] + [(MISSING_PREFIX + n, F.col("missing")[F.lit(n)]) for n in self.columns]
        return self.frame.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("orden"),
                            F.lit(name).alias("indicador"),
                            value.alias("valor"),
                        )
                        for i, (name, value) in enumerate(single)
                    ]
                )
            )
        )


def quality_report(df: DataFrame, source: str, config: c.CleaningConfig | None = None,
                   ignore: tuple[str, ...] = (c.SEQ,)) -> QualityReport:
    """Profile ``df`` in one scan; dirty data is counted, never an error.

    Three shrinking aggregations: identical rows collapse first (already inside the map tasks,
    so a row copied many times travels once per task), then ids, then one global row. Grouping
    by the whole row also spreads an id that owns a large share of the table.
    """
    expected = _expected(source)
    config = config or c.CleaningConfig()
    data = nan_to_null(df.drop(*ignore))
    names = data.columns
    types = dict(df.drop(*ignore).dtypes)
    has_ids = source in (c.PROFILE_SOURCE, c.BUREAU_SOURCE) and c.ID in names
    has_ages = source == c.PROFILE_SOURCE and c.AGE in names

    def missing(i: int) -> str:
        return f"_missing_{i}"

    copies = F.col("_copies")
    counts: list[Column] = [
        F.sum(copies).alias("rows"),
        F.sum(copies - 1).alias("duplicates"),
        *[
            F.sum(F.when(col(n).isNull(), copies).otherwise(0)).alias(missing(i))
            for i, n in enumerate(names)
        ],
    ]
    carried = ["rows", "duplicates"] + [missing(i) for i in range(len(names))]
    if has_ages:
        odd = ~tolerant_number(data, c.AGE).between(config.min_age, config.max_age)
        counts.append(F.sum(F.when(odd, copies).otherwise(0)).alias("atypical_ages"))
        carried.append("atypical_ages")

    rows = data.groupBy(*[col(n) for n in names]).agg(F.count(F.lit(1)).alias("_copies"))
    if has_ids:
        per_id = rows.groupBy(col(c.ID)).agg(*counts)
        total = per_id.agg(
            *[F.sum(n).alias(n) for n in carried], F.count(F.lit(1)).alias("_ids")
        )
    else:
        total = rows.agg(*counts)

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("long")

    absent = [n for n in expected if n not in names]
    extra = [n for n in names if n not in expected]
    none = F.lit(None).cast("long")
    frame = total.select(
        F.lit(source).alias("source"),
        number("rows").alias("rows"),
        number("duplicates").alias("duplicates"),
        (number("rows") - F.col("_ids") if has_ids else none).alias("repeated_ids"),
        (number("atypical_ages") if has_ages else none).alias("atypical_ages"),
        F.array(*[F.lit(n) for n in absent]).cast("array<string>").alias("missing_columns"),
        F.array(*[F.lit(n) for n in extra]).cast("array<string>").alias("extra_columns"),
        F.lit(not absent).alias("valid_structure"),
        F.create_map(
            *[part for i, n in enumerate(names) for part in (F.lit(n), number(missing(i)))]
        ).cast("map<string,bigint>").alias("missing"),
    )
    return QualityReport(source, tuple(names), types, frame)


def compare_quality(before: QualityReport, after: QualityReport) -> DataFrame:
    """Indicators side by side; those that do not apply, or are missing nowhere, are left out."""
    if before.source != after.source:
        raise ValidationError(
            f"cannot compare reports of '{before.source}' and '{after.source}'"
        )
    left = before.indicators().withColumnsRenamed({"valor": "antes", "orden": "_left"})
    right = after.indicators().withColumnsRenamed({"valor": "después", "orden": "_right"})
    is_missing_count = F.col("indicador").startswith(MISSING_PREFIX)
    was, now = F.col("antes"), F.col("después")
    return (
        left.join(right, "indicador", "full")
        .withColumn("antes", F.when(is_missing_count, F.coalesce(was, F.lit(0))).otherwise(was))
        .withColumn("después", F.when(is_missing_count, F.coalesce(now, F.lit(0))).otherwise(now))
        .filter(
            F.when(is_missing_count, (was > 0) | (now > 0)).otherwise(
                was.isNotNull() | now.isNotNull()
            )
        )
        .select(
            F.coalesce(F.col("_left"), F.col("_right") + 1000).alias("orden"),
            "indicador",
            "antes",
            "después",
        )
    )


def missing_by_stage(before: QualityReport, after: QualityReport) -> DataFrame:
    """Report table: missing values per column and stage, for columns missing at either."""
    table = compare_quality(before, after).filter(F.col("indicador").startswith(MISSING_PREFIX))
    name = F.substr(F.col("indicador"), F.lit(len(MISSING_PREFIX) + 1))
    return _by_stage(table.withColumn("columna", name), "columna", "faltantes")


def problems_by_stage(before: QualityReport, after: QualityReport) -> DataFrame:
    """Report table: duplicates and atypical ages per stage."""
    table = compare_quality(before, after).filter(
        F.col("indicador").isin(DUPLICATES, ATYPICAL_AGES)
    ).withColumn("después", F.coalesce(F.col("después"), F.lit(0)))
    return _by_stage(table.withColumn("problema", F.col("indicador")), "problema", "cantidad")


def _by_stage(table: DataFrame, label: str, value: str) -> DataFrame:
    return table.select(
        label,
        F.inline(
            F.array(
                F.struct(F.lit("Antes").alias("momento"), F.col("antes").alias(value)),
                F.struct(F.lit("Después").alias("momento"), F.col("después").alias(value)),
            )
        ),
    )


def quality_totals(before: QualityReport, after: QualityReport) -> DataFrame:
    """Report table: total missing before and after, removed duplicates, atypical ages."""
    def missing_total(report: QualityReport, name: str) -> DataFrame:
        total = F.aggregate(
            F.map_values("missing"), F.lit(0).cast("long"), lambda a, b: a + b
        )
        return report.frame.select(
            "source", "rows", "duplicates", "atypical_ages", total.alias("missing_total")
        ).select([F.col(n).alias(n if n == "source" else f"{name}_{n}") for n in (
            "source", "rows", "duplicates", "atypical_ages", "missing_total")])

    return missing_total(before, "before").join(missing_total(after, "after"), "source").select(
        "source",
        "before_rows",
        "before_missing_total",
        "after_missing_total",
        (F.col("before_duplicates") - F.col("after_duplicates")).alias("removed_duplicates"),
        F.coalesce("before_atypical_ages", F.lit(0)).alias("atypical_ages"),
    )
