"""Exact statistics whose memory per task stays bounded at any row count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval.functions.values import col, without_nan

_ACCURACY = 10_000


@dataclass
class _Search:
    """One value being located: the open interval that holds it and what lies below."""

    name: str
    rank: int
    size: int
    where: Column | None = None
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def inside(self, value: Column) -> Column:
        kept = value.isNotNull() if self.where is None else value.isNotNull() & self.where
        if self.low is not None:
            kept = kept & (value > self.low)
        if self.high is not None:
            kept = kept & (value < self.high)
        return F.when(kept, value)


def _within(items: list, sizes: list[int], limit: int) -> list[list]:
    """``items`` in order, in groups whose sizes add up to at most ``limit`` (one item at least)."""
    groups: list[list] = []
    total = 0
    for item, size in zip(items, sizes):
        if not groups or total + size > limit:
            groups.append([])
            total = 0
        groups[-1].append(item)
        total += size
    return groups


def values_at_ranks(df: DataFrame, wanted: list[tuple],
                    direct_rows: int = 1_000_000) -> list[float]:
    """The exact values at 0-based ``rank`` of each ``(column, rank, non-missing count)``.

    A fourth element is the condition on the rows among which the rank counts.
    While more than ``direct_rows`` candidates remain, an approximate quantile sketch proposes
    a bracket and an exact count decides which side of it holds the rank, so each round
    shrinks the candidates thousands of times whatever the distribution or the number of
    equal values. All columns advance together: two scans per round. At the end columns share a
    scan as long as their candidates together stay within ``direct_rows``, so the buffers of the
    last step are bounded by it, however many columns there are.
    """
    searches = [_Search(*one) for one in wanted]

    def value(s: _Search) -> Column:
        return without_nan(col(s.name), df.schema[s.name].dataType).cast("double")

    while True:
        wide = [s for s in searches if s.answer is None and s.size > direct_rows]
        if not wide:
            break
        margin = 2.0 / _ACCURACY
        proposals = df.agg(*[
            F.percentile_approx(
                s.inside(value(s)),
                [max(0.0, s.rank / s.size - margin), min(1.0, (s.rank + 1) / s.size + margin)],
                _ACCURACY,
            ).alias(f"p{i}")
            for i, s in enumerate(wide)
        ]).first()
        brackets = [tuple(proposals[f"p{i}"]) for i in range(len(wide))]
        counts = []
        for i, (s, (a, b)) in enumerate(zip(wide, brackets)):
            v = s.inside(value(s))
            counts += [
                F.count_if(v < a).alias(f"below{i}"), F.count_if(v == a).alias(f"at_a{i}"),
                F.count_if((v > a) & (v < b)).alias(f"between{i}"),
                F.count_if((v == b) & (v > a)).alias(f"at_b{i}"),
            ]
        found = df.agg(*counts).first()
        for i, (s, (a, b)) in enumerate(zip(wide, brackets)):
            below, at_a = found[f"below{i}"], found[f"at_a{i}"]
            between, at_b = found[f"between{i}"], found[f"at_b{i}"]
            if s.rank < below:
                s.high, s.size = a, below
            elif s.rank < below + at_a:
                s.answer = a
            elif s.rank < below + at_a + between:
                s.low, s.high, s.rank, s.size = a, b, s.rank - below - at_a, between
            elif s.rank < below + at_a + between + at_b:
                s.answer = b
            else:
                passed = below + at_a + between + at_b
                s.low, s.rank, s.size = b, s.rank - passed, s.size - passed
    narrow = [s for s in searches if s.answer is None]
    for group in _within(narrow, [s.size for s in narrow], direct_rows):
        # The half step keeps the position clear of rounding at either neighbour.
        shares = [(s.rank + 0.5) / s.size for s in group]
        candidates = df.select(*[s.inside(value(s)).alias(f"v{i}") for i, s in enumerate(group)])
        row = candidates.agg(*[
            F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY v{i})").alias(f"r{i}")
            for i, share in enumerate(shares)
        ]).first()
        for i, s in enumerate(group):
            s.answer = row[f"r{i}"]
    return [s.answer for s in searches]


def exact_medians(df: DataFrame, counts: dict[str, int],
                  direct_rows: int = 1_000_000) -> dict[str, float]:
    """Interpolated median of each column; ``counts`` gives its non-missing values (> 0)."""
    if not counts:
        return {}
    if max(counts.values()) <= direct_rows:
        medians: dict[str, float] = {}
        for group in _within(list(counts), list(counts.values()), direct_rows):
            row = df.agg(*[
                F.median(without_nan(col(n), df.schema[n].dataType).cast("double")).alias(f"m{i}")
                for i, n in enumerate(group)
            ]).first()
            medians |= {n: float(row[f"m{i}"]) for i, n in enumerate(group)}
        return medians
    wanted = [
        (n, rank, size) for n, size in counts.items()
        for rank in sorted({(size - 1) // 2, size // 2})
    ]
    found: dict[str, list[float]] = {}
    for (n, _, _), v in zip(wanted, values_at_ranks(df, wanted, direct_rows)):
        found.setdefault(n, []).append(v)
    return {n: sum(v) / len(v) for n, v in found.items()}


def value_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Long ``(columna, valor, n)`` of the non-missing texts of several columns, in one pass."""
    return (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("columna"), col(n).cast("string").alias("valor"))
            for n in names
        ])))
        .filter(F.col("valor").isNotNull())
        .groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent value per column (smallest on a tie) and the number of distinct values.

    Works on the counted values, so no buffer holds a column's whole set of values.
    """
    return counts.groupBy("columna").agg(
        F.min_by("valor", F.struct(-F.col("n"), F.col("valor"))).alias("moda"),
        F.count(F.lit(1)).alias("categorias"),
    )
