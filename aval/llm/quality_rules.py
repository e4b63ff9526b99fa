"""Learned decision lists: ordered threshold rules over text statistics.

``text_statistics`` counts per document. ``learn_rules`` grows each rule on one part of the
labelled rows, condition by condition, prunes it on the other part and removes what it covers
before the next (sequential covering). ``DecisionList.verdict`` is the list as one Spark
conditional expression, so applying it is a projection.

Edge cases: null or empty texts have zero in every count and zero rates. Rows without a label,
or with one other than 0 or 1, are not learned from; a document with several labels counts with
its lowest. Without labelled rows of both classes the list is empty and keeps everything.
Repeated documents get one row each. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval.llm.words import (
    covered,
    find_words,
    numbered,
    per_text,
    smallest_hashes,
    window_ranks,
)

_SPACE = " \t\n\x0b\x0c\r"
STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_marks long, n_digits long"
)


def _codes(chars: str) -> list[int]:
    return [ord(c) for c in chars]


_SPACES, _SYMBOLS, _MARKS = _codes(_SPACE), _codes("#*$%&|<>"), _codes("!?;:")


def _statistics(text: str | None, window: int) -> tuple:
    words = find_words(text or "")
    if not words:
        return (0,) * 9
    raw = text.encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    repeated = 0
    if len(words) > window:
        ranks = window_ranks(numbered(words), window)
        twice = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
        repeated = int(covered(twice, window, len(words)).sum()) if len(twice) else 0
    return (
        len(words), len(text) - int(seen[_SPACES].sum()), int(seen[_SYMBOLS].sum()),
        len(lines) - len(set(lines)), repeated, len(lines), int(seen[65:91].sum()),
        int(seen[_MARKS].sum()), int(seen[48:58].sum()),
    )


def text_statistics(docs: DataFrame, keep: list[str], window: int = 5) -> DataFrame:
    """``keep`` and the counts of ``STATISTICS`` for every whole text."""
    return per_text(docs, keep, STATISTICS, lambda text: _statistics(text, window))


def _rate(count: str, of: str) -> Column:
    return F.coalesce(F.try_divide(100.0 * F.col(count), F.col(of)), F.lit(0.0))


def features() -> dict[str, Column]:
    """The measures that conditions compare, by name."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _rate("word_chars", "n_words"),
        "symbol_rate": _rate("n_symbols", "n_words"),
        "repeated_line_rate": _rate("n_dup_lines", "n_lines"),
        "repeated_word_rate": _rate("n_repeat_words", "n_words"),
        "upper_rate": _rate("n_upper", "word_chars"),
        "mark_rate": _rate("n_marks", "n_words"),
        "digit_rate": _rate("n_digits", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column > self.threshold if self.above else column <= self.threshold

    def expression(self) -> Column:
        column = features()[self.feature]
        return column > self.threshold if self.above else column <= self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first whose conditions all hold rejects, else the text is kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rule_number(self) -> Column:
        """Number of the first rule that holds, from 1; 0 when none does."""
        chain = None
        for number, rule in enumerate(self.rules, 1):
            test = rule[0].expression()
            for condition in rule[1:]:
                test = test & condition.expression()
            chain = F.when(test, number) if chain is None else chain.when(test, number)
        return (F.lit(0) if chain is None else chain.otherwise(0)).cast("int")

    def verdict(self) -> Column:
        return self.rule_number() == 0

    def __str__(self) -> str:
        return "\n".join(
            " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:g}" for c in rule)
            for rule in self.rules)


def _all(rule, values, size):
    hit = np.ones(size, bool)
    for condition in rule:
        hit &= condition.holds(values)
    return hit


def _grow(values, bad, open_rows, thresholds, longest):
    """Add the condition with the best FOIL gain until no kept row is covered."""
    rule: list[Condition] = []
    hit = open_rows.copy()
    while len(rule) < longest and (hit & ~bad).any():
        before = np.log2(max((hit & bad).sum(), 1e-9) / hit.sum())
        best, choice = 1e-9, None
        for name, column in values.items():
            cuts = np.unique(np.quantile(column[hit], np.linspace(0, 1, thresholds)))
            for cut in (cuts[:-1] + cuts[1:]) / 2:
                for above in (True, False):
                    now = hit & ((column > cut) if above else (column <= cut))
                    good = (now & bad).sum()
                    if good:
                        gain = good * (np.log2(good / now.sum()) - before)
                        if gain > best:
                            best, choice = gain, Condition(name, above, float(cut))
        if choice is None:
            break
        rule.append(choice)
        hit &= choice.holds(values)
    return rule


def _prune(rule, values, bad, open_rows):
    """The prefix of the rule with the best (p - n) / (p + n) on rows it was not grown on."""
    best, kept = -2.0, rule
    for length in range(1, len(rule) + 1):
        hit = _all(rule[:length], values, len(bad)) & open_rows
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best:
            best, kept = worth, rule[:length]
    return kept


def learn_rules(
    statistics: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 20_000,
    min_precision: float = 0.9, min_covered: int = 5, max_rules: int = 12, max_conditions: int = 4,
    thresholds: int = 33,
) -> DecisionList:
    """Fit on at most ``sample_rows`` labelled documents, those with the smallest id hashes.

    An id counts once, by the smallest of its rows, so repeated ids neither fill the sample nor weigh more.
    The bound is on what the learner sees, not on what the list is applied to. A rule joins the
    list if at least ``min_precision`` of the open rows it covers, in the part it was not grown
    on, are labelled 0, and it covers ``min_covered`` of them.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("_label")))
    measures = [n for n in statistics.columns if n != "doc_id"]
    labelled = statistics.join(known, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("_label", *measures)).alias("_one")).select("doc_id", "_one.*")
    sample = smallest_hashes(labelled, sample_rows, "_label", "n_words", "word_chars")
    rows = sample.select(
        *[c.alias(n) for n, c in features().items()], "_label", F.xxhash64("doc_id").alias("_order")
    ).toPandas()
    bad = rows["_label"].to_numpy() == 0
    if not bad.any() or bad.all():
        return DecisionList()
    values = {name: rows[name].to_numpy(float) for name in features()}
    prune = (rows["_order"].to_numpy() >> 7) % 3 == 0
    open_rows, rules = np.ones(len(bad), bool), []
    while len(rules) < max_rules:
        if not (open_rows & bad & ~prune).any():
            break
        rule = _prune(_grow(values, bad, open_rows & ~prune, thresholds, max_conditions),
                      values, bad, open_rows & prune)
        if not rule:
            break
        hit = _all(rule, values, len(bad)) & open_rows
        p, n = (hit & bad & prune).sum(), (hit & ~bad & prune).sum()
        if (hit & bad).sum() < min_covered or p < min_precision * max(p + n, 1):
            break
        rules.append(tuple(rule))
        open_rows &= ~hit
    return DecisionList(tuple(rules))
