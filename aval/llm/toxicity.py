"""Toxicity from confirmed toxic examples and unlabelled text, by non-negative PU learning.

The features are words, and beginnings of words, that are clearly more frequent among the
confirmed examples than in unlabelled text. A numpy linear classifier minimises the risk estimate of positive-unlabelled
data: prior * loss(positive as 1) + max(0, loss(unlabelled as 0) - prior * loss(positive as 0)),
where the second term is the estimated loss on the unseen negatives and may not fall below zero.

The prior, the share of toxic documents, is estimated from the confirmed and the unlabelled
examples alone: where the classifier scores highest nearly all documents are toxic, so the share of unlabelled
ones there over the share of confirmed ones there is the prior.

Edge cases: null and empty texts get the score of a text without any feature. Without a
confirmed example every text gets 0.12; if none of the confirmed ones is among the documents, the labelled
share, below 0.5. A label other than 1 is never read as a negative; repeated labels count once, and a document
is confirmed if any label says 1. Of rows that share an id one is learned from, that whose words come first.
Repeated documents are scored each; texts of any length are read whole; ties of features go by
their words. Other columns are not read, and a column named like the result is replaced. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aval.llm.words import find_letters, per_text, smallest_hashes
from aval.session import discard, materialise

BEGINNINGS = (4, 5)
LABELLED_SHARE = "labelled share"


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -2.0

    def scorer(self):
        whole = {w: v for w, v in self.weights.items() if w[-1] != "*"}
        begun = {n: {w[:-1]: v for w, v in self.weights.items() if w[-1] == "*" and len(w) == n + 1}
                 for n in BEGINNINGS}

        def score(text: str | None) -> tuple[float]:
            words = set(find_letters((text or "").lower()))
            margin = self.bias + sum(whole[w] for w in sorted(whole.keys() & words))
            for size, weights in begun.items():
                found = weights.keys() & {w[:size] for w in words if len(w) > size} if weights else ()
                margin += sum(weights[w] for w in sorted(found))
            return (float(1 / (1 + np.exp(-min(max(margin, -60.0), 60.0)))),)

        return score


def _features(text: str | None) -> tuple[list[str]]:
    """Distinct words, and the beginnings of longer ones with a star."""
    words = set(find_letters((text or "").lower()))
    begun = {f"{w[:n]}*" for n in BEGINNINGS for w in words if len(w) > n}
    return (sorted(words | begun),)


def fit_nnpu(
    rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, features: int, prior: float,
    steps: int = 600, rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias from presence pairs (row, column); ``positive`` marks confirmed rows.

    Sigmoid loss, Adam on the whole sample, weights kept at 0 or above. Where the estimated loss on negatives is below zero
    the step ascends that term instead, which stops it from overfitting.
    """
    p, u = positive, ~positive
    n_p, n_u = max(int(p.sum()), 1), max(int(u.sum()), 1)
    theta = np.zeros(features + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        margin = np.bincount(rows, theta[columns], len(p)) + theta[-1]
        as_one = 1 / (1 + np.exp(np.clip(margin, -40, 40)))  # loss of calling the row 1
        slope = as_one * (1 - as_one)
        negative_risk = (1 - as_one)[u].mean() - prior * (1 - as_one)[p].mean() if u.any() else 0.0
        by_row = np.zeros(len(p))
        if negative_risk >= 0:
            by_row[p] = -prior * slope[p] / n_p - prior * slope[p] / n_p
            by_row[u] = slope[u] / n_u
        else:
            by_row[p] = prior * slope[p] / n_p
            by_row[u] = -slope[u] / n_u
        gradient = np.append(np.bincount(columns, by_row[rows], features), by_row.sum())
        gradient[:-1] += decay * prior * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    return theta[:-1], float(theta[-1])


def estimate_prior(
    rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, features: int, doubt: float = 0.1,
) -> float:
    """The share of toxic rows among the unlabelled ones, without a single negative.

    A classifier fitted on every other row ranks the rest, and the other way round. Among the rows that score
    at least some value, the toxic part of the unlabelled ones is the prior times the share of confirmed rows there;
    so the ratio of the two shares is the prior plus what clean rows add. The value is chosen where the
    ratio and its uncertainty (``doubt``: the chance that a share is further off) are least.
    """
    turn = np.random.default_rng(0).permutation(len(positive)) % 2  # not by place: rows may come in a pattern
    found = []
    for half in (0, 1):
        learn = turn == half
        number, used = np.cumsum(learn) - 1, learn[rows]
        weights, _ = fit_nnpu(number[rows[used]], columns[used], positive[learn], features, 0.3, steps=200)
        margins = np.bincount(rows[~used], weights[columns[~used]], len(positive))
        ranked = [np.sort(margins[~learn & kind]) for kind in (positive, ~positive)]
        if not all(map(len, ranked)):
            continue
        values = np.unique(margins[~learn])
        confirmed, unlabelled = (1 - np.searchsorted(r, values) / len(r) for r in ranked)
        off = sum(np.sqrt(np.log(4 / doubt) / (2 * len(r))) for r in ranked)
        there = confirmed > 0
        best = int(np.argmin((unlabelled[there] + off) / confirmed[there]))
        found.append(unlabelled[there][best] / confirmed[there][best])
    return float(np.mean(found)) if found else 0.5


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column, prior: float | str | None = None,
    max_positive: int = 3_000, max_unlabelled: int = 9_000, max_features: int = 2_000,
    min_documents: int = 4, min_share: float = 0.01, min_z: float = 4.0,
) -> ToxicityModel:
    """Fit on at most ``max_positive`` confirmed and ``max_unlabelled`` unlabelled documents.

    Both are the documents with the smallest id hashes among those where ``usable`` holds, so the
    choice is repeatable and bounded at any size; scoring covers every text. ``prior`` is the
    share of toxic documents; by default it is estimated without negatives, and ``LABELLED_SHARE`` takes that among
    the labelled usable ones. The model has at most ``max_features`` words. A feature needs
    ``min_documents`` confirmed examples, at least ``min_share`` of them, and a difference of
    ``min_z`` standard errors.
    """
    known = labels.where(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return ToxicityModel()
    labelled = counts["toxic"] / counts["n"]

    confirmed = smallest_hashes(known.where("toxic = 1").select("doc_id"), max_positive)
    unlabelled = smallest_hashes(
        docs.where(usable & F.col("doc_id").isNotNull()).select("doc_id").distinct(), max_unlabelled)
    chosen = (
        confirmed.withColumn("positive", F.lit(True))
        .unionByName(unlabelled.withColumn("positive", F.lit(False))))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the limits
    words = materialise(  # rows that repeat an id must not outgrow the limits
        per_text(texts, ["doc_id", "positive"], "words array<string>", _features)
        .groupBy("doc_id", "positive").agg(F.min("words").alias("words")), "toxicity-words")
    sizes = words.agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).first()
    if not sizes["p"] or not sizes["u"]:
        discard(words)
        share = min(max(labelled, 1e-4), 0.49)
        return ToxicityModel(bias=float(np.log(share / (1 - share))))
    p, u = F.col("p") / sizes["p"], F.col("u") / sizes["u"]
    pooled = (F.col("p") + F.col("u")) / (sizes["p"] + sizes["u"])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / sizes["p"] + 1 / sizes["u"]))
    picked = (
        words.select("positive", F.explode("words").alias("word")).groupBy("word")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
        .where((F.col("p") >= min_documents) & (p >= min_share) & (pooled < 1))
        .withColumn("z", (p - u) / spread).where(F.col("z") >= min_z)
        .orderBy(F.desc("z"), "word").limit(max_features).collect())
    names = sorted(r["word"] for r in picked)
    wanted = F.array_intersect("words", F.array(*map(F.lit, names)).cast("array<string>"))
    table = words.select("positive", wanted.alias("words")).orderBy("doc_id", "positive").collect()
    discard(words)
    number = {w: i for i, w in enumerate(names)}
    rows = np.array([i for i, r in enumerate(table) for _ in r["words"]], np.int64)
    columns = np.array([number[w] for r in table for w in r["words"]], np.int64)
    positive = np.array([r["positive"] for r in table], bool)
    if prior is None:
        prior = estimate_prior(rows, columns, positive, len(names))
    share = min(max(labelled if prior == LABELLED_SHARE else float(prior), 1e-4), 0.9)
    weights, bias = fit_nnpu(rows, columns, positive, len(names), share)
    return ToxicityModel(dict(zip(names, weights.tolist())), bias)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, keep: list[str], result: str = "score"
) -> DataFrame:
    """``keep`` and ``result`` for every whole text; a projection."""
    return per_text(docs, keep, f"`{result}` double", model.scorer())
