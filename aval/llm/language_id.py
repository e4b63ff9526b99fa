"""Language by words first, then by shorter and shorter character n-grams.

A word seen in training is scored by its log frequency in each language. Any other word is
walked left to right: at each place the longest known n-gram counts, 4 characters down to 1.
The scores of all words of a text are summed and turned into a share per language.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is everything
when nothing could be learned. Ties go to the language that sorts first. Rows with a null
language are not learned from. Repeated documents are scored each; texts of any length are read whole,
one at a time. Empty tables give no rows. Other columns are not read; a column with the name of a result
is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aval.llm.words import find_letters, per_text
from aval.session import discard, materialise

UNDETERMINED = "und"
LONGEST = 4
_COUNTS = "lang string, kind int, token string, n long"


def _grams(word: str) -> Iterator[str]:
    padded = f" {word} "
    for size in range(1, LONGEST + 1):
        for at in range(len(padded) - size + 1):
            yield padded[at : at + size]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 0) and n-grams (kind: their length) per language and batch."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            words.setdefault(lang.as_py(), Counter()).update(
                find_letters((text.as_py() or "").lower()))
        for lang, counts in words.items():
            grams: Counter = Counter()
            for word, n in counts.items():
                for gram in _grams(word):
                    grams[gram] += n
            for kinds, table in (([0] * len(counts), counts), (list(map(len, grams)), grams)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(table), pa.string()), pa.array(kinds, pa.int32()),
                     pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())],
                    ["lang", "kind", "token", "n"])


@dataclass
class LanguageModel:
    """Log frequencies: one row of ``scores`` per known token, one column per language."""

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    word_scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    gram_scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def unseen(self, word: str) -> np.ndarray:
        """Mean score of the longest known n-gram at each place; zeros if none is known."""
        padded, rows = f" {word} ", []
        for at in range(len(padded) - 1):
            for size in range(LONGEST, 0, -1):
                row = self.grams.get(padded[at : at + size])
                if row is not None:
                    rows.append(row)
                    break
        return self.gram_scores[rows].mean(0) if rows else np.zeros(len(self.langs))

    def predictor(self, cached: int = 200_000):
        """A function of a text; scores of unseen words are kept for up to ``cached`` words."""
        known, width = len(self.words), len(self.langs)
        table = np.zeros((known + cached, width))
        table[:known] = self.word_scores
        index, extra = dict(self.words), {}

        def predict(text: str | None) -> tuple[str, float]:
            counts = Counter(find_letters((text or "").lower()))
            if not width or not any(map(str.isalpha, "".join(counts))):  # such as "²" alone
                return UNDETERMINED, 0.0
            if len(extra) + len(counts) > cached:
                extra.clear()
            total = np.zeros(width)
            rows, times = [], []
            for word, n in counts.items():
                row = index.get(word)
                if row is None:
                    row = extra.get(word)
                if row is None:
                    if len(extra) < cached:
                        row = extra[word] = known + len(extra)
                        table[row] = self.unseen(word)
                    else:
                        total += n * self.unseen(word)
                        continue
                rows.append(row)
                times.append(n)
            total += np.array(times, float) @ table[rows] if rows else 0
            best = int(total.argmax())
            return self.langs[best], float(1 / np.exp(total - total[best]).sum())

        return predict


def _table(rows, langs: list[str], smoothing: float) -> tuple[dict[str, int], np.ndarray]:
    tokens = {t: i for i, t in enumerate(sorted({r["token"] for r in rows}))}
    counts = np.zeros((len(tokens), len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    for r in rows:
        counts[tokens[r["token"]], column[r["lang"]]] += r["n"]
    scores = np.log((counts + smoothing) / (counts.sum(0) + smoothing * max(len(tokens), 1)))
    return tokens, scores - scores.mean(1, keepdims=True)


def learn_languages(
    docs: DataFrame, docs_per_language: int = 2_000, words_per_language: int = 25_000,
    grams_per_language: int = 25_000, smoothing: float = 0.5,
) -> LanguageModel:
    """Fit on about ``docs_per_language`` different documents of each language, chosen by their hash.

    The hash is that of id and text, and rows equal in both count once, so neither rows without an id nor
    repeated ids or rows lengthen the sample. It bounds what is fitted; prediction covers every text.
    Every language proposes its ``words_per_language`` and ``grams_per_language`` most frequent tokens,
    words only if seen twice; of a token that one proposes the counts in all languages are used.
    So no language loses tokens to another, and the model is bounded per language.
    """
    labelled = docs.where(F.col("lang").isNotNull()).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("hash"))
    shares = materialise(labelled.groupBy("lang").agg(
        (docs_per_language / F.count(F.lit(1))).alias("share")), "language-shares")
    place = F.shiftrightunsigned("hash", 11) / float(1 << 53)
    # The stored shares are small, so Spark broadcasts them by their measured size.
    sample = labelled.join(shares, "lang").where(place < F.col("share")).dropDuplicates(["lang", "hash"])
    stored = materialise(
        sample.select("lang", "text").mapInArrow(_count, _COUNTS)
        .groupBy("lang", "kind", "token").agg(F.sum("n").alias("n")), "language-counts")
    langs = sorted(r["lang"] for r in shares.select("lang").collect())
    model = LanguageModel(langs)
    for quota, kept, names in (
        (words_per_language, "kind = 0", ("words", "word_scores")),
        (grams_per_language, "kind > 0", ("grams", "gram_scores")),
    ):
        tokens = stored.where(kept)
        frequent = tokens.where("kind > 0 or n > 1").withColumn("rank", F.row_number().over(
            Window.partitionBy("lang").orderBy(F.desc("n"), "token")))
        chosen = frequent.where(F.col("rank") <= quota).select("token").distinct()
        for name, value in zip(names, _table(tokens.join(chosen, "token").collect(), langs, smoothing)):
            setattr(model, name, value)
    discard(stored, shares)
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """``keep`` with ``lang_pred`` and ``score`` for every whole text; a projection."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def work(text: str | None) -> tuple[str, float]:
        if "predict" not in state:
            state["predict"] = shared.value.predictor()
        return state["predict"](text)

    return per_text(docs, keep, "lang_pred string, score double", work)
