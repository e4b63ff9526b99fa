"""Benchmark decontamination: pigeonhole pieces, exact hits, Myers' bit-parallel distance.

An item of m words may occur with up to k = floor(error_rate * m) word insertions, deletions and
substitutions. Cut into k + 1 pieces, at least one piece then occurs unchanged. All pieces are
searched at once in every whole text; around each hit the distance of the item to the text is
computed exactly by Myers' algorithm over words. Texts and items are compared by their
lower-case words, without punctuation; in scripts without spaces a character is a word. Items too short for an
edit (under ten words at a rate of a tenth) are found where they occur unchanged.

Edge cases: null or empty texts match nothing; neither do null items nor items without a word, nor those under
``min_item_words`` words, if it is raised above 1. Texts and items of any length are searched whole. Equal items are reported under each id. A text's smallest distance per
item id is reported, once, also where rows of the benchmark repeat the id. Repeated documents get a row each. Other columns are
not read, whatever they are called; one named like the result is replaced. Empty tables give no rows, and an
empty benchmark no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aval.llm.words import free_name, per_text
from aval.session import materialise

# Thai, Lao, Burmese, Khmer, kana and Han are written without spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff"
_words = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+").findall
MATCHES = "array<struct<item_id:bigint,distance:int>>"


def normalised(text: str | None) -> list[str]:
    return _words((text or "").lower())


def budget(words: int, error_rate: float) -> int:
    return int(words * error_rate + 1e-9)


def best_distance(pattern: list[str], text: list[str]) -> int:
    """Smallest number of word edits that turn ``pattern`` into some stretch of ``text``."""
    size = len(pattern)
    full, last = (1 << size) - 1, 1 << (size - 1)
    equal: dict[str, int] = {}
    for i, word in enumerate(pattern):
        equal[word] = equal.get(word, 0) | 1 << i
    up, down, score = full, 0, size
    best = score
    for word in text:
        match = equal.get(word, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rises, falls = down | ~(diagonal | up) & full, up & diagonal
        score += bool(rises & last) - bool(falls & last)
        rises, falls = rises << 1 & full, falls << 1 & full
        up, down = falls | ~(diagonal | rises) & full, rises & diagonal
        best = min(best, score)
    return best


class ItemSearch:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, list[str]]], error_rate: float) -> None:
        self.items, self.error_rate = items, error_rate
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (_, words) in enumerate(items):
            cuts = np.linspace(0, len(words), budget(len(words), error_rate) + 2).astype(int)
            for start, end in zip(cuts, cuts[1:]):
                pieces.setdefault(f" {' '.join(words[start:end])} ", []).append((number, int(start)))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, smallest distance) of every item within its budget, by item id."""
        words = normalised(text)
        if not words or not self.items:
            return []
        joined, places = f" {' '.join(words)} ", None
        tried: set[tuple[int, int]] = set()
        found: dict[int, int] = {}
        for end, (length, owners) in self.automaton.iter(joined):
            if places is None:
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                places = np.cumsum(lengths + 1) - lengths  # where each word starts in ``joined``
            at = int(np.searchsorted(places, end - length + 2))
            for number, offset in owners:
                first = at - offset
                if (number, first) in tried or found.get(number) == 0:
                    continue
                tried.add((number, first))
                wanted = self.items[number][1]
                spare = budget(len(wanted), self.error_rate)
                region = words[max(0, first - spare) : max(0, first + len(wanted) + spare)]
                distance = best_distance(wanted, region)
                if distance <= spare:
                    found[number] = min(distance, found.get(number, distance))
        best: dict[int, int] = {}
        for number, distance in found.items():
            item = self.items[number][0]
            best[item] = min(distance, best.get(item, distance))
        return sorted(best.items())


def _blocks(
    items: DataFrame, size: int, characters: int, min_words: int
) -> Iterator[list[tuple[int, list[str]]]]:
    block: list[tuple[int, list[str]]] = []
    held = 0
    for row in items.toLocalIterator():
        words = normalised(row[1])
        if len(words) < max(min_words, 1):
            continue
        if len(block) == size or (block and held + len(row[1]) > characters):
            yield block
            block, held = [], 0
        block.append((row[0], words))
        held += len(row[1])
    if block:
        yield block


def _searcher(shared, error_rate: float):
    """A function of a text for ``per_text``; the automaton is built once per task."""
    state: dict = {}

    def work(text: str | None) -> tuple[list[dict]]:
        if "search" not in state:
            state["search"] = ItemSearch(shared.value, error_rate)
        return ([{"item_id": i, "distance": d} for i, d in state["search"].matches(text)],)

    return work


def find_items(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], error_rate: float = 0.1,
    min_item_words: int = 1, block_items: int = 20_000, result: str = "matches",
    block_characters: int = 20_000_000,
) -> DataFrame:
    """``keep`` and ``result`` (see ``MATCHES``), which replaces a column of that name.

    Up to ``block_items`` items of ``block_characters`` together are broadcast and searched in one projection. More are
    searched block by block: each block is one scan of the texts whose few hits are stored by the
    digest of the text, and its broadcast is given up before the next, so a task never holds more
    than one block and the driver two. The hits are joined to the texts at the end.
    """
    context = docs.sparkSession.sparkContext
    known = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long"), "text")
    keep = [c for c in keep if c != result]
    blocks = _blocks(known, block_items, block_characters, min_item_words)
    block, following = next(blocks, []), next(blocks, None)
    if following is None:
        work = _searcher(context.broadcast(block), error_rate)
        return per_text(docs, keep, f"`{result}` {MATCHES}", work)

    texts, hits = docs.select(F.sha2("text", 256).alias("_hit_text"), "text"), []
    while block:
        shared = context.broadcast(block)
        found = per_text(texts, ["_hit_text"], f"found {MATCHES}", _searcher(shared, error_rate))
        hits.append(materialise(
            found.select("_hit_text", F.inline("found")).groupBy("_hit_text", "item_id")
            .agg(F.min("distance").alias("distance")), "item-hits"))
        shared.destroy()
        block, following = following, next(blocks, None)
    text, listed = free_name(docs, "_hit_text"), free_name(docs, "_hit_items")
    by_text = (
        reduce(DataFrame.unionByName, hits).groupBy("_hit_text", "item_id")
        .agg(F.min("distance").alias("distance")).groupBy(F.col("_hit_text").alias(text))
        .agg(F.array_sort(F.collect_list(F.struct("item_id", "distance"))).alias(listed)))
    joined = docs.join(by_text, F.sha2("text", 256) == F.col(text), "left")
    return joined.select(
        *keep, F.coalesce(listed, F.array().cast(MATCHES)).alias(result))
