"""Substring dedup by suffix automata of reference shards.

The reference is the corpus itself, so it grows with the data and cannot be broadcast whole.
It is cut into shards that are dealt instead, so that a text is only streamed against the shards
that can match it: every window of ``window`` words names the smallest hash of its word 6-grams, its
anchor; equal windows name equal anchors. Windows in a row with the same anchor occurrence form
a passage, and the passages of one anchor are one shard.

1. Anchors of all texts are counted; those that occur once have no repeated window.
2. Equal passages of an anchor are merged, keeping the first place (smallest id, then start).
3. Per anchor with differing passages, in order of their first places, each passage is streamed
   through the suffix automaton of those before it; matching statistics of ``window`` words or
   more mark the windows seen earlier. Then it is added to the automaton.
4. A copy of a passage loses all of its windows, the first one those that were seen earlier.

A shard with over ``shard_passages`` differing passages (a common line in many contexts) is not
put into one task: its windows are merged by their own hashes, which decides them exactly, too. So
are the windows of a shard whose passages lie in several rows with one id, since the places of such
passages interleave.

Ids only order the rows. Rows are numbered in the table they are stored in, and passages are
collected and joined by that number, so a list never holds more than the passages of one text.

Edge cases: null texts have no words and keep the empty string. Null ids come before all others.
Rows that share an id, or have none, are at the same place: equal windows at equal starts in them
are not earlier than one another. Extra columns are carried, except ``n_words``, ``n_removed`` and
``kept_text``, which are replaced. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aval.llm.words import covered, find_words, free_name
from aval.session import discard, materialise

GRAM = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


class WordHashes:
    """64-bit hashes of words; those of up to ``limit`` words are remembered."""

    def __init__(self, limit: int = 300_000) -> None:
        self.known: dict[str, int] = {}
        self.limit = limit

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class Spans:
    """Hashes of any stretch of a word sequence, from prefix sums of a polynomial."""

    def __init__(self, hashes: np.ndarray) -> None:
        size = len(hashes)
        powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _ODD)])
        self.sums = np.r_[np.uint64(0), np.cumsum(hashes * powers[:size])]
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(size, _INVERSE)])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        ends = starts + lengths
        return _mixed((self.sums[ends] - self.sums[starts]) * self.back[starts]
                      + np.asarray(lengths, np.uint64))


def passages(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Starts, numbers of windows, anchors and content hashes of the passages of one text."""
    spans = Spans(hashes)
    grams = np.arange(len(hashes) - GRAM + 1)
    least, place, span, wide = spans.of(grams, GRAM), grams, 1, window - GRAM + 1
    while span < wide:
        step = min(span, wide - span)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        span += step
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    windows = np.diff(np.r_[starts, len(place)])
    return starts, windows, least[starts], spans.of(starts, windows + window - 1)


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            parts, owners = [], []
            for row, text in enumerate(batch.column("text")):
                words = find_words(text.as_py() or "")
                if len(words) >= window:
                    parts.append(passages(table.of(words), window))
                    owners.append((row, len(parts[-1][0])))
            if parts:
                starts, windows, anchors, contents = map(np.concatenate, zip(*parts))
                rows = np.repeat([o[0] for o in owners], [o[1] for o in owners])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(rows)),
                     batch.column("doc_id").take(pa.array(rows)), pa.array(starts.astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(anchors.view(np.int64)),
                     pa.array(contents.view(np.int64))],
                    ["row", "doc_id", "start", "windows", "anchor", "content"])

    return run


class SuffixAutomaton:
    """Automaton of all stretches of the word sequences added to it."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _parted(self, state: int, word, target: int) -> int:
        """``target``, or its clone that is one longer than ``state``."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._parted(last, word, self.next[last][word])
                continue
            new, state = self._state(self.length[last] + 1, 0, {}), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._parted(state, word, self.next[state][word])
            last = new

    def matching(self, words: list) -> Iterator[int]:
        """For each place the length of the longest stretch ending there that was added."""
        state = size = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            yield size


def seen_windows(automaton: SuffixAutomaton, words: list[str], window: int) -> int:
    """Bits of the windows of ``words`` that the automaton has."""
    mask = 0
    for end, size in enumerate(automaton.matching(words), 1):
        if size >= window:
            mask |= 1 << (end - window)
    return mask


def _judge(window: int):
    """Sorted passages in, (anchor, content, mask) out; one automaton at a time in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = automaton = None
        for batch in batches:
            masks = []
            for now, text in zip(batch.column("anchor").to_pylist(), batch.column("words")):
                if automaton is None or now != anchor:
                    anchor, automaton = now, SuffixAutomaton()
                words = text.as_py().split(" ")
                masks.append(seen_windows(automaton, words, window))
                automaton.add(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("content"), pa.array(masks, pa.int64())],
                ["anchor", "content", "mask"])

    return run


_PASSAGE = "anchor long, content long, doc_id long, start int, windows int, words string, hot boolean"
_WINDOW = "anchor long, content long, doc_id long, start int, bit int, windowed long"


def _flat(column: pa.Array, *names: str) -> list[np.ndarray]:
    """The fields of a batch of struct lists as arrays, after the offsets of the lists."""
    structs = column.flatten()
    lengths = np.array([0 if n is None else n for n in pc.list_value_length(column).to_pylist()])
    return [np.r_[0, np.cumsum(lengths)],
            *(structs.field(n).to_numpy(zero_copy_only=False) for n in names)]


def _cut_passages(window: int):
    """The word strings of the wanted passages of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            ends, start, windows = _flat(wanted, "start", "windows")
            texts = []
            for row, text in enumerate(batch.column("text")):
                words = find_words(text.as_py() or "")
                mine = slice(ends[row], ends[row + 1])
                for at, size in zip(start[mine].tolist(), (windows[mine] + window - 1).tolist()):
                    texts.append(" ".join(words[at : at + size]))
            owner = pa.array(np.repeat(np.arange(len(ends) - 1), np.diff(ends)))
            flat = wanted.flatten()
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor"), flat.field("content"), batch.column("doc_id").take(owner),
                 flat.field("start"), flat.field("windows"), pa.array(texts, pa.string()),
                 flat.field("hot")],
                ["anchor", "content", "doc_id", "start", "windows", "words", "hot"])

    return run


def _cut_windows(window: int):
    """Every window of the passages, with the hash of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            hashes = [Spans(table.of(t.as_py().split(" "))) for t in batch.column("words")]
            counts = batch.column("windows").to_numpy()
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            bits = np.concatenate([np.arange(n) for n in counts]) if len(counts) else counts
            found = [s.of(np.arange(n), window) for s, n in zip(hashes, counts)]
            windowed = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            start = batch.column("start").to_numpy()[rows.to_numpy()] if len(counts) else counts
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor").take(rows), batch.column("content").take(rows),
                 batch.column("doc_id").take(rows), pa.array((start + bits).astype(np.int32)),
                 pa.array(bits.astype(np.int32)), pa.array(windowed)],
                ["anchor", "content", "doc_id", "start", "bit", "windowed"])

    return run


def _masks(first: DataFrame, docs: DataFrame, row: str, window: int, shard_passages: int) -> DataFrame:
    """(anchor, content, mask) of all passages whose anchor has others with another content."""
    ids = first.groupBy("anchor", "first.doc_id").agg(
        F.count("*").alias("n"), F.min("first.row").alias("low"), F.max("first.row").alias("high"))
    kinds = materialise(
        ids.groupBy("anchor").agg(
            F.sum("n").alias("kinds"), F.max(F.col("low") < F.col("high")).alias("shared"))
        .where("kinds > 1"), "kinds")
    wanted = first.join(kinds, "anchor").groupBy(F.col("first.row").alias(row)).agg(
        F.collect_list(F.struct(
            "anchor", "content", F.col("first.start").alias("start"), "windows",
            (F.col("shared") | (F.col("kinds") > shard_passages)).alias("hot"))).alias("wanted"))
    texts = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted, row).select("doc_id", "text", "wanted")
    cut = materialise(texts.mapInArrow(_cut_passages(window), _PASSAGE), "passages")
    ordered = cut.where("not hot").repartition("anchor").sortWithinPartitions(
        "anchor", "doc_id", "start")
    judged = ordered.select("anchor", "content", "words").mapInArrow(
        _judge(window), "anchor long, content long, mask long")
    windows = cut.where("hot").select("anchor", "content", "doc_id", "start", "windows", "words")
    windows = windows.mapInArrow(_cut_windows(window), _WINDOW)
    earliest = windows.groupBy("windowed").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    later = ~F.struct("doc_id", "start").eqNullSafe(F.col("least"))
    split = windows.join(earliest, "windowed").groupBy("anchor", "content").agg(
        F.bit_or(F.when(later, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
                 .otherwise(0)).alias("mask"))
    masks = materialise(judged.unionByName(split), "masks")
    discard(kinds, cut)
    return masks


def _apply(window: int, schema: StructType):
    """The passages to remove are the last column, whatever its name."""
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(62)
        for batch in batches:
            counts, gone, texts = [], [], []
            ends, start, mask = _flat(batch.columns[-1], "start", "mask")
            for row, text in enumerate(batch.column("text")):
                words = find_words(text.as_py() or "")
                drop, mine = None, slice(ends[row], ends[row + 1])
                if ends[row + 1] > ends[row]:
                    passage, bit = np.nonzero(mask[mine][:, None] >> bits & 1)
                    drop = covered(start[mine][passage] + bit, window, len(words))
                kept = words if drop is None else [w for w, d in zip(words, drop.tolist()) if not d]
                counts.append(len(words))
                gone.append(len(words) - len(kept))
                texts.append(" ".join(kept))
            made = {"n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                    "kept_text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else batch.column(n) for n in names], names)

    return run


def remove_repeated(docs: DataFrame, window: int = 20, shard_passages: int = 64) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the words that stay.

    Equal windows of ``window`` words are removed wherever they start later than somewhere else.
    """
    if not GRAM < window < 60:
        raise ValueError("the window must have 7 to 59 words")
    docs = docs.drop("n_words", "n_removed", "kept_text")
    schema = StructType(docs.schema.fields + StructType.fromDDL(
        "n_words long, n_removed long, kept_text string").fields)
    row, spans = free_name(docs, "_row"), free_name(docs, "_removed")
    docs = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    anchors = materialise(
        docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(
            _anchor_rows(window),
            "row long, doc_id long, start int, windows int, anchor long, content long"), "anchors")
    repeated = materialise(
        anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
        "repeated")
    members = materialise(anchors.join(repeated, "anchor"), "members")
    discard(anchors, repeated)
    first = materialise(
        members.groupBy("anchor", "content").agg(
            F.min(F.struct("doc_id", "start", "row")).alias("first"), F.max("windows").alias("windows"),
            F.count("*").alias("n")), "first")
    masks = _masks(first, docs, row, window, shard_passages)
    decided = materialise(
        first.join(masks, ["anchor", "content"], "left")
        .select("anchor", "content", "first", F.coalesce("mask", F.lit(0)).alias("mask"))
        .where((F.col("n") > 1) | (F.col("mask") != 0)), "decided")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("start") == F.col("first.start"))
    every = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("windows")) - 1
    removed = (
        members.join(decided, ["anchor", "content"])
        .withColumn("mask", F.when(is_first, F.col("mask")).otherwise(every)).where("mask <> 0")
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_list(F.struct("start", "mask")).alias(spans)))
    discard(masks, first)
    return docs.join(removed, row, "left").mapInArrow(_apply(window, schema), schema)
