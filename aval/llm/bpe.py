"""BPE encoding and decoding by speculation: propose tokens greedily, verify pairs, merge what fails.

Words that a task has not seen are encoded together. Greedy longest match proposes tokens for each.
A sequence of tokens is what merging gives if and only if every two neighbours are what merging gives
for the two of them, so a vectorised check undoes the merges on both sides of every boundary,
latest first, and looks whether an earlier merge would have crossed it. Only words with a boundary that
fails are merged exactly, with a heap, in n log n steps. This holds for vocabularies in which every token has one
merge and is made before it is used; others are refused.

The vocabulary is a ``tokenizers`` file of a BPE model over bytes with word ends; its bytes are broadcast (a
few MB, whatever the data). Its normaliser is the library's, except for texts below U+0300, where it comes to lower
case. Words are cut by the file's pattern with ``regex`` where both know the characters alike,
otherwise by the library.

Edge cases: null and empty texts have no tokens and decode to the empty text. Strings of special
tokens in a text become those tokens, as in the library. Repeated rows are encoded each. A word of any length
is encoded in whole; words over ``_LONGEST`` characters are not remembered. A column named like a result is
replaced by it. Null ids (binary) decode like none; ids that the vocabulary lacks are left out, as in the
library. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

_END = "</w>"
_REMEMBERED = 200_000  # words a task remembers, at most
_LONGEST = 64
_CHUNK = 1 << 20  # characters of text encoded together
_ROWS = 1_000  # rows of a batch worked on together
_NEVER = int(np.iinfo(np.int64).max)
_beyond_latin = re.compile("[̀-\U0010ffff]").search


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def _spelled_out(pattern: str) -> str:
    """``pattern`` for ``re`` and characters below U+0300: classes of characters as lists of ranges."""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        found = [i for i in range(0x300) if regex.match(name, chr(i))]
        begins = [i for i in found if i - 1 not in found]
        ends = [i for i in found if i + 1 not in found]
        pattern = pattern.replace(name, "".join(
            f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(begins, ends)))
    return pattern


class BytePairs:
    """The merges of one vocabulary file, and the words already encoded with it."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _END or any(map(model.get, plain)):
            raise ValueError("only plain BPE over bytes with word ends is supported")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(not t["special"] or t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
               for t in spec["added_tokens"]):
            raise ValueError("only plain special tokens are supported")

        self._translate = byte_characters()
        letters = list(self._translate.values())
        if not all(c in self.ids and c + _END in self.ids for c in letters):
            raise ValueError("the vocabulary lacks bytes")
        self._learn(model["merges"])
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in splits] != ["Split", "ByteLevel"] or not splits[0]["invert"] or (
                splits[0]["behavior"] != "Removed" or splits[1]["use_regex"] or splits[1]["add_prefix_space"]):
            raise ValueError("only words cut by one pattern are supported")
        pattern = splits[0]["pattern"]["Regex"]
        self._pattern = regex.compile(pattern)
        steps = spec["normalizer"]["normalizers"]
        self._latin_is_lower = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and (
            steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        self._find_latin = re.compile(_spelled_out(pattern)).findall if self._latin_is_lower else None
        self._cut_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if (
            self.special) else (lambda text: [text])
        self._content = content
        self._agreed: set[str] = set()
        self._from_bytes = {c: b for b, c in self._translate.items()}
        self._forget()

    def _learn(self, merges: list) -> None:
        """Rank, left and right part of every token, and the ranks of all pairs in a sorted table."""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        size = max(self.ids.values()) + 1
        self._rank = np.full(size, -1, np.int64)
        self._left, self._right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        ranks = np.arange(len(pairs))
        self._rank[made], self._left[made], self._right[made] = ranks, left, right
        if len(np.unique(made)) < len(made) or (
                np.maximum(self._rank[left], self._rank[right]) >= ranks).any():
            raise ValueError("a token is made by two merges, or used before it is made")
        self._size = size
        keys = left * size + right
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], ranks[order]
        self._pairs = dict(zip(keys.tolist(), zip(ranks.tolist(), made.tolist())))
        sound = self.compatible(left, right, ranks)  # does merging the whole token's text give the token?
        reached = dict.fromkeys(self.ids.values(), True)
        for token, a, b, good in zip(made.tolist(), left.tolist(), right.tolist(), sound.tolist()):
            reached[token] = good and reached[a] and reached[b]
        self._inner = {t: i for t, i in self.ids.items() if reached[i] and not t.endswith(_END)}
        self._final = {t[: -len(_END)]: i for t, i in self.ids.items() if reached[i] and t.endswith(_END)}
        self._beginnings = {t[:n]: -1 for t in self._inner for n in range(1, len(t))} | self._inner
        self._final_span = max(map(len, self._final))

    @cached_property
    def _library(self) -> Tokenizer:
        return Tokenizer.from_str(self._content.decode())

    def _forget(self) -> None:
        self._known = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}

    def compatible(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens whether merging their joint text keeps the boundary between them.

        Both sides are taken apart along the boundary, the later merge first. While two parts meet there,
        the merge of the two must not come before the merge that takes one of them up (``limit``).
        Of equal merges the leftmost comes first, hence the limit is one higher on the right side.
        """
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), _NEVER) if limit is None else limit.astype(np.int64)
        good = np.ones(len(left), bool)
        alive = np.arange(len(left))
        while len(alive):
            a, b = left[alive], right[alive]
            keys = a * self._size + b
            at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            crossed = (self._keys[at] == keys) & (self._ranks[at] < limit[alive])
            good[alive[crossed]] = False
            made_a, made_b = self._rank[a], self._rank[b]
            from_left = made_a > made_b
            limit[alive] = np.where(from_left, made_a, made_b + 1)
            left[alive] = np.where(from_left, self._right[a], a)
            right[alive] = np.where(from_left, b, self._left[b])
            alive = alive[~crossed & (np.maximum(made_a, made_b) >= 0)]
        return good

    def propose(self, word: str) -> list[int]:
        """Greedy longest match, left to right, over the characters that stand for bytes."""
        out, at, size = [], 0, len(word)
        begins = self._beginnings.get
        while True:
            if size - at <= self._final_span and (last := self._final.get(word[at:])) is not None:
                out.append(last)
                return out
            for end in range(at + 1, size):
                if (token := begins(word[at:end])) is None:
                    break
                if token >= 0:
                    longest, to = token, end
            out.append(longest)
            at = to

    def merge(self, word: str) -> list[int]:
        """The tokens of a word by merging the first pair of the lowest rank until none is left."""
        tokens = self.ids_of(word)
        return self._merge_short(tokens) if len(tokens) <= _LONGEST else self._merge_long(tokens)

    def ids_of(self, word: str) -> list[int]:
        """A token per character, the last one with the word's end."""
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + _END]]

    def _merge_short(self, tokens: list[int]) -> list[int]:
        """A scan for the lowest rank per merge."""
        size, none = self._size, (_NEVER, -1)
        pairs = self._pairs.get
        ranks = [pairs(a * size + b, none)[0] for a, b in zip(tokens, tokens[1:])]
        while ranks and (lowest := min(ranks)) < _NEVER:
            at = ranks.index(lowest)
            tokens[at : at + 2] = [pairs(tokens[at] * size + tokens[at + 1])[1]]
            del ranks[at]
            if at:
                ranks[at - 1] = pairs(tokens[at - 1] * size + tokens[at], none)[0]
            if at < len(ranks):
                ranks[at] = pairs(tokens[at] * size + tokens[at + 1], none)[0]
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        """A heap of the pairs, so a word of any length takes n log n steps."""
        after = [*range(1, len(tokens)), -1]
        before = [*range(-1, len(tokens) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            to = after[at]
            if to >= 0 and (found := self._pairs.get(tokens[at] * self._size + tokens[to])):
                heapq.heappush(heap, (found[0], at, tokens[at], tokens[to]))

        for at in range(len(tokens)):
            offer(at)
        while heap:
            _, at, a, b = heapq.heappop(heap)
            to = after[at]
            if tokens[at] != a or to < 0 or tokens[to] != b:
                continue
            tokens[at], tokens[to] = self._pairs[a * self._size + b][1], -1
            after[at] = after[to]
            if after[to] >= 0:
                before[after[to]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of each word (characters as in a normalised text); words must not be empty."""
        spelled = [w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._translate) for w in words]
        proposed = [self.propose(s) for s in spelled]
        lengths = np.array([len(p) for p in proposed], np.int64)
        tokens = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[:-1] == owner[1:]
        failing = owner[:-1][inside][~self.compatible(tokens[:-1][inside], tokens[1:][inside])]
        for i in np.unique(failing).tolist():
            proposed[i] = self.merge(spelled[i])
        return proposed

    def words(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        out: list[str] = []
        for part in self._cut_special(text):
            if part in self.special:
                out.append(part)
                continue
            if self._find_latin and not _beyond_latin(part):
                out += self._find_latin(part.lower())
                continue
            part = self._library.normalizer.normalize_str(part)
            if all(map(self._alike, set(part) - self._agreed)):
                out += self._pattern.findall(part)
            else:
                pieces = self._library.pre_tokenizer.pre_tokenize_str(part)
                out += [bytes(self._from_bytes[c] for c in p).decode() for p, _ in pieces]
        return out

    def _alike(self, character: str) -> bool:
        """Whether the library and ``regex`` agree if this is a letter, a digit, space or none of them."""
        probe = f"a{character}{character}1"
        theirs = [span for _, span in self._library.pre_tokenizer.pre_tokenize_str(probe)]
        if theirs == [m.span() for m in self._pattern.finditer(probe)]:
            self._agreed.add(character)
            return True
        return False

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            cut, size = [], 0
            while at < len(texts) and size <= _CHUNK:
                text = texts[at] or ""
                cut.append(self.words(text))
                size, at = size + len(text), at + 1
            if len(self._known) > _REMEMBERED:
                self._forget()
            known = self._known
            unseen = list({w: None for words in cut for w in words if w not in known})
            packed = {w: np.array(t, "<u4").tobytes() for w, t in zip(unseen, self.encode_words(unseen))}
            known.update((w, b) for w, b in packed.items() if len(w) <= _LONGEST)
            packed = {w: b for w, b in packed.items() if len(w) > _LONGEST}
            for words in cut:
                yield b"".join([known[w] if w in known else packed[w] for w in words])


class TokenNames:
    """The strings of the ids of one vocabulary file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        if spec["decoder"] is not None:
            raise ValueError("only files without a decoder are supported")
        self._names = {i: t for t, i in spec["model"]["vocab"].items()}
        self._names |= {t["id"]: t["content"] for t in spec["added_tokens"]}

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        return " ".join([self._names[i] for i in numbers if i in self._names])


_LOADED: dict[type, tuple] = {}


def _load(kind: type, content: bytes):
    """``kind(content)``; a worker process keeps the last one it used of each kind."""
    key = hashlib.sha256(content).hexdigest()
    if _LOADED.get(kind, ("",))[0] != key:
        _LOADED[kind] = key, kind(content)
    return _LOADED[kind][1]


def _with_vocabulary(
    df: DataFrame, path: str, keep: list[str], column: str, schema: str, kind: type,
    work: Callable[..., Iterator[tuple]],
) -> DataFrame:
    """``keep`` columns and the values that ``work`` makes of ``column``; a projection."""
    with open(path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    added = StructType.fromDDL(schema)
    keep = [c for c in dict.fromkeys(keep) if c not in added.names]
    source = df.select(*(c for c in keep if c != column), column)
    at = {c: i for i, c in enumerate(source.columns)}
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _load(kind, shared.value)
        for whole in batches:
            for first in range(0, max(len(whole), 1), _ROWS):
                batch = whole.slice(first, _ROWS)
                rows = list(work(vocabulary, batch.column(at[column]).to_pylist()))
                columns = list(zip(*rows)) if rows else [()] * len(arrow)
                arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(at[c]) for c in keep] + arrays, keep + arrow.names)

    return source.mapInArrow(run, StructType([source.schema[c] for c in keep] + added.fields))


def _encoded(vocabulary: BytePairs, texts: list) -> Iterator[tuple]:
    return ((len(ids) // 4, ids) for ids in vocabulary.encode(texts))


def _decoded(vocabulary: TokenNames, packed: list) -> Iterator[tuple]:
    return ((vocabulary.decode(ids),) for ids in packed)


def encode_texts(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep``, ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit) of every whole text.

    ``path`` is the vocabulary file, read by the driver.
    """
    return _with_vocabulary(docs, path, keep, "text", "n_tokens long, ids binary", BytePairs, _encoded)


def decode_ids(table: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``decoded``, the text of ``ids`` as the library writes it without a decoder."""
    return _with_vocabulary(table, path, keep, "ids", "decoded string", TokenNames, _decoded)
