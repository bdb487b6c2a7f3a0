"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The symbols of all new words of a batch lie in one flat array, linked to their neighbours inside the word. A pair's
rank is found by binary search over the sorted pair keys. Rounds go through the ranks in ascending order and merge
every occurrence of the round's pair in all words at once; only pairs next to a merge are looked up again. That equals
merging each word's lowest pair first, because a merge list in creation order never makes a pair of a lower rank
(checked on loading). The work per word grows with its length, so a text without spaces is no special case. Words of at
most ``SHORT_WORDS[-1]`` bytes are one row each instead: a round merges every word's own lowest pair, so the number of
rounds follows the longest word and not the number of different pairs.

Words already met stay in a bounded table until the task ends. ``ids`` is a binary column of little-endian unsigned
32-bit integers.

Defined cases: a null text counts as empty and has no ids; the file's special tokens are found in the text first, as
their library does; unknown ids raise; ids that are no whole UTF-8 decode with replacement characters; other columns
of the input stay, except those named as an output, which are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rentlens.llm.common import give_back

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int64).max
BATCH_BYTES = 2 << 20
DECODE_BYTES = 1 << 19
CACHE_WORDS = 100_000
#: Words of more bytes than one limit and at most the next are merged together, a row each.
SHORT_WORDS = (0, 4, 6, 8, 10, 12, 16, 24, 32)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, and the byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start … start + length - 1`` of every item, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def plane_zero_pattern() -> re.Pattern[str]:
    """``PATTERN`` for texts of code points below 65536, its classes written out as ranges: the faster matcher takes those."""

    def ranges(kind: str) -> str:
        inside = {c for c in range(0x10000) if regex.match(kind, chr(c))}
        heads, tails = sorted(c for c in inside if c - 1 not in inside), sorted(c for c in inside if c + 1 not in inside)
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(heads, tails))

    letter, number, space = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Codes(dict):
    """Word to number; a new word gets the next number and is noted."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.fresh.append(word)
        return code


class ByteBpe:
    """The tables of one vocabulary file, and a bounded table of encoded words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.find_all, self.find_low = regex.compile(PATTERN).findall, plane_zero_pattern().findall
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        raw = [b""] * size
        for token, i in vocab.items():
            raw[i] = token.encode() if token in self.special else bytes(letters[c] for c in token)
        for token, i in self.special.items():
            raw[i] = token.encode()
        self.size, self.known = size, np.array([len(b) > 0 for b in raw])
        self.text = np.frombuffer(b"".join(raw), np.uint8)
        self.text_length = np.array([len(b) for b in raw], np.int64)
        self.text_start = np.cumsum(self.text_length) - self.text_length
        self.byte_id = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left, right = np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs])
        self.merged = np.array([vocab[a + b] for a, b in pairs])
        made = np.full(size, -1, np.int64)
        made[self.merged] = np.arange(len(pairs))
        if (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any() or len(set(self.merged.tolist())) != len(pairs):
            raise ValueError(f"{path}: the merges are not in the order of their creation")
        keys = left * size + right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        self.clear()

    def clear(self) -> None:
        self.words = Codes()
        self.ids, self.start, self.length = (np.zeros(0, np.int64) for _ in range(3))
        self.words.update({token: i for i, token in enumerate(self.special)})
        self._store(np.array(list(self.special.values()), np.int64), np.ones(len(self.special), np.int64))

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def pair_ranks(self, symbols: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair (symbol, symbol to the right), or ``NONE``."""
        keys = symbols * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.by_key[at], NONE)

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Merges in place; ``first`` marks the first symbol of each word. Returns which symbols are left."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[:-1][first[1:]] = n
        before[first] = -1
        ranks = np.full(n + 1, NONE)
        inner = np.flatnonzero(after[:n] < n)
        ranks[inner] = self.pair_ranks(symbols[inner], symbols[inner + 1])
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def push(at: np.ndarray) -> None:
            r = ranks[at]
            some = r < NONE
            if not some.all():
                at, r = at[some], r[some]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(at)]
            for rank, a, b in zip(r[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if rank in waiting:
                    waiting[rank].append(at[a:b])
                else:
                    waiting[rank] = [at[a:b]]
                    heapq.heappush(heap, rank)

        push(inner)
        while heap:
            rank = heapq.heappop(heap)
            parts = waiting.pop(rank)
            at = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            at = at[ranks[at] == rank]
            if len(parts) > 1 and len(at):
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            if not len(at):
                continue
            if len(at) > 1:  # of overlapping occurrences every other one, from the left
                chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
                if chained.any():
                    head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - head) % 2 == 0]
            gone = after[at]
            symbols[at] = self.merged[rank]
            alive[gone] = False
            ranks[gone] = NONE
            to = after[gone]
            after[at] = to
            some = to < n
            before[to[some]] = at[some]
            left = before[at]
            near = np.sort(np.concatenate([at, left[left >= 0]]))
            near = near[np.concatenate([[True], near[1:] != near[:-1]])]
            ends = after[near]
            ranks[near] = NONE
            some = ends < n
            near, ends = near[some], ends[some]
            ranks[near] = self.pair_ranks(symbols[near], symbols[ends])
            push(near)
        return alive

    def merge_rows(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """One row a word: its symbols after all merges, then -1. Each round merges the lowest pair of every word, of equal ones the first."""
        n, wide = len(lengths), int(lengths.max())
        inside = np.arange(wide) < lengths[:, None]
        ids, ranks = np.full((n, wide + 1), -1), np.full((n, wide), NONE)
        ids[:, :wide][inside] = symbols
        pair = inside[:, 1:]
        ranks[:, : wide - 1][pair] = self.pair_ranks(ids[:, : wide - 1][pair], ids[:, 1:wide][pair])
        out, word = np.full((n, wide), -1), np.arange(n)
        while len(word):
            at = ranks.argmin(1)
            rank = ranks[np.arange(len(at)), at]
            some = rank < NONE
            if not some.all():
                out[word[~some]] = ids[~some, :wide]
                ids, ranks, word, at, rank = ids[some], ranks[some], word[some], at[some], rank[some]
            row, later = np.arange(len(at)), np.arange(wide) > at[:, None]
            ids[:, :wide] = np.where(later, ids[:, 1:], ids[:, :wide])
            ranks[:, : wide - 1] = np.where(later[:, : wide - 1], ranks[:, 1:], ranks[:, : wide - 1])
            ids[row, at] = self.merged[rank]
            right = ids[row, at + 1]
            ranks[row, at] = np.where(right >= 0, self.pair_ranks(ids[row, at], right), NONE)
            row, at = row[at > 0], at[at > 0]
            ranks[row, at - 1] = self.pair_ranks(ids[row, at - 1], ids[row, at])
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(b) for b in raw], np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        starts, counts = np.cumsum(lengths) - lengths, np.zeros(len(words), np.int64)
        found = []
        for low, high in zip(SHORT_WORDS, SHORT_WORDS[1:]):
            at = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(at):
                rows = self.merge_rows(symbols[spread(starts[at], lengths[at])], lengths[at])
                counts[at] = (rows >= 0).sum(1)
                found.append((at, rows[rows >= 0]))
        at = np.flatnonzero(lengths > SHORT_WORDS[-1])
        if len(at):
            long = symbols[spread(starts[at], lengths[at])]
            first = np.zeros(len(long), bool)
            first[np.cumsum(lengths[at]) - lengths[at]] = True
            alive = self.merge(long, first)
            counts[at] = np.add.reduceat(alive.astype(np.int64), np.flatnonzero(first))
            found.append((at, long[alive]))
        ids, starts = np.empty(counts.sum(), np.int64), np.cumsum(counts) - counts
        for at, part in found:
            ids[spread(starts[at], counts[at])] = part
        return ids, counts

    def learn(self, words: list[str]) -> None:
        """Encodes new words, in the order of their numbers, and keeps them."""
        self._store(*self.encode_words(words))

    def pieces(self, text: str) -> list[str]:
        find = self.find_low if text.isascii() or max(text) < "\U00010000" else self.find_all
        if self.split is None or self.split.search(text) is None:
            return find(text)
        out: list[str] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += find(part)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self.clear()
        counts, numbers = [], []
        for text in texts:
            words = self.pieces(text)
            counts.append(len(words))
            numbers += map(self.words.__getitem__, words)
        if self.words.fresh:
            self.learn(self.words.fresh)
            self.words.fresh = []
        codes = np.array(numbers, np.int64)
        ids = self.ids[spread(self.start[codes], self.length[codes])].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(self.length[codes])])[np.cumsum([0, *counts])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        if len(flat) and (flat.max() >= self.size or not self.known[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        raw = self.text[spread(self.text_start[flat], self.text_length[flat])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.text_length[flat])])[np.cumsum([0, *map(len, ids)])]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> ByteBpe:
    """One per Python worker and file."""
    return ByteBpe(path)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of items of about ``limit`` together; a larger item stands alone or ends its run."""
    a = total = 0
    for i, s in enumerate(sizes):
        total += s
        if total >= limit:
            yield a, i + 1
            a, total = i + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text."""

    @arrow_udf("binary")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe(path)
        for batch in batches:
            out: list[bytes] = []
            for a, b in slices(pc.binary_length(batch).to_pylist(), BATCH_BYTES):
                out += [x.tobytes() for x in coder.encode(batch.slice(a, b - a).to_pylist())]
            yield pa.array(out, pa.binary())
            out = []
        coder.clear()
        give_back()

    return docs.withColumn(ids_col, ids_of(F.coalesce(F.col(text_col), F.lit(""))))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; null ids count as none."""

    @arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe(path)
        for batch in batches:
            out: list[pa.Array] = []
            for a, b in slices(pc.binary_length(batch).to_pylist(), DECODE_BYTES):
                ids = [np.frombuffer(x, "<u4") for x in batch.slice(a, b - a).to_pylist()]
                out.append(pa.array(coder.decode(ids), pa.string()))
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())

    return encoded.withColumn(text_col, text_of(F.coalesce(F.col(ids_col), F.lit(b""))))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``encode`` and then ``decode`` in one Python worker per task, with the same columns: half the memory of both one after another."""

    @arrow_udf(T.StructType().add("ids", T.BinaryType()).add("decoded", T.StringType()))
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe(path)
        for batch in batches:
            ids: list[pa.Array] = [pa.array([], pa.binary())]
            texts: list[pa.Array] = [pa.array([], pa.string())]
            for a, b in slices(pc.binary_length(batch).to_pylist(), BATCH_BYTES // 2):
                found = coder.encode(batch.slice(a, b - a).to_pylist())
                raw = [x.tobytes() for x in found]
                ids.append(pa.array(raw, pa.binary()))
                for c, d in slices([len(x) for x in raw], DECODE_BYTES):
                    texts.append(pa.array(coder.decode([np.frombuffer(x, "<u4") for x in raw[c:d]]), pa.string()))
            both_arrays = [pa.concat_arrays(ids), pa.concat_arrays(texts)]
            del ids, texts
            yield pa.StructArray.from_arrays(both_arrays, ["ids", "decoded"])
            del both_arrays
        coder.clear()
        give_back()

    found = docs.withColumn("__bpe", both(F.coalesce(F.col(text_col), F.lit(""))))
    return found.withColumns({ids_col: F.col("__bpe.ids"), decoded_col: F.col("__bpe.decoded")}).drop("__bpe")


def token_count(ids_col: str = "ids") -> F.Column:
    return (F.octet_length(ids_col) / 4).cast("bigint")
