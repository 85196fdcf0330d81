"""Operator 4, token counts that follow edits.

A document is cut into pre-tokens by the tokenizer's pattern; runs of about
``LEAF_CHARS`` characters are the leaves of a segment tree whose nodes sum
characters and tokens. An edit re-encodes from the last pre-token that ends at
least ``CONTEXT`` characters before it (the pattern looks no further ahead)
until a new pre-token bound falls on an old one behind it: from there the
pattern reads the same text again, so older leaves keep their counts. Only the
leaves in between change, and their sums are updated up the tree. A leaf that
outgrows ``GROWTH`` leaves, or a tree of mostly empty leaves, is built anew.

Counts of distinct pre-tokens are kept in a bounded cache a worker.

Null and blank texts count 0 and take edits as any text; edits apply in order,
each to the text before it, clipped to its length; a null edit list is empty.
"""

from __future__ import annotations

import base64
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.session import ship_package

LEAF_CHARS = 256
GROWTH = 8
CONTEXT = 2
CACHE = 600_000


class PieceCounter:
    """Tokens of a pre-token under a byte-level vocabulary of ranks."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        import tiktoken
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        out = [cache.get(p, 0) for p in pieces]
        if 0 in out:
            for k, n in enumerate(out):
                if not n:
                    p = pieces[k]
                    n = cache.get(p, 0) or len(self.encoding.encode_ordinary(p))
                    out[k] = cache[p] = n
        return out


class CountedText:
    """A text under a segment tree of token counts; ``replace`` edits it."""

    def __init__(self, text: str, counter: PieceCounter):
        self.counter = counter
        self._build(text)

    def _build(self, text: str) -> None:
        pieces = self.counter.find(text)
        self.reencoded = len(text)
        counts = self.counter.counts(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lens)
        cut = np.flatnonzero(np.diff(ends // LEAF_CHARS, prepend=0)) + 1 if len(ends) else np.zeros(0, np.int64)
        bounds = [0, *[c for c in cut.tolist() if c < len(pieces)], len(pieces)]
        self.leaves = [(pieces[a:b], counts[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.size = 1 << max(0, (len(self.leaves) - 1)).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for k, (p, c) in enumerate(self.leaves):
            self.chars[self.size + k], self.tokens[self.size + k] = sum(map(len, p)), sum(c)
        lo = self.size
        while lo > 1:  # a level at a time
            for t in (self.chars, self.tokens):
                t[lo // 2:lo] = t[lo:2 * lo:2] + t[lo + 1:2 * lo:2]
            lo //= 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def text(self) -> str:
        return "".join(p for leaf, _ in self.leaves for p in leaf)

    def tokens_before(self, leaf: int) -> int:
        """Tokens of all leaves before one, by the tree."""
        at, out = self.size + leaf, 0
        while at > 1:
            if at & 1:
                out += int(self.tokens[at - 1])
            at >>= 1
        return out

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one at the end) and its first character."""
        at, start = 1, 0
        while at < self.size:
            left = int(self.chars[2 * at])
            at, start = (2 * at, start) if pos < start + left else (2 * at + 1, start + left)
        leaf = at - self.size
        while leaf >= len(self.leaves) or (leaf and not self.leaves[leaf][0]):
            leaf -= 1
            start -= int(self.chars[self.size + leaf])
        return leaf, start

    def _set(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf] = (pieces, counts)
        at = self.size + leaf
        self.chars[at], self.tokens[at] = sum(map(len, pieces)), sum(counts)
        while at > 1:
            at >>= 1
            self.chars[at], self.tokens[at] = self.chars[2 * at] + self.chars[2 * at + 1], self.tokens[2 * at] + self.tokens[2 * at + 1]

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of characters ``start..end``; returns the characters encoded again."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, base = self._leaf_at(max(0, start - CONTEXT - 1))
        while first and base > start - CONTEXT:
            first -= 1
            base -= int(self.chars[self.size + first])
        last, last_base = self._leaf_at(end)
        last_end = last_base + int(self.chars[self.size + last])
        while True:
            old = [p for leaf, _ in self.leaves[first:last + 1] for p in leaf]
            ends = (np.cumsum([len(p) for p in old]) + base).tolist() if old else []
            keep = bisect_right(ends, start - CONTEXT)  # pre-tokens that end early enough stay
            at = ends[keep - 1] if keep else base
            joined = "".join(old)
            more = joined[at - base:start - base] + new + joined[end - base:]
            shift = len(new) - (end - start)
            whole = last + 1 >= len(self.leaves)
            pieces, place, same = [], at, None
            bounds = {e: k for k, e in enumerate(ends) if e >= end}
            limit = at + len(more) - (0 if whole else CONTEXT)  # nearer to the cut the next leaf may matter
            for p in self.counter.find(more):
                if place + len(p) > limit:
                    break
                pieces.append(p)
                place += len(p)
                if place - shift in bounds and place >= start + len(new):
                    same = bounds[place - shift]
                    break
            if same is not None or whole:
                break
            last += 1
            last_end += int(self.chars[self.size + last])
        tail = old[same + 1:] if same is not None else []
        done = sum(map(len, pieces))
        result = old[:keep] + pieces + tail
        counts = self.counter.counts(result)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, [], [])
        self._set(first, result, counts)
        empty = sum(not p for p, _ in self.leaves)
        if self.chars[self.size + first] > GROWTH * LEAF_CHARS or 2 * empty > len(self.leaves) + 8:
            self._build(self.text())
        return done


_COUNTERS: dict[tuple[str, str], PieceCounter] = {}


def counter(rank_file: str, pattern: str) -> PieceCounter:
    if (rank_file, pattern) not in _COUNTERS:
        _COUNTERS[rank_file, pattern] = PieceCounter(rank_file, pattern)
    return _COUNTERS[rank_file, pattern]


def count_with_edits(docs: DataFrame, edits: Column, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, n_chars, n_tokens, edited_chars, edited_tokens, reencoded_chars`` per row of
    ``docs`` (``doc_id, text``); ``edits`` is an ``array<struct<start, end, new>>`` in characters."""
    ship_package(docs.sparkSession)

    def run(batches):
        count = counter(rank_file, pattern)
        for batch in batches:
            out = []
            for t, es in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
                c = CountedText(t, count)
                row = [c.n_chars, c.n_tokens]
                redone = sum(c.replace(e["start"], e["end"], e["new"] or "") for e in es or () if e is not None and e["start"] is not None and e["end"] is not None)
                out.append((*row, c.n_chars, c.n_tokens, redone))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in cols]], ["doc_id", "n_chars", "n_tokens", "edited_chars", "edited_tokens", "reencoded_chars"])
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), edits.cast("array<struct<start: long, end: long, new: string>>").alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, edited_chars long, edited_tokens long, reencoded_chars long")
