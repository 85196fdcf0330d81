"""Operator 13, spelling variants by a bit-sliced position index.

Words that one insertion, deletion or replacement parts are found with one bitset
per (position, letter) over the vocabulary. A query's letters are read once; four
bitsets follow which words agree so far without an error and with one replaced,
deleted or inserted letter, the latter two reading the index one position lower or
higher. One step is a handful of word-parallel operations for all indexed words.

The vocabulary is dealt over shards by halves: of two words one edit apart, either
the first half of the query opens both, or its second half closes both. A query
visits the shard of its first half, where errors start behind it, and the shard of
its second half, where the first half must differ, so every pair is found once. A
half that more than ``HOT`` indexed words share gets shards of its own, each with a
part of its words and all of its queries: a stated query set against all rows, in
blocks.

Defined results: null and empty texts hold no words; a null id is an empty string
in the hash; rows that repeat count each time (equal ids and texts too); words of
any length take part (long ones in small blocks, so memory is bounded by
``CELLS`` and one word's length); ties for a form go to the smallest word in code
point order; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, so
extra columns of any name do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.llm.spool import spool
from evenline.session import ship_package

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPO = 97
MIN_LENGTH = 5
MIN_COUNT = 3
SHARD = 4096      # index words of a shard, on average
HOT = 1 << 16     # index words of one half before it is dealt over shards of its own
BLOCK = 4096      # words of one bitset
CELLS = 1 << 25   # position x letter x word cells of a block while it is built
QUERIES = 512     # queries of one length that run side by side
FRONT, BACK = 0, 1


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: runs of letters of ``docs`` (``doc_id, text``), A-Z lower-cased, where a run whose
    ``crc32("<doc_id>:<run>")`` ``TYPO`` divides misses the letter at that value modulo its length."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class Block:
    """Bitsets per (position, letter) over up to ``BLOCK`` words of similar length."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = words, np.array(counts, np.int64)
        self.rank = np.empty(len(words), np.int64)  # in code point order
        self.rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        lengths = np.array([len(w) for w in words], np.int64)
        self.shortest, self.longest = int(lengths.min()), int(lengths.max())
        n, self.width = len(words), -(-len(words) // 64)
        self.codes = np.zeros((self.longest + 2, self.width * 64), np.uint8)  # letter 0: behind the end
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            self.codes[:length, at] = np.frombuffer("".join([words[k] for k in at.tolist()]).encode("latin-1"), np.uint8).reshape(-1, length).T
        self.of_length = {length: self._pack(np.pad(lengths == length, (0, self.width * 64 - n))) for length in range(self.shortest, self.longest + 1)}
        self.none = np.zeros(self.width, np.uint64)
        present = np.unique(self.codes)
        present = present[present > 0]
        self.table = None
        if self.codes.size * (len(present) + 1) <= CELLS:
            self.row = np.full(256, len(present), np.int64)  # letters that no word holds: an empty bitset
            self.row[present] = np.arange(len(present))
            cells = np.zeros((len(present) + 1, *self.codes.shape), bool)
            for k, c in enumerate(present.tolist()):
                cells[k] = self.codes == c
            self.table = self._pack(cells)

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """A bitset per query: words with the query's letter at ``position``."""
        if position < 0 or position >= len(self.codes):
            return np.zeros((len(letters), self.width), np.uint64)
        if self.table is not None:
            return self.table[self.row[letters], position]
        return self._pack(self.codes[position][None, :] == letters[:, None])

    def one_error(self, letters: np.ndarray, side: int) -> np.ndarray:
        """A bitset per query (a row of letters): indexed words exactly one edit away whose
        first half (of the query's length) is the query's own (``FRONT``) or is not (``BACK``)."""
        q, m = letters.shape
        half = m // 2
        same = np.full((q, self.width), ~np.uint64(0))
        replaced = deleted = inserted = np.zeros((q, self.width), np.uint64)
        front = same
        below = self.at(-1, letters[:, 0])
        here = self.at(0, letters[:, 0])
        for k in range(m):
            if k == half:
                front = same
            above = self.at(k + 1, letters[:, k])
            if side == BACK or k >= half:
                if k:
                    below = self.at(k - 1, letters[:, k])
                inserted = (inserted | same) & above
                deleted = (deleted & below) | same
                replaced = (replaced & here) | (same & ~here)
            same = same & here
            if k + 1 < m:
                here = self.at(k + 1, letters[:, k + 1])
        inserted = inserted | same

        def only(length: int) -> np.ndarray:
            return self.of_length.get(length, self.none)[None, :]
        found = (replaced & only(m)) | (deleted & only(m - 1)) | (inserted & only(m + 1))
        return found & (front if side == FRONT else ~front)

    def matches(self, queries: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, indexed word) by index, queries of one length in order."""
        m = len(queries[0])
        if m + 1 < self.shortest or m - 1 > self.longest:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        letters = np.frombuffer("".join(queries).encode("latin-1"), np.uint8).reshape(len(queries), m)
        bits = self.one_error(letters, side)
        query, cell = np.nonzero(bits)
        k, bit = np.nonzero(np.unpackbits(bits[query, cell].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return query[k], cell[k] * 64 + bit


def cut_blocks(index: dict[str, int]) -> list[Block]:
    """Blocks of the words of a shard, by length."""
    words = sorted(index, key=lambda w: (len(w), w))
    out, a = [], 0
    while a < len(words):
        room = max(1, min(BLOCK, CELLS // 32 // len(words[a])))
        b = min(a + room, len(words))
        while b > a + 1 and len(words[b - 1]) > 2 * len(words[a]) + 64:  # a block's positions are those of its longest word
            b = a + (b - a) // 2
        out.append(Block(words[a:b], [index[w] for w in words[a:b]]))
        a = b
    return out


def nearest(blocks: list[Block], queries: list[str], side: int) -> Iterator[tuple[str, int, int, str]]:
    """``query, near words, count of the most frequent one, that word`` for queries with any."""
    found: dict[int, tuple[int, int, str]] = {}
    for block in blocks:
        query, word = block.matches(queries, side)
        if not len(query):
            continue
        order = np.lexsort((block.rank[word], -block.counts[word], query))
        query, word = query[order], word[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        for k, n, w in zip(query[first].tolist(), np.diff(first, append=len(query)).tolist(), word[first].tolist()):
            best = (-int(block.counts[w]), block.words[w])
            if k in found:
                m, c, old = found[k]
                n, best = n + m, min(best, (-c, old))
            found[k] = (n, -best[0], best[1])
    for k, (n, c, w) in found.items():
        yield queries[k], n, c, w


def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, side, query, size, word, n`` sorted by the first four: a shard's index words, then its queries."""
    at, index, blocks = None, {}, None
    for batch in batches:
        shard, side, query, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "side", "query", "size"))
        words, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        new = np.flatnonzero(np.any([np.diff(x.astype(np.int64), prepend=x[0]) != 0 for x in (shard, side, query, size)], axis=0)) if len(words) else []
        out: list[tuple[str, int, int, str]] = []
        for a, b in zip([0, *new], [*new, len(words)]):
            if a == b:
                continue
            if (shard[a], side[a]) != at:
                at, index, blocks = (shard[a], side[a]), {}, None
            if not query[a]:
                index.update(zip(words[a:b], n[a:b]))  # a word may come by both of its half lengths
                continue
            if blocks is None:
                blocks, index = cut_blocks(index), {}
            step = max(1, min(QUERIES, CELLS // 64 // int(size[a])))
            for k in range(a, b, step):
                out += nearest(blocks, words[k:min(k + step, b)], int(side[a]))
        cols = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])


def _halves(words: DataFrame) -> DataFrame:
    """``word, n, size, side, query, half``: the halves by which a word is asked for, and those by which words one longer or shorter ask."""
    size = F.length("word")

    def entry(side: int, query: bool, length: Column) -> Column:
        part = F.substring("word", F.lit(1), length) if side == FRONT else F.substring("word", size - length + 1, length)
        return F.struct(F.lit(side).alias("side"), F.lit(int(query)).alias("query"), part.alias("half"))
    low, mid, high = (size - 1).bitwiseAND(-2) / 2, size.bitwiseAND(-2) / 2, (size + 1).bitwiseAND(-2) / 2
    front = {k: x.cast("int") for k, x in (("low", low), ("mid", mid), ("high", high))}
    back = {k: (size + d - front[k]) for k, d in (("low", -1), ("mid", 0), ("high", 1))}
    entries = [entry(FRONT, True, front["mid"]), entry(BACK, True, back["mid"]),
               entry(FRONT, False, front["low"]), entry(FRONT, False, front["high"]), entry(BACK, False, back["low"]), entry(BACK, False, back["high"])]
    return words.select("word", "n", size.alias("size"), F.explode(F.array(*entries)).alias("e")).select("word", "n", "size", "e.*")


def near_words(words: DataFrame, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``word, n_near, best_n, best`` for rows of ``words`` (``word, n``; distinct) that have near words:
    how many, and the most frequent (smallest of ties)."""
    spark = words.sparkSession
    ship_package(spark)
    entries = _halves(words)
    n_shards = max(1, -(-4 * words.count() // shard))
    # a half in `heavy` has more than `hot` of the 4 index entries a word: at most 4 / hot rows a word
    heavy = (entries.where("query = 0").groupBy("side", "half").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot)
             .select("side", "half", F.ceil(F.col("m") / hot).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    part = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("query") == 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own)))
    dealt = entries.join(F.broadcast(heavy), ["side", "half"], "left").select("*", part.alias("part"))
    place = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("side", "half"), F.lit(n_shards))).otherwise(
        -1 - F.pmod(F.xxhash64("side", "half", "part"), F.lit(1 << 62)))
    rows = dealt.select(place.alias("shard"), "side", "query", "size", "word", "n")
    found = (rows.repartition(max(1, -(-n_shards // 8)), "shard").sortWithinPartitions("shard", "side", "query", "size")
             .mapInArrow(search_shards, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms`` (``word, form``): the last word behind each, by doubled steps. A form is
    at least twice as frequent as its word, so paths are no longer than the logarithm of the largest count."""
    jump = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open"))
    while True:
        after = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jump = spool(jump.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")), "roots")
        if jump.where("open").isEmpty():
            return jump.select("word", "root")


def spelling_forms(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``docs`` (``doc_id, text``). ``form`` is the
    most frequent near word if it occurs at least twice as often, ``root`` the last form reached from a word."""
    words = spool(count_words(docs, min_length, min_count), "words")
    known = words.join(near_words(words), "word", "left")
    known = spool(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[
        F.when(F.col("best_n") >= 2 * F.col("n"), F.col(c)).alias(a) for c, a in (("best", "form"), ("best_n", "form_n"))]), "forms")
    roots = follow_forms(known.where("form is not null").select("word", "form"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
