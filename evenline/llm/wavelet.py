"""Operator 5, token-ID output: a wavelet matrix per shard of ids.

``WaveletMatrix`` stores ids as bit-planes, most significant first; every plane
keeps the order the planes above have sorted ids into (zeros before ones). With
ranks over the packed planes one file answers access, counting and the places
of an id without decoding. ``write_tokens`` encodes whole texts in ascending
``doc_id`` order (equal ids by their text's hash) and writes shards of about
``SHARD_IDS`` ids; ``read_tokens`` reads them back.

A shard is a row ``part, block, docs, planes`` of zstd-compressed Parquet, so
Spark's committer makes a retried task's file whole; a document never spans
shards. Range partitions are balanced by a sample of the ids; a text longer
than a shard is a shard of its own.

Null and blank texts hold the end id alone; repeated rows are encoded each; a
null id sorts first. An empty table writes no shard. Extra columns are not read.
Words are told apart by 64-bit hashes in a worker's cache of at most
``CACHE_BYTES`` and the words of one block of text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evenline.llm.words import Block, blocks, lowered, spread
from evenline.session import ship_package

SHARD_IDS = 1 << 20
PARTITION_BYTES = 16 << 20
END_ID = 2
CACHE_BYTES = 64 << 20
JOINED, JOINED_PLAIN = 200, 20
MARK = "\x01"  # no letter, digit or space: a pre-token of its own
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch  # letters that normalization and lower-casing leave alone
RAW_SEED = 0x9FB21C651E98DF25  # parts the hashes of words as they are from those of lower-case cores
PLAIN_SAMPLE = "straße éàüöñçøÿ"
CLOSING, ALNUM = np.zeros(256, bool), np.zeros(256, bool)
CLOSING[list(b".,;:!?")] = True
ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_HEAD = struct.Struct("<4sBQ")
_MAGIC = b"WVM1"
_RANK_WORDS = 8  # 64-bit words between two entries of the rank directory


class WaveletMatrix:
    """Bit-planes over ``n`` ids below ``2 ** planes``."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self.words, self.ranks, self.zeros = [], [], []
        for p in planes:
            w = np.zeros(-(-n // 64) + 1, "<u8")
            w.view(np.uint8)[:len(p)] = p
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(w), dtype=np.int64)))
            self.words.append(w)
            self.ranks.append(ones[::_RANK_WORDS].copy())
            self.zeros.append(n - int(ones[-1]))

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = 16) -> "WaveletMatrix":
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = []
        for k in range(bits - 1, -1, -1):
            one = (x >> x.dtype.type(k)) & x.dtype.type(1) != 0
            planes.append(np.packbits(one, bitorder="little"))
            x = np.concatenate((x[~one], x[one]))
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        return _HEAD.pack(_MAGIC, len(self.planes), self.n) + b"".join(p.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "WaveletMatrix":
        magic, bits, n = _HEAD.unpack_from(raw)
        size = -(-n // 8)
        if magic != _MAGIC or len(raw) != _HEAD.size + bits * size:
            raise ValueError("not a wavelet matrix, or cut short")
        return cls(n, [np.frombuffer(raw, np.uint8, size, _HEAD.size + k * size) for k in range(bits)])

    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones of plane ``k`` before position ``i``: a directory entry, whole words, and a masked word."""
        i = np.asarray(i, np.int64)
        word = i >> 6
        lead = word // _RANK_WORDS
        out = self.ranks[k][lead].copy()
        w = self.words[k]
        for j in range(_RANK_WORDS - 1):
            at = lead * _RANK_WORDS + j
            out += np.where(at < word, np.bitwise_count(w[np.minimum(at, len(w) - 1)]), 0)
        rest = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(w[word] & rest)

    def _bit(self, k: int, i: np.ndarray) -> np.ndarray:
        return (self.words[k][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def access(self, at) -> np.ndarray:
        """Ids at the given positions."""
        i = np.atleast_1d(np.asarray(at, np.int64)).copy()
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("position outside the shard")
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.planes)):
            one, r = self._bit(k, i), self._rank1(k, i)
            out = out << 1 | one
            i = np.where(one, self.zeros[k] + r, i - r)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        bits = len(self.planes)
        if token < 0 or token >> bits:
            return 0, 0
        for k in range(bits):
            r = self._rank1(k, np.array([lo, hi]))
            lo, hi = (self.zeros[k] + int(r[0]), self.zeros[k] + int(r[1])) if token >> (bits - 1 - k) & 1 else (lo - int(r[0]), hi - int(r[1]))
        return lo, hi

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of an id before position ``end`` (the whole shard by default)."""
        lo, hi = self._range(token, self.n if end is None else min(max(end, 0), self.n))
        return hi - lo

    def _select(self, k: int, bit: bool, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth (from 0) ones or zeros of a plane, by binary search over ranks."""
        lo, hi = np.zeros(len(nth), np.int64), np.full(len(nth), self.n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            r = self._rank1(k, np.minimum(mid + 1, self.n))
            have = r if bit else np.minimum(mid + 1, self.n) - r
            go = have > nth
            live = lo < hi
            hi, lo = np.where(live & go, mid, hi), np.where(live & ~go, mid + 1, lo)
        return lo

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of an id, ascending."""
        lo, hi = self._range(token, self.n)
        i = np.arange(lo, hi)
        bits = len(self.planes)
        for k in range(bits - 1, -1, -1):
            bit = bool(token >> (bits - 1 - k) & 1)
            i = self._select(k, bit, i - self.zeros[k] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids: planes are undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            y = np.empty_like(x)
            y[~one] = x[:self.zeros[k]]
            y[one] = x[self.zeros[k]:] | x.dtype.type(1 << (len(self.planes) - 1 - k))
            x = y
        return x


class WordEncoder:
    """Ids of white-space separated words, encoded once a worker. Tokenizers that
    drop white space encode word by word: their pieces never span a gap.

    A word is a lower-case core and closing marks, both pre-token bounds, known by
    64-bit hashes made for a block of text at once. ``flat[offset[e]:offset[e + 1]]``
    are the ids of entry ``e``, entry 0 is the end id; ``keys`` has the hashes seen so
    far, sorted, and ``entry`` their entries. All of it is dropped beyond ``CACHE_BYTES``."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tok, self.end_id = Tokenizer.from_file(path), end_id
        self.bits = max(1, (max(self.tok.get_vocab_size(True), end_id + 1) - 1).bit_length())
        mark = self.tok.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None  # parts words in a joined string
        # for words that the normalizer leaves as they are and the pattern takes whole, the model alone
        self.plain = Tokenizer(self.tok.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.has_plain = self.mark is not None and all(
            self.plain.encode(w, add_special_tokens=False).ids == self.tok.encode(w, add_special_tokens=False).ids for w in (f"ab {MARK} {PLAIN_SAMPLE}", MARK))
        self.reset()

    def reset(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.flat[0] = self.end_id
        self.offset = np.zeros(1 << 16, np.int64)
        self.offset[1] = 1
        self.n = 1

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """New entries of the given sizes; returns the first."""
        first, end = self.n, self.offset[self.n] + np.cumsum(sizes)
        while self.n + len(sizes) + 1 > len(self.offset):
            self.offset = np.concatenate((self.offset, np.zeros_like(self.offset)))
        while len(end) and end[-1] > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        if len(end):
            self.flat[self.offset[first]:end[-1]] = ids
            self.offset[first + 1:first + 1 + len(sizes)] = end
        self.n += len(sizes)
        return first

    def _joined(self, tok, words: list[str], size: int) -> int:
        """Entries of words that hold no mark, many in one string with a mark between them."""
        start = self.n
        for a in range(0, len(words), size * 256):
            texts = [f" {MARK} ".join(words[b:b + size]) for b in range(a, min(a + size * 256, len(words)), size)]
            ids = [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast([t + f" {MARK}" for t in texts], add_special_tokens=False)]
            ids = np.concatenate(ids)
            cut = np.flatnonzero(ids == self.mark)
            self._append(np.delete(ids, cut), np.diff(cut, prepend=-1) - 1)
        return start

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Entries of distinct words not seen so far."""
        words = [w.decode() for w in words]
        kind = np.array([2 if self.mark is None or MARK in w else 0 if self.has_plain and PLAIN(w) else 1 for w in words], np.int8)
        out = np.empty(len(words), np.int64)
        for k, tok, size in ((0, self.plain, JOINED_PLAIN), (1, self.tok, JOINED)):
            at = np.flatnonzero(kind == k)
            if len(at):
                out[at] = self._joined(tok, [words[j] for j in at.tolist()], size) + np.arange(len(at))
        for j in np.flatnonzero(kind == 2).tolist():
            ids = np.array(self.tok.encode(words[j], add_special_tokens=False).ids, np.uint32)
            out[j] = self._append(ids, np.array([len(ids)]))
        return out

    def _entries(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of every word ``data[start:end]`` under its hash."""
        seen, first, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, seen)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != seen if len(self.keys) else np.ones(len(seen), bool))
        if len(new):
            raw = data.tobytes()
            got = self._learn([raw[s:e] for s, e in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            self.keys, self.entry = np.insert(self.keys, at[new], seen[new]), np.insert(self.entry, at[new], got)
            at = np.searchsorted(self.keys, seen)
        return self.entry[at][back]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block, each followed by the end id, and the number of ids of each."""
        if self.keys.nbytes + self.entry.nbytes + self.flat.nbytes + self.offset.nbytes > CACHE_BYTES:
            self.reset()
        start, end, core = block.start, block.end, block.end
        if b"<|" in block.data.tobytes():  # words that may hold a special token stay as they are
            keys = block.hashes(seed=RAW_SEED)
        else:
            block = replace(block, data=lowered(block.data))
            core = end.copy()
            while len(at := np.flatnonzero((core > start) & CLOSING[block.data[core - 1]])):
                core[at] -= 1
            core = np.where((core > start) & ALNUM[block.data[core - 1]], core, end)
            keys = block.hashes(ends=core)
        data, marked = block.data, np.flatnonzero(core < end)
        if len(marked):  # closing marks, behind their core
            marks = replace(block, start=core[marked], end=end[marked]).hashes()
            keys, start, core = (np.insert(x, marked + 1, y) for x, y in ((keys, marks), (start, core[marked]), (core, end[marked])))
        words = block.word_offsets + np.searchsorted(marked, block.word_offsets)  # words and marks before each document
        at = np.insert(self._entries(keys, data, start, core), words[1:], 0)
        lens = self.offset[at + 1] - self.offset[at]
        total = np.concatenate(([0], np.cumsum(lens)))
        bounds = words[1:] + np.arange(1, len(words))
        return self.flat[spread(self.offset[at], lens)], np.diff(np.concatenate(([0], total[bounds])))


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _shards(path: str, end_id: int, shard_ids: int):
    def run(batches):
        enc = encoder(path, end_id)
        held, size, block, part = [], 0, 0, 0

        def flush():
            ids = np.concatenate([x[0] for x in held])
            docs = np.stack((np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([docs.astype("<i8").tobytes()], pa.binary()),
                                               pa.array([WaveletMatrix.build(ids, enc.bits).to_bytes()], pa.binary())], ["part", "block", "n_ids", "docs", "planes"])
        for batch in batches:
            if len(batch):
                part = batch.column("part")[0].as_py()
            keys = batch.column("doc_id")
            null = np.asarray(keys.is_null())
            keys = keys.fill_null(0).to_numpy()
            for b in blocks(batch.column("text"), block_bytes=1 << 20):
                ids, n = enc.encode(b)
                own = slice(b.first, b.first + b.n_docs)
                held.append((ids, keys[own], null[own].astype(np.int64), n))
                size += len(ids)
                if size >= shard_ids:
                    yield flush()
                    held, size, block = [], 0, block + 1
        if held:
            yield flush()
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, partition_bytes: int = PARTITION_BYTES) -> None:
    """Encode ``docs`` (``doc_id, text``) into wavelet-matrix shards under ``out``."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // partition_bytes))
    ordered = docs.repartitionByRange(parts, "doc_id") if parts > 1 else docs.repartition(1)
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text")).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    (ordered.mapInArrow(_shards(tokenizer, end_id, shard_ids), "part int, block int, n_ids long, docs binary, planes binary")
     .write.option("compression", "zstd").parquet(out))


def _read(batches):
    for batch in batches:
        for k in range(len(batch)):
            ids = WaveletMatrix.from_bytes(batch.column("planes")[k].as_py()).decode().astype("<u4")
            doc, null, n = np.frombuffer(batch.column("docs")[k].as_py(), "<i8").reshape(3, -1)
            end = np.cumsum(n)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip((end - n).tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(doc, mask=null > 0), pa.array(np.full(len(n), batch.column("part")[k].as_py(), np.int32)), pa.array(np.full(len(n), batch.column("block")[k].as_py(), np.int32)),
                                              pa.array(end - n), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "part", "block", "at", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shards under ``path``."""
    ship_package(spark)
    files = spark.read.schema("part int, block int, n_ids long, docs binary, planes binary").parquet(path)
    shards = files.select("part", "block", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("lead"))
    lead = shards.select("part", "block", F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("inner")).join(parts, "part")
    rows = files.mapInArrow(_read, "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long")
    return rows.join(lead, ["part", "block"]).select("doc_id", (F.col("lead") + F.col("inner") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``part, block, n, positions`` of an id in every shard that holds it, straight from the planes."""
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for p, b, raw in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), batch.column("planes")):
                at = WaveletMatrix.from_bytes(raw.as_py()).occurrences(token)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([b], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([at.tolist()], pa.list_(pa.int64()))], ["part", "block", "n", "positions"])
    files = spark.read.schema("part int, block int, n_ids long, docs binary, planes binary").parquet(path)
    return files.select("part", "block", "planes").mapInArrow(run, "part int, block int, n long, positions array<long>")
