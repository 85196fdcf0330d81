"""Operator 6, document fingerprints: an invertible Bloom lookup sketch of paragraphs.

A paragraph is a line, cut again after sentence ends; its digest is a 64-bit
hash of its text and of how often it occurred before, so repeats stay apart.
Each digest is added to ``HASHES`` cells of ``(count, xor of digests, sum of
check hashes)``. Sketches of two versions subtract cell by cell and peeling
cells that hold one digest recovers what either side has alone. When peeling
fails both sketches are built again with more cells. ``likeness`` is the
Jaccard similarity that follows from the recovered digests.

``fingerprints`` compares every document with its own edit and with the next
document in descending ``doc_id`` order. Documents are dealt once, by ranges of
``doc_id``; each range also gets the last document of the range before it, so no
task or group holds more than its range and no global order is sorted in one
place.

Null and blank texts have an empty sketch; two empty ones are alike (1.0). Equal
ids are ordered by their text's hash, equal rows are interchangeable; null ids
come last in descending order. A table of one document is its own next.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.session import ship_package

CELLS = 16
HASHES = 3
MAX_RETRIES = 8
RANGE_BYTES = 16 << 20


def paragraphs(text: str) -> list[str]:
    """Non-blank lines, cut again after sentence ends."""
    return [p for p in (m.strip() for m in re.split(r"\n|(?<=[.!?]) ", text)) if p]


def digests(text: str) -> np.ndarray:
    """A distinct 64-bit digest for every paragraph occurrence."""
    seen: dict[str, int] = {}
    out = []
    for p in paragraphs(text):
        n = seen[p] = seen.get(p, -1) + 1
        out.append(xxhash.xxh3_64_intdigest(p.encode(), n))
    return np.array(out, np.uint64)


_ALL = (1 << 64) - 1
_CHECK = 0xD6E8FEB86659FD93
# odd multipliers, one for every cell of a digest and, by position, for every retry
_PLACE = [[(0x9E3779B97F4A7C15 * (2 * (HASHES * r + j) + 1) ^ 0xBF58476D1CE4E5B9 * (r + 1)) % (1 << 64) | 1 for j in range(HASHES)] for r in range(MAX_RETRIES + 1)]


class Sketch:
    """``cells`` cells in ``HASHES`` equal parts; a digest falls into one cell of each part."""

    def __init__(self, cells: int, seed: int = 0):
        self.part = max(2, -(-cells // HASHES))
        self.seed = seed
        n = self.part * HASHES
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def add(self, keys: np.ndarray) -> "Sketch":
        at = np.stack([((keys * np.uint64(m)) >> np.uint64(33)) % np.uint64(self.part) for m in _PLACE[self.seed]]).astype(np.int64)
        at += np.arange(HASHES)[:, None] * self.part
        self.count += np.bincount(at.ravel(), minlength=len(self.count))
        np.bitwise_xor.at(self.keys, at, keys)
        np.bitwise_xor.at(self.checks, at, (keys * np.uint64(_CHECK)) >> np.uint64(32))
        return self

    def minus(self, other: "Sketch") -> "Sketch":
        if (self.part, self.seed) != (other.part, other.seed):
            raise ValueError("sketches of different shapes")
        out = Sketch(self.part * HASHES, self.seed)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Digests with a positive and with a negative count, or None if some cells cannot be undone."""
        count, keys, checks = self.count.tolist(), self.keys.tolist(), self.checks.tolist()
        plus, minus, part, places = [], [], self.part, _PLACE[self.seed]
        todo = [c for c, n in enumerate(count) if n == 1 or n == -1]
        while todo:
            c = todo.pop()
            n, key = count[c], keys[c]
            check = (key * _CHECK & _ALL) >> 32
            if n not in (1, -1) or checks[c] != check:
                continue
            (plus if n > 0 else minus).append(key)
            for j, m in enumerate(places):
                at = ((key * m & _ALL) >> 33) % part + j * part
                count[at] -= n
                keys[at] ^= key
                checks[at] ^= check
                if count[at] == 1 or count[at] == -1:
                    todo.append(at)
        if any(count) or any(keys):
            return None
        return np.array(plus, np.uint64), np.array(minus, np.uint64)

    def __str__(self) -> str:
        body = self.count.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u4").tobytes()
        return base64.b64encode(body).decode()


def difference(a: np.ndarray, b: np.ndarray, base: tuple[Sketch, Sketch] | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Digests only in ``a``, only in ``b``, and the retries it took. The first
    retry has room for every digest, each further one doubles the cells; after
    ``MAX_RETRIES`` (never seen) the digest lists themselves are compared."""
    pair, cells = base or (Sketch(CELLS).add(a), Sketch(CELLS).add(b)), CELLS
    for retry in range(MAX_RETRIES):
        found = pair[0].minus(pair[1]).peel()
        if found is not None:
            return found[0], found[1], retry
        cells = max(2 * cells, 3 * (len(a) + len(b)) // 2)
        pair = Sketch(cells, retry + 1).add(a), Sketch(cells, retry + 1).add(b)
    return np.setdiff1d(a, b), np.setdiff1d(b, a), MAX_RETRIES


def likeness(a: np.ndarray, b: np.ndarray, base: tuple[Sketch, Sketch] | None = None) -> float:
    """Jaccard similarity of two digest sets by sketch difference."""
    plus, minus, _ = difference(a, b, base)
    union = len(a) + len(minus)
    return (len(a) - len(plus)) / union if union else 1.0


def _compare(batches):
    """Rows of one or more ranges, each ascending behind the document before it."""
    bucket, last, last_d, last_s = None, None, None, None
    for batch in batches:
        out = []
        for b, before, i, t in zip(*(batch.column(c).to_pylist() for c in ("bucket", "is_before", "doc_id", "text"))):
            d = digests(t)
            s = Sketch(CELLS).add(d)
            if not before:
                if b != bucket:
                    raise RuntimeError("a range lacks the document before it")
                k = len(t) // 3
                edited = t[:len(t) - k] + last[:k]
                e = digests(edited)
                es = Sketch(CELLS).add(e)
                out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(s), str(es), likeness(d, e, (s, es)), likeness(d, last_d, (s, last_s))))
            bucket, last, last_d, last_s = b, t, d, s
        cols = list(zip(*out)) if out else [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // range_bytes))
    cuts = sorted({int(x) for x in docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.25 / n)}) if n > 1 else []

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(-(1 << 63)).astype("int64")
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), known.to_numpy(), "right").astype("int32"))

    placed = docs.withColumn("bucket", range_of("doc_id") if cuts else F.lit(0))
    ends = placed.groupBy("bucket").agg(F.max("doc_id").alias("end")).orderBy("bucket").collect()  # a row a range
    order = [r["bucket"] for r in ends]
    to = [(order[(k + 1) % len(order)], r["end"]) for k, r in enumerate(ends)]
    before = spark.createDataFrame(to, "bucket int, end long")
    carried = docs.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("end"))).select("doc_id", "text", "bucket", F.lit(True).alias("is_before"))
    rows = placed.withColumn("is_before", F.lit(False)).unionByName(carried)
    rows = rows.repartitionById(len(order), F.col("bucket") % F.lit(len(order))) if len(order) > 1 else rows.repartition(1)
    rows = rows.sortWithinPartitions("bucket", F.desc("is_before"), "doc_id", F.xxhash64("text"))
    return rows.select("bucket", "is_before", "doc_id", "text").mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
