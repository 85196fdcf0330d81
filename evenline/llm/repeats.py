"""Operator 10, substring dedup: a count-min prefilter, then exact grouping.

A window is ``width`` consecutive words of one document. A word goes when it
lies in a window whose word sequence also starts earlier in the corpus
(smaller ``doc_id``, or same document and smaller position).

1. *Whole copies.* Documents with the same word sequence are grouped by a
   128-bit hash; all but the smallest id lose every word if they have at least
   ``width`` words. They need no window.
2. *Sketch.* A window is counted under its anchor: the smallest of the hashes
   of its ``GRAM``-word grams, a function of the window alone, so equal windows
   have equal anchors and an anchor occurs at least as often as any of its
   windows. Every task counts its anchors in its part of a count-min sketch of
   ``ROWS`` rows and emits it sparsely in shards; a grouped sum merges the
   shards. Cells grow with the bytes of the input. What stays of the sketch is
   one bit per cell: counted twice or more.
3. *Exact pass.* Windows whose anchor is estimated repeated (never an
   underestimate, so none is lost) are emitted with a 128-bit hash and grouped:
   the first position of each hash is a partial aggregate, and every other
   position of it marks ``width`` words.

The bits are broadcast while they are under ``max_sketch_bytes``. Beyond it the
anchors are semi-joined with the repeated cells instead, with the same result.

Texts of documents that lose no word stay where they are: one bit per hash of a
changed document's id is broadcast, and only texts whose bit is set are
shuffled to the positions to cut.

Null and blank texts have no window; repeated rows of one ``doc_id`` with one
text count as one document; rows that share a ``doc_id`` with different texts
are documents of their own, in the order of their texts' md5. Rows with a null
id have no place in the order: they are compared with nothing and kept whole.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evenline.llm.spool import spool
from evenline.llm.words import Block, blocks, mix64, rolling, sliding_min, spread
from evenline.session import ship_package

WIDTH = 20
GRAM = 10
ROWS = 2
CELLS_PER_BYTE = 0.125     # sketch cells per row and byte of text: about five per anchor
SHARD_BITS = 20            # cells of one shard of a row
MAX_SKETCH_BYTES = 96 << 20
MAX_BROADCAST_IDS = 1_000_000
CELLS_PER_CHANGE = 8       # bits that tell documents with a change from others: one for each, broadcast in words of 64
MAX_LISTED_CELLS = 1 << 26 # a million words; more changes than these can part move more texts, with the same result
_ODD1, _ODD2, _ODD3 = 0xD1342543DE82EF95, 0xDA942042E4DD58B5, 0xAEF17502108EF2D9


def _anchors(b: Block, h: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the block in runs that share one anchor occurrence: the first
    word of every window, then per run its index into them, its length and its anchor."""
    none = np.zeros(0, np.int64)
    if len(h) < width:
        return none, none, none, np.zeros(0, np.uint64)
    g = rolling(h, gram, _ODD3)
    low = np.uint64(0xFFFFFFFF)
    at = sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), width - gram + 1) & low  # the leftmost of the smallest
    i = np.flatnonzero(b.doc[:len(at)] == b.doc[width - 1:])
    if not len(i):
        return none, none, none, np.zeros(0, np.uint64)
    at = at[i].astype(np.int64)
    s = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return i, s, np.diff(np.append(s, len(i))), g[at[s]]


def _cells(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix64(anchor ^ np.uint64(0x632BE59BD9B4E019 * (row + 1) % (1 << 64))) >> np.uint64(64 - bits)


def sketch_bits(text_bytes: int) -> int:
    """Log2 of the cells of a sketch row, in proportion to the input."""
    return max(SHARD_BITS, int(text_bytes * CELLS_PER_BYTE).bit_length())


def _partial_sketch(width: int, gram: int, bits: int):
    def run(batches):
        for batch in batches:
            parts = [[] for _ in range(ROWS)]
            for b in blocks(batch.column("text")):
                _, _, _, a = _anchors(b, b.hashes(), width, gram)
                for r in range(ROWS):
                    parts[r].append(_cells(a, r, bits))
            out_r, out_s, out_c = [], [], []
            for r in range(ROWS):
                c, n = np.unique(np.concatenate(parts[r]) if parts[r] else np.zeros(0, np.uint64), return_counts=True)
                shard = (c >> np.uint64(SHARD_BITS)).astype(np.int64)
                low = (c & np.uint64((1 << SHARD_BITS) - 1)).astype(np.uint32) | ((n > 1).astype(np.uint32) << np.uint32(31))
                cut = np.flatnonzero(np.diff(shard)) + 1
                for x, y in zip(np.split(low, cut), np.split(shard, cut)):
                    if len(x):
                        out_r.append(r)
                        out_s.append(int(y[0]))
                        out_c.append(x.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_r, pa.int32()), pa.array(out_s, pa.int64()), pa.array(out_c, pa.binary())], ["row", "shard", "cells"])
    return run


def _merge_sketch(pdf):
    import pandas as pd
    seen = np.zeros(1 << SHARD_BITS, np.uint8)
    for raw in pdf["cells"]:
        x = np.frombuffer(raw, "<u4")
        at = x & np.uint32((1 << SHARD_BITS) - 1)
        seen[at] = np.minimum(seen[at] + 1 + (x >> np.uint32(31)), 2)  # cells are distinct within one partial sketch
    return pd.DataFrame({"row": [int(pdf["row"].iloc[0])], "shard": [int(pdf["shard"].iloc[0])],
                         "bits": [np.packbits(seen > 1).tobytes()]})


def repeated_cells(docs: DataFrame, width: int, gram: int, bits: int) -> DataFrame:
    """``row, shard, bits``: cells of the merged sketch that were counted twice or more."""
    partial = docs.select("text").mapInArrow(_partial_sketch(width, gram, bits), "row int, shard long, cells binary")
    return partial.groupBy("row", "shard").applyInPandas(_merge_sketch, "row int, shard long, bits binary")


def _keys(batch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and, above 32 bits, variants: what a position in a document starts from."""
    return batch.column("doc_id").to_numpy(), batch.column("variant").to_numpy().astype(np.int64) << 32


def _windows(b: Block, ids: np.ndarray, lead: np.ndarray, h: np.ndarray, i: np.ndarray, width: int) -> pa.RecordBatch:
    """Hash, document and position of the windows that start at words ``i``."""
    w1, w2 = rolling(h, width, _ODD1), rolling(h, width, _ODD2)
    d = b.doc[i]
    return pa.RecordBatch.from_arrays([pa.array(w1[i].view(np.int64)), pa.array(w2[i].view(np.int64)), pa.array(ids[b.first + d].astype(np.int64)),
                                       pa.array(i - b.word_offsets[d] + lead[b.first + d])], ["h1", "h2", "doc_id", "start"])


def _flagged_windows(width: int, gram: int, bits: int, sketch):
    """Windows whose anchor the broadcast sketch estimates repeated."""
    def run(batches):
        rows = sketch.value
        for batch in batches:
            ids, lead = _keys(batch)
            for b in blocks(batch.column("text")):
                h = b.hashes()
                i, s, n, a = _anchors(b, h, width, gram)
                ok = np.ones(len(s), bool)
                for r in range(ROWS):
                    c = _cells(a, r, bits)
                    ok &= (rows[r][(c >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (c & np.uint64(7))).astype(np.uint8)) & 1 == 1
                j = i[spread(s[ok], n[ok])]
                if len(j):
                    yield _windows(b, ids, lead, h, j, width)
    return run


def _anchor_rows(width: int, gram: int, bits: int):
    """``cell, doc_id, start, n``: runs of windows under their sketch cell."""
    def run(batches):
        for batch in batches:
            ids, lead = _keys(batch)
            for b in blocks(batch.column("text")):
                i, s, n, a = _anchors(b, b.hashes(), width, gram)
                d = b.doc[i[s]]
                yield pa.RecordBatch.from_arrays([pa.array(_cells(a, 0, bits).astype(np.int64)), pa.array(ids[b.first + d].astype(np.int64)),
                                                  pa.array(i[s] - b.word_offsets[d] + lead[b.first + d]), pa.array(n.astype(np.int32))], ["cell", "doc_id", "start", "n"])
    return run


def _cell_rows(batches):
    for batch in batches:
        out = [(np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8))) + (s << SHARD_BITS)) for s, raw in zip(batch.column("shard").to_pylist(), batch.column("bits").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))], ["cell"])


def _listed_windows(width: int):
    """Windows of the listed runs of each document."""
    def run(batches):
        for batch in batches:
            ids, lead = _keys(batch)
            starts, ns = batch.column("starts").to_pylist(), batch.column("ns").to_pylist()
            for b in blocks(batch.column("text")):
                h = b.hashes()
                j = [np.unique(spread(np.array(starts[b.first + k], np.int64) & 0xFFFFFFFF, np.array(ns[b.first + k], np.int64))) + b.word_offsets[k] for k in range(b.n_docs)]
                j = np.concatenate(j) if j else np.zeros(0, np.int64)
                if len(j):
                    yield _windows(b, ids, lead, h, j, width)
    return run


def _sequence_hash(batches):
    """Word count and a 128-bit hash of each document's word sequence."""
    for batch in batches:
        for b in blocks(batch.column("text")):
            h = b.hashes()
            raw = h.astype("<u8").tobytes()
            o = (b.word_offsets * 8).tolist()
            dig = [hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(o, o[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(b.first, b.n_docs), pa.array(b.n_words.astype(np.int64)), pa.array(dig, pa.binary())],
                                             ["doc_id", "n_words", "seq"])


def _cut(width: int):
    """Remove the marked words and hash what is left."""
    def run(batches):
        for batch in batches:
            copies, starts = batch.column("is_copy").to_pylist(), batch.column("starts").to_pylist()
            n_words, removed, sha = [], [], []
            for b in blocks(batch.column("text")):
                raw = b.data.tobytes()
                for k in range(b.n_docs):
                    lo, hi = int(b.word_offsets[k]), int(b.word_offsets[k + 1])
                    n, gone = hi - lo, np.zeros(hi - lo, bool)
                    if copies[b.first + k]:
                        gone[:] = n >= width
                    elif starts[b.first + k]:
                        edge = np.zeros(n + 1, np.int64)
                        s = np.unique(np.array(starts[b.first + k], np.int64) & 0xFFFFFFFF)
                        edge[s] += 1
                        edge[s + width] -= 1
                        gone = np.cumsum(edge)[:n] > 0
                    n_words.append(n)
                    removed.append(int(gone.sum()))
                    if removed[-1] == n:
                        words = []
                    elif removed[-1]:
                        at = lo + np.flatnonzero(~gone)
                        words = [raw[x:y] for x, y in zip(b.start[at].tolist(), b.end[at].tolist())]
                    else:
                        words = raw[b.offsets[k]:b.offsets[k + 1]].split()
                    sha.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array([x.decode() for x in sha], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def split_listed(docs: DataFrame, changes: DataFrame, most: int = MAX_LISTED_CELLS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose id is surely not in ``changes``, and the others: those with a change and a few whose id falls on the bit of one."""
    cells = min(most, max(64, 1 << (changes.count() * CELLS_PER_CHANGE).bit_length()))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells))
    word, bit = F.shiftright(cell, 6).alias("word"), cell.bitwiseAND(F.lit(63)).cast("int")
    bits = changes.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    marked = docs.withColumn("word", word).join(F.broadcast(bits), "word", "left").withColumn("listed", F.bit_get(F.coalesce("bits", F.lit(0).cast("long")), bit) == 1)
    return tuple(marked.where(x).select(*docs.columns) for x in (~F.col("listed"), F.col("listed")))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, max_sketch_bytes: int = MAX_SKETCH_BYTES, max_listed_cells: int = MAX_LISTED_CELLS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words joined by one space) per document."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if not 0 < gram <= width:
        raise ValueError("gram must lie between 1 and width")

    again = spool(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    docs = docs.withColumn("variant", F.lit(0))
    if not again.isEmpty():  # several texts under one id: numbered in the order of their md5
        texts = docs.join(again, "doc_id", "left_semi").select("doc_id", F.md5("text").alias("md5")).distinct()
        texts = texts.withColumn("nth", F.row_number().over(W.partitionBy("doc_id").orderBy("md5")) - 1)
        docs = docs.withColumn("md5", F.md5("text")).join(texts, ["doc_id", "md5"], "left").select("doc_id", "text", F.coalesce("nth", F.lit(0)).alias("variant"))

    seq = docs.select("doc_id", "text").mapInArrow(_sequence_hash, "doc_id long, n_words long, seq binary")
    first = seq.where(F.col("n_words") >= width).groupBy("seq").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("seq", "first_id")
    copies = spool(seq.join(spool(first, "sequences"), "seq").where(F.col("doc_id") > F.col("first_id")).select("doc_id").distinct()
                   .join(again, "doc_id", "left_anti"), "copies")
    small = copies.count() <= MAX_BROADCAST_IDS
    alone = docs.where("doc_id is not null").join(F.broadcast(copies) if small else copies, "doc_id", "left_anti")

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch_bits(size)
    cells = spool(repeated_cells(alone, width, gram, bits), "sketch")
    if ROWS << (bits - 3) <= max_sketch_bytes:
        rows = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(ROWS)]
        step = 1 << (SHARD_BITS - 3)
        for r in cells.collect():  # within max_sketch_bytes
            rows[r["row"]][r["shard"] * step:(r["shard"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
        found = alone.mapInArrow(_flagged_windows(width, gram, bits, spark.sparkContext.broadcast(rows)), "h1 long, h2 long, doc_id long, start long")
    else:
        repeated = cells.where("row = 0").mapInArrow(_cell_rows, "cell long")
        hits = (alone.mapInArrow(_anchor_rows(width, gram, bits), "cell long, doc_id long, start long, n int")
                .join(repeated, "cell", "left_semi").groupBy("doc_id", F.shiftright("start", 32).cast("int").alias("variant"))
                .agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns")))
        found = alone.join(hits, ["doc_id", "variant"]).mapInArrow(_listed_windows(width), "h1 long, h2 long, doc_id long, start long")
    # the windows are found twice rather than written: hashing is cheaper than their disk. The first positions are
    # written, so that both sides of the join are plain exchanges and a hot window's rows can be split.
    first = spool(found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"))
                  .where("n > 1").select("h1", "h2", "first"), "first")
    marks = (found.join(first, ["h1", "h2"]).where(F.struct("doc_id", "start") != F.col("first"))
             .groupBy("doc_id", F.shiftright("start", 32).cast("int").alias("variant")).agg(F.collect_list("start").alias("starts")))
    changes = spool(marks.select("doc_id", "variant", "starts", F.lit(False).alias("is_copy")).unionByName(
        copies.select("doc_id", F.lit(0).alias("variant"), F.lit(None).cast("array<long>").alias("starts"), F.lit(True).alias("is_copy"))), "changes")
    columns = "doc_id", "text", "starts", F.coalesce("is_copy", F.lit(False)).alias("is_copy")
    kept, moved = split_listed(docs, changes, max_listed_cells)
    listed = moved.join(changes, ["doc_id", "variant"], "left").select(*columns).unionByName(
        kept.select("doc_id", "text", F.lit(None).cast("array<long>").alias("starts"), F.lit(False).alias("is_copy")))
    return listed.mapInArrow(_cut(width), "doc_id long, n_words long, n_removed long, kept string")
