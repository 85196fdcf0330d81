"""Operator 8, n-gram Jaccard self-join: size-aware heavy-light join.

A document's set is its distinct ``width``-word shingles (64-bit hashes); two
sets link when ``100 * |A n B| >= percent * |A u B|``. All links between
different sets count; no candidate is capped or sampled.

1. Equal sets are one *node* (64-bit hash of the sorted set), so exact copies
   never meet each other.
2. Shingles get a global order, rarest first, from a count-min sketch whose
   merged levels (one byte a cell, at most ``2 ** MAX_CELL_BITS`` cells) are
   broadcast. Linked sets must agree in the first ``s - ceil(t s) + k`` shingles
   of this order at ``k`` places at least.
3. *Light* sets (up to ``boundary`` shingles) enumerate all 2-subsets of that
   prefix for ``k = 2``; *heavy* ones enter the inverted lists of their prefix
   for ``k = 1``, as do light sets that are large enough to link with a heavy
   one. The boundary minimises rows emitted plus expected list lengths over the
   histogram of sizes.
4. Each node first meets the most central leader of its lists, the one they name most often; verified links
   give components. In lists that still hold two components a node meets the
   clusters of the larger ones, then the members of clusters that it may link
   with, each step behind an exact bound on missing shingles, before pairs are
   verified on whole sets. Groups of near copies cost one pair a member.

Null and blank texts have an empty set, link with nothing and are their own
component; a text with fewer than ``width`` words is one shingle. Rows with a
null ``doc_id`` are returned with their size and a null component. Repeated rows
give repeated results; rows that share an id are one id in the components.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from evenline.llm.graph import components
from evenline.llm.spool import spool
from evenline.llm.words import Block, blocks, mix64, rolling, spread
from evenline.session import ship_package

WIDTH = 5
PERCENT = 75
SHINGLES_PER_CELL = 64
MIN_CELL_BITS, MAX_CELL_BITS, SHARD_BITS = 16, 26, 16
MAX_BROADCAST_IDS = 1_000_000
CROWD = 256              # members of a cluster whose lists are joined; larger ones are met in blocks
BLOCK_ENTRIES = 1 << 18  # list entries of one side of a block
BAND = 0.04  # width of a cluster's size band, in natural logarithm
_ODD = 0xD1342543DE82EF95
_SHORT = 0xA24BAED4963EE407


def _sets(b: Block, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of the block."""
    h = b.hashes()
    g = rolling(h, width, _ODD)
    out = []
    for lo, hi in zip(b.word_offsets.tolist(), b.word_offsets[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(g[lo:hi - width + 1]))
        elif hi > lo:  # the whole sequence as one
            out.append(rolling(h[lo:hi], hi - lo, _ODD) ^ np.uint64(_SHORT + hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=8).digest(), "little", signed=True)


def _describe(width: int, cell_bits: int):
    """One pass: a row per document (size and node), and the task's sketch of shingle counts in shards."""
    shards, cells = 1 << (cell_bits - SHARD_BITS), 1 << SHARD_BITS

    def run(batches):
        count = np.zeros(shards * cells, np.uint32)
        for batch in batches:
            for b in blocks(batch.column("text"), lower=True):
                sets = _sets(b, width)
                if b.n_docs:
                    every = np.concatenate(sets)
                    if len(every):
                        at, n = np.unique(every >> np.uint64(64 - cell_bits), return_counts=True)
                        count[at.astype(np.int64)] += n.astype(np.uint32)
                k = b.n_docs
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(b.first, k), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) for s in sets], pa.int64()),
                                                  pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], ["doc_id", "n", "node", "shard", "counts"])
        for s in range(shards):
            part = count[s * cells:(s + 1) * cells]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([s], pa.int32()),
                                                  pa.array([np.minimum(part, 255).astype(np.uint8).tobytes()], pa.binary())], ["doc_id", "n", "node", "shard", "counts"])
    return run


def _merge(pdf):
    import pandas as pd
    total = np.zeros(1 << SHARD_BITS, np.uint64)
    for raw in pdf["counts"]:
        total += np.frombuffer(raw, np.uint8)
    total = total.astype(np.float64)
    level = np.ceil(np.log2(total + 1)).astype(np.uint8)
    usual = total[total <= 2 * total.mean() + 2]  # prefixes take the rarest shingles, so cells of frequent ones don't count
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "levels": [level.tobytes()], "cells": [float(len(usual))], "f1": [float(usual.sum())], "f2": [float((usual ** 2).sum())]})


def allowed(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` that may be missing from any linked set."""
    return n - -(-percent * n // 100)


def choose_boundary(sizes: dict[int, int], expected_list: float, percent: int = PERCENT) -> int:
    """Largest light size with the least total cost: rows emitted plus, for
    inverted lists, the expected length of the list each row meets."""
    best, at = math.inf, 0
    for bound in range(0, 200):
        cost = 0.0
        for n, docs in sizes.items():
            p = allowed(n, percent)
            if n <= bound:
                cost += docs * (p + 2) * (p + 1) / 2
            if n > bound * percent / 100:
                cost += docs * (p + 1) * (1 + expected_list)
        if cost < best:
            best, at = cost, bound
    return at


def _ordered(s: np.ndarray, levels: np.ndarray, cell_bits: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` shingles of a set, rarest first, and their levels."""
    level = levels[(s >> np.uint64(64 - cell_bits)).astype(np.int64)].astype(np.uint64)
    at = np.argsort((level << np.uint64(57)) | (s >> np.uint64(7)), kind="stable")[:n]
    # a shingle's place in the order, coarsely: its level and the first 12 bits of its hash
    return s[at], (level[at] << np.uint64(12) | s[at] >> np.uint64(52)).astype(np.int64)


#: A posting's ``info``: set size (28 bits), shingles of the prefix placed before its last one (12, saturated),
#: the last one's place (18), the posting's own level (6).
_SIZE_BITS, _BELOW_BITS, _PLACE_BITS = 28, 12, 18


def _info(n: int, place: np.ndarray | None) -> np.ndarray | int:
    if place is None:  # of a set that no bound applies to
        return n
    last = int(place[-1])
    head = n | min(int((place < last).sum()), (1 << _BELOW_BITS) - 1) << _SIZE_BITS | last << (_SIZE_BITS + _BELOW_BITS)
    return (np.uint64(head) | (place >> 12).astype(np.uint64) << np.uint64(58)).view(np.int64)


def _unpacked(info: str = "info") -> dict:
    def bits(shift: int, width: int):
        return F.shiftrightunsigned(info, shift).bitwiseAND(F.lit((1 << width) - 1))
    return {"size": bits(0, _SIZE_BITS), "below": bits(_SIZE_BITS, _BELOW_BITS), "last": bits(_SIZE_BITS + _BELOW_BITS, _PLACE_BITS),
            "place": F.shiftrightunsigned(info, 58) * 4096 + F.shiftrightunsigned("sig", 52)}


def _postings(width: int, percent: int, cell_bits: int, boundary: int, levels_b):
    def run(batches):
        levels = levels_b.value
        for batch in batches:
            sig, node, size, kind = [], [], [], []
            for b in blocks(batch.column("text"), lower=True):
                for s in _sets(b, width):
                    n = len(s)
                    p = allowed(n, percent)
                    if not p and 100 * n // percent == n:
                        continue  # links with equal sets alone
                    pre, place = _ordered(s, levels, cell_bits, p + 2)
                    at = _node(s)
                    if n <= boundary:
                        i, j = np.triu_indices(len(pre), 1)
                        sig.append(mix64(pre[i] * np.uint64(_ODD) + pre[j] * np.uint64(3) + np.uint64(1)))
                        node.append(np.full(len(i), at))
                        size.append(np.full(len(i), _info(n, None)))
                    if n > boundary * percent / 100:
                        one = pre[:p + 1]
                        sig.append(one)
                        node.append(np.full(len(one), at))
                        size.append(_info(n, place[:p + 1]) if n > boundary else np.full(len(one), _info(n, None)))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node)), pa.array(np.concatenate(size))], ["sig", "node", "info"])
    return run


def _set_rows(width: int):
    def run(batches):
        for batch in batches:
            for b in blocks(batch.column("text"), lower=True):
                sets = _sets(b, width)
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["node", "shingles"])
    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                u, v = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])
    return run


def _links(pairs: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose whole sets link."""
    pairs = spool(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ids = spool(reps.join(nodes, "node").select("doc_id").distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    sets = spool(docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(_set_rows(width), "node long, shingles binary"), "sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    right = sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return left.join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long, linked boolean").where("linked").select("a", "b")


def _through(links: DataFrame, root: DataFrame) -> DataFrame:
    """Links between the components that their nodes belong to."""
    out = links.join(root.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left").join(root.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left")
    return out.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a != b").distinct()


def _open_clusters(lists: DataFrame, percent: int) -> DataFrame:
    """``node, own, root, band, center``: nodes (of component ``own``) beside clusters they may link with.

    A *cluster* is the nodes of one component whose sizes are near each other.
    If all their prefixes end behind a node's, its prefix shingles that no list
    shares with the cluster are missing from every set in it. Too many of them
    rule the cluster out before any pair is made, so a borderline copy beside a
    large group costs a row a list, not one a member. Of two components the
    smaller one's nodes meet the larger one's clusters; of two of one weight,
    that with the earlier prefix end."""
    clusters = lists.groupBy("root", "band").agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.min("last").alias("end"), F.max(F.struct("central", "node")).alias("top"))
    met = lists.select("sig", "root", "band", "weight", "ends").distinct()
    x, c = lists.alias("x"), met.alias("c")
    beside = (x.join(c, F.col("x.sig") == F.col("c.sig"))
              .where("c.root != x.root and struct(c.weight, c.ends, c.root) > struct(x.weight, x.ends, x.root)")
              .groupBy(F.col("x.node").alias("node"), F.col("x.size").alias("size"), F.col("x.below").alias("below"), F.col("x.last").alias("last"), F.col("x.root").alias("from"),
                       F.col("c.root").alias("root"), F.col("c.band").alias("band"))
              .agg(F.count_if(F.col("x.place") < F.col("x.last")).alias("met")))
    beside = beside.join(clusters, ["root", "band"])
    smallest = F.greatest("lo", F.ceil(F.lit(percent) * F.col("size") / 100))  # of the cluster's sets, those near enough in size
    need = F.ceil(F.lit(percent) * (F.col("size") + smallest) / (100 + percent))
    missing = F.when(F.col("end") >= F.col("last"), F.col("below") - F.col("met")).otherwise(F.lit(0))
    beside = beside.where((F.col("lo") * percent <= 100 * F.col("size")) & (F.col("hi") * 100 >= percent * F.col("size")) & (missing <= F.col("size") - need))
    return beside.select("node", F.col("from").alias("own"), "root", "band", F.col("top.node").alias("center"))


def _least_shared(n: Column, s: Column, t: Column, percent: int) -> Column:
    """Prefix shingles that linked sets of ``s`` and ``t`` share at least, if the prefix of that of ``n`` ends first."""
    need = F.ceil(F.lit(percent) * (s + t) / (100 + percent))
    return 1 - F.ceil(F.lit(percent) * n / 100) + need


def _count_block(percent: int, boundary: int):
    """Pairs of a block's open nodes (``open``) and members that share enough prefix shingles: each open
    node's inverted lists, within the block, are scanned and the members on them counted."""
    def run(pdf):
        import pandas as pd
        ask, have = pdf[pdf["open"]], pdf[~pdf["open"]]
        size, node = have["size"].to_numpy(), have["node"].to_numpy()
        sig = np.concatenate([np.asarray(x) for x in have["sigs"]]) if len(have) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(have)), [len(x) for x in have["sigs"]])
        order = np.argsort(sig, kind="stable")
        sig, owner = sig[order], owner[order]
        left, right = [], []
        for n, s, sigs in zip(ask["node"], ask["size"], ask["sigs"]):
            lo, hi = np.searchsorted(sig, sigs, "left"), np.searchsorted(sig, sigs, "right")
            shared = np.bincount(owner[spread(lo, hi - lo)], minlength=len(have))
            need = -(-percent * (s + size) // (100 + percent))
            least = 1 + need + np.minimum(percent * -s // 100, percent * -size // 100) if s > boundary else 1
            hit = np.flatnonzero((shared >= np.maximum(least, 1)) & (100 * np.minimum(s, size) >= percent * np.maximum(s, size)))
            left.append(np.full(len(hit), n, np.int64))
            right.append(node[hit])
        both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
        return pd.DataFrame({"a": both[0], "b": both[1]})
    return run


def _open_pairs(lists: DataFrame, beside: DataFrame, percent: int, boundary: int) -> DataFrame:
    """``a, b``: the nodes of ``beside`` with the members of their clusters that they may link with.

    A linked member shares at least ``least`` of a heavy node's prefix shingles, so it stands in one of the lists
    that remain without the ``least - 1`` longest, and a node with fewer lists than ``least`` in the cluster is done.
    In clusters of at most ``CROWD`` members the remaining lists are joined. In larger ones open nodes meet members
    in blocks of bounded size, which count shared shingles and give only pairs that share enough."""
    inside = lists.groupBy("sig", "root", "band").agg(F.count("*").alias("members"))
    clusters = lists.groupBy("root", "band").agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.count_distinct("node").alias("crowd"), F.count("*").alias("entries"))
    mine = lists.select("sig", "node", "size").join(beside, "node").join(inside, ["sig", "root", "band"]).join(clusters, ["root", "band"])
    lo, hi = F.greatest("lo", F.ceil(F.lit(percent) * F.col("size") / 100)), F.least("hi", F.floor(100 * F.col("size") / percent))
    # over the sizes of the cluster, the node's own bound is least for the smallest set, a member's for the largest
    least = F.least(_least_shared(F.col("size"), F.col("size"), lo, percent), _least_shared(hi, F.col("size"), hi, percent))
    least = F.when(F.col("size") > boundary, F.greatest(least, F.lit(1))).otherwise(1)
    group = W.partitionBy("node", "root", "band")
    mine = mine.select("*", least.alias("least"), F.count("*").over(group).alias("k"), F.row_number().over(group.orderBy("members", "sig")).alias("nth")).where("k >= least")
    mine = spool(mine.select("sig", "node", "size", "root", "band", "crowd", "entries", "least", "k", "nth"), "asked")
    x, y = mine.where(f"crowd <= {CROWD} and nth <= k - least + 1").alias("x"), lists.alias("y")
    pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.root") == F.col("y.root")) & (F.col("x.band") == F.col("y.band")))
    pairs = pairs.where(100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()

    asked = mine.where(f"crowd > {CROWD}")
    # blocks of a cluster: `across` of members by `down` of open nodes, each of about BLOCK_ENTRIES list entries
    grid = asked.groupBy("root", "band").agg(F.ceil(F.max("entries") / BLOCK_ENTRIES).cast("int").alias("across"), F.ceil(F.count("*") / BLOCK_ENTRIES).cast("int").alias("down"))
    part = ["root", "band", "across_at", "down_at"]

    def dealt(rows: DataFrame, fixed: str, free: str, is_open: bool) -> DataFrame:
        sets = rows.groupBy("node", "size", "root", "band").agg(F.collect_list("sig").alias("sigs")).join(grid, ["root", "band"])
        return sets.select("node", "size", "sigs", F.lit(is_open).alias("open"), "root", "band", F.pmod(F.xxhash64("node"), F.col(fixed)).cast("int").alias(f"{fixed}_at"),
                           F.explode(F.sequence(F.lit(0), F.col(free) - 1)).alias(f"{free}_at"))
    blocks_ = dealt(asked, "down", "across", True).unionByName(dealt(lists.join(grid.select("root", "band"), ["root", "band"], "left_semi"), "across", "down", False))
    return pairs.unionByName(blocks_.groupBy(*part).applyInPandas(_count_block(percent, boundary), "a long, b long"))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``)."""
    if not 50 < percent <= 100:
        raise ValueError("percent must lie in 51..100")
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MAX_CELL_BITS, max(MIN_CELL_BITS, int(size / 6 / SHINGLES_PER_CELL).bit_length()))
    seen = spool(docs.mapInArrow(_describe(width, bits), "doc_id long, n long, node long, shard int, counts binary"), "described")
    stats = seen.where("shard is null").select("doc_id", "n", "node")
    levels = np.zeros(1 << bits, np.uint8)
    cells = f1 = f2 = 0.0
    for r in seen.where("shard is not null").groupBy("shard").applyInPandas(_merge, "shard int, levels binary, cells double, f1 double, f2 double").collect():  # 2 ** MAX_CELL_BITS bytes at most
        levels[r["shard"] << SHARD_BITS:(r["shard"] + 1) << SHARD_BITS] = np.frombuffer(r["levels"], np.uint8)
        cells, f1, f2 = cells + r["cells"], f1 + r["f1"], f2 + r["f2"]

    reps = stats.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count("*").alias("copies"))
    reps = spool(reps, "nodes")
    # an id goes unposted if every text it holds is a smaller id's
    first = reps.where("copies > 1").select("node", F.col("doc_id").alias("first_id"))
    more = stats.where("n > 0 and doc_id is not null").join(first, "node", "left").groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))).alias("copy"))
    more = spool(more.where("copy").select("doc_id"), "copies")
    alone = docs.where("doc_id is not null").join(F.broadcast(more) if more.count() <= MAX_BROADCAST_IDS else more, "doc_id", "left_anti")

    histogram = {r["n"]: r["c"] for r in reps.groupBy(F.least("n", F.lit(400)).alias("n")).agg(F.count("*").alias("c")).collect()}
    expected = max(0.0, f2 / f1 - 1 - f1 / cells) if f1 else 0.0
    boundary = choose_boundary(histogram, expected, percent)
    posted = alone.select("text").mapInArrow(_postings(width, percent, bits, boundary, spark.sparkContext.broadcast(levels)), "sig long, node long, info long").select("sig", "node", "info")
    # postings are made twice rather than written: hashing is cheaper than their disk
    shared = posted.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("sig")
    lists = spool(posted.join(spool(shared, "shared"), "sig").withColumns(_unpacked()).drop("info"), "lists")
    # a list's leader is its most central node: the one with the largest share of its prefix in lists. Of an
    # original and its edits that is the original, which links with edits that don't link with each other.
    central = lists.groupBy("node", "size").agg((F.count("*") / F.col("size")).alias("central")).select("node", "central")
    lists = spool(lists.join(central, "node"), "lists")
    leaders = spool(lists.groupBy("sig").agg(F.max(F.struct("central", "node")).alias("top")).select("sig", F.col("top.node").alias("leader")), "leaders")
    lists = lists.join(leaders, "sig")

    votes = lists.where("node != leader").groupBy("node", "leader", "size").agg(F.count("*").alias("votes"))
    best = votes.groupBy("node", "size").agg(F.max(F.struct("votes", "leader")).alias("best"))
    star = best.where(F.col("best.votes") >= 0.4 * (F.col("size") * (100 - percent) / 100)).select(F.col("node").alias("a"), F.col("best.leader").alias("b"))
    known = spool(_links(star, docs, reps, width, percent), "links")
    root = components(known)

    # lists that still hold two components
    open_lists = spool(lists.select("sig", "node", "size", "below", "last", "place", "central", F.floor(F.log("size") / BAND).alias("band")).join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "open")
    mixed = open_lists.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("sig")
    weight = open_lists.groupBy("root").agg(F.approx_count_distinct("node").alias("weight"), F.min("last").alias("ends"))
    open_lists = spool(open_lists.join(mixed, "sig", "left_semi").join(weight, "root"), "mixed")
    beside = spool(_open_clusters(open_lists, percent), "beside")
    # one link into a component is enough: the centers first, every member only where they leave it open
    second = _links(beside.select(F.col("node").alias("a"), F.col("center").alias("b")).distinct(), docs, reps, width, percent)
    second = spool(_through(second, root), "links")
    joined = components(second).withColumnsRenamed({"node": "from", "root": "to"})
    left = beside.join(joined.withColumnsRenamed({"from": "own", "to": "own_to"}), "own", "left").join(joined.withColumnsRenamed({"from": "root", "to": "root_to"}), "root", "left")
    left = spool(left.where(F.coalesce("own_to", "own") != F.coalesce("root_to", "root")).select("node", "root", "band"), "open")
    pairs = _open_pairs(open_lists, left, percent, boundary)
    more = _through(_links(pairs, docs, reps, width, percent), root)
    again = components(spool(second.unionByName(more).distinct(), "links"))

    named = reps.join(root, "node", "left").withColumn("first", F.coalesce("root", "node")).drop("root")
    named = named.join(again.withColumnsRenamed({"node": "first", "root": "final"}), "first", "left").select("node", F.coalesce("final", "first").alias("root"), "doc_id")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(smallest, "root").select("node", "component_id")
    return (stats.withColumn("key", F.when(F.col("n") > 0, F.col("node")))
            .join(by_node.withColumnRenamed("node", "key"), "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` with all their columns, one of every component: that of
    the smallest ``doc_id``, and of rows that share it the one with the smallest
    text hash. Empty texts and null ids link with nothing and stay."""
    found = jaccard_components(docs, width, percent)
    gone = spool(found.where("component_id != doc_id").select("doc_id").distinct(), "gone")
    again = spool(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    out = docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone, "doc_id", "left_anti")
    if again.isEmpty():
        return out.select(*[F.col(f"`{c}`") for c in docs.columns])
    once = out.join(again, "doc_id", "left_anti")
    # one row of an id: that of the smallest text hash, its columns under one name so that theirs do not matter
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = W.partitionBy("id").orderBy("tie")
    some = out.join(again, "doc_id", "left_semi").select(row.alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie")).withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(some.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
