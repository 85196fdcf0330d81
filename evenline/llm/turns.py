"""Operator 12, repair of conversations along the least of their cheapest edit paths.

A conversation's rows, by turn, are to read ``(s?(ua)+)?`` in the initials of their
roles: nothing, or an optional system turn and pairs of user and assistant turns.
Rows are kept (K, 0), given the role of a user or assistant (R, 3) or deleted (D, 4;
blank and duplicate rows must be); empty turns may be inserted anywhere (I, 3); an
undeleted truncated row adds 3. Of all cheapest edits those with the ASCII-least
string of initials (the audit) are taken.

Method. Nodes are (rows read, role state). Costs to the end come from a dynamic
programme run backwards. Arcs on cheapest paths are then ranked by their audits'
first 1, 2, 4, ... letters: the rank of twice the length is that of the pair (own
rank, rank of the arc so many steps on). The least-ranked arc of the first node opens
the path, and its t-th arc is reached through the doubled pointers of t's binary
digits. Labels of a node's arcs differ, so the least successor is unique from the
first round.

Any length. Equal rows are one row with a count, so copies never meet in one task.
Rows are range-partitioned by (conv_id, turn, role, digest) and cut into segments of
at most ``BLOCK`` rows. A conversation of many segments is solved over a tree of
``FAN`` children a node: min-plus products of the segments' 4 x 4 cost tables give
each the costs behind it, and composed exit states give each the state it is entered
in. No task holds more than ``FAN`` summaries or ``CHUNK`` rows, however long a
conversation is.

Defined results: null conv_ids are one conversation; null turns come first; rows of
one turn are ordered by role, then by digest (``md5`` of role and text, also the
identity of a row's content); null roles and texts are one space; a role that starts
with none of s, u, a (also an empty one) cannot be kept; texts of any length are read
once for their faults and once to be joined to kept rows; an empty table gives no
rows. Only the four columns are read, so extra columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.llm.spool import spool
from evenline.session import ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 1024    # rows of a segment
FAN = 1024      # summaries of a tree node
CHUNK = 1 << 15  # rows solved side by side
FAR = 1 << 60

# States: nothing written, after s, after u, after a. Initials: other, s, u, a.
LABELS = "DIKR"
TURNED = np.array([2, 2, 3, 2])                       # state behind an inserted or re-roled turn
KEPT = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])  # by initial and state
CLOSED = np.array([0, 2 * INSERT, INSERT, 0])         # costs behind the last row

ROW = "place long, code int, times long, turn long, role string, digest string"
EDIT = "block long, step int, edit string, times long, turn long, role string, digest string, cost long"


class Segments:
    """Several segments as flat arrays: ``code`` and ``times`` of all rows, ``sizes`` rows a segment."""

    def __init__(self, code: np.ndarray, times: np.ndarray, sizes: np.ndarray):
        self.sizes, self.n = sizes, len(sizes)
        self.first_row = np.cumsum(sizes) - sizes
        self.first = self.first_row + np.arange(self.n)      # its nodes: one more than rows
        self.last = self.first + sizes
        self.initial, self.must = code & 3, (code & 4) > 0
        self.extra = DELETE * (times - 1)                    # further copies of a row go, right behind it
        self.late = np.where((code & 8) > 0, TRUNCATED, 0)
        self.node = np.arange(len(code)) + np.repeat(np.arange(self.n), sizes)

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Cost behind every (node, state), given those of each segment's last node (``n x 4 x any``)."""
        h = np.full((int(self.sizes.sum()) + self.n, *end.shape[1:]), FAR, np.int64)
        h[self.last] = end
        order = np.argsort(-self.sizes, kind="stable")
        for k in range(int(self.sizes.max(initial=0))):
            at = order[:np.searchsorted(-self.sizes[order], -k, "left")]  # segments with more than k rows
            row, node = self.first_row[at] + self.sizes[at] - 1 - k, self.last[at] - 1 - k
            after = h[node + 1]
            stays = np.where(self.must[row], FAR, self.late[row])[:, None, None]
            to = KEPT[self.initial[row]]
            kept = np.where((to < 0)[..., None], FAR, np.take_along_axis(after, np.maximum(to, 0)[..., None], 1)) + stays
            g = np.minimum(np.minimum(after + DELETE, kept + KEEP), after[:, TURNED] + stays + REROLE) + self.extra[row][:, None, None]
            two, three = np.minimum(g[:, 2], g[:, 3] + INSERT), np.minimum(g[:, 3], g[:, 2] + INSERT)
            h[node] = np.minimum(FAR, np.stack([np.minimum(g[:, 0], two + INSERT), np.minimum(g[:, 1], two + INSERT), two, three], 1))
        return h

    def arcs(self, h: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every (node, state, label): whether it lies on a cheapest path, and the (node, state) behind
        it. ``closed`` marks segments that end their conversation, where turns may be inserted behind the last row."""
        nodes = len(h)
        good, to = np.zeros((nodes, 4, 4), bool), np.zeros((nodes, 4, 4), np.int64)
        inner = np.ones(nodes, bool)
        inner[self.last] = closed
        good[:, :, 1] = inner[:, None] & (h == h[:, TURNED] + INSERT)
        to[:, :, 1] = np.arange(nodes)[:, None] * 4 + TURNED
        a, b = self.node, self.node + 1
        free = ~self.must[:, None]
        cost = (self.extra + self.late)[:, None]
        keep = KEPT[self.initial]
        good[a, :, 0] = h[a] == h[b] + DELETE + self.extra[:, None]
        to[a, :, 0] = b[:, None] * 4 + np.arange(4)
        good[a, :, 2] = free & (keep >= 0) & (h[a] == np.take_along_axis(h[b], np.maximum(keep, 0), 1) + cost + KEEP)
        to[a, :, 2] = b[:, None] * 4 + np.maximum(keep, 0)
        good[a, :, 3] = free & (h[a] == h[b][:, TURNED] + cost + REROLE)
        to[a, :, 3] = b[:, None] * 4 + TURNED
        return good, to

    def least_paths(self, end: np.ndarray, entry: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The least of the cheapest paths from each segment's ``entry`` state: ``length`` per segment, then
        per step the node it leaves, its label and the state behind it."""
        h = self.costs(end[:, :, None])[:, :, 0]
        good, to = self.arcs(h, closed)
        arc = np.flatnonzero(good)                            # by node, state, label
        stop, label, target = len(arc), arc % 4, to.reshape(-1)[arc]
        of_node = np.full(len(h) * 4 + 1, stop, np.int64)     # least arc that leaves a (node, state)
        of_node[(arc // 4)[::-1]] = np.arange(stop)[::-1]     # arcs of a node are in the order of their labels
        rank = np.append(label + 1, 0)                        # the end of an audit is less than any letter
        pointers = [np.append(of_node[target], stop)]
        while (pointers[-1] != stop).any():
            p = pointers[-1]
            rank = np.unique(rank * (len(rank) + 1) + rank[p], return_inverse=True)[1]
            pointers.append(p[p])
        leaves = (self.first * 4 + entry)
        options = np.array([np.searchsorted(arc, leaves * 4), np.searchsorted(arc, leaves * 4 + 4)])
        start = np.full(self.n, stop, np.int64)
        for k in range(4):                                    # the least-ranked of up to four arcs
            option = np.minimum(options[0] + k, stop)
            better = (options[0] + k < options[1]) & ((start == stop) | (rank[option] < rank[start]))
            start = np.where(better, option, start)
        length, at = (start != stop).astype(np.int64), start
        for k in range(len(pointers) - 1, -1, -1):
            ahead = pointers[k][at]
            length += np.where(ahead != stop, 1 << k, 0)
            at = np.where(ahead != stop, ahead, at)
        step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(start, length)
        for k, p in enumerate(pointers):
            at = np.where((step >> k) & 1, p[at], at)
        return length, arc[at] // 16, label[at], target[at] % 4

    def exits(self, end: np.ndarray) -> np.ndarray:
        """The state in which each segment is left when entered in each of the four."""
        out = np.zeros((self.n, 4), np.int64)
        for q in range(4):
            length, _, _, state = self.least_paths(end, np.full(self.n, q), np.zeros(self.n, bool))
            out[:, q] = state[np.cumsum(length) - 1]
        return out


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.StructArray, Segments]]:
    """Parts of a batch of segments with at most ``CHUNK`` rows (or one segment)."""
    sizes = np.diff(batch.column("rows").offsets.to_numpy())
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, "right")))
        part = batch.slice(a, b - a)
        rows = part.column("rows").flatten()
        yield part, rows, Segments(rows.field("code").to_numpy().astype(np.int64), rows.field("times").to_numpy(), sizes[a:b])
        a = b


def _numbers(col: pa.ListArray, width: int) -> np.ndarray:
    return col.flatten().to_numpy().reshape(-1, width)


def cost_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unit = np.where(np.eye(4, dtype=bool), 0, FAR)
    for batch in batches:
        for part, _, s in _chunks(batch):
            table = s.costs(np.broadcast_to(unit, (s.n, 4, 4)))[s.first]
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("idx"), pa.array(list(table.reshape(s.n, 16)), pa.list_(pa.int64()))], ["conv_id", "idx", "value"])


def exit_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, _, s in _chunks(batch):
            out = s.exits(_numbers(part.column("ends"), 4))
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("idx"), pa.array(list(out), pa.list_(pa.int64()))], ["conv_id", "idx", "value"])


def segment_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, rows, s in _chunks(batch):
            end, entry = _numbers(part.column("ends"), 4), part.column("entry").to_numpy()
            length, node, label, state = s.least_paths(end, entry, part.column("closed").to_numpy(zero_copy_only=False))
            seg = np.repeat(np.arange(s.n), length)
            row, real = node - seg, label != 1
            at = pa.array(np.where(real, row, 0), pa.int64(), mask=~real)
            times = np.where(real, rows.field("times").to_numpy()[np.where(real, row, 0)], 1)
            late, extra = s.late[np.where(real, row, 0)], DELETE * (times - 1)
            cost = np.array([DELETE, INSERT, KEEP, REROLE])[label] + extra + np.where(real & (label != 0), late, 0)
            new = pa.array(np.where(state == 2, "user", "assistant").tolist(), pa.string())
            role = pa.compute.if_else(pa.array((label == 0) | (label == 2)), rows.field("role").take(at), new)
            step = np.arange(len(seg)) - np.repeat(np.cumsum(length) - length, length)
            yield pa.RecordBatch.from_arrays([part.column("conv_id").take(pa.array(seg)), part.column("block").take(pa.array(seg)), pa.array(step, pa.int32()), pa.array(list(LABELS), pa.string()).take(pa.array(label)),
                                              pa.array(times, pa.int64()), rows.field("turn").take(at), role, rows.field("digest").take(at), pa.array(cost, pa.int64())],
                                             ["conv_id", "block", "step", "edit", "times", "turn", "role", "digest", "cost"])


def _product(tables: np.ndarray) -> np.ndarray:
    """Min-plus product of 4 x 4 tables, in order."""
    out = tables[0]
    for t in tables[1:]:
        out = np.minimum(FAR, (out[:, :, None] + t[None]).min(1))
    return out


def _costs_up(values: np.ndarray) -> np.ndarray:
    return _product(values.reshape(-1, 4, 4)).reshape(16)


def _costs_down(values: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    out = []
    for t in values.reshape(-1, 4, 4)[::-1]:
        out.append(end)
        end = (t + end[None]).min(1)
    return out[::-1]


def _states_up(values: np.ndarray) -> np.ndarray:
    out = np.arange(4)
    for v in values:
        out = v[out]
    return out


def _states_down(values: np.ndarray, entry: np.ndarray) -> list[np.ndarray]:
    out = []
    for v in values:
        out.append(entry)
        entry = v[entry]
    return out


def _tree_scan(leaves: DataFrame, up: Callable, down: Callable, root: list[int], kind: str) -> DataFrame:
    """``conv_id, idx, carried`` for ``leaves`` (``conv_id, idx, value``; idx from 0 in each conversation): ``up`` folds
    the values of up to ``FAN`` children, ``down`` hands each child what its parent carries; the top carries ``root``."""
    parent = F.floor(F.col("idx") / FAN).cast("long")
    schema = f"conv_id {kind}, idx long, "

    def fold(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        return pd.DataFrame({"conv_id": pdf["conv_id"].iloc[:1], "idx": [int(key[1])], "value": [up(np.stack(pdf["value"].to_list())).tolist()]})

    def spread(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        carried = down(np.stack(pdf["value"].to_list()), np.asarray(pdf["carried"].iloc[0]))
        return pd.DataFrame({"conv_id": pdf["conv_id"], "idx": pdf["idx"], "carried": [np.atleast_1d(c).tolist() for c in carried]})
    levels = [leaves]
    while not levels[-1].where("idx > 0").isEmpty():
        levels.append(spool(levels[-1].groupBy("conv_id", parent.alias("up")).applyInPandas(fold, schema + "value array<long>"), "fold"))
    carried = levels[-1].select("conv_id", "idx", F.lit(root).cast("array<long>").alias("carried"))
    for level in levels[-2::-1]:
        joined = join_on(level.withColumn("up", parent), carried.withColumnRenamed("idx", "up"), "conv_id", "up")
        carried = spool(joined.groupBy("conv_id", "up").applyInPandas(spread, schema + "carried array<long>"), "spread")
    return carried


def join_on(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Equi-join in which nulls are equal; keeps the keys of ``a``."""
    b = b.select(*[F.col(k).alias(f"right_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"right_{k}"))
    return a.join(b, on, how).drop(*[f"right_{k}" for k in keys])


def content(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, text`` with nulls of role and text as one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       F.md5(F.concat(role, F.lit("\0"), text).cast("binary")).alias("digest"), text.alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """One row per distinct row of ``content``: ``conv_id, turn, role, digest, times, initial``, booleans ``blank``,
    ``first`` (no equal role and text at an earlier turn) and ``truncated``; texts are not carried."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    seen = (rows.select("conv_id", "turn", "role", "digest", F.left("role", F.lit(1)).alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
            .groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "open").agg(F.count(F.lit(1)).alias("times")))
    seen = spool(seen, "rows")
    first = (seen.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("t"))
             .select("conv_id", "digest", F.col("t.turn").alias("turn"), F.lit(True).alias("first")))
    out = join_on(seen, first, "conv_id", "turn", "digest", how="left")  # either side has one row a key
    first = F.coalesce("first", F.lit(False))
    return out.select("conv_id", "turn", "role", "digest", "times", "initial", "blank", first.alias("first"), (first & ~F.col("blank") & F.col("open")).alias("truncated"))


def segments(found: DataFrame) -> DataFrame:
    """``conv_id, block, idx, closed, many, rows``: the rows of ``faults`` in order, at most ``BLOCK`` a segment."""
    keys = ("conv_id", "turn", "role", "digest")
    found = spool(found, "faults")
    code = (F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(0)
            + F.when(F.col("blank") | ~F.col("first"), 4).otherwise(0) + F.when(F.col("truncated"), 8).otherwise(0))
    placed = spool(found.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, "times", code.alias("code"), F.monotonically_increasing_id().alias("place")), "placed")
    cut = (placed.groupBy("conv_id", F.floor(F.col("place") / BLOCK).cast("long").alias("block"))
           .agg(F.sort_array(F.collect_list(F.struct("place", "code", "times", "turn", "role", "digest"))).alias("rows")))
    cut = spool(cut, "segments")
    spans = cut.groupBy("conv_id").agg(F.max("block").alias("top"), (F.count(F.lit(1)) > 1).alias("many"))
    return spool(join_on(cut, spans, "conv_id").select("conv_id", "block", "rows", (F.col("block") == F.col("top")).alias("closed"), "many"), "segments")


def repair_edits(cut: DataFrame) -> DataFrame:
    """The edits of every conversation of ``segments``: ``conv_id, block, step`` (their order), ``edit`` (D, I, K, R),
    ``times`` (a row's further copies are deleted right behind it), the row's ``turn`` and ``digest``, its
    ``role`` afterwards, and their ``cost``."""
    from pyspark.sql import Window
    ship_package(cut.sparkSession)
    kind = cut.schema["conv_id"].dataType.simpleString()
    closed = F.lit(CLOSED.tolist()).cast("array<long>")
    whole = cut.where("not many").select("conv_id", "block", "rows", "closed", closed.alias("ends"), F.lit(0).cast("long").alias("entry"))
    # summaries, one per BLOCK rows, are numbered here
    long = cut.where("many").select("*", (F.row_number().over(Window.partitionBy("conv_id").orderBy("block")) - 1).cast("long").alias("idx"))
    if not long.isEmpty():
        long = spool(long, "long")
        schema = f"conv_id {kind}, idx long, value array<long>"
        tables = spool(long.select("conv_id", "idx", "rows").mapInArrow(cost_tables, schema), "tables")
        ends = _tree_scan(tables, _costs_up, _costs_down, CLOSED.tolist(), kind).withColumnRenamed("carried", "ends")
        known = spool(join_on(long, ends, "conv_id", "idx"), "known")
        states = spool(known.select("conv_id", "idx", "rows", "ends").mapInArrow(exit_states, schema), "states")
        entries = _tree_scan(states, _states_up, _states_down, [0], kind)
        whole = whole.unionByName(join_on(known, entries, "conv_id", "idx").select("conv_id", "block", "rows", "closed", "ends", F.col("carried")[0].alias("entry")))
    return whole.mapInArrow(segment_edits, f"conv_id {kind}, {EDIT}")


def repaired_rows(edits: DataFrame, rows: DataFrame) -> DataFrame:
    """The edits with the ``text`` of kept rows (from ``content``) and of inserted ones (empty); null for deleted rows."""
    # copies of a row leave by the partial aggregate, before the text moves
    texts = rows.select("conv_id", "turn", "digest", "text").distinct()
    kept = join_on(edits.where("edit in ('K', 'R')"), texts, "conv_id", "turn", "digest")
    others = edits.where("edit in ('D', 'I')").select("*", F.when(F.col("edit") == "I", F.lit("")).alias("text"))
    return kept.unionByName(others)


def repair_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256``: rows of a conversation pass through a task in order and are held
    one Arrow batch at a time; only the audit itself, one letter a row, is gathered."""
    ship_package(repaired.sparkSession)
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches):
        at, audit, digest, n = None, [], None, 0
        for batch in batches:
            out = []
            ids = batch.column("conv_id").to_pylist()
            for c, edit, times, role, text in zip(ids, *[batch.column(x).to_pylist() for x in ("edit", "times", "role", "text")]):
                if digest is None or c != at:
                    if digest is not None:
                        out.append((at, "".join(audit), digest.hexdigest()))
                    at, audit, digest, n = c, [], hashlib.sha256(), 0
                audit.append(edit + "D" * (times - 1))
                if text is not None:
                    digest.update(("\n" * (n > 0) + role + ":" + text).encode())
                    n += 1
            yield _digest_rows(out, batch.column("conv_id").type)
        if digest is not None:
            yield _digest_rows([(at, "".join(audit), digest.hexdigest())], batch.column("conv_id").type)
    rows = repaired.select("conv_id", "block", "step", "edit", "times", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "block", "step")
    return rows.mapInArrow(run, f"conv_id {kind}, audit string, repaired_sha256 string")


def _digest_rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*out)) if out else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.string(), pa.string()))], ["conv_id", "audit", "repaired_sha256"])


def conversation_faults(found: DataFrame, cut: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal`` from ``faults`` and ``segments``. Every row counts by its
    first fault; adjacent initials other than su, ua and au are illegal."""
    from pyspark.sql import Window
    n = F.col("times")
    one = F.when(F.col("first") & ~F.col("blank"), 1).otherwise(0)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    by = found.groupBy("conv_id").agg(F.coalesce(turns, F.lit(0)).alias("gaps"), F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
                                      F.sum(F.when(~F.col("blank"), n - one).otherwise(0)).alias("duplicate"), F.sum(F.when(F.col("truncated"), one).otherwise(0)).alias("truncated"))

    def legal(a: Column, b: Column) -> Column:
        return F.concat(F.left(a, F.lit(1)), F.left(b, F.lit(1))).isin("su", "ua", "au")
    size = F.size("rows")
    inner = F.expr("aggregate(rows, 0L, (s, r) -> s + r.times - 1)") + F.size(F.filter(F.sequence(F.lit(1), size), lambda k: (k < size) & ~legal(F.get("rows", k - 1)["role"], F.get("rows", k)["role"])))
    ends = cut.select("conv_id", "block", inner.alias("inner"), F.get("rows", F.lit(0))["role"].alias("a"), F.get("rows", size - 1)["role"].alias("z"))
    before = F.lag("z").over(Window.partitionBy("conv_id").orderBy("block"))  # one row per BLOCK rows
    pairs = ends.select("conv_id", (F.col("inner") + F.when(~legal(before, F.col("a")), 1).otherwise(0)).alias("illegal"))
    pairs = pairs.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    return join_on(by, pairs, "conv_id")


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables for rows of ``conversations`` (``conv_id, turn, role, text``): per conversation ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost`` (longs), and the edits of :func:`repair_edits` with the texts they leave."""
    rows = content(conversations)
    found = spool(faults(rows), "found")
    cut = segments(found)
    edits = spool(repair_edits(cut), "edits")
    cost = edits.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    return join_on(conversation_faults(found, cut), cost, "conv_id"), repaired_rows(edits, rows)
