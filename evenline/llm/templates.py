"""Operator 2, benchmark decontamination by template canonicalisation.

Words lose outer punctuation (any number of marks) and case. Numbers, names
(capitalised inside a sentence) and units (after a number, or glued to one)
become typed placeholders; what they replaced is kept as slot values. A
capitalised word that opens a sentence may be either, so its windows are made
both ways. Every ``width``-token window of a text is hashed as plain words and
with placeholders; where it holds few plain words the latter grows, so that
stretches of slots are met by longer windows (``MIN_WEIGHT``). Document windows
join benchmark windows on the hash, and a document holds an item when the
matched windows cover ``min_coverage`` of the item's, or of those places that a
copy with other values can match at all, and the slots agree: each item value
stands for one document value and the other way round.
Slots are judged an occurrence: windows at one distance between document and
item are one, and it is joined by others whose slots agree with its own. So
several copies with different values don't hide each other, nor does an item
whose windows match each other. Equal slots are a copy, renamed ones a
re-parameterised copy.

A bitmap of the benchmark's window hashes (fixed ``2 ** BITMAP_BITS`` bits)
stops document windows that cannot join in the map, so what is shuffled follows
the matches, whatever the benchmark's size; the join itself is Spark's.

Null and blank texts and items match nothing; extra columns are not read; texts
of any length are read whole. Items shorter than ``width``
tokens are one window of their own length, if they have ``min_tokens``. Repeated
items are items of their own; rows that share a ``doc_id`` are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.llm.spool import spool
from evenline.llm.words import blocks, mix64, rolling
from evenline.session import ship_package

WIDTH = 8
MIN_TOKENS = 4
MIN_LITERALS = 4      # plain words that a template of a whole short item must keep
MIN_WEIGHT = 20       # 4 a plain word, 1 a slot: what a template window must weigh
MIN_COVERAGE = 0.4
BITMAP_BITS = 26
BLOCK_BYTES = 1 << 20  # text whose windows are made at once
MAX_BROADCAST_IDS = 1_000_000
_ODD = 0xAEF17502108EF2D9

# Unit words and number words.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec second seconds min minute minutes h hr hour hours day days week weeks "
         "month months year years percent dollar dollars euro euros cent cents pound pounds metre metres meter meters mile miles litre litres").split()
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()

_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True
NUM, NAME, UNIT = 1, 2, 3
#: How a window can match: a template with words that open sentences as words or as names; plain words without slots; plain
#: words with slots, which a re-parameterised copy changes.
AS_WORDS, AS_NAMES, ONLY_WORDS, VERBATIM = range(4)


def _hash_list(words: list[str]) -> np.ndarray:
    b = next(blocks(pa.array([" ".join(words)])))
    return np.sort(b.hashes())


def tokens(b) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``plain, kind, doc, maybe`` of the block's tokens: hash of the folded word, 0 or
    its placeholder, its document, and whether it may be a name that opens a sentence."""
    raw = b.data
    high = np.concatenate(([False], raw[:-1] == 0xC3)) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)  # capital letters of Latin-1 in UTF-8
    s, e = b.start.copy(), b.end.copy()
    signs = np.append(np.flatnonzero(~_PUNCT[raw]), len(raw))  # marks at either end go, however many
    s = np.minimum(signs[np.searchsorted(signs, s)], e)
    before = np.searchsorted(signs, e) - 1  # none before a ruler that opens the block
    e = np.maximum(np.where(before >= 0, signs[np.maximum(before, 0)] + 1, 0), s)
    stops = np.concatenate(([0], np.cumsum(_STOP[raw])))
    keep = np.flatnonzero(s < e)
    s, e, doc = s[keep], e[keep], b.doc[keep]
    if not len(s):
        z = np.zeros(0, np.uint64)
        return z, np.zeros(0, np.int8), doc, np.zeros(0, bool)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[raw])))
    marks = np.concatenate(([0], np.cumsum(_PUNCT[raw])))
    n_digits, n_marks = digits[e] - digits[s], marks[e] - marks[s]
    opens = np.concatenate(([True], (doc[1:] != doc[:-1]) | (stops[s[1:]] != stops[e[:-1]])))  # first of a sentence
    capital = _UPPER[raw[s]] | ((raw[s] == 0xC3) & high[np.minimum(s + 1, len(raw) - 1)])
    folded = raw + np.where(_UPPER[raw] | high, 0x20, 0).astype(np.uint8)
    t = type(b)(b.first, b.n_docs, folded, b.offsets, s, e, doc, b.word_offsets)
    plain = t.hashes()
    number = ((n_digits > 0) & (n_digits + n_marks == e - s)) | np.isin(plain, _LISTS[0])
    glued = (n_digits > 0) & ~number & _DIGIT[raw[s]]
    after = np.concatenate(([False], number[:-1] & (doc[1:] == doc[:-1])))
    unit = after & np.isin(plain, _LISTS[1])
    kind = np.where(number, NUM, np.where(unit | glued, UNIT, np.where(capital & ~opens, NAME, 0))).astype(np.int8)
    return plain, kind, doc, capital & opens & (kind == 0)


_LISTS = (_hash_list(NUMBERS), _hash_list(UNITS))


def _span_hashes(x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of ``x[start:end]`` for spans of any length."""
    p, q = np.full(len(x) + 1, _ODD, np.uint64), np.full(len(x) + 1, pow(_ODD, -1, 1 << 64), np.uint64)
    p[0] = q[0] = 1
    p, q = np.cumprod(p), np.cumprod(q)  # wrap modulo 2**64
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * p[:-1])))
    return mix64((c[end] - c[start]) * q[start] ^ (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _windows(toks: tuple, n_docs: int, widths: list[int], main: int, only_short: bool):
    """Windows of the block: ``first, end`` token, hash, the kinds whose words are slots (None: a plain window), and how
    the window can match (see ``AS_WORDS``).

    A template window of the main width grows until it weighs ``MIN_WEIGHT``: a plain word counts 4, a slot 1, so eight
    tokens with four plain words are enough, and a stretch of slots alone takes twenty. It is made with the capitalised
    words that open sentences as words, and once more with them as names."""
    plain, kind, doc, maybe = toks
    counts = np.bincount(doc, minlength=n_docs) if len(doc) else np.zeros(n_docs, np.int64)
    last = np.cumsum(counts)[doc] if len(doc) else doc
    slots = np.concatenate(([0], np.cumsum(kind > 0)))
    unsure = np.concatenate(([0], np.cumsum(maybe)))
    for width in widths:
        first = np.arange(max(0, len(doc) - width + 1))
        ok = first + width <= last[first]
        if width != main and only_short:
            ok &= counts[doc[first]] == width
        first = first[ok]
        if not len(first):
            continue
        salt = np.uint64(width * 0x9E37)
        plain_hash = (rolling(plain, width, _ODD) ^ salt)[first]
        bare = slots[first + width] == slots[first]
        yield first[bare], first[bare] + width, plain_hash[bare], None, ONLY_WORDS
        yield first[~bare], first[~bare] + width, plain_hash[~bare], None, VERBATIM
        for how in (AS_WORDS, AS_NAMES):
            k = kind if how == AS_WORDS else np.where(maybe, NAME, kind)
            weight = np.concatenate(([0], np.cumsum(np.where(k > 0, 1, 4))))
            free = np.concatenate(([0], np.cumsum(k == 0)))
            at = first
            if width == main:
                end = np.maximum(at + width, np.searchsorted(weight, weight[at] + MIN_WEIGHT))
            else:
                end = at + width
            good = end <= last[at]
            at, end = at[good], end[good]
            has = free[end] - free[at] < end - at
            if width != main:
                has &= free[end] - free[at] >= min(MIN_LITERALS, width)
            if how == AS_NAMES:
                has &= unsure[end] > unsure[at]
            at, end = at[has], end[has]
            template = np.where(k > 0, mix64(k.astype(np.uint64) + np.uint64(0x5107)), plain)
            yield at, end, _span_hashes(template, at, end), k, how


def _rows(key: str, widths: list[int], main: int, only_short: bool, bitmap=None):
    names = ["h", key, "row", "pos", "how", "slots"]

    def run(batches):
        bits = bitmap.value if bitmap is not None else None
        for batch in batches:
            ids, rows = batch.column(key), batch.column("row")
            for b in blocks(batch.column("text"), block_bytes=BLOCK_BYTES):
                toks = tokens(b)
                plain, doc = toks[0], toks[2]
                counts = np.bincount(doc, minlength=b.n_docs) if len(doc) else np.zeros(b.n_docs, np.int64)
                lead = np.cumsum(counts) - counts
                for at, end, h, kind, how in _windows(toks, b.n_docs, widths, main, only_short):
                    if bits is not None:
                        cell = (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                        hit = (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
                        at, end, h = at[hit], end[hit], h[hit]
                    if not len(at):
                        continue
                    slots = [plain[i:j][kind[i:j] > 0].view(np.int64).tolist() if kind is not None else [] for i, j in zip(at.tolist(), end.tolist())]
                    own = pa.array(b.first + doc[at])
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids.take(own), rows.take(own), pa.array(at - lead[doc[at]]), pa.array(np.full(len(at), how, np.int32)), pa.array(slots, pa.list_(pa.int64()))], names)
    return run


def _lengths(batches):
    for batch in batches:
        for b in blocks(batch.column("text")):
            doc = tokens(b)[2]
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(b.first, b.n_docs), pa.array(np.bincount(doc, minlength=b.n_docs))], ["item_id", "n"])


def _bitmap(bench: DataFrame) -> np.ndarray:
    """Set bits of all window hashes, merged by shard; ``2 ** BITMAP_BITS`` bits reach the driver at most."""
    cell = F.shiftrightunsigned("h", 64 - BITMAP_BITS)

    def merge(pdf):
        import pandas as pd
        bits = np.zeros(1 << 16, bool)
        bits[pdf["cell"].to_numpy() & 0xFFFF] = True
        return pd.DataFrame({"shard": [int(pdf["cell"].iloc[0]) >> 16], "bits": [np.packbits(bits).tobytes()]})
    cells = bench.select(cell.alias("cell")).distinct().withColumn("shard", F.shiftright("cell", 16))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in cells.groupBy("shard").applyInPandas(merge, "shard long, bits binary").collect():
        out[r["shard"] << 13:(r["shard"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    return out


def _agreeing(min_coverage: float):
    """The first set of occurrences that agree and cover ``min_coverage`` of the item, from the largest on."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                units: dict = {}
                for u in r["units"]:
                    units.setdefault(frozenset((x["item"], x["doc"]) for x in u["slots"]), set()).update(u["at"])
                order = sorted(units.items(), key=lambda u: (-len(u[1]), sum(i != d for i, d in u[0]), sorted(u[0])))
                for seed in order:
                    there, back, got = {}, {}, set()
                    for slots, at in [seed, *order]:
                        if at <= got or any(there.get(i, d) != d or back.get(d, i) != i for i, d in slots):
                            continue
                        there.update(slots)
                        back.update((d, i) for i, d in slots)
                        got |= at
                    can = r["can"]
                    coverage = max(len(got) / r["windows"], len(got.intersection(can)) / len(can) if can else 0.0)
                    if coverage >= min_coverage:
                        out.append({"doc_id": r["doc_id"], "item_id": r["item_id"], "matched": len(got), "windows": r["windows"], "coverage": coverage,
                                    "slots": len(there), "changed": sum(i != d for i, d in there.items())})
                        break
            yield pa.RecordBatch.from_pylist(out, _FOUND)
    return run


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int64()), ("windows", pa.int64()), ("coverage", pa.float64()), ("slots", pa.int32()), ("changed", pa.int32())])


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_tokens: int = MIN_TOKENS, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, item_id, matched, windows, coverage, slots, changed, kind`` for every
    document (``doc_id, text``) that holds an item (``item_id, text``) of the benchmark."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("row")).where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long"), "text", F.lit(0).cast("long").alias("row")).where("item_id is not null and text is not null")
    short = [r["n"] for r in items.mapInArrow(_lengths, "item_id long, n long").where((F.col("n") < width) & (F.col("n") >= min_tokens)).select("n").distinct().collect()]
    widths = [width, *sorted(short)]
    schema = "h long, {} long, row long, pos long, how int, slots array<long>"
    bench = spool(items.mapInArrow(_rows("item_id", widths, width, True), schema.format("item_id")), "benchmark")
    # places where a re-parameterised copy can match are a measure of their own: others need the item's own values
    size = bench.groupBy("item_id").agg(F.countDistinct("pos").alias("windows"), F.collect_set(F.when(F.col("how") != VERBATIM, F.col("pos"))).alias("can"))
    held = spark.sparkContext.broadcast(_bitmap(bench))
    hits = docs.mapInArrow(_rows("doc_id", widths, width, False, held), schema.format("doc_id"))
    pairs = hits.alias("d").join(bench.alias("b"), (F.col("d.h") == F.col("b.h")) & (F.size("d.slots") == F.size("b.slots")))
    pairs = pairs.select("d.doc_id", "b.item_id", "d.row", (F.col("d.pos") - F.col("b.pos")).alias("shift"), "b.pos", (F.col("d.how") == AS_NAMES).alias("as_doc"), (F.col("b.how") == AS_NAMES).alias("as_item"), F.arrays_zip(F.col("b.slots").alias("item"), F.col("d.slots").alias("doc")).alias("slots"))
    # plain windows stand or fall with the slots of their occurrence; names that open sentences are judged apart
    units = pairs.groupBy("doc_id", "item_id", "row", "shift", "as_doc", "as_item").agg(F.collect_set("pos").alias("at"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"))
    items_n = F.size(F.array_distinct(F.transform("slots", lambda x: x["item"])))
    docs_n = F.size(F.array_distinct(F.transform("slots", lambda x: x["doc"])))
    units = units.where((F.size("slots") == items_n) & (F.size("slots") == docs_n))
    both = units.groupBy("doc_id", "item_id").agg(F.collect_list(F.struct("at", "slots")).alias("units")).join(size, "item_id")
    some = F.least(F.col("windows"), F.greatest(F.size("can"), F.lit(1)))
    both = both.where(F.size(F.array_distinct(F.flatten("units.at"))) / some >= min_coverage)
    found = both.select("doc_id", "item_id", "windows", "can", "units").mapInArrow(_agreeing(min_coverage), "doc_id long, item_id long, matched long, windows long, coverage double, slots int, changed int")
    return found.withColumn("kind", F.when(F.col("changed") > 0, "reparameterised").otherwise("copy"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` with all their columns, without documents that hold a benchmark item."""
    gone = spool(find_contamination(docs, benchmark).select("doc_id").distinct(), "contaminated")
    out = docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone, "doc_id", "left_anti")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
