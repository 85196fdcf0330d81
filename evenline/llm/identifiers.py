"""Operator 11, personal data by fixed detectors and bootstrapped contexts, in DataFrame functions alone.

*Base.* Four kinds (e-mail, IP, card and phone number) by pattern, leftmost matches that
do not overlap, each checked (parts, digits, Luhn). Positions are code points: the
lengths of a text's parts between matches, summed up.

*Bootstrapping.* An identifier is a run of words, one space apart, that hold a digit or
an at-sign. Identifiers in which a detector finds something are the seeds of that kind.
The word, and the two words, before an identifier are lexical patterns; all patterns
that stand before at least ``MIN_INSTANCES`` different identifiers enter a graph of
patterns and identifiers, and one pass over all texts counts how often each pattern
occurs before any word. Then, in ``ROUNDS`` rounds and per kind,

- a pattern's confidence is the share of its occurrences that stand before confident
  identifiers, weighed by their confidence: ``sum(times * conf) / (occurrences + 1)``;
  it is 0 with fewer than ``MIN_INSTANCES`` identifiers of confidence ``ACCEPT``;
- an unseen identifier's confidence is the noisy-or of its patterns of at least
  ``MIN_PATTERN``, of those with one last word the best.

Unseen identifiers of confidence ``ACCEPT`` and ``MIN_SIGNS`` letters or digits are
personal data of their most confident kind wherever they occur. Words such as "the"
stand before many ordinary words and so have no confidence, however many seeds follow them.

Defined results: null texts are empty; rows that repeat (ids and texts too) give a row
each; a null id is kept; texts and words of any length are read whole, by patterns that
never go back over a run; an empty table gives no rows. Only ``doc_id`` and ``text`` are
read, so extra columns of any name do not matter. Ties between kinds go to the first of
``KINDS``. Patterns are told apart by 64-bit hashes of their words, identifiers by the
md5 of their lower-cased signs. Patterns are broadcast up to ``MAX_BROADCAST`` (16 bytes
each); beyond that all pattern occurrences are counted before they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.llm.spool import spool

KINDS = ("email", "ip", "card", "phone")
# Equal to [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on, in linear time: a match starts
# where a run starts or the match before it ended, and no run is read twice.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
IDENTIFIER = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+"
WORD = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
SPACES = " \t\n\x0b\f\r"
MASK = "\x01"

MIN_INSTANCES = 3
MIN_PATTERN = 0.5
ACCEPT = 0.7
MIN_SIGNS = 5
ROUNDS = 3
RUN = 64
MAX_BROADCAST = 1 << 20


def _sums(values: Column) -> Column:
    """Sums of all values before each, over runs of ``RUN`` values, so arrays grow by short copies."""
    def before(a: Column) -> Column:
        return F.aggregate(a, F.array(F.lit(0).cast("long")), lambda out, v: F.concat(out, F.array(F.element_at(out, -1) + v)))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")), lambda k: F.slice(values, k * RUN + 1, F.lit(RUN)))
    totals = before(F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda s, v: s + v)))
    each = F.zip_with(runs, F.slice(totals, F.lit(1), F.size(runs)), lambda r, s: F.transform(F.slice(before(r), F.lit(1), F.size(r)), lambda x: x + s))
    return F.when(F.size(values) > 0, F.flatten(each)).otherwise(F.array().cast("array<long>"))


def _places(found: Column, parts: Column) -> Column:
    """``start, end, value`` of matches, given the parts of the text between them."""
    steps = F.zip_with(F.slice(parts, F.lit(2), F.size(found)), found, lambda p, f: (F.length(f) + F.length(p)).cast("long"))
    starts = _sums(steps)
    first = F.length(F.get(parts, F.lit(0)))
    return F.zip_with(found, starts, lambda f, s: F.struct((s + first).alias("start"), (s + first + F.length(f)).alias("end"), f.alias("value")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the checksum: from the right, every second one counts twice, less 9 above 9."""
    n = F.length(digits)

    def worth(k: Column) -> Column:
        d = F.substr(digits, n - k, F.lit(1)).cast("int")
        return F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, k: s + worth(k)) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(12, 19) & _luhn(digits)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def _valid(kind: str, places: Column) -> Column:
    return F.filter(places, lambda m: is_valid(kind, m["value"]))


def _ranked(rank: int, places: Column) -> Column:
    return F.transform(places, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))


def _may_hold(kind: str, text: Column) -> Column:
    return text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else F.col("digits")


def _with_matches(df: DataFrame, text: str) -> DataFrame:
    """Adds an array ``start, end, value`` per kind, valid matches alone."""
    t, empty = F.col(text), F.array().cast("array<string>")
    cols = [c for c in df.columns if c != "digits"]
    df = df.select(*cols, t.rlike("[0-9]").alias("digits"))
    df = df.select(*cols, *[F.when(_may_hold(k, t), F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0))).otherwise(empty).alias(f"{k}_found") for k in KINDS])
    df = df.select(*cols, *[f"{k}_found" for k in KINDS], *[F.when(F.size(f"{k}_found") > 0, F.split(t, PATTERNS[k], -1)).otherwise(empty).alias(f"{k}_parts") for k in KINDS])
    return df.select(*cols, *[_valid(k, _places(F.col(f"{k}_found"), F.col(f"{k}_parts"))).alias(k) for k in KINDS])


SPAN = "array<struct<start: long, rank: int, end: long>>"


def find_base(docs: DataFrame) -> DataFrame:
    """``row`` (a number), ``doc_id``, ``base`` (spans ``start, rank, end`` in order; rank: place in ``KINDS``) and
    ``chunks`` (identifiers: ``start, value`` and the two words before, ``last`` and ``other``) per row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = _with_matches(rows, "text")
    spans = F.concat(*[_ranked(r, F.col(k)) for r, k in enumerate(KINDS)])
    t, empty = F.col("text"), F.array().cast("array<string>")
    rows = rows.select("row", "doc_id", "text", F.array_sort(spans).cast(SPAN).alias("base"),
                       F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(IDENTIFIER), F.lit(0))).otherwise(empty).alias("found"))
    rows = rows.select("row", "doc_id", "base", "found", F.when(F.size("found") > 0, F.split(t, IDENTIFIER, -1)).otherwise(empty).alias("parts"))
    before = r"^\s*+(\S++)(?:\s++(\S++))?"

    def word(part: Column, group: int) -> Column:
        return F.nullif(F.lower(F.reverse(F.regexp_extract(F.reverse(part), before, group))), F.lit(""))
    words = F.transform(F.slice("parts", F.lit(1), F.size("found")), lambda p: F.struct(word(p, 1).alias("last"), word(p, 2).alias("other")))
    chunks = F.zip_with(_places(F.col("found"), F.col("parts")), words, lambda m, w: F.struct(m["start"].alias("start"), m["value"].alias("value"), w["last"].alias("last"), w["other"].alias("other")))
    return rows.select("row", "doc_id", "base", chunks.alias("chunks"))


def _lead(value: Column, signs: str) -> Column:
    return F.length(F.regexp_extract(value, f"^{signs}", 0))


def find_identifiers(base: DataFrame) -> DataFrame:
    """Every identifier of ``find_base``, without the marks around it: ``row, start, end, id, signs, kinds`` (of the
    detectors that find something in it) and ``last, other``."""
    found = base.select("row", F.explode("chunks").alias("c")).select("row", "c.*")
    head, tail = _lead(F.col("value"), r"[^\p{L}\p{N}+]*+"), _lead(F.reverse("value"), r"[^\p{L}\p{N}]*+")
    found = found.select("row", "last", "other", "start", "value", head.alias("head"), tail.alias("tail")).where(F.col("head") + F.col("tail") < F.length("value"))
    found = found.select("row", "last", "other", (F.col("start") + F.col("head")).alias("start"), F.substr("value", F.col("head") + 1, F.length("value") - F.col("head") - F.col("tail")).alias("value"))
    found = _with_matches(found, "value")
    kinds = F.filter(F.array(*[F.when(F.size(k) > 0, F.lit(r)) for r, k in enumerate(KINDS)]), lambda r: r.isNotNull())
    signs = F.lower(F.regexp_replace("value", r"[^\p{L}\p{N}@]", ""))
    return found.select("row", "start", (F.col("start") + F.length("value")).alias("end"), F.md5(signs.cast("binary")).alias("id"), F.length(signs).alias("signs"), kinds.alias("kinds"), "last", "other")


def pattern_keys(last: Column, other: Column) -> Column:
    """Hashes of the patterns that two words form; null words form none."""
    one, two = F.xxhash64(F.lit(1), last), F.xxhash64(F.lit(2), other, last)
    return F.filter(F.array(F.when(last.isNotNull(), one), F.when(last.isNotNull() & other.isNotNull(), two)), lambda k: k.isNotNull())


def count_patterns(docs: DataFrame, patterns: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``pattern, total``: how often each of ``patterns`` (``pattern``, distinct) stands before a word in all texts."""
    t = F.lower(F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES)))
    t = F.when(t.rlike("[0-9@]"), F.regexp_replace(t, WORD, MASK)).otherwise(t)  # identifiers are no words of patterns
    words = docs.select(F.split(t, r"\s+").alias("w"))
    n = F.size("w")
    one = F.transform(F.slice("w", F.lit(1), n - 1), lambda a: F.xxhash64(F.lit(1), a))
    two = F.when(n > 2, F.zip_with(F.slice("w", F.lit(1), n - 2), F.slice("w", F.lit(2), n - 2), lambda a, b: F.xxhash64(F.lit(2), a, b))).otherwise(F.array().cast("array<long>"))
    keys = words.select(F.explode(F.concat(one, two)).alias("pattern"))
    if patterns.count() <= max_broadcast:
        return keys.join(F.broadcast(patterns), "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    return keys.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")).join(patterns, "pattern", "left_semi")


def pattern_graph(docs: DataFrame, found: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``pattern, last, id, kinds, signs, times, total`` for patterns before at least ``MIN_INSTANCES`` identifiers."""
    edges = (found.select("id", "kinds", "signs", F.xxhash64("last").alias("last"), F.explode(pattern_keys(F.col("last"), F.col("other"))).alias("pattern"))
             .groupBy("pattern", "last", "id").agg(F.array_sort(F.first("kinds")).alias("kinds"), F.first("signs").alias("signs"), F.count(F.lit(1)).alias("times")))
    edges = spool(edges, "edges")
    patterns = spool(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("m"), F.sum("times").alias("seen")).where(F.col("m") >= MIN_INSTANCES).select("pattern", "seen"), "patterns")
    total = count_patterns(docs, patterns.select("pattern"), max_broadcast)
    patterns = patterns.join(total, "pattern", "left").select("pattern", F.greatest("seen", F.coalesce("total", F.lit(0))).alias("total"))
    return spool(edges.join(patterns, "pattern"), "graph")


def score_patterns(graph: DataFrame, conf: DataFrame) -> DataFrame:
    """``pattern, rank, score`` from ``conf`` (``id, rank, conf``): confidence of each pattern for each kind."""
    known = graph.join(conf, "id").groupBy("pattern", "rank").agg(F.sum(F.col("times") * F.col("conf")).alias("hits"), F.max("total").alias("total"), F.count_if(F.col("conf") >= ACCEPT).alias("m"))
    return known.where(F.col("m") >= MIN_INSTANCES).select("pattern", "rank", (F.col("hits") / (F.col("total") + 1)).alias("score")).where(F.col("score") >= MIN_PATTERN)


def score_identifiers(graph: DataFrame, scores: DataFrame) -> DataFrame:
    """``id, rank, conf`` of unseen identifiers: noisy-or over their patterns, one a last word."""
    best = graph.where(F.size("kinds") == 0).join(scores, "pattern").groupBy("id", "rank", "last").agg(F.max("score").alias("score"))
    return best.groupBy("id", "rank").agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("conf"))


def bootstrap(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``id, rank, conf`` of unseen identifiers that contexts make personal data."""
    seeds = spool(graph.select("id", F.explode("kinds").alias("rank"), F.lit(1.0).alias("conf")).distinct(), "seeds")
    found = None
    for _ in range(rounds):
        scores = score_patterns(graph, seeds if found is None else seeds.unionByName(found))
        found = spool(score_identifiers(graph, spool(scores, "scores")), "found")
    long = graph.where((F.size("kinds") == 0) & (F.col("signs") >= MIN_SIGNS)).select("id").distinct()
    best = found.join(long, "id").groupBy("id").agg(F.min(F.struct((-F.col("conf")).alias("c"), "rank")).alias("b"))
    return best.select("id", F.col("b.rank").alias("rank"), (-F.col("b.c")).alias("conf")).where(F.col("conf") >= ACCEPT)


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id``, ``base`` and ``added`` spans (``start, rank, end``; rank:
    place in ``KINDS``; in order). Added spans touch no base span."""
    docs = docs.select("doc_id", "text")
    base = spool(find_base(docs), "base")
    found = spool(find_identifiers(base), "identifiers")
    accepted = bootstrap(pattern_graph(docs, found, max_broadcast), rounds)
    added = (found.where(F.size("kinds") == 0).join(accepted, "id")
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).cast(SPAN).alias("added")))
    free = F.filter("added", lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    none = F.array().cast(SPAN)
    return base.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", F.coalesce(F.when(F.col("added").isNotNull(), free), none).alias("added"))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def spell(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")
