"""Splits and subsets.

Splits come from a hash of a key column, never from ``randomSplit``: the result
does not depend on partitioning, task retries or executor loss, and exact
copies of a text land in the same split when the key is the text (D1). All of
it is a projection; no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenline.functions.text import hash_bucket
from evenline.guards import MAX_CLASSES, bounded_collect

DEFAULT_RATIOS = (("train", 80), ("validation", 10), ("test", 10))


def split_expr(key: Column, ratios: Sequence[tuple[str, int]] = DEFAULT_RATIOS) -> Column:
    """Split name from ``hash_bucket(key) in [0, 100)``; weights are percent
    and must add up to 100. Null key gives a null split (row in no split)."""
    if sum(w for _, w in ratios) != 100:
        raise ValueError("split weights must add up to 100")
    b = hash_bucket(key)
    e = F.when(key.isNull(), F.lit(None).cast("string"))
    edge = 0
    for name, w in ratios[:-1]:
        edge += w
        e = e.when(b < edge, F.lit(name))
    return e.otherwise(F.lit(ratios[-1][0]))


def holdout_split(df: DataFrame, key: str = "text",
                  ratios: Sequence[tuple[str, int]] = DEFAULT_RATIOS, out: str = "split",
                  keep_existing: bool = False) -> DataFrame:
    """A5: adds ``split``. Key ``text`` keeps exact copies together.
    With ``keep_existing`` a ready-made split already in ``out`` is kept and
    only missing values are assigned."""
    e = split_expr(F.col(key), ratios)
    if keep_existing and out in df.columns:
        e = F.coalesce(F.col(out), e)
    return df.withColumn(out, e)


def split_profile(df: DataFrame, by: Sequence[str] = ("task", "split", "label")) -> DataFrame:
    """Rows per task, split and label (two-phase hash aggregate)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def subset_order(key: str, tiebreak: str) -> list[Column]:
    """Total order for subsets: md5 of the key, then the id (exact copies share
    the md5, so the id breaks ties)."""
    return [F.md5(F.col(key)), F.col(tiebreak)]


def staged_subsets(df: DataFrame, sizes: Sequence[int] = (1000, 5000, 10000),
                   key: str = "text", id_col: str = "example_id", oversample: float = 2.0) -> DataFrame:
    """Nested subsets of fixed sizes; one row per (stage, member). Rows
    are ordered by (md5(key), id); rows with a null key are in no subset.

    A plain ``orderBy(...).limit(k)`` sends every partition's local top k to
    one task (partitions x k rows). Instead, the first 32 bits of md5 are
    uniform, so the rows with hash share below ``c`` are exactly a prefix of
    the order: with ``c`` about ``2k / N`` only some ``2k`` rows in total reach
    the top-k. If fewer than k pass (rare), ``c`` doubles and the step repeats,
    so the result is exact. The at most ``k`` rows are checkpointed (bounded)
    and ranked by a window over them alone.
    """
    from evenline.session import ensure_checkpoint_dir
    k = max(sizes)
    order = subset_order(key, id_col)
    keyed = df.where(F.col(key).isNotNull())
    n = keyed.count()
    c = min(1.0, oversample * k / max(n, 1) + 1e-9)
    ensure_checkpoint_dir(df.sparkSession)
    while True:
        cand = keyed.where(hash_share(F.col(key)) < F.lit(c)) if c < 1.0 else keyed
        top = cand.orderBy(*order).limit(k).checkpoint(eager=True)
        if c >= 1.0 or top.count() >= k:
            break
        c = min(1.0, 2.0 * c)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    stages = F.array(*[F.lit(s) for s in sorted(sizes)])
    return (ranked
            .withColumn("stage", F.explode(F.filter(stages, lambda s: F.col("rank") <= s)))
            .drop("rank"))


def staged_fractions(df: DataFrame, fractions: Sequence[float] = (0.1, 0.5, 1.0),
                     key: str = "text") -> DataFrame:
    """Nested subsets by share of rows, one row per (stage, member).

    Membership is ``u(key) < fraction`` with ``u`` uniform from md5, so stages
    nest by construction and need no global sort: a map-only plan whose size
    grows with the data (the 1K/5K/10K ladder is shares 0.1/0.5/1.0).
    """
    u = hash_share(F.col(key))
    stages = F.array(*[F.lit(float(f)) for f in sorted(fractions)])
    return df.withColumn("stage", F.explode(F.filter(stages, lambda f: u < f)))


def hash_share(key: Column) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def share_below(key: Column, fraction: float) -> Column:
    """Row is in the nested subset of share ``fraction``."""
    return hash_share(key) < F.lit(float(fraction))


# --- exact sizes ---------------------------------------------------------------

KEY_LENGTH = 64  # hex digits: md5 of the text, then md5 of the id
STEP = 3         # digits by which a cut is narrowed a round: 4,096 counts a label and cut
ALL_LABELS = ""


def exact_sizes(counts: dict[str, int], sizes: Sequence[int]) -> list[dict[str, int]]:
    """Rows of every label in each split: in proportion, the rest to the largest remainders (ties: the smaller label),
    so that both the splits' sizes and the labels' counts come out exactly."""
    total = sum(counts.values())
    if sum(sizes) != total:
        raise ValueError(f"split sizes {list(sizes)} do not add up to the {total} rows")
    out, before, done = [], dict.fromkeys(counts, 0), 0
    for size in sizes:
        done += size
        upto = {y: max(n * done // total if total else 0, before[y]) for y, n in counts.items()}
        order = sorted(counts, key=lambda y: (-(counts[y] * done % total if total else 0), y))
        while (rest := done - sum(upto.values())) != 0:
            for y in order if rest > 0 else order[::-1]:
                if rest > 0 and upto[y] < counts[y]:
                    upto[y], rest = upto[y] + 1, rest - 1
                elif rest < 0 and upto[y] > before[y]:
                    upto[y], rest = upto[y] - 1, rest + 1
                if rest == 0:
                    break
        out.append({y: upto[y] - before[y] for y in counts})
        before = upto
    return out


def exact_split(df: DataFrame, sizes: dict[str, int | float], key: str = "text", id_col: str = "doc_id", label: str | None = None, out: str = "split",
                max_classes: int = MAX_CLASSES) -> DataFrame:
    """A5 with exact counts: adds ``out``, with as many rows of each split as ``sizes`` says (whole numbers that add up
    to the rows, or shares that add up to 1; the last split takes what rounding leaves), in every label in proportion.

    Rows of a label are in the order of (md5(key), md5(id)); a split is a stretch of it. The keys at which stretches
    end are order statistics, found without a sort: rows are counted by the next ``STEP`` digits of their keys, the
    digit group where a cut falls is counted again by the digits after it, until a count ends on the cut. A round
    brings at most 4,096 counts a label and cut to the driver. Null keys are an empty text, null labels a label of
    their own. Rows of equal key and id stay together, so sizes are exact where ids are distinct."""
    name = F.lit(ALL_LABELS) if label is None else F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))
    order = F.concat(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = df.select(name.alias("y"), order.alias("k"))
    got = bounded_collect(rows.groupBy("y").count(), max_classes)
    if got is None:
        raise ValueError(f"more than {max_classes} labels")
    counts = {r["y"]: r["count"] for r in got}
    total, names = sum(counts.values()), list(sizes)
    given = list(sizes.values())
    if any(isinstance(s, float) for s in given):
        if abs(sum(given) - 1) > 1e-9:
            raise ValueError("shares must add up to 1")
        given = [int(s * total + 0.5) for s in given[:-1]]
        given.append(total - sum(given))
    plan = exact_sizes(counts, given)
    # cuts: per label and split but the last, how many rows come before; "" stands before all keys, "g" behind them
    ends, want = {}, {}
    for y, n in counts.items():
        done = 0
        for k in range(len(names) - 1):
            done += plan[k][y]
            if done in (0, n):
                ends[y, k] = "g" if done else ""
            else:
                want[y, k] = ("", done)
    spark = df.sparkSession
    for at in range(0, KEY_LENGTH, STEP):
        if not want:
            break
        asked = spark.createDataFrame([(y, k, p) for (y, k), (p, _) in want.items()], "y string, cut int, prefix string")  # a row a label and cut
        found = rows.join(F.broadcast(asked), "y").where(F.substring("k", 1, at) == F.col("prefix") if at else F.lit(True))
        cells: dict[tuple[str, int], list] = {}
        for r in found.groupBy("y", "cut", F.substring("k", at + 1, STEP).alias("d")).count().collect():
            cells.setdefault((r["y"], r["cut"]), []).append((r["d"], r["count"]))
        for c, (prefix, left) in list(want.items()):
            for d, n in sorted(cells[c]):
                if left < n:
                    break
                left -= n
            if left == 0 or at + STEP >= KEY_LENGTH:  # keys below this one are just enough
                ends[c] = prefix + d
                del want[c]
            else:
                want[c] = (prefix + d, left)
    expr = F.lit(names[-1])
    for k in range(len(names) - 2, -1, -1):
        cut = F.create_map(*[x for (y, c), e in ends.items() if c == k for x in (F.lit(y), F.lit(e))]) if counts and len(names) > 1 else None
        expr = F.when(order < F.element_at(cut, name), F.lit(names[k])).otherwise(expr) if cut is not None else expr
    return df.withColumn(out, expr)
