"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenline.llm.spool import spool

MAX_STEPS = 64


def _is_star_forest(e: DataFrame) -> bool:
    """No node hangs on two others, and none that hangs on another holds one."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        e.select(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    bad = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 or (child > 0 and parent > 0)")
    return bad.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``), the root being the
    smallest node reachable; roots map to themselves. Self-loops and nulls are ignored.

    Every step ends with about one edge a node, is written to the checkpoint
    folder, and aggregates before it joins, so a hub costs a skew join only.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    for _ in range(MAX_STEPS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every node also keeps its own smallest neighbour, so no edge to a root is lost
        large = large.unionByName(m.where("u != m").select("u", F.col("m").alias("v"))).where("u != v")
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = spool(small.unionByName(m.select("u", F.col("m").alias("v")))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        if _is_star_forest(e):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
