"""Size guards: nothing reaches the driver or a broadcast without a checked bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

# Defaults, overridable per call. A lexicon inlined as an IN-set or a weights
# table broadcast to every executor must stay well inside executor memory.
MAX_INLINE_TERMS = 50_000
MAX_BROADCAST_BYTES = 256 << 20
KEY_BYTES = 64  # a term with its row overhead
MAX_CLASSES = 1_000


def bounded_collect(df: DataFrame, limit: int) -> list[Row] | None:
    """Rows of ``df`` if it has at most ``limit`` of them, else ``None``.

    Pulls at most ``limit + 1`` rows to the driver, whatever the size of ``df``.
    """
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows

