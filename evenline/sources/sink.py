"""Result sink (D5): Parquet partitioned by a low-cardinality column (language
by default), so downstream reads prune partitions (PartitionFilters)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, partition_by: Sequence[str] = ("lang",),
                  mode: str = "overwrite") -> None:
    """Replace ``path`` with ``df``, one folder a group. Rows are rebalanced by
    the group first: AQE cuts a large group into several files and a small one
    stays one file, instead of a file per task and group. The whole folder is
    replaced, so a group that is gone leaves no rows behind."""
    (df.hint("rebalance", *partition_by).write.mode(mode)
       .option("partitionOverwriteMode", "static")
       .partitionBy(*partition_by)
       .parquet(path))
