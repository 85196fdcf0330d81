"""Intermediate tables in the shared checkpoint folder, as Parquet: they cut
lineage, survive a lost executor and are read again without recomputing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from evenline.session import scratch_path


def spool(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
