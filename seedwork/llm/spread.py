"""Even work for stages in which Python does much per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round-robin over twice the cores if the scan has fewer partitions than cores; else leave them where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
