"""Rows for Python: enough partitions for all cores, without moving rows that already lie in many."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df itself where its scan gives every core a partition, else df dealt out in turn."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
