"""Repeated deliveries: of the rows with one key, the latest holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """One row per ``key``: of its rows, the greatest by (at, columns...).

    A null ``at`` is the earliest; rows with a null key have no identity and are
    left out; equal rows count once.  It is a partial aggregate before its one
    shuffle, so a key that holds a third of all rows is reduced where it lies.
    ``columns`` must be orderable.
    """
    rest = [c for c in columns if c != key]
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(F.col(at).alias("_at"), *[F.col(c) for c in rest])).alias("_row"))
        .select(key, *[F.col("_row")[c].alias(c) for c in rest])
    )
