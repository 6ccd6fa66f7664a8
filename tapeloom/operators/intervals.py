"""Coverage of time by intervals: continuous periods and the gaps between them.

An entity's intervals are cut into time chunks by their start, so that no task
ever holds a whole entity.  Inside a chunk, a window with the running maximum
of the previous ends labels islands.  Across chunks only one row per chunk
travels: the greatest end (and the start of the last island) before each chunk,
a two-level prefix over chunk summaries (``prefix``).  Islands are then summed
by their first start.

Defined results: rows with a null key, a null bound or an end before the start
have no usable time and are left out; intervals of no length count and touch
what lies at their point; ties and repeated rows change nothing but counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.operators.prefix import prefixed
from tapeloom.session import cut

CHUNK_US = 600_000_000


def usable(df: DataFrame, start: str = "start_us", end: str = "end_us") -> DataFrame:
    return df.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start)))


def _chunk(start: Column, chunk_us: int) -> Column:
    return F.floor(start / F.lit(float(chunk_us))).cast("long")


def _pieces(df: DataFrame, keys: list[str], chunk_us: int) -> DataFrame:
    """Local islands (keys, _c, _s, _e, n) of each chunk; touching intervals belong together."""
    by = [*keys, "_c"]
    # one shuffle: the window and the sums below share its partitioning
    rows = df.withColumn("_c", _chunk(F.col("_s"), chunk_us))
    order = W.partitionBy(*by).orderBy("_s", "_e")
    before = F.max("_e").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when(before.isNull() | (F.col("_s") > before), 1).otherwise(0))
    rows = rows.withColumn("_i", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*by, "_i").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("n").alias("n")).drop("_i")


def _carried(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Per chunk: the greatest end before it (_carry) and the start of the island that has it (_open)."""
    chunks = pieces.groupBy(*keys, "_c").agg(F.max("_e").alias("_me"), F.max("_s").alias("_ms"))
    chunks = prefixed(chunks, keys, "_c", {"_carry": ("max", "_me")})
    # the last island of a chunk begins in it only if it begins after all that was covered before
    chunks = chunks.withColumn("_last", F.when(F.col("_carry").isNull() | (F.col("_ms") > F.col("_carry")), F.col("_ms")))
    return prefixed(chunks, keys, "_c", {"_open": ("last", "_last")}).drop("_last", "_ms", "_me")


def periods(df: DataFrame, keys: list[str], start: str = "start_us", end: str = "end_us", chunk_us: int = CHUNK_US) -> DataFrame:
    """(keys, start, end, n): the longest stretches that intervals of one entity cover without a break; n intervals each."""
    rows = usable(df, start, end).filter(" and ".join(f"`{k}` is not null" for k in keys))
    rows = rows.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.lit(1).cast("long").alias("n"))
    pieces = cut(_pieces(rows, keys, chunk_us), "pieces")  # read for the summaries and for the islands
    joined = pieces.join(_carried(pieces, keys), [*keys, "_c"])
    island = F.when(F.col("_carry").isNull() | (F.col("_s") > F.col("_carry")), F.col("_s")).otherwise(F.col("_open"))
    merged = joined.withColumn("_g", island).groupBy(*keys, "_g").agg(F.max("_e").alias(end), F.sum("n").alias("n"))
    return merged.select(*keys, F.col("_g").alias(start), end, "n")


def gaps(df: DataFrame, keys: list[str], start: str = "start_us", end: str = "end_us", longer_than_us: int = 0, at_most_us: int | None = None, chunk_us: int = CHUNK_US) -> DataFrame:
    """(keys, start, end): stretches between two intervals of an entity in which none lies."""
    rows = usable(df, start, end).filter(" and ".join(f"`{k}` is not null" for k in keys))
    rows = rows.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.lit(1).cast("long").alias("n"))
    pieces = cut(_pieces(rows, keys, chunk_us), "pieces")  # read for the summaries and for the gaps
    carry = prefixed(pieces.groupBy(*keys, "_c").agg(F.max("_e").alias("_me")), keys, "_c", {"_carry": ("max", "_me")}).drop("_me")
    before = F.max("_e").over(W.partitionBy(*keys, "_c").orderBy("_s").rowsBetween(W.unboundedPreceding, -1))
    rows = pieces.withColumn("_before", before).join(carry, [*keys, "_c"])
    rows = rows.withColumn("_before", F.greatest("_before", "_carry"))
    long_enough = (F.col("_s") - F.col("_before")) > longer_than_us
    if at_most_us is not None:
        long_enough &= (F.col("_s") - F.col("_before")) <= at_most_us
    return rows.filter(F.col("_before").isNotNull() & long_enough).select(*keys, F.col("_before").alias(start), F.col("_s").alias(end))
