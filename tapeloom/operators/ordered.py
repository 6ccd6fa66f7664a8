"""Neighbours, running sums and forward fills over ordered rows of a key, without one task per key.

A window over a whole recording would put a recording that holds a third of all
rows into one task.  Here rows are cut into chunks by their place in time; a
window sees one chunk, and what crosses a border comes from a two-level prefix
over one summary row for each chunk (``prefix``).

Defined results: rows with a null key or place are left out by the callers;
ties in ``order`` must be broken by a unique last column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.operators.prefix import prefixed

CHUNK_US = 600_000_000


def chunked(df: DataFrame, place: str, chunk: float = CHUNK_US) -> DataFrame:
    return df.withColumn("_c", F.floor(F.col(place) / F.lit(float(chunk))).cast("long"))


def with_neighbours(df: DataFrame, key: str, order: list[str], columns: list[str], before: str | None = "prev_", after: str | None = "next_", chunk: float = CHUNK_US) -> DataFrame:
    """Adds prev_<c> and next_<c> of the neighbouring rows of a key."""
    rows = chunked(df, order[0], chunk)
    inside = W.partitionBy(key, "_c").orderBy(*order)
    packed = F.struct(*[F.col(c) for c in columns])
    full = F.struct(*[F.col(c) for c in order], packed.alias("_v"))
    ends = rows.groupBy(key, "_c").agg(F.min_by(full, F.struct(*order)).alias("_lo"), F.max_by(full, F.struct(*order)).alias("_hi"))
    ends = prefixed(ends, [key], "_c", {k: v for k, v in {"_ph": ("last", "_hi"), "_nl": ("next", "_lo")}.items() if (before if k == "_ph" else after)})
    ends = ends.select(key, "_c", *[F.col(a)["_v"].alias(b) for a, b in (("_ph", "_pv"), ("_nl", "_nv")) if a in ends.columns])
    rows = rows.withColumns({"_p": F.lag(packed).over(inside), "_n": F.lead(packed).over(inside)}).join(ends, [key, "_c"], "left")
    out = {}
    if before:
        out |= {f"{before}{c}": F.when(F.col("_p").isNotNull(), F.col("_p")[c]).otherwise(F.col("_pv")[c]) for c in columns}
    if after:
        out |= {f"{after}{c}": F.when(F.col("_n").isNotNull(), F.col("_n")[c]).otherwise(F.col("_nv")[c]) for c in columns}
    return rows.withColumns(out).drop("_p", "_n", "_pv", "_nv", "_c")


def with_running_sum(df: DataFrame, key: str, order: list[str], value: Column, name: str, chunk: float = CHUNK_US) -> DataFrame:
    """Adds the sum of ``value`` from the key's first row up to this one."""
    rows = chunked(df.withColumn("_v", value.cast("long")), order[0], chunk)
    inside = W.partitionBy(key, "_c").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    sums = rows.groupBy(key, "_c").agg(F.sum("_v").alias("_t"))
    sums = prefixed(sums, [key], "_c", {"_o": ("sum", "_t")}).drop("_t")
    rows = rows.withColumn("_s", F.sum("_v").over(inside)).join(sums, [key, "_c"])
    return rows.withColumn(name, (F.col("_s") + F.col("_o")).cast("long")).drop("_v", "_c", "_s", "_o")


def with_greatest_before(df: DataFrame, key: str, order: list[str], value: Column, name: str, chunk: float = CHUNK_US) -> DataFrame:
    """Adds the greatest ``value`` of the key's rows before this one, null for the first."""
    rows = chunked(df.withColumn("_v", value), order[0], chunk)
    inside = W.partitionBy(key, "_c").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    most = rows.groupBy(key, "_c").agg(F.max("_v").alias("_t"))
    most = prefixed(most, [key], "_c", {"_o": ("max", "_t")}).drop("_t")
    rows = rows.withColumn("_s", F.max("_v").over(inside)).join(most, [key, "_c"])
    return rows.withColumn(name, F.greatest("_s", "_o")).drop("_v", "_c", "_s", "_o")


def with_stretches(df: DataFrame, key: str, order: list[str], pause: int, name: str, chunk: float = CHUNK_US) -> DataFrame:
    """Adds the number of the stretch a row belongs to: a row begins one where it starts more than ``pause`` after all ends before it."""
    rows = with_greatest_before(df, key, order, F.col("end_us"), "_reach", chunk)
    begins = F.when(F.col("_reach").isNull() | (F.col("start_us") - F.col("_reach") > pause), 1).otherwise(0)
    return with_running_sum(rows, key, order, begins, name, chunk).drop("_reach")


def with_last(df: DataFrame, key: str, order: list[str], value: Column, name: str, chunk: float = CHUNK_US) -> DataFrame:
    """Adds the last non-null ``value`` of the key's rows before this one (forward fill, this row not counted)."""
    rows = chunked(df.withColumn("_v", value), order[0], chunk)
    inside = W.partitionBy(key, "_c").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    last = rows.groupBy(key, "_c").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_t"))
    last = prefixed(last, [key], "_c", {"_o": ("last", "_t")}).drop("_t")
    rows = rows.withColumn("_s", F.last("_v", ignorenulls=True).over(inside)).join(last, [key, "_c"])
    return rows.withColumn(name, F.coalesce("_s", "_o")).drop("_v", "_c", "_s", "_o")


def with_islands(df: DataFrame, key: str, order: list[str], columns: list[str], breaks: Column, name: str = "island", chunk: float = CHUNK_US, using: list[str] | None = None) -> DataFrame:
    """Adds the number of the island a row belongs to: a row begins one where ``breaks`` (over prev_ columns) is not false.

    ``breaks`` may read ``columns``, the order, ``using`` and prev_<column>.  One window over a chunk finds the breaks inside it;
    the first row of a chunk meets the last of the chunk before in the summaries, which also count the islands begun before each chunk.
    """
    read = list(dict.fromkeys([*columns, *order, *(using or [])]))
    rows = chunked(df, order[0], chunk)
    inside = W.partitionBy(key, "_c").orderBy(*order)
    packed = F.struct(*[F.col(c) for c in columns])
    flag = F.when(breaks, 1).when(~breaks, 0).otherwise(1).cast("long")

    def marked(r: DataFrame, before: str, column: str) -> DataFrame:
        """Adds ``column``: the break of each row against the struct ``before``."""
        r = r.withColumns({f"prev_{c}": F.col(before)[c] for c in columns})
        return r.withColumn(column, flag).drop(*[f"prev_{c}" for c in columns])

    def local(r: DataFrame) -> DataFrame:
        r = marked(r.withColumns({"_p": F.lag(packed).over(inside), "_nr": F.row_number().over(inside)}), "_p", "_b")
        # the first row of a chunk is judged with the chunk before
        return r.withColumn("_b", F.when(F.col("_nr") == 1, 0).otherwise(F.col("_b"))).drop("_p")

    few = local(rows.select(key, "_c", *[c for c in read if c != key]))
    at = F.struct(*order)
    ends = few.groupBy(key, "_c").agg(F.min_by(F.struct(*read), at).alias("_lo"), F.max_by(packed, at).alias("_hi"), F.sum("_b").alias("_in"))
    ends = prefixed(ends, [key], "_c", {"_ph": ("last", "_hi")}).drop("_hi")
    ends = marked(ends.select(key, "_c", "_in", "_ph", *[F.col("_lo")[c].alias(c) for c in read if c != key]), "_ph", "_fb")
    ends = ends.select(key, "_c", "_fb", (F.col("_fb") + F.col("_in")).alias("_t"))
    ends = prefixed(ends, [key], "_c", {"_o": ("sum", "_t")}).select(key, "_c", (F.col("_o") + F.col("_fb")).alias("_o"))
    out = local(rows).withColumn("_s", F.sum("_b").over(inside.rowsBetween(W.unboundedPreceding, 0))).join(ends, [key, "_c"])
    return out.withColumn(name, (F.col("_s") + F.col("_o")).cast("long")).drop("_b", "_nr", "_c", "_s", "_o")


def interval_join(left: DataFrame, right: DataFrame, key: str, bin_us: int = 60_000_000) -> DataFrame:
    """Pairs of left (key, l_start, l_end, ...) and right (key, r_start, r_end, ...) that overlap for longer than nothing.

    Both sides are cut into time bins, so the join is an equi join on (key, bin);
    a pair is kept only in the bin in which its overlap begins.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / bin_us).cast("long"), F.greatest(F.floor(F.col(a) / bin_us), F.floor(F.col(b) / bin_us)).cast("long")))
    lb, rb = left.withColumn("_bin", bins("l_start", "l_end")), right.withColumn("_bin", bins("r_start", "r_end"))
    pairs = lb.join(rb, [key, "_bin"]).filter("r_start < l_end and l_start < r_end")
    return pairs.filter(F.floor(F.greatest("l_start", "r_start") / bin_us) == F.col("_bin")).drop("_bin")
