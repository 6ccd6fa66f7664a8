"""Prefixes over chunk summaries, in two levels.

A key that holds a third of all rows has very many chunks, so even their
summaries must not meet in one task.  Chunks are taken together in blocks of
FAN: a window runs inside each block, a second one over one row for each block
of a key, and both are put together.  A key with 10^9 chunks thus brings 10^6
rows into the second window and a thousand into each first one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Chunks in a block.
FAN = 1000

#: fold -> (over a window, of a group by place, block part with chunk part)
_FOLDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda v, _: F.sum(v), lambda far, near: F.coalesce(far, F.lit(0)) + F.coalesce(near, F.lit(0))),
    "max": (F.max, lambda v, _: F.max(v), lambda far, near: F.greatest(far, near)),
    "last": (lambda v: F.last(v, ignorenulls=True), lambda v, at: F.max_by(v, F.when(v.isNotNull(), at)), lambda far, near: F.coalesce(near, far)),
    "next": (lambda v: F.first(v, ignorenulls=True), lambda v, at: F.min_by(v, F.when(v.isNotNull(), at)), lambda far, near: F.coalesce(near, far)),
}


def prefixed(chunks: DataFrame, keys: list[str], at: str, columns: dict[str, tuple[str, str]], fan: int | None = None) -> DataFrame:
    """Adds to one row per (keys, at) for each name -> (fold, column) the fold of that column over the rows before it.

    sum, max and last (non-null) fold the rows before; next is the first non-null of the rows after.  A sum over
    no rows is 0, the others are null.
    """
    rows = chunks.withColumn("_blk", F.floor(F.col(at) / F.lit(float(fan or FAN))).cast("long"))
    past, future = (W.unboundedPreceding, -1), (1, W.unboundedFollowing)
    inner, outer = W.partitionBy(*keys, "_blk").orderBy(at), W.partitionBy(*keys).orderBy("_blk")
    span = lambda w, fold: w.rowsBetween(*(future if fold == "next" else past))
    near = rows.withColumns({f"_near_{n}": _FOLDS[f][0](F.col(c)).over(span(inner, f)) for n, (f, c) in columns.items()})
    blocks = rows.groupBy(*keys, "_blk").agg(*[_FOLDS[f][1](F.col(c), F.col(at)).alias(f"_blk_{n}") for n, (f, c) in columns.items()])
    far = blocks.select(*keys, "_blk", *[_FOLDS[f][0](F.col(f"_blk_{n}")).over(span(outer, f)).alias(f"_far_{n}") for n, (f, c) in columns.items()])
    out = near.join(far, [*keys, "_blk"])
    out = out.withColumns({n: _FOLDS[f][2](F.col(f"_far_{n}"), F.col(f"_near_{n}")) for n, (f, _) in columns.items()})
    return out.drop("_blk", *[f"_{p}_{n}" for p in ("near", "far") for n in columns])
