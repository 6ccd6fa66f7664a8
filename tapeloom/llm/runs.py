"""Problem 2: runs of the same event, collapsed into one with its count and duration.

Associative run summaries.  All events are sorted by range over (key, order), so
a partition is a chunk of equally many rows, wherever the rows of one key lie;
a third of all rows in one recording is a third of all partitions.  Each
partition encodes its runs locally, in one pass over Arrow batches, and marks
its first and its last run.  Two summaries join where the last run of one and
the first of the next hold the same key and value; that merge across boundaries
is a prefix over two rows a partition, blocks of partitions side by side first
and then one row for each block, so no task sees more than a block's edges.

Defined results: rows with a null key, order or value are left out; rows equal
in the order are ordered by the tie columns; repeated rows count as often as
they stand; a null start or end does not count for the bounds of its run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.intervals import usable
from tapeloom.operators.prefix import prefixed
from tapeloom.operators.speech_periods import timed_and_named, valid_segments
from tapeloom.session import cut

#: Places of a chunk among all: partition number times PLACES plus its number in the partition.
PLACES = 1 << 32


def _encoder(chunk_rows: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, value, ident, start, end) in order -> place, edge, key, value, first, n, start, end of the local runs.

    edge: 1 the first run of a chunk, 2 its last, 3 both, 0 neither."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "edge", "key", "value", "first", "n", "start", "end"]
        place, held, opened, filled = (TaskContext.get().partitionId() if TaskContext.get() else 0) * PLACES, None, True, 0
        schema = None

        def table(rows: pa.Table, edges: np.ndarray, at: int) -> pa.RecordBatch:
            cols = [pa.array(np.full(len(edges), at)), pa.array(edges, pa.int32()), *rows.columns]
            return pa.Table.from_arrays(cols, names).combine_chunks().to_batches()[0]

        def local(b: pa.RecordBatch) -> pa.Table:
            n = b.num_rows
            key, value = b.column(0), b.column(1)
            new = np.ones(n, bool)
            if n > 1:
                new[1:] = pc.or_(pc.not_equal(key.slice(1), key.slice(0, n - 1)), pc.not_equal(value.slice(1), value.slice(0, n - 1))).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(new)
            bound = lambda i, fold, gone: fold.reduceat(pc.fill_null(b.column(i), gone).to_numpy(zero_copy_only=False), at)
            low, high = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            s, e = bound(3, np.minimum, low), bound(4, np.maximum, high)
            ids = pa.array(at)
            return pa.Table.from_arrays([key.take(ids), value.take(ids), b.column(2).take(ids), pa.array(np.diff(np.append(at, n))), pa.array(s, mask=s == low), pa.array(e, mask=e == high)], names[2:])

        for whole in batches:
            at = 0
            while at < whole.num_rows:
                room = whole.num_rows - at if chunk_rows is None else min(chunk_rows - filled, whole.num_rows - at)
                rows = local(whole.slice(at, room))
                schema = rows.schema
                at, filled = at + room, filled + room
                if held is not None:  # the run that the batch before left open
                    a, b = held.slice(0, 1).to_pylist()[0], rows.slice(0, 1).to_pylist()[0]
                    if a["key"] == b["key"] and a["value"] == b["value"]:
                        some = lambda f, x, y: f(v for v in (x, y) if v is not None) if x is not None or y is not None else None
                        one = {**a, "n": a["n"] + b["n"], "start": some(min, a["start"], b["start"]), "end": some(max, a["end"], b["end"])}
                        rows = pa.concat_tables([pa.Table.from_pylist([one], schema), rows.slice(1)])
                    else:
                        rows = pa.concat_tables([held, rows])
                done = chunk_rows is not None and filled >= chunk_rows
                give = rows if done else rows.slice(0, rows.num_rows - 1)
                held = None if done else rows.slice(rows.num_rows - 1)
                if give.num_rows:
                    edges = np.zeros(give.num_rows, np.int32)
                    edges[0] += opened
                    edges[-1] += 2 * done
                    opened = done
                    yield table(give, edges, place)
                if done:
                    place, filled = place + 1, 0
        if held is not None:
            yield table(held, np.array([2 + opened], np.int32), place)

    return encode


def runs(df: DataFrame, key: str, value: str, order: list[str], start: str, end: str, chunk_rows: int | None = None) -> DataFrame:
    """(key, value, first_<tie>, n, start, end, duration) for each maximal run of equal ``value``.

    ``order`` is the full order within a key: integer columns, the first the
    position in time, the last the tie-breaking id.  start and end are the least
    start and the greatest end in the run.  ``chunk_rows`` makes chunks smaller
    than a partition.
    """
    ident, kinds = order[-1], {f.name: f.dataType.simpleString() for f in df.schema}
    rows = df.filter(" and ".join(f"`{c}` is not null" for c in {key, value, *order}))
    rows = rows.select(F.col(key).alias("_key"), F.col(value).alias("_value"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(start).cast("long").alias("_start"), F.col(end).cast("long").alias("_end"))
    by = ["_key", *[f"_o{i}" for i in range(len(order))]]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    shape = f"place bigint, edge int, key {kinds[key]}, value {kinds[value]}, first {kinds[ident]}, n bigint, start bigint, end bigint"
    local = ordered.select("_key", "_value", f"_o{len(order) - 1}", "_start", "_end").mapInArrow(_encoder(chunk_rows), shape)
    local = cut(local, "runs")  # read for the edges and for what lies between them
    edges = local.filter("edge > 0").withColumn("part", F.lit(0))
    # prefix over the chunks: the run that the chunk before hands on, then how many runs begin before each chunk
    run = F.struct("key", "value")
    chunks = edges.groupBy("part", "place").agg(F.max(F.when(F.col("edge") != 2, run)).alias("opening"), F.max(F.when(F.col("edge") != 1, run)).alias("closing"), F.max("edge").alias("most"))
    chunks = prefixed(chunks, ["part"], "place", {"handed": ("last", "closing")})
    chunks = chunks.withColumn("fresh", F.when(F.col("handed") == F.col("opening"), 0).otherwise(1).cast("long"))
    chunks = chunks.withColumn("begun", F.col("fresh") + F.when(F.col("most") == 2, 1).otherwise(0))
    chunks = prefixed(chunks, ["part"], "place", {"before": ("sum", "begun")}).select("place", (F.col("before") + F.col("fresh")).alias("at"))
    joined = edges.join(chunks, "place").withColumn("at", F.col("at") + F.when(F.col("edge") == 2, 1).otherwise(0))
    merged = joined.groupBy("at", "key", "value").agg(F.min_by("first", "place").alias("first"), F.sum("n").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))
    inner = local.filter("edge = 0").select("key", "value", "first", "n", "start", "end")
    out = inner.unionByName(merged.drop("at"))
    return out.select(F.col("key").alias(key), F.col("value").alias(value), F.col("first").alias(f"first_{ident}"), "n", F.col("start").alias(start), F.col("end").alias(end), (F.col("end") - F.col("start")).alias("duration"))


def p2_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every run, those of one segment too, with its count and duration."""
    return runs(timed_and_named(spark, d), "file_id", "name", ["start_us", "end_us", "seg_id"], "start_us", "end_us").withColumnRenamed("n", "n_segs")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_runs(spark, d).filter("n_segs >= 2").select("file_id", "first_seg_id", "n_segs")


def p2_label_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs by the labels as they are written, names not resolved: the same operator in a form that SQL can follow."""
    rows = usable(valid_segments(spark, d, ["file_id", "start_us", "end_us", "speaker"])).filter("file_id is not null")
    return runs(rows.withColumn("speaker", F.coalesce("speaker", F.lit(""))), "file_id", "speaker", ["start_us", "end_us", "seg_id"], "start_us", "end_us").withColumnRenamed("n", "n_segs")


SQL = {
    "p2_label_runs": "WITH va AS (SELECT seg_id, file_id, start_us, end_us, coalesce(speaker, '') AS speaker FROM (SELECT *, row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM segments_merged WHERE seg_id IS NOT NULL) WHERE rn = 1 AND file_id IS NOT NULL AND start_us IS NOT NULL AND end_us >= start_us), "
    "nb AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_us, end_us, seg_id) - row_number() OVER (PARTITION BY file_id, speaker ORDER BY start_us, end_us, seg_id) AS g FROM va) "
    "SELECT file_id, speaker, arg_min(seg_id, (start_us, end_us, seg_id)) AS first_seg_id, count(*) AS n_segs, min(start_us) AS start_us, max(end_us) AS end_us, max(end_us) - min(start_us) AS duration FROM nb GROUP BY file_id, speaker, g"
}
