"""The transcript pipeline as one plan: deliveries to exported lines (LC0).

Stages, in the order that gives the result its meaning: valid deliveries and
names (alignment), command halves, sentences carried over, duplicates of two
speakers and of one, drift, merge of replicas, classification, mixed replicas
split, introductions, clock marks, cleaning, export.  Recognition is no stage:
its output is the input table, filled gaps included.

Defined results: rows without usable file or times, and rows without text, are
left out; a stage that empties a text drops the row; positions count from 1 in
each recording.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import matching as M
from tapeloom.functions.text import hms
from tapeloom.operators import folds
from tapeloom.operators.names import resolve_names
from tapeloom.operators.ordered import with_neighbours, with_running_sum
from tapeloom.plans.base import ORDER, read, segments
from tapeloom.plans.intervals import label_of
from tapeloom.plans.machines import classified, split_mixed
from tapeloom.plans.texts import command_halves, introduced
from tapeloom.session import cut, forget

QUERIES: dict = {}
SQL: dict[str, str] = {}

RAW = "file_id string, tape_no int, seg_id bigint, start_us bigint, end_us bigint, speaker string, raw_speaker_id string, surname string, text string, from_gap boolean"


def query(name: str):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        return f

    return keep


def aligned(spark: SparkSession, d: str) -> DataFrame:
    """Valid segments with text, their speakers by name and the expert of the recording."""
    r = segments(spark, d, "tape_no", "speaker", "raw_speaker_id", "text", "from_gap").filter("trim(text) <> ''")
    r = resolve_names(r, read(spark, d, "audio_files"), read(spark, d, "speaker_roles"), read(spark, d, "role_aliases"))
    expert = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = r.drop("speaker").withColumnRenamed("name", "speaker").join(expert, "file_id", "left")
    return r.select(*[c.split()[0] for c in folds._columns(RAW)])


def with_commands(r: DataFrame) -> DataFrame:
    """EX1: the expert's replicas that hold a command in halves, all others as they are; ids are doubled so that halves have their own."""
    halves = command_halves(r.filter("speaker = surname"), ["file_id", "tape_no", "surname", "from_gap"]).withColumn("seg_id", 2 * F.col("seg_id") + F.col("part") - 1)
    split = halves.filter("part = 1").select((F.col("seg_id") / 2).cast("long").alias("seg_id"))
    rest = r.join(split, "seg_id", "left_anti").withColumn("seg_id", 2 * F.col("seg_id"))
    return rest.unionByName(halves.select(*r.columns))


def without_drift(r: DataFrame) -> DataFrame:
    """WN2: a start up to 10 s before the end of the row before is moved to that end."""
    gap = F.col("start_us") - F.col("prev_end_us")
    moved = with_neighbours(r, "file_id", ORDER, ["end_us"], after=None).withColumn("start_us", F.when(gap.between(-10_000_000, 0), F.col("prev_end_us")).otherwise(F.col("start_us")))
    return moved.drop("prev_end_us")


def stamped(r: DataFrame) -> DataFrame:
    """EX4 to EX6 and TX9 on text, start_us, end_us and sub_segments; rows left without text are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            subs = [[(m["start_us"], m["end_us"], m["words"]) for m in json.loads(x)] for x in b["subs"]]
            b["text"] = [M.cleaned(M.with_timestamps(t, int(s), int(e), x)) for t, s, e, x in zip(b["text"], b["start_us"], b["end_us"], subs, strict=True)]
            yield b.drop(columns="subs")

    r = r.withColumn("subs", F.to_json("sub_segments")).drop("sub_segments")
    return r.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in r.schema if f.name != "subs")).filter("text <> ''")


def replicas(spark: SparkSession, d: str) -> DataFrame:
    """file_id, pos, start_us, end_us, speaker, raw_speaker_id, text: the finished transcript."""
    def stage(df: DataFrame, label: str, *read: DataFrame) -> DataFrame:
        """df written, and what it was read from deleted: ordered helpers read their input several times, so it must be a table, but only as long as that."""
        out = cut(df, label)
        if read:
            forget(spark, *read)
        return out

    first = stage(aligned(spark, d), "aligned")
    r = stage(with_commands(first), "commands", first)
    r = stage(folds.boundary_carry(r, RAW).filter("trim(text) <> ''"), "carried", r)
    for across in (True, False):
        gone = folds.near_duplicates(r.select("file_id", "seg_id", "speaker", "text", "start_us", "end_us"), across).select(F.col("removed").alias("seg_id")).distinct()
        r = stage(r.join(gone, "seg_id", "left_anti"), "distinct", r)
    expert = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = stage(without_drift(r), "drift", r)
    merged = folds.merge_replicas(r, folds.REPLICA + ", tape_no int").drop("n").join(expert, "file_id", "left")
    shape = folds.REPLICA.replace("n int, ", "") + ", tape_no int, surname string"
    merged = stage(merged, "merged", r)
    parts = stage(split_mixed(classified(merged, shape)), "split", merged)
    # parts have their order by id; whose speaker a stage changed takes that speaker's label on the tape
    numbered = with_running_sum(parts, "file_id", ["start_us", "seg_id", "part"], F.lit(1), "pos").join(label_of(spark, d), ["file_id", "tape_no", "speaker"], "left")
    raw = F.when(F.col("n_parts") > 1, F.coalesce("label_of_speaker", "raw_speaker_id")).otherwise(F.col("raw_speaker_id"))
    parts = stage(numbered.withColumn("raw_speaker_id", raw).drop("seg_id", "part", "n_parts", "label_of_speaker").withColumnRenamed("pos", "seg_id").join(expert, "file_id", "left"), "parts", parts)
    out = stage(stamped(introduced(parts).drop("surname", "tape_no")), "stamped", parts)
    return with_running_sum(out, "file_id", ORDER, F.lit(1), "pos").select("file_id", "pos", "start_us", "end_us", "speaker", "raw_speaker_id", "text")


@query("lc0_pipeline")
def lc0(spark: SparkSession, d: str) -> DataFrame:
    """The whole pipeline with the line that is exported for each replica."""
    return replicas(spark, d).withColumn("line", F.concat(hms(F.col("start_us")), F.lit(" "), "speaker", F.lit(": "), "text"))
