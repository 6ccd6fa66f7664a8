"""Problem 1: the continuous periods of each person and the silences of each recording."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.deliveries import latest
from tapeloom.operators.intervals import CHUNK_US, gaps, periods, usable
from tapeloom.operators.names import resolve_names
from tapeloom.session import cut

GAP_LONGER_THAN_US, GAP_AT_MOST_US = 3_000_000, 600_000_000


def valid_segments(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    rows = spark.read.parquet(f"{d}/segments_merged.parquet").select("seg_id", "loaded_at", *columns)
    return latest(rows, "seg_id", "loaded_at", columns)


def named_segments(spark: SparkSession, d: str, segments: DataFrame, surname: str | None = None) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    return resolve_names(segments, read("audio_files"), read("speaker_roles"), read("role_aliases"), surname=surname)


def timed_and_named(spark: SparkSession, d: str) -> DataFrame:
    """seg_id, file_id, start_us, end_us, name of the valid segments that have a usable time."""
    rows = valid_segments(spark, d, ["file_id", "tape_no", "start_us", "end_us", "speaker", "raw_speaker_id"])
    rows = usable(rows).filter("file_id is not null")
    return named_segments(spark, d, rows).select("seg_id", "file_id", "start_us", "end_us", "name")


def speech_periods(segments: DataFrame, chunk_us: int = CHUNK_US) -> DataFrame:
    """kind, file_id, speaker, start_us, end_us, n_segs from (file_id, name, start_us, end_us).

    ``period`` rows: every continuous stretch of one person, one segment long or more.
    ``gap`` rows (speaker ``*``, n_segs 0): nobody's segment, for more than 3 s and at most 600 s.
    """
    own = periods(segments.select("file_id", F.col("name").alias("speaker"), "start_us", "end_us"), ["file_id", "speaker"], chunk_us=chunk_us)
    own = cut(own, "periods")  # the gaps are those between all periods, so they are read twice
    silent = gaps(own, ["file_id"], longer_than_us=GAP_LONGER_THAN_US, at_most_us=GAP_AT_MOST_US, chunk_us=chunk_us)
    return own.select(F.lit("period").alias("kind"), "file_id", "speaker", "start_us", "end_us", F.col("n").alias("n_segs")).unionByName(
        silent.select(F.lit("gap").alias("kind"), "file_id", F.lit("*").alias("speaker"), "start_us", "end_us", F.lit(0).cast("long").alias("n_segs"))
    )


def p1_periods(spark: SparkSession, d: str) -> DataFrame:
    return speech_periods(timed_and_named(spark, d))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Periods of two or more segments and the silences, as TESTDATA.md defines them."""
    return p1_periods(spark, d).filter("kind = 'gap' or n_segs >= 2").drop("n_segs")


def p1_label_periods(spark: SparkSession, d: str) -> DataFrame:
    """Periods and silences by the labels as they are written, names not resolved: the same operator in a form that SQL can follow."""
    rows = usable(valid_segments(spark, d, ["file_id", "start_us", "end_us", "speaker"])).filter("file_id is not null")
    return speech_periods(rows.select("file_id", F.coalesce("speaker", F.lit("")).alias("name"), "start_us", "end_us"))


_VALID = "va AS (SELECT seg_id, file_id, start_us, end_us, coalesce(speaker, '') AS speaker FROM (SELECT *, row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM segments_merged WHERE seg_id IS NOT NULL) WHERE rn = 1 AND file_id IS NOT NULL AND start_us IS NOT NULL AND end_us >= start_us)"
_REACH = "max(end_us) OVER (PARTITION BY {0} ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
SQL = {
    "p1_label_periods": f"WITH {_VALID}, ow AS (SELECT *, CASE WHEN start_us > {_REACH.format('file_id, speaker')} THEN 1 ELSE 0 END AS b FROM va), oi AS (SELECT *, sum(b) OVER (PARTITION BY file_id, speaker ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS g FROM ow), "
    f"gp AS (SELECT file_id, {_REACH.format('file_id')} AS s, start_us AS e FROM va) "
    "SELECT 'period' AS kind, file_id, speaker, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS n_segs FROM oi GROUP BY file_id, speaker, g "
    f"UNION ALL SELECT 'gap', file_id, '*', s, e, 0 FROM gp WHERE e - s > {GAP_LONGER_THAN_US} AND e - s <= {GAP_AT_MOST_US}"
}
