"""Canonical views that the queries start from, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.deliveries import latest

ORDER = ["start_us", "seg_id"]
COLUMNS = ["file_id", "tape_no", "start_us", "end_us", "speaker", "raw_speaker_id", "text", "confidence", "from_gap"]


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def segments(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Valid segments with both bounds (which may be inverted), labels blank-free, from_gap never null."""
    want = [c for c in COLUMNS if not columns or c in columns or c in ("file_id", "start_us", "end_us")]
    rows = latest(read(spark, d, "segments_merged").select("seg_id", "loaded_at", *want), "seg_id", "loaded_at", want)
    rows = rows.filter("file_id is not null and start_us is not null and end_us is not null")
    if "from_gap" in want:
        rows = rows.withColumn("from_gap", F.coalesce("from_gap", F.lit(False)))
    for c in ("speaker", "raw_speaker_id"):
        if c in want:
            rows = rows.withColumn(c, F.coalesce(c, F.lit("")))
    return rows


SEG = """seg AS (SELECT seg_id, file_id, tape_no, start_us, end_us, coalesce(speaker, '') AS speaker, coalesce(raw_speaker_id, '') AS raw_speaker_id, text, confidence, coalesce(from_gap, false) AS from_gap
 FROM (SELECT *, row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM segments_merged WHERE seg_id IS NOT NULL) WHERE rn = 1 AND file_id IS NOT NULL AND start_us IS NOT NULL AND end_us IS NOT NULL)"""
W_FILE = "(PARTITION BY file_id ORDER BY start_us, seg_id)"


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Diarization turns: the stretches of segments with a raw label, (file_id, turn_id, start_us, end_us, label)."""
    return segments(spark, d, "raw_speaker_id").filter("raw_speaker_id like 'SPEAKER%' and end_us > start_us").select("file_id", F.col("seg_id").alias("turn_id"), "start_us", "end_us", F.col("raw_speaker_id").alias("label"))


TURNS = "turns AS (SELECT file_id, seg_id AS turn_id, start_us, end_us, raw_speaker_id AS label FROM seg WHERE raw_speaker_id LIKE 'SPEAKER%' AND end_us > start_us)"


def terms(spark: SparkSession, d: str) -> DataFrame:
    """Term lists of documents: (category, source, doc_id, pos, term), blank lines left out."""
    docs = read(spark, d, "documents").filter("doc_kind = 'term_list' and text is not null")
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("category"), "source", "doc_id", F.posexplode(F.split("text", r"\n|; ")).alias("pos", "term"))
    return rows.withColumn("term", F.regexp_replace(F.trim("term"), r":\d+$", "")).filter("term <> ''").withColumn("pos", F.col("pos").cast("long"))


TERMS = r"""terms AS (SELECT * FROM (SELECT coalesce(lang, '') AS category, source, doc_id, CAST(i - 1 AS BIGINT) AS pos, regexp_replace(trim(p[i]), ':\d+$', '') AS term
 FROM (SELECT *, regexp_split_to_array(text, '\n|; ') AS p FROM documents WHERE doc_kind = 'term_list' AND text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i)) WHERE term <> '')"""


def pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("html is not null")


__all__ = ["COLUMNS", "ORDER", "SEG", "TERMS", "TURNS", "W_FILE", "hms", "pages", "read", "segments", "terms", "tokens", "turns"]
