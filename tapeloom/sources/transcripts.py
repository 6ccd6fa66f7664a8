"""Transcript documents as JSON lines: a sink, and a source with a fixed schema that skips what it cannot read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tapeloom.session import shared_folder

SCHEMA = "file_id string, tape_no int, n_segments bigint, segments array<struct<start_us bigint, seg_id bigint, end_us bigint, speaker string, text string>>"


def write_transcripts(df: DataFrame, path: str | None = None) -> str:
    path = path or f"{shared_folder(df.sparkSession)}/tapeloom/transcripts-{uuid.uuid4().hex}"
    df.write.mode("overwrite").json(path)
    return path


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path, mode="DROPMALFORMED")
