"""Other files: audio folders, address tables, logs, and the sinks of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

URL_SCHEMA = "category_id string, category_name string, url string, status_code string, content_type string, parseable string, priority string, notes string"


def audio_folder(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the WAV files below a folder, without reading their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(path).select("path", "length").orderBy("path")


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """The audit table: all columns trimmed, missing ones empty, parseable in lower and priority in upper case."""
    rows = spark.read.schema(URL_SCHEMA).csv(path, header=True, enforceSchema=True)
    rows = rows.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in rows.columns])
    return rows.withColumns({"parseable": F.lower("parseable"), "priority": F.upper("priority")})


def write_urls(df: DataFrame, path: str) -> None:
    df.select(*[c.split()[0] for c in URL_SCHEMA.split(", ")]).write.mode("overwrite").csv(path, header=True)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Whole log files as one row each: path, text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def write_txt(lines: DataFrame, path: str) -> None:
    """(file_id, start_us, seg_id, line) as texts below a folder for each recording: heading, ruler, lines in order.

    Lines are sorted by range, not gathered: the parts of a recording, in the order of their names, are its text."""
    head = lines.select("file_id").distinct().select("file_id", F.explode(F.array(F.struct(F.lit(0).alias("_k"), F.col("file_id").alias("line")), F.struct(F.lit(1).alias("_k"), F.lit("=" * 60).alias("line")))).alias("h"))
    head = head.select("file_id", "h._k", F.lit(None).cast("long").alias("start_us"), F.lit(None).cast("long").alias("seg_id"), "h.line")
    by = ["file_id", "_k", "start_us", "seg_id"]
    rows = head.unionByName(lines.select("file_id", F.lit(2).alias("_k"), "start_us", "seg_id", "line"))
    rows.repartitionByRange(*by).sortWithinPartitions(*by).select("file_id", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file_id").text(path)


def read_txt(spark: SparkSession, path: str) -> DataFrame:
    """The lines of such texts with their recording and part."""
    return spark.read.text(path).select("file_id", F.col("value").alias("line"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("part"))


ASR_SCHEMA = "file_id string, segments array<struct<start double, end double, text string, avg_logprob double, words array<struct<word string, start double, end double, probability double>>>>"


def read_asr(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: recognised segments of JSON documents, one row each, times in whole microseconds, words with their probabilities; what cannot be read is left out."""
    rows = spark.read.schema(ASR_SCHEMA).json(path, mode="DROPMALFORMED").filter("file_id is not null").select("file_id", F.posexplode("segments").alias("pos", "s"))
    us = lambda c: F.round(F.col(c) * 1_000_000).cast("long")
    return rows.select("file_id", "pos", us("s.start").alias("start_us"), us("s.end").alias("end_us"), F.col("s.text").alias("text"), F.col("s.avg_logprob").alias("confidence"), F.col("s.words").alias("words"))


def write_log(lines: DataFrame, path: str) -> None:
    """SNK11 on (phase, at, line): the main log, and one for each phase beside it, lines in order; each is sorted by range, not gathered."""
    main = lines.select(F.lit("main").alias("log"), "at", "line")
    both = main.unionByName(lines.filter("phase is not null").select(F.concat(F.lit("phase-"), "phase").alias("log"), "at", "line"))
    both.repartitionByRange("log", "at").sortWithinPartitions("log", "at").select("log", F.col("line").alias("value")).write.mode("overwrite").partitionBy("log").text(path)


def publish(results: dict[str, DataFrame], path: str) -> None:
    """SNK10: tables of results as JSON below one folder, each replacing what was published before under its name."""
    for name, df in results.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
