"""Term lists as text files, one term a line, in folders by category."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import shared_folder


def write_terms(df: DataFrame, path: str | None = None) -> str:
    """(category, term) -> category=<c>/part-*.txt."""
    path = path or f"{shared_folder(df.sparkSession)}/tapeloom/terms-{uuid.uuid4().hex}"
    df.select(F.when(F.col("category") == "", "none").otherwise(F.col("category")).alias("category"), F.col("term").alias("value")).write.mode("overwrite").partitionBy("category").text(path)
    return path


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """category, term: all files below path; ends stripped, blank lines left out."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path)
    rows = rows.select(F.regexp_extract(F.input_file_name(), "category=([^/]*)", 1).alias("category"), F.rtrim("value").alias("term"))
    return rows.filter("term <> ''")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """term, weight from lines ``term:weight``; a line without a weight has none."""
    rows = spark.read.text(path).select(F.trim("value").alias("v")).filter("v <> ''")
    return rows.select(F.regexp_replace("v", r":\d+$", "").alias("term"), F.expr(r"try_cast(nullif(regexp_extract(v, ':(\\d+)$', 1), '') as int)").alias("weight"))
