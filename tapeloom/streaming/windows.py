"""The same shapes on streams: sessions by pause and sliding windows, with watermarks for late rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import shared_folder

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events of a folder as a stream; times are read as UTC."""
    rows = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(d)
    return rows.filter("ts is not null").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 hour")


def sessions(events: DataFrame, pause: str = "30 minutes") -> DataFrame:
    """A session of a user ends with a pause of that length."""
    r = events.groupBy("user_id", F.session_window("at", pause).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return r.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


def sliding(events: DataFrame, length: str = "12 minutes", step: str = "9 minutes") -> DataFrame:
    r = events.groupBy("event_type", F.window("at", length, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return r.select("event_type", F.unix_micros("w.start").alias("start_us"), "n")


def settled(stream: DataFrame, label: str) -> DataFrame:
    """Runs a stream over all that is there and returns its last complete result."""
    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/tapeloom/{label}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(base + "/result")

    stream.writeStream.outputMode("complete").option("checkpointLocation", base + "/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(base + "/result")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    return settled(sessions(event_stream(spark, d)), "sessions")


def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    return settled(sliding(event_stream(spark, d)), "sliding")


QUERIES = {"stream_sessions": stream_sessions, "stream_sliding_windows": stream_sliding}
SQL = {
    "stream_sessions": "SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events WHERE ts IS NOT NULL)) GROUP BY user_id, g",
    "stream_sliding_windows": "SELECT event_type, s AS start_us, count(*) AS n FROM (SELECT event_type, epoch_us(ts) AS t, (epoch_us(ts) // 540000000 - k) * 540000000 AS s FROM events, (SELECT unnest([0, 1]) AS k) WHERE ts IS NOT NULL) WHERE s > t - 720000000 GROUP BY 1, 2",
}
