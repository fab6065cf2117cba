"""Queries of the streaming operators, in their batch form over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.streaming import ingest


def event_windows(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    w = ingest.event_windows(e)
    return w.select(F.unix_seconds("start").alias("start_s"), "event_type", "events", F.round("value", 2).alias("value"))


def event_sessions(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.sessions(e).select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "events")


def latest_stages(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.fold_stages(e, "user_id", "event_type").select("user_id", "event_type", F.unix_micros("ts").alias("at_us"))


def queries() -> dict:
    return {f.__name__: f for f in (event_windows, event_sessions, latest_stages)}


def oracle_sql() -> dict[str, str]:
    return {
        "event_windows": "SELECT epoch(date_trunc('hour', ts))::BIGINT AS start_s, event_type, count(*) AS events, round(sum(value), 2) AS value FROM events GROUP BY 1, 2",
        "event_sessions": "WITH f AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 1800000000 THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, t, sum(n) OVER (PARTITION BY user_id ORDER BY t) AS s FROM f) SELECT user_id, min(t) AS start_us, max(t) + 1800000000 AS end_us, count(*) AS events FROM s GROUP BY user_id, s",
        "latest_stages": "SELECT user_id, arg_max(event_type, ts) AS event_type, epoch_us(max(ts)) AS at_us FROM events GROUP BY 1",
    }
