"""The driver's tables in the shapes that the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.times import add_micros

# Classes of the driver's event types.
KIND = {"click": "work", "view": "interruptible", "purchase": "interruptible", "error": "capture", "signup": "other"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Microseconds since 1970, for comparison across engines."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of as many seconds as their value, on one of three devices, with a class and a small number for a picture hash."""
    return as_intervals(table(spark, sf_dir, "events"))


def as_intervals(rows: DataFrame) -> DataFrame:
    """The same of a table or stream of events."""
    length = F.floor(F.col("value") * 1_000_000).cast("long")
    kind = F.lit("other")
    for event_type, name in KIND.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    return rows.select(
        F.col("event_id").alias("id"), "user_id", (F.col("event_id") % 3).alias("device_id"), "event_type", F.col("ts").alias("start_at"), add_micros(F.col("ts"), length).alias("end_at"), length.alias("dur"), kind.alias("kind"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


EV = """ev AS (
  SELECT event_id AS id, user_id, event_id % 3 AS device_id, event_type, ts AS start_at, ts + to_microseconds(CAST(floor(value * 1000000) AS BIGINT)) AS end_at,
         CAST(floor(value * 1000000) AS BIGINT) AS dur, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'click' THEN 'work' WHEN 'error' THEN 'capture' WHEN 'signup' THEN 'other' ELSE 'interruptible' END AS kind
  FROM events)"""
