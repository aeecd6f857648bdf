"""A day's overview and its segments read the captures few times, and one scan makes signals and segments."""

import __spark_entry__
from timeloom.operators import segments
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_overview_reads_its_segments_once(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("ts").alias("start_at"), F.col("ts").alias("end_at"), F.col("event_type").alias("coarse_category"), F.lit("a").alias("primary_app_name"),
        F.lit(1).alias("capture_count"), F.lit(0).alias("idle_capture_count"), F.lit(0).alias("near_duplicate_capture_count"), F.lit(True).alias("should_queue_interpretation"), "event_id")
    assert reads(segments.day_overview(rows, ["user_id", "day"], F.col("event_id"))) == 1


def test_query_reads_stored_segments(spark):
    assert reads(__spark_entry__.queries()["overview_events"](spark, SF)) <= 2


def test_overview_counts(spark):
    row = lambda day, no, category, app, n, queued=True: ("u", day, no, f"2026-01-01 00:00:0{no}", category, app, n, 1, 0, queued)
    rows = [row("d1", 1, "x", "p", 2), row("d1", 2, "y", "p", 3, False), row("d1", 3, "x", "q", 1), row("d2", 4, "", "r", 5), row(None, 5, "x", "p", 7)]
    df = spark.createDataFrame(rows, "u string, day string, no int, at string, coarse_category string, primary_app_name string, capture_count long, idle_capture_count long, near_duplicate_capture_count long, should_queue_interpretation boolean")
    df = df.withColumn("start_at", F.col("at").cast("timestamp")).withColumn("end_at", F.col("start_at"))
    got = {r["day"]: r.asDict() for r in segments.day_overview(df, ["u", "day"], F.col("no")).collect()}
    assert set(got) == {"d1", "d2"}
    one, two = got["d1"], got["d2"]
    assert (one["capture_count"], one["segment_count"], one["idle_capture_count"], one["suppressed_segment_count"], one["suppressed_capture_count"]) == (6, 3, 3, 1, 3)
    assert one["category_counts"] == {"x": 3, "y": 3} and one["app_counts"] == {"p": 5, "q": 1} and one["dominant_category"] == "x" and one["dominant_app"] == "p"
    assert two["dominant_category"] == "unknown" and two["dominant_app"] == "r" and str(one["start_at"]) == "2026-01-01 00:00:01" and str(one["end_at"]) == "2026-01-01 00:00:03"
