"""Streams give the groups that a batch gives once they are complete."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from timeloom.streaming import sessions as streams

T0 = datetime(2026, 1, 1)


def rows(spark):
    data = [("u1", "a", 0), ("u1", "a", 30), ("u1", "b", 40), ("u1", "b", 200), ("u2", "a", 10), ("u2", "a", 60), ("zz", "end", 90_000)]
    return spark.createDataFrame([(u, a, T0 + timedelta(seconds=s)) for u, a, s in data], "user string, app string, ts timestamp")


def drained(stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    q.processAllAvailable()
    q.stop()


def streamed(spark, path):
    rows(spark).coalesce(1).write.parquet(path)
    return spark.readStream.schema("user string, app string, ts timestamp").parquet(path)


def test_sessions_by_gap(spark, tmp_path):
    drained(streams.sessions(streamed(spark, str(tmp_path / "s")), "ts", ["user"], 60), "gap_sessions")
    got = sorted((r["user"], r["n"]) for r in spark.table("gap_sessions").collect())
    assert got == [("u1", 1), ("u1", 3), ("u2", 2)]


def test_runs_of_one_application(spark, tmp_path):
    drained(streams.runs(streamed(spark, str(tmp_path / "s")), "ts", "user", "app", 60), "app_runs")
    got = sorted((r["user_id"], r["app"], r["n"]) for r in spark.table("app_runs").where("user_id <> 'zz'").collect())
    assert got == [("u1", "a", 2), ("u1", "b", 1), ("u1", "b", 1), ("u2", "a", 2)]


def test_rebuilding_days_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "days")
    data = rows(spark).select(F.col("user").alias("user_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "app")
    run = streams.rebuild_days(lambda touched: data.join(touched, ["user_id", "day"], "left_semi"), lambda df: df.groupBy("user_id", "day").count(), path)
    run(data.where("user_id = 'u1'"), 0)
    run(data, 1)
    run(data.where("user_id = 'u1'"), 1)
    assert sorted((r["user_id"], r["count"]) for r in spark.read.parquet(path).collect()) == [("u1", 4), ("u2", 2), ("zz", 1)]
