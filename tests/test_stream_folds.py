"""Streams with state give the rows of the batch, out of order within the lateness and after a restart in the middle."""

import random

import pytest
from pyspark.sql import functions as F

from timeloom.operators import episodes, windows
from timeloom.plans.driver_tables import events
from timeloom.streaming import folds

SF = "/root/testdata/sf0.001"
ORDER = ["start_at", "end_at", "id"]
HALF_DAY = 43_200.0


@pytest.fixture(scope="module")
def rows(spark):
    """The events of a few users, and one long after all others that closes the rest."""
    e = events(spark, SF).where("user_id < 25").withColumn("start_at", F.col("start_at").cast("timestamp")).withColumn("end_at", F.col("end_at").cast("timestamp"))
    last = spark.range(1).select(F.lit(10**9).alias("id"), F.lit(-1).cast(e.schema["user_id"].dataType).alias("user_id"), *[F.lit(None).cast(e.schema[c].dataType).alias(c) for c in ("device_id", "event_type")], F.lit("2030-01-01").cast("timestamp").alias("start_at"),
        F.lit("2030-01-01").cast("timestamp").alias("end_at"), *[F.lit(None).cast(e.schema[c].dataType).alias(c) for c in ("dur", "kind", "k")])
    e = e.withColumn("id", F.col("id").cast("long")).withColumn("sha", F.lit("")).withColumn("title", F.lit(""))
    return e.unionByName(last.withColumn("sha", F.lit("")).withColumn("title", F.lit("")))


def streamed(spark, rows, path, make, batches=4):
    """Files by time, rows swapped between neighbouring ones; the query is stopped after half of them and goes on."""
    data = sorted(rows.collect(), key=lambda r: (r["start_at"], r["id"]))
    rng = random.Random(5)
    size = -(-len(data) // batches)
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    for a, b in zip(parts, parts[1:-1]):
        late = rng.sample(range(len(a) // 2, len(a)), 3)
        b += [a[i] for i in late]
        for i in sorted(late, reverse=True):
            del a[i]
    folder, out, state = (f"{path}/{n}" for n in ("in", "out", "state"))
    for i, part in enumerate(parts):
        spark.createDataFrame(part, rows.schema).coalesce(1).write.mode("append").parquet(folder)
        if i in (len(parts) // 2 - 1, len(parts) - 1):
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
            with folds.configured(spark):
                make(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out).where("user_id <> '-1'")
    return sorted((int(r["user_id"]), int(r["id"]), r["number"], r["kind"], r["role"]) for r in found.collect())


LATE = "20 days"


def test_scenes(spark, rows, tmp_path):
    got = streamed(spark, rows, str(tmp_path), lambda s: folds.scenes(s, ["user_id"], "id", "start_at", "end_at", "event_type", "kind", HALF_DAY, 86_400.0, LATE))
    want = windows.capped_scenes(rows.where("user_id >= 0"), ["user_id"], ORDER, "start_at", "end_at", "event_type", "kind", HALF_DAY, 86_400.0)
    assert [g[:3] for g in got] == sorted((r["user_id"], r["id"], r["scene_no"]) for r in want.collect())


def test_captures(spark, rows, tmp_path):
    walk = folds.Captures(HALF_DAY, 2, HALF_DAY, 1)
    got = streamed(spark, rows, str(tmp_path), lambda s: folds.captures(s, ["user_id"], "id", "start_at", "event_type", "title", "sha", "k", walk, LATE))
    some = rows.where("user_id >= 0")
    signal = windows.change_signal(some, ["user_id"], ["start_at", "id"], "start_at", "sha", "k", HALF_DAY, 1)
    want = windows.anchored_segments(signal, ["user_id"], ["start_at", "id"], "start_at", "event_type", "title", "sha", "k", gap=HALF_DAY, bits=2)
    assert [g[:3] for g in got] == sorted((r["user_id"], r["id"], r["segment_no"]) for r in want.collect())


def test_episodes(spark, rows, tmp_path):
    got = streamed(spark, rows, str(tmp_path), lambda s: folds.episodes(s, ["user_id"], "id", "start_at", "end_at", "kind", HALF_DAY, 120.0, LATE))
    want = episodes.label(rows.where("user_id >= 0"), ["user_id"], ORDER, "start_at", "end_at", "kind", HALF_DAY, 120.0)
    want = sorted((r["user_id"], r["id"], r["group_no"], r["episode_type"], r["role"]) for r in want.collect())
    assert got == want and any(g[4] == "interruption" for g in got)
