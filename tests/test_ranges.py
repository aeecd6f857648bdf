"""Scans by ranges of time against windows by key, and one user who fills many tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.operators import ranges, windows

T0 = datetime(2026, 1, 1)


@pytest.mark.parametrize("seconds", [1.0, 50.0, 86_400.0])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_equal_to_windows(spark, seconds, kind):
    rng = random.Random(int(seconds))
    rows = [
        (rng.choice(["u", "v", None]), rng.choice([1, 2, None]), None if rng.random() < 0.05 else T0 + timedelta(seconds=rng.choice([0, 1, 49, 50, 500, 100_000]) + rng.randint(-300, 300)), i, rng.choice(["x", "y", None]), rng.choice([0, 1, 5, None]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "user string, device int, at timestamp, id int, name string, n int").withColumn("at", F.col("at").cast(kind))
    keys, order = ["user", "device"], ["at", "id"]
    scan = ranges.Scan(df, keys, order, seconds)
    asked = [scan.before("name"), scan.after("name"), scan.before(F.upper("name")), scan.sum_to("n"), scan.most_before("n"), scan.before("at")]
    got = scan.rows().select("id", *[c.alias(f"c{i}") for i, c in enumerate(asked)])
    w = Window.partitionBy(*keys).orderBy(*order)
    all_to, all_before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = [F.lag("name").over(w), F.lead("name").over(w), F.lag(F.upper("name")).over(w), F.coalesce(F.sum("n").over(all_to), F.lit(0)), F.max("n").over(all_before), F.lag("at").over(w)]
    want = df.select("id", *[c.alias(f"c{i}") for i, c in enumerate(want)])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_empty_and_no_questions(spark):
    df = spark.createDataFrame([], "user string, at timestamp, id int")
    scan = ranges.Scan(df, ["user"], ["at", "id"])
    scan.before("id")
    assert scan.rows().count() == 0


def test_one_user_fills_many_tasks(spark):
    """The scenes of one user of very many events: no partition of any exchange of rows holds most of them."""
    n = 120_000
    at = F.timestamp_seconds(1_760_000_000 + F.col("id") * 60)
    df = spark.range(n).select(F.lit("u").alias("user_id"), "id", at.alias("s"), F.timestamp_add("SECOND", F.lit(50), at).alias("e"), F.concat(F.lit("x"), F.floor(F.col("id") / 30).cast("string")).alias("app"), F.lit(None).cast("string").alias("cat"))
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scan = ranges.Scan(df, ["user_id"], ["s", "id"])
        scan.before("app")
        share = lambda rows: max(r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()) / n
        assert share(scan.rows()) < 0.4
        scenes = windows.capped_scenes(df, ["user_id"], ["s", "id"], "s", "e", "app", "cat", gap=75.0, longest=170.0)
        assert share(scenes) < 0.4
        assert scenes.agg(F.max("scene_no"), F.count("*")).first() == (n // 3, n)
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
