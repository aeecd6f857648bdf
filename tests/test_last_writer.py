"""Of rows that repeat a key in one batch the last one's values hold, whatever the partitions."""

import random

import pytest
from pyspark.sql import functions as F

from timeloom.operators import upsert


def by_hand(old, batch, fixed):
    """Rows applied one after another; a row is (key, a fixed value, a value)."""
    held = {r[0]: list(r) for r in old}
    for key, first, last in batch:
        if key in held:
            held[key][2] = last
            if not fixed:
                held[key][1] = first
        else:
            held[key] = [key, first, last]
    return sorted(map(tuple, held.values()), key=str)


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(2)
    return [(rng.choice([*map(str, range(20)), None]), f"f{i}", f"v{i}") for i in range(300)]


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("fixed", [[], ["first"]])
def test_rows_in_their_order(spark, batch, parts, fixed):
    schema = "id string, first string, last string"
    old = [(str(i), f"o{i}", f"o{i}") for i in range(0, 30, 2)]
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(batch)], schema + ", line int").repartition(parts)
    one = upsert.last_writer(rows, ["id"], ["line"], fixed)
    assert one.columns == ["id", "first", "last"]
    updated = ["last"] if fixed else ["first", "last"]
    got = upsert.merge(spark.createDataFrame(old, schema), one, ["id"], updated)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(old, batch, fixed)


def test_events_by_time_then_by_digest(spark):
    """Without an order the times of writing decide; what is equal there is decided alike for any partitions."""
    rows = [(f"e{i % 20}", "u", f"p{i}", f"2026-01-01 00:00:{(i * 7) % 60:02d}") for i in range(200)]
    batch = spark.createDataFrame(rows, "id string, user_id string, payload_json string, at string").withColumn("created_at", F.col("at").cast("timestamp"))
    none = spark.createDataFrame([], "id string")
    results = [sorted(map(tuple, upsert.upsert(none, batch.repartition(n), "event").select("id", "payload_json", F.col("created_at").cast("string")).collect())) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]
    latest = {key: max(r[3] for r in rows if r[0] == key) for key in {r[0] for r in rows}}
    assert {r[0]: r[2] for r in results[0]} == latest


def test_columns_of_the_table_may_give_the_order(spark):
    """An order by a column that is kept itself."""
    batch = spark.createDataFrame([("x", "a", 3, "primary"), ("x", "a", 9, "context"), ("x", "b", 1, "context")], "episode_id string, event_id string, ordinal int, role string")
    got = upsert.upsert(spark.createDataFrame([], "episode_id string"), batch, "episode_event", ["ordinal"])
    assert sorted(map(tuple, got.collect())) == [("x", "a", 9, "context"), ("x", "b", 1, "context")]
    tied = upsert.upsert(spark.createDataFrame([], "episode_id string"), batch, "episode_event")
    assert sorted(map(tuple, tied.collect())) == [("x", "a", 3, "primary"), ("x", "b", 1, "context")]


def test_keys_alone_and_unknown_rows(spark):
    keys = spark.createDataFrame([("c", "t", "v"), ("c", "t", "v")], "chunk_id string, tag_type string, tag_value string")
    assert upsert.upsert(keys.limit(0), keys, "chunk_tag").count() == 1
    all_rows, new = upsert.insert_missing(spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "k int, v string"), ["k"])
    assert all_rows.count() == 2 and new.count() == 1 and new.first()["k"] == 2
