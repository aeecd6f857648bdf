"""The two-phase folds against plain walks over random rows, and how a key of many rows is dealt."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeloom.functions import text
from timeloom.operators import windows

T0 = datetime(2026, 1, 1)


def walked(rows, gap=45.0, bits=10):
    """Segment numbers by the rule: tied to the row before, or like the anchor; an unlike row that is tied, but not by its picture, is the new anchor."""
    out, anchor, last, number = [], None, None, 0
    for at, app, title, sha, dhash, near in rows:
        name = (app or "").strip().lower()
        alike = anchor is not None and ((sha and sha == anchor[0]) or (dhash is not None and anchor[1] is not None and bin((dhash ^ anchor[1]) & (2**64 - 1)).count("1") <= bits))
        tied = last is not None and (near or (name == last[1] and name not in ("", "unknown")) or (title and title == last[2]))
        if last is None or at - last[0] > gap or not (alike or tied):
            number, anchor = number + 1, (sha, dhash)
        elif not alike and not near:
            anchor = (sha, dhash)
        last = (at, name, title)
        out.append(number)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_anchored_segments_equal_the_walk(spark, seed):
    rng, rows = random.Random(seed), []
    for user in range(30):
        clock = 0
        for i in range(rng.randint(1, 40)):
            clock += rng.choice([0, 5, 44, 45, 46])
            picture = rng.choice([None, 0, -1, 0b111, (1 << 12) - 1, -(1 << 63)])
            rows.append((user, i, clock, rng.choice(["x", " X", "y", "unknown", None]), rng.choice(["t", "u", "", None]), rng.choice(["s", "r", "", None]), picture, rng.random() < 0.15))
    want = []
    for user in range(30):
        mine = [r for r in rows if r[0] == user]
        want += [(user, r[1], n) for r, n in zip(mine, walked([r[2:] for r in mine]))]
    df = spark.createDataFrame([(*r[:2], T0 + timedelta(seconds=r[2]), *r[3:]) for r in rows], "user_id int, id int, at timestamp, app string, title string, sha string, dhash bigint, near_duplicate boolean")
    for kind in ("timestamp", "timestamp_ntz"):
        got = windows.anchored_segments(df.withColumn("at", F.col("at").cast(kind)), ["user_id"], ["at", "id"], "at", "app", "title", "sha", "dhash")
        assert got.columns == [*df.columns, "segment_no"]
        assert sorted(tuple(r) for r in got.select("user_id", "id", "segment_no").collect()) == sorted(want)


def test_one_key_fills_many_tasks(spark):
    """The rows of one user go to the fold in islands, not in one partition."""
    rows = spark.range(20_000).select(F.lit(1).alias("user_id"), "id", F.timestamp_seconds(F.col("id") * 100).alias("s"), F.timestamp_seconds(F.col("id") * 100 + 50).alias("e"), F.lit("x").alias("app"), F.lit("c").alias("cat"))
    out = windows.capped_scenes(rows, ["user_id"], ["s", "id"], "s", "e", "app", "cat", gap=49.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[[^\]]*_island#\d+L?\]", plan)
    assert out.agg(F.max("scene_no")).first()[0] == 20_000


def test_text_of_json_of_any_depth():
    def plain(x):
        if x is None:
            return ""
        if isinstance(x, list):
            return "; ".join(t for t in map(plain, x) if t)
        if isinstance(x, dict):
            return "; ".join(f"{k}: {t}" for k, t in ((k, plain(v)) for k, v in x.items()) if t)
        return " ".join(str(x).split())

    rng = random.Random(4)

    def made(depth):
        kind = rng.choice("sldn" if depth else "sn")
        if kind == "l":
            return [made(depth - 1) for _ in range(rng.randint(0, 3))]
        if kind == "d":
            return {rng.choice("abc") + str(i): made(depth - 1) for i in range(rng.randint(0, 3))}
        return rng.choice([None, "", "  a  b ", 1, 2.5, True, "z"])

    for _ in range(500):
        x = made(5)
        assert text.spoken(x) == (plain(x) or None)
    deep = "x"
    for _ in range(5000):
        deep = [deep]
    assert text.spoken(deep) == "x"
