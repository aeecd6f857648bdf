"""Reading a recorder's database in slices, with ranges that reach it."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from timeloom.functions.times import parse_instant
from timeloom.sources import screen

T0 = datetime(2026, 1, 10, tzinfo=timezone.utc)
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def stamp(rng, at):
    """The same instant as texts of several kinds."""
    offset = rng.choice([0, 14, -12, 5.5, -7])
    local = (at + timedelta(hours=offset)).replace(tzinfo=None).isoformat(timespec="microseconds" if rng.random() < 0.5 else "seconds")
    zone = "Z" if offset == 0 else f"{'+' if offset > 0 else '-'}{int(abs(offset)):02d}:{30 if offset % 1 else 0:02d}"
    return rng.choice(["", "", " "]) + local + zone


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    frames = [(i, rng.choice([stamp(rng, T0 + timedelta(minutes=rng.randint(-20_000, 20_000))), None, "soon"] if i % 40 == 0 else [stamp(rng, T0 + timedelta(minutes=rng.randint(-20_000, 20_000)))]), rng.choice(["k", "m"])) for i in range(600)]
    frame = spark.createDataFrame(frames, "id int, timestamp string, machine_id string").select("*", F.lit(" a  b ").alias("full_text"), F.lit(None).cast("string").alias("accessibility_text"), F.lit("https://X.org/").alias("browser_url"))
    ocr = spark.createDataFrame([(rng.randint(0, 700), f"text {'x' * rng.randint(0, 9)}", None, "e") for _ in range(900)], "frame_id int, text string, text_json string, ocr_engine string")
    # Spark writes a null text as a kind of value that the test's database refuses.
    return frame.fillna(""), ocr.fillna("")


@pytest.fixture(scope="module")
def database(spark, tables, tmp_path_factory):
    url = f"jdbc:derby:{tmp_path_factory.mktemp('derby')}/recorder;create=true"
    for name, df in zip(("frames", "ocr_text"), tables):
        types = ", ".join(f"{f.name} VARCHAR(200)" for f in df.schema if f.dataType.simpleString() == "string")
        df.coalesce(1).write.jdbc(url, name, properties={"driver": DRIVER, "createTableColumnTypes": types})
    return url


def test_the_range_of_texts_loses_nothing(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, stamp(rng, T0 + timedelta(minutes=rng.randint(-9000, 9000)))) for i in range(3000)], "id int, timestamp string")
    for start, end in (("2026-01-10", "2026-01-11"), (datetime(2026, 1, 9, 23, 59), datetime(2026, 1, 12, 0, 1)), (None, "2026-01-08 12:00:00"), ("2026-01-13", None)):
        at = parse_instant(F.col("timestamp"))
        inside = F.lit(True)
        if start is not None:
            inside &= at >= F.lit(start).cast("timestamp")
        if end is not None:
            inside &= at < F.lit(end).cast("timestamp")
        passed = rows
        for test in screen.text_range("timestamp", start, end):
            passed = passed.where(test)
        assert rows.where(inside).exceptAll(passed).count() == 0
        assert passed.count() < rows.count()


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_slices_hold_every_row_once(spark, tables, database, parts):
    slices = screen.time_slices("timestamp", "2026-01-05", "2026-01-15", parts)
    read = screen.read_jdbc(spark, database, "frames", slices, driver=DRIVER)
    assert len(slices) == read.rdd.getNumPartitions() == parts
    assert sorted(map(str, read.select(*tables[0].columns).collect())) == sorted(map(str, tables[0].collect()))


def test_a_range_reaches_the_database(spark, tables, database):
    slices = screen.time_slices("timestamp", "2026-01-09", "2026-01-12", 4)
    frame, ocr = (screen.read_jdbc(spark, database, name, s, driver=DRIVER) for name, s in (("frames", slices), ("ocr_text", None)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    kept = []
    for ask in ({"machine": "k", "start": "2026-01-09", "end": "2026-01-12"}, {"start": "2026-01-09 12:00:00", "limit": 7}, {}):
        got, want = screen.frames(frame, ocr, narrow=True, **ask), screen.frames(*tables, **ask)
        columns = ["id", "at", "host", "full_text", "ocr_text", "ocr_engine"]
        assert [tuple(r[c] for c in columns) for r in got.collect()] == [tuple(r[c] for c in columns) for r in want.collect()]
        kept.append(got)
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line or "Scan JDBC" in line]
    assert any("GreaterThanOrEqual(timestamp,2026-01-07)" in p and "LessThan(timestamp,2026-01-14)" in p and "EqualTo(machine_id,k)" in p for p in pushed)
    assert any("GreaterThanOrEqual(frame_id" in p and "LessThanOrEqual(frame_id" in p for p in pushed)
    inside = kept[0].collect()
    assert inside and screen.of_frames(ocr, kept[0].where("false")).count() == 0
