"""Places of rows in the order of a whole table."""

import __spark_entry__
from pyspark.sql import functions as F

from timeloom.operators.ranges import places
from timeloom.plans.stages import keeper


def test_places_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 2 == 0, F.col("id") * 7919 % 601).alias("at"), F.col("id").cast("string").alias("id"))
    got = places(df, [F.col("at").asc_nulls_first(), F.col("id")], keeper(spark)).collect()
    want = sorted(((r["at"] is not None, r["at"] or 0, r["id"]) for r in df.collect()))
    assert [r["id"] for r in sorted(got, key=lambda r: r["place"])] == [w[2] for w in want]
    assert sorted(r["place"] for r in got) == list(range(1, 5001))


def test_places_of_no_rows(spark):
    assert places(spark.range(0), [F.col("id")], keeper(spark)).collect() == []


def test_voiceprints_say_their_place(spark):
    """Those of all people, in the order of their enrolment."""
    rows = __spark_entry__.queries()["voiceprints_of_people"](spark, "/root/testdata/sf0.001").orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1, len(rows) + 1)) and [r["enrolled"] for r in rows] == sorted(r["enrolled"] for r in rows)


def test_coverage_says_its_place(spark):
    """Spans without a start come first, then the others as they start."""
    rows = __spark_entry__.queries()["coverage_view"](spark, "/root/testdata/sf0.001").orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1, len(rows) + 1))
    order = [(r["start_s"] is not None, r["start_s"] or 0, r["id"]) for r in rows]
    assert order == sorted(order) and order[0][0] is False and order[-1][0] is True


def test_frames_of_every_machine(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert __spark_entry__.queries()["frames_left_join"](spark, "/root/testdata/sf0.001").count() == orders.count()
