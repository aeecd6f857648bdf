"""Scores of episodes that lie on a half."""

import json
from datetime import datetime, timedelta

from timeloom.operators import episodes

START = datetime(2024, 1, 28, 9)


def test_a_score_on_a_half_goes_up(spark):
    """0.375 less 0.15 is 0.22499999999999998 as a double."""
    spans = [("a", "development", 0.0, 3.0, 0.25), ("b", "browser", 5.0, 4.0, 0.25), ("c", "development", 10.0, 3.0, 0.5)]
    rows = [(i, "u", "activity_context", START + timedelta(seconds=s), START + timedelta(seconds=s + n), c, json.dumps({"activity_type": kind})) for i, kind, s, n, c in spans]
    df = spark.createDataFrame(rows, "id string, user_id string, event_type string, start_at timestamp, end_at timestamp, confidence double, payload_json string")
    made = episodes.build(df, START)[0].collect()
    assert [(r["episode_type"], r["confidence"]) for r in made] == [("work_block", 0.23)]
