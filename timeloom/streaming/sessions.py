"""The lag-based groupings over streams.

``sessions`` is event-time gaps alone, with a watermark.  ``runs`` closes a run
when the application changes or the gap is exceeded, keeping one open run a key
in state and closing it by an event-time timer.  ``rebuild_days`` is the batch
plan inside ``foreachBatch``: late rows rebuild the days they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN = "user_id string, app string, start_at timestamp, last_at timestamp, n long"
STATE = "app string, start_at timestamp, last_at timestamp, n long"


def sessions(stream: DataFrame, at: str, keys: list[str], gap_seconds: float, late: str = "10 minutes") -> DataFrame:
    """Counts of sessions by gap, each emitted once the watermark has passed its end."""
    grouped = stream.withWatermark(at, late).groupBy(*keys, F.session_window(at, f"{int(gap_seconds * 1000)} milliseconds").alias("w"))
    return grouped.agg(F.count("*").alias("n"), F.min(at).alias("start_at"), F.max(at).alias("last_at")).select(*keys, "start_at", "last_at", "n")


def runs(stream: DataFrame, at: str, user: str, app: str, gap_seconds: float, late: str = "10 minutes") -> DataFrame:
    """Runs of one application by user: closed by another application, by a gap, or by the watermark."""
    gap = timedelta(seconds=gap_seconds)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        closed = []
        run = list(state.get) if state.exists else None
        if state.hasTimedOut:
            closed.append((key[0], *run))
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(["at", "app"])
            for when, name in zip(rows["at"].dt.to_pydatetime(), rows["app"]):
                if run and name == run[0] and abs(when - run[2]) <= gap:
                    run = [name, min(run[1], when), max(run[2], when), run[3] + 1]
                else:
                    if run:
                        closed.append((key[0], *run))
                    run = [name, when, when, 1]
            state.update(tuple(run))
            ends = int((run[2] + gap).timestamp() * 1000)
            state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(closed, columns=["user_id", "app", "start_at", "last_at", "n"])

    rows = stream.select(F.col(user).cast("string").alias("user_id"), F.col(app).cast("string").alias("app"), F.col(at).alias("at")).withWatermark("at", late)
    return rows.groupBy("user_id").applyInPandasWithState(step, RUN, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def rebuild_days(history: Callable[[DataFrame], DataFrame], build: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the (user, day) partitions that a batch touches are built again from all their rows.

    ``history`` gives all rows of the touched keys, those of the batch included;
    the result must carry user_id and day.  Replaying a batch changes nothing.
    """

    def run(batch: DataFrame, _epoch: int) -> None:
        touched = batch.select("user_id", "day").distinct()
        build(history(touched)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("user_id", "day").parquet(path)

    return run
