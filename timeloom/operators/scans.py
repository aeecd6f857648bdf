"""Table scans with optional conditions in each table's usual order.

A condition that isn't given adds no predicate, so what is given reaches the
files' statistics and partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions.times import day_of, day_range

# The usual order of each table; names with a minus sign go down.
ORDERS = {
    "event": ["start_at", "end_at", "id"],
    "scene_window": ["start_at", "end_at", "id"],
    "content_span": ["start_at", "end_at", "id"],
    "artifact": ["normalized_at", "id"],
    "job": ["-priority", "queued_at", "id"],
    "person": ["display_name", "id"],
    "person_voiceprint": ["enrolled_at", "updated_at", "id"],
    "memory_chunk": ["sort_key", "start_at", "id"],
}


def ordering(table: str) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc_nulls_first() for c in ORDERS[table]]


def scan(
    df: DataFrame, table: str, *, at: str = "start_at", start=None, end=None, day: str | None = None, offset_hours: float = 0.0, like: dict[str, str] | None = None, among: dict[str, Iterable] | None = None, limit: int | None = None, **equal
) -> DataFrame:
    """Rows that equal, lie in [start, end) or on a day, match patterns (whatever their case) and are among values."""
    tests = [F.col(c) == v for c, v in equal.items() if v is not None]
    tests += [F.col(at) >= F.lit(start).cast("timestamp")] if start is not None else []
    tests += [F.col(at) < F.lit(end).cast("timestamp")] if end is not None else []
    if day is not None:
        first, after = day_range(day, offset_hours)
        tests += [F.col(at) >= first, F.col(at) < after]
    tests += [F.col(c).ilike(p) for c, p in (like or {}).items() if p is not None]
    tests += [F.col(c).isin(list(vs)) for c, vs in (among or {}).items() if vs]
    for test in tests:
        df = df.where(test)
    df = df.orderBy(*ordering(table))
    return df.limit(limit) if limit is not None else df


def get(df: DataFrame, ident: str) -> DataFrame:
    return df.where(F.col("id") == ident).limit(1)


def device_days(events: DataFrame, user: str, offset_hours: float = 0.0, **conditions) -> DataFrame:
    """The days on which each device has rows."""
    rows = scan(events, "event", user_id=user, **conditions)
    return rows.select("device_id", day_of(F.col("start_at"), offset_hours).alias("day")).distinct().orderBy("day", F.col("device_id").asc_nulls_first())


def event_days(events: DataFrame, user: str, event_types: Iterable[str] | None = None, offset_hours: float = 0.0) -> DataFrame:
    rows = scan(events, "event", user_id=user, among={"event_type": event_types or []})
    return rows.select(day_of(F.col("start_at"), offset_hours).alias("day")).distinct().orderBy("day")


def event_artifacts(events: DataFrame, event_artifact: DataFrame, artifact: DataFrame) -> DataFrame:
    """All artifacts of all events at once, primary ones first within an event."""
    rank = F.when(F.col("role") == "primary", 0).when(F.col("role") == "supporting", 1).otherwise(2)
    rows = event_artifact.join(events.select(F.col("id").alias("event_id")), "event_id", "left_semi")
    rows = rows.join(artifact.withColumnRenamed("id", "artifact_id").withColumnRenamed("user_id", "owner_id"), "artifact_id")
    return rows.orderBy("event_id", rank, "captured_at_wall", "artifact_id")


def voiceprints(person_voiceprint: DataFrame, person: DataFrame, user: str, person_id: str | None = None, status: str | None = None) -> DataFrame:
    """Voiceprints with the name of their person."""
    rows = scan(person_voiceprint, "person_voiceprint", user_id=user, person_id=person_id, status=status)
    return rows.join(person.select(F.col("id").alias("person_id"), "display_name"), "person_id").orderBy(*ordering("person_voiceprint"))
