"""The folds over rows in order, as streams with state.

Rows wait in the state of their key until the watermark has passed them, so
that they are taken in the order of a batch, however they came in; an event-time
timer wakes a key whose rows have waited long enough.  What a fold knows of the
rows so far (a scene's start, an anchor picture, a row that waits for its
successor) is a value of a few columns.  A query that is stopped goes on from
its checkpoint.  Needs the RocksDB state store, which ``configured`` chooses.

A run that is bounded passes its last rows, too, if it allows no lateness and
takes all files in one batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from timeloom.operators.windows import BRIDGE_BITS, COMPARE_SECONDS, DUPLICATE_BITS, WORD64

#: Microseconds by which the watermark's column is late, so that timers of rows at the very end fire.
BEHIND = 1_000_000
#: Waiting rows of a key that one value of its state holds; each value is pickled, sent and stored by itself.
PACKED = 4096


@contextmanager
def configured(spark: SparkSession) -> Iterator[None]:
    """The session with the state store that these streams need, for as long as they are started in here."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def micros(x: Column) -> Column:
    return F.unix_micros(x.cast("timestamp"))


@dataclass(frozen=True)
class Scenes:
    """Near enough to the row before, of its application or category, and of limited length; a row is (end, app, category)."""

    gap: float = 75.0
    longest: float = 180.0
    by_end = True
    facts = "end long, app string, category string"
    state = "since long, last long, app string, category string, number long"

    def row(self, state, ident, at, end, app, category):
        since, last, last_app, last_category, number = state or (None, None, None, None, 0)
        apart = state is None or at - last > self.gap * 1e6
        same = (app and app == last_app) or (category and category == last_category)
        if apart or not same or end - since > self.longest * 1e6:
            since, number = at, number + 1
        return [(ident, at, number, "", "")], (since, end, app, category, number)

    def due(self, state):
        return None


@dataclass(frozen=True)
class Captures:
    """Runs of captures like the row before or the run's anchor picture; a row is (app, title, digest, picture as text)."""

    gap: float = 45.0
    bits: int = BRIDGE_BITS
    near_gap: float = COMPARE_SECONDS
    near_bits: int = DUPLICATE_BITS
    by_end = False
    facts = "app string, title string, digest string, picture string"
    state = "at long, app string, title string, digest string, picture string, anchor_digest string, anchor_picture string, number long"

    @staticmethod
    def apart_by(a: str, b: str) -> int:
        """Bits between two pictures, more than any number allowed where one is unknown."""
        return ((int(a) ^ int(b)) & WORD64).bit_count() if a and b else 999

    def row(self, state, ident, at, app, title, digest, picture):
        if state is None:
            return [(ident, at, 1, "", "")], (at, app, title, digest, picture, digest, picture, 1)
        last_at, last_app, last_title, last_digest, last_picture, anchor_digest, anchor_picture, number = state
        close = at - last_at <= self.near_gap * 1e6
        near = close and ((digest and digest == last_digest) or self.apart_by(picture, last_picture) <= self.near_bits)
        tied = near or (app == last_app and app not in ("", "unknown")) or (title and title == last_title)
        alike = (digest and digest == anchor_digest) or self.apart_by(picture, anchor_picture) <= self.bits
        if at - last_at > self.gap * 1e6 or not (alike or tied):
            number, anchor_digest, anchor_picture = number + 1, digest, picture
        elif not alike and not near:
            anchor_digest, anchor_picture = digest, picture
        return [(ident, at, number, "", "")], (at, app, title, digest, picture, anchor_digest, anchor_picture, number)

    def due(self, state):
        return None


@dataclass(frozen=True)
class Episodes:
    """Blocks of work that absorb a short interruption if work follows: a row waits for its successor, or until none can come; a row is (end, kind).

    ``held`` is the row that waits, the rest is about the one before it.
    """

    max_gap: float = 300.0
    interruption_max: float = 120.0
    by_end = True
    facts = "end long, kind string"
    state = "held_id string, held_at long, held_end long, held_kind string, last_end long, last_kind string, last_type string, number long"

    def decided(self, state, next_at=None, next_kind=None):
        """The waiting row with its group, and the state behind it."""
        ident, at, end, kind, last_end, last_kind, last_type, number = state
        if ident is None:
            return [], state
        longest, first = self.max_gap * 1e6, not last_type
        gap_in = None if first else max(0, at - last_end)
        short = max(0, end - at) <= self.interruption_max * 1e6
        absorbed = kind == "interruptible" and last_kind == "work" and next_kind == "work" and short and gap_in <= longest and max(0, next_at - end) <= longest
        made = "capture_control" if kind == "capture" else "work_block" if kind == "work" or absorbed else "unclassified"
        if first or made != last_type or gap_in > longest:
            number += 1
        return [(ident, at, number, made, "interruption" if absorbed else "primary")], (None, None, None, None, end, kind, made, number)

    def row(self, state, ident, at, end, kind):
        out, (*_, last_end, last_kind, last_type, number) = self.decided(state, at, kind) if state else ([], (None,) * 7 + (0,))
        return out, (ident, at, end, kind, last_end, last_kind, last_type, number)

    def due(self, state):
        """When nothing that comes could follow the waiting row closely enough."""
        return None if state is None or state[0] is None else max(state[1], state[2]) + int(self.max_gap * 1e6) + 1


OUT = "id string, at long, number long, kind string, role string"
#: Waiting rows as JSON.
WAITING = "rows string"


def packed(rows: list[tuple]) -> list[tuple[str]]:
    """Rows as values of a state, up to PACKED in each."""
    return [(json.dumps(rows[i : i + PACKED]),) for i in range(0, len(rows), PACKED)]


def unpacked(values: Iterator[tuple]) -> list[tuple]:
    return [tuple(r) for (text,) in values for r in json.loads(text)]


def processor(walk, names: list[str], state: T.StructType) -> type[StatefulProcessor]:
    """The stateful processor of a walk; ``names`` are the columns of its rows (id, order, at, due, facts ...)."""

    class Walker(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.rows, self.so_far = handle.getListState("waiting", WAITING), handle.getValueState("so_far", state)

        def held(self) -> list[tuple]:
            return unpacked(self.rows.get()) if self.rows.exists() else []

        def go(self, key: tuple, rows: list[tuple], held: bool, timers) -> Iterator[pd.DataFrame]:
            """Take the rows that the watermark has passed; ``held`` says whether some of them are in the state."""
            passed = timers.getCurrentWatermarkInMs() * 1000
            ready = sorted((r for r in rows if r[3] <= passed), key=lambda r: (r[2], r[4] if walk.by_end else 0, r[1]))
            waiting = [r for r in rows if r[3] > passed]
            now, out = self.so_far.get() if self.so_far.exists() else None, []
            now = None if now is None else tuple(now)
            for ident, _, at, _, *facts in ready:
                made, now = walk.row(now, ident, at, *facts)
                out += made
            due = walk.due(now)
            if due is not None and due + BEHIND <= passed and not any(r[2] <= due for r in waiting):
                made, now = walk.decided(now)
                out, due = out + made, None
            if now is not None:
                self.so_far.update(now)
            if waiting:
                self.rows.put(packed(waiting))
            elif held:
                self.rows.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            next_at = [*([min(r[3] for r in waiting)] if waiting else []), *([due + BEHIND] if due is not None else [])]
            if next_at:
                # Somewhat early; a timer that finds nothing ready waits for the watermark to move.
                self.handle.registerTimer(max(-(-min(next_at) // 1000) - BEHIND // 2000, passed // 1000 + 1))
            if out:
                columns = [*([k] * len(out) for k in key), *zip(*out)]
                yield pd.DataFrame(dict(zip([*(f"k{i}" for i in range(len(key))), "id", "at", "number", "kind", "role"], columns)))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            new = [r for frame in rows for r in zip(*(frame[c].tolist() for c in names))]
            old = self.held()
            yield from self.go(key, old + new, bool(old), timerValues)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            old = self.held()
            yield from self.go(key, old, bool(old), timerValues)

        def close(self) -> None:
            pass

    return Walker


def walked(stream: DataFrame, walk, keys: list[str], ident: str, at: str, facts: dict[str, Column], late: str = "10 minutes") -> DataFrame:
    """keys (as text), id (as text), at (microseconds), number, kind and role of every row, once the watermark has passed it.

    Rows are taken by time, then by end where the walk has one, then by ``ident`` (a whole number).
    """
    due = F.ceil(micros(F.col(at)) / 1000) * 1000 + BEHIND
    rows = stream.select(
        *[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)], F.col(ident).cast("string").alias("id"), F.col(ident).cast("long").alias("turn"), micros(F.col(at)).alias("at"), due.cast("long").alias("due"), *[c.alias(n) for n, c in facts.items()]
    ).withColumn("passes", F.timestamp_micros("due")).withWatermark("passes", late)
    waiting = T.StructType.fromDDL(f"id string, turn long, at long, due long, {walk.facts}")
    made = processor(walk, waiting.names, T.StructType.fromDDL(walk.state))
    names = ", ".join(f"k{i} string" for i in range(len(keys)))
    out = rows.groupBy(*[f"k{i}" for i in range(len(keys))]).transformWithStateInPandas(made(), f"{names}, {OUT}", "Append", "EventTime")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "id", "at", "number", "kind", "role")


def text_of(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def scenes(stream: DataFrame, keys: list[str], ident: str, start: str, end: str, app: str, category: str, gap: float = 75.0, longest: float = 180.0, late: str = "10 minutes") -> DataFrame:
    """``windows.capped_scenes`` as a stream."""
    facts = {"end": micros(F.coalesce(end, start)), "app": text_of(app), "category": text_of(category)}
    return walked(stream, Scenes(gap, longest), keys, ident, start, facts, late)


def captures(stream: DataFrame, keys: list[str], ident: str, at: str, app: str, title: str, sha: str, dhash: str, walk: Captures = Captures(), late: str = "10 minutes") -> DataFrame:
    """``windows.change_signal`` and ``windows.anchored_segments`` as a stream."""
    facts = {"app": F.lower(F.trim(text_of(app))), "title": text_of(title), "digest": text_of(sha), "picture": text_of(dhash)}
    return walked(stream, walk, keys, ident, at, facts, late)


def episodes(stream: DataFrame, keys: list[str], ident: str, start: str, end: str, kind: str, max_gap: float = 300.0, interruption_max: float = 120.0, late: str = "10 minutes") -> DataFrame:
    """``episodes.label`` as a stream."""
    facts = {"end": micros(F.coalesce(end, start)), "kind": text_of(kind)}
    return walked(stream, Episodes(max_gap, interruption_max), keys, ident, start, facts, late)
