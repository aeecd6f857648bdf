"""Ordered operators: change signals, islands and folds.

What a look at neighbouring rows decides is a scan (``ranges``), which needs no
key's rows in one task.  What needs the state of the group so far is a fold
inside islands that a scan has cut already: it streams over sorted partitions
with one state, so an island of any length costs constant memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from timeloom.functions.scoring import hamming
from timeloom.functions.times import seconds_between
from timeloom.operators.ranges import CUT, Scan, instant

# Bits of difference, and seconds, within which frames are compared.
DUPLICATE_BITS, BRIDGE_BITS, COMPARE_SECONDS = 6, 10, 300.0
WORD64 = (1 << 64) - 1

Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(df: DataFrame, name: str) -> DataFrame:
    return df


def ordered(keys: list[str], order: list) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def change_signal(df: DataFrame, keys: list[str], order: list[str], at: str, sha: str, dhash: str, gap: float = COMPARE_SECONDS, bits: int = DUPLICATE_BITS) -> DataFrame:
    """Against the row before: exact_duplicate, near_duplicate and bits_changed, unless it is more than ``gap`` seconds away."""
    scan = Scan(df, keys, order)
    made = signals(scan, at, sha, dhash, gap, bits)
    return scan.rows().select(*df.columns, *[c.alias(n) for n, c in made.items()])


def signals(scan: Scan, at: str, sha: str, dhash: str, gap: float = COMPARE_SECONDS, bits: int = DUPLICATE_BITS) -> dict[str, Column]:
    """The columns of ``change_signal`` over what a scan finds."""
    close = F.coalesce(seconds_between(scan.before(at), F.col(at)) <= gap, F.lit(False))
    equal = close & F.coalesce((F.col(sha) != "") & (F.col(sha) == scan.before(sha)), F.lit(False))
    changed = F.when(equal, 0).when(close, hamming(F.col(dhash), scan.before(dhash)))
    return {"exact_duplicate": equal, "near_duplicate": equal | F.coalesce(changed <= bits, F.lit(False)), "bits_changed": changed.cast("int")}


def numbered(df: DataFrame, keys: list[str], order: list[str], begins: str, out: str) -> DataFrame:
    """Number the groups of each key from the flag (0 or 1) of their first rows, which is dropped."""
    scan = Scan(df, keys, order)
    number = scan.sum_to(begins)
    return scan.rows().select(*[c for c in df.columns if c != begins], number.alias(out))


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Callable[[Scan], Column], out: str = "segment_no") -> DataFrame:
    """Number the runs of rows: a new one starts where ``breaks`` holds, a null counting as a break."""
    scan = Scan(df, keys, order)
    hard = F.coalesce(breaks(scan), F.lit(True)).cast("int")
    return numbered(scan.rows().select(*df.columns, hard.alias("_break")), keys, order, "_break", out)


def fold(scan: Scan, hard: Column, facts: dict[str, Column], step: Callable, out: str, also: dict[str, Column] | None = None, keep: Keep = as_it_is) -> DataFrame:
    """Number groups that depend on the state of the group so far, in two phases.

    ``hard`` says, by what a scan tells of the rows before, where a group
    begins whatever the state; a null counts as one.  The rows between are an
    island, and islands are dealt to all tasks, so that one key can fill many.
    Inside an island ``step(state, *facts)``, with a state of None at its first
    row, gives whether a group begins and the next state; it sees only the
    ``facts``, a few numbers that the JVM has made.  A last running sum numbers
    the groups of each key.  Both sums are scans, too, so that no key is sorted in
    one task; rows without any certain break between them are one walk, though.

    ``also`` are columns of the scan that stay.  ``keep`` stores the walked rows,
    which the last sum needs twice.
    """
    keys, order, names, also = scan.keys, scan.order, list(facts), also or {}
    stay = [*scan.df.columns, *also]
    rows = scan.rows(cut=True).select(*scan.df.columns, *CUT, *[c.alias(n) for n, c in also.items()], F.coalesce(hard, F.lit(True)).cast("int").alias("_hard"), *[c.alias(n) for n, c in facts.items()])
    rows = numbered(rows, keys, order, "_hard", "_island").drop(*CUT)
    group = [*keys, "_island"]
    schema = T.StructType([*[rows.schema[c] for c in stay], T.StructField("_begins", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            column = {c: batch.column(i).to_pylist() for i, c in enumerate(batch.schema.names) if c in group or c in names}
            begins = []
            for which, seen in zip(zip(*(column[c] for c in group)), zip(*(column[c] for c in names))):
                if which != now:
                    now, state = which, None
                first, state = step(state, *seen)
                begins.append(int(first))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in stay], pa.array(begins, pa.int32())], names=[*stay, "_begins"])

    walked = keep(rows.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(run, schema), "walked")
    return numbered(walked, keys, order, "_begins", out)


def capped_scenes(df: DataFrame, keys: list[str], order: list[str], start: str, end: str, app: str, category: str, gap: float = 75.0, longest: float = 180.0, out: str = "scene_no") -> DataFrame:
    """Scenes: near enough to the row before, of its application or category, and at most ``longest`` seconds from the scene's start."""
    scan, cap = Scan(df, keys, order), int(longest * 1e6)
    begin, ends = instant(df, start), F.coalesce(instant(df, end), instant(df, start))
    same = lambda c: F.coalesce((F.col(c) != "") & (F.col(c) == scan.before(c)), F.lit(False))
    apart = begin - scan.before(ends) > int(gap * 1e6)

    def step(since, first, last):
        return (True, first) if since is None or last - since > cap else (False, since)

    return fold(scan, apart | ~(same(app) | same(category)), {"_first": begin, "_last": ends}, step, out)


def capped_overlaps(df: DataFrame, keys: list[str], order: list[str], start: str, end: str, tolerance: float = 8.0, longest: float = 900.0, out: str = "group_no") -> DataFrame:
    """Groups of intervals that start before the latest end so far plus ``tolerance``, of at most ``longest`` seconds.

    Beyond the latest end of all rows before there is a break for certain.
    """
    scan, near, cap = Scan(df, keys, order), int(tolerance * 1e6), int(longest * 1e6)
    begin, ends = instant(df, start), instant(df, end)

    def step(span, first, last):
        if span is not None and first <= span[1] + near:
            wider = min(first, span[0]), max(last, span[1])
            if wider[1] - wider[0] <= cap:
                return False, wider
        return True, (first, last)

    return fold(scan, begin - scan.most_before(ends) > near, {"_first": begin, "_last": ends}, step, out)


def anchored_segments(
    df: DataFrame, keys: list[str], order: list[str], at: str, app: str, title: str, sha: str, dhash: str, near: str | None = "near_duplicate", gap: float = 45.0, bits: int = BRIDGE_BITS, out: str = "segment_no", keep: Keep = as_it_is
) -> DataFrame:
    """Captures in runs: near in time, and alike in application, title or picture, to the row before or to the run's anchor picture.

    The anchor is the run's first picture; it moves to a row of the run that is
    like neither the anchor nor the row before.  Where ``near`` is None the same
    scan makes the columns of ``change_signal``, which stay.
    """
    scan = Scan(df, keys, order)
    also = signals(scan, at, sha, dhash) if near is None else {}
    name, heading = F.lower(F.trim(F.coalesce(app, F.lit("")))), F.coalesce(title, F.lit(""))
    like = F.coalesce(also["near_duplicate"] if near is None else F.col(near), F.lit(False))
    tied = like | ((name == scan.before(name)) & ~name.isin("", "unknown")) | ((heading != "") & (heading == scan.before(heading)))
    apart = instant(df, at) - scan.before(instant(df, at)) > int(gap * 1e6)

    def step(anchor, tie, close, digest, picture):
        seen = (digest, picture)
        if anchor is None:
            return True, seen
        by_digest = bool(digest) and digest == anchor[0]
        both = picture is not None and anchor[1] is not None
        by_picture = both and ((picture ^ anchor[1]) & WORD64).bit_count() <= bits
        if by_digest or by_picture:
            return False, anchor
        return not tie, anchor if tie and close else seen

    facts = {"_tie": F.coalesce(tied, F.lit(False)), "_close": like, "_digest": F.col(sha), "_picture": F.col(dhash)}
    return fold(scan, apart, facts, step, out, also, keep)


def frame_segments(df: DataFrame, keys: list[str], order: list[str], at: str, app: str, host: str, title: str, gap: float = 45.0, out: str = "segment_no") -> DataFrame:
    """Frames in runs: one application, near in time, one host or else one title where both are known."""

    def breaks(scan: Scan) -> Column:
        last_at, last_app, last_host, last_title = (scan.before(c) for c in (at, app, host, title))
        known = lambda c, last: F.coalesce((F.col(c) != "") & (last != ""), F.lit(False))
        moved = F.when(known(host, last_host), F.col(host) != last_host).when(known(title, last_title), F.col(title) != last_title).otherwise(False)
        return last_at.isNull() | (seconds_between(last_at, F.col(at)) > gap) | ~F.col(app).eqNullSafe(last_app) | moved

    return islands(df, keys, order, breaks, out)


def first_distinct(order: Column, value: Column, n: int | None = None) -> Column:
    """An aggregate: the distinct non-blank values in order, the first ``n``."""
    some = F.collect_list(F.when(F.coalesce(value, F.lit("")) != "", F.struct(order.alias("o"), value.alias("v"))))
    values = F.array_distinct(F.transform(F.array_sort(some), lambda x: x["v"]))
    return F.slice(values, 1, n) if n else values


def sample_places(n: Column) -> Column:
    """First, middle and last place of n, from 0, each once."""
    return F.array_distinct(F.array(F.lit(0).cast("long"), F.floor(n / 2), n.cast("long") - 1))


def dominant(df: DataFrame, keys: list[str], value: str, position: Column, weight: Column | None = None, out: str = "dominant") -> DataFrame:
    """The most frequent (or heaviest) non-blank value of each key; of equals the one that came first."""
    some = df.where(F.coalesce(F.col(value), F.lit("")) != "")
    total = F.sum(weight if weight is not None else F.lit(1))
    counts = some.groupBy(*keys, value).agg(total.alias("_n"), F.min(position).alias("_first"))
    # One struct decides: largest total, then earliest position.
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("f"), F.col(value).alias("v"))).alias("_best"))
    return best.select(*keys, F.col("_best.v").alias(out), (-F.col("_best.n")).alias(f"{out}_count"))
