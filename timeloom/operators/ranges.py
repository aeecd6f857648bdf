"""Looks at neighbouring rows, and running sums and maxima, for keys of any number of rows.

A window by key sorts all rows of a key in one task.  Here a key's rows are cut
in ranges of time, by default days; each range sums up (its first and last row,
its sum, its maximum), the summaries, one row a range, are combined along the
key, and every range takes what it needs of those before or after it.  So one
user's rows fill as many tasks as there are ranges, after one exchange.

Order is ascending, nulls first; the first column of the order must be the time
that the ranges are cut by (rows without one are a range before all others).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds of a range.
RANGE_SECONDS = 86_400.0
#: A row's key and range.
CUT = ["_key", "_range"]


def instant(df: DataFrame, c: str) -> Column:
    """Microseconds since 1970, whatever kind of timestamp the column is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(df.schema[c].dataType), F.col(c))


class Scan:
    """What is asked of a table by ``before``, ``after``, ``sum_to`` and ``most_before`` is a column of ``rows()``.

    Each gives the name of its column, so that expressions can be built before
    the rows are there; one scan answers all that was asked.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], seconds: float = RANGE_SECONDS):
        self.df, self.keys, self.order, self.seconds = df, keys, order, seconds
        self.asked: list[tuple[str, str, Column]] = []

    def _ask(self, kind: str, value: Column | str) -> Column:
        name = f"_{kind}{len(self.asked)}"
        self.asked.append((kind, name, F.col(value) if isinstance(value, str) else value))
        return F.col(name)

    def before(self, value: Column | str) -> Column:
        """The value of the row before, null if there is none."""
        return self._ask("before", value)

    def after(self, value: Column | str) -> Column:
        return self._ask("after", value)

    def sum_to(self, value: Column | str) -> Column:
        """The sum of a whole number from the first row to this one."""
        return self._ask("sum", value)

    def most_before(self, value: Column | str) -> Column:
        """The largest value of all rows before this one."""
        return self._ask("most", value)

    def rows(self, cut: bool = False) -> DataFrame:
        """The table with a column for each question; with ``cut`` also its key and range, by which the rows are dealt.

        A scan of the same keys and order over such a table takes the rows as they lie.
        """
        named = {name: value for _, name, value in self.asked}
        dealt = set(CUT) <= set(self.df.columns)
        places = F.coalesce(F.floor(instant(self.df, self.order[0]) / int(self.seconds * 1e6)), F.lit(-(1 << 62)))
        # One key of all parts, which may be null inside, serves the windows and the join.
        rows = self.df.withColumns(named if dealt else {"_key": F.struct(F.lit(0), *self.keys), "_range": places, **named})
        inside = Window.partitionBy("_key", "_range").orderBy(*self.order)
        place = F.struct(*self.order)
        made, parts, carried = {}, [], {}
        along = Window.partitionBy("_key").orderBy("_range")
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        for kind, name, _ in self.asked:
            value, whole, carry = F.struct(F.col(name).alias("v")), f"_of{name}", F.col(f"_in{name}")
            if kind == "before":
                parts.append(F.max_by(value, place).alias(whole))
                carried[f"_in{name}"] = F.lag(whole).over(along)
                made[name] = F.coalesce(F.lag(value).over(inside), carry)["v"]
            elif kind == "after":
                parts.append(F.min_by(value, place).alias(whole))
                carried[f"_in{name}"] = F.lead(whole).over(along)
                made[name] = F.coalesce(F.lead(value).over(inside), carry)["v"]
            elif kind == "sum":
                parts.append(F.sum(name).alias(whole))
                carried[f"_in{name}"] = F.sum(whole).over(earlier)
                made[name] = F.coalesce(F.sum(name).over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) + F.coalesce(carry, F.lit(0))
            else:
                parts.append(F.max(name).alias(whole))
                carried[f"_in{name}"] = F.max(whole).over(earlier)
                made[name] = F.greatest(F.max(name).over(inside.rowsBetween(Window.unboundedPreceding, -1)), carry)
        summary = rows.groupBy("_key", "_range").agg(*parts)
        carry = summary.select("_key", "_range", *[c.alias(n) for n, c in carried.items()])
        # In this order the join keeps the partitions that the windows need.
        rows = rows.join(carry, ["_key", "_range"]).withColumns(made)
        return rows.select(*self.df.columns, *named, *(CUT if cut and not dealt else []))


def places(df: DataFrame, order: list[Column], keep: Callable[[DataFrame, str], DataFrame], name: str = "place") -> DataFrame:
    """Number all rows from 1 on in an order; what it leaves open falls as it may.

    Rows are dealt and sorted by ranges of the order and stored (``keep``) with
    their number in their range; only the sizes of the ranges meet in one task.
    """
    # The number of a partition, and of a row in it.
    rows = keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "places")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return rows.withColumn("_part", part).join(F.broadcast(sizes), "_part").select(*df.columns, place.cast("long").alias(name))
