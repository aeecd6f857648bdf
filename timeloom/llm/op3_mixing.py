"""Mixing sources to target weights by entropy balancing.

Each document of source s gets a rate r = min(cap, exp(lambda_s * size / scale_s)):
of all rates of at most ``cap`` that give every source its token target, these
have the least relative entropy to rate 1.  The multipliers lambda maximise the
convex dual.  Newton steps, kept inside a bracket, find them; every step's
gradient and curvature are sums in Spark over counts by (source, size).  Rates
are then rounded into copies: sizes from large to small pass on the words by
which they missed, and inside one (source, size) group the documents with the
smallest hashes take the extra copy.

What reaches the driver is a row for each source, as the weights do.  The table
of (source, size) groups is broadcast only if it has at most BROADCAST_ROWS
rows; beyond that the rows, texts included in ``resample``, are exchanged by
group, those of one group dealt to several tasks.

Corner cases: a null text has size 0; a null source is a source, last in order;
a source of size 0 has target 0; documents of size 0 keep one copy and count
nothing; a very long text is one document of its size, and a source that it
dominates misses its target by up to half of it; rows that agree in id and
text are numbered, and each number has its own hash, so that so many of them
as needed are taken (which ones is left open, as they are the same); ties of
hashes inside a group decide alike; an empty table gives no rows; columns of
other names, clashing ones too, are carried by ``resample`` and ignored by
``mix``, never read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.llm import common

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, CAP = (1, 2, 3), 3
#: Above this many (source, size) groups the group table is no longer broadcast.
BROADCAST_ROWS = 300_000
#: Members of a group whose hashes are sorted together.
SORT_TOGETHER = 4096
TOLERANCE, MAX_STEPS = 1e-7, 200


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Share all sizes by repeating weights; a target above cap * size stays there and its excess is shared again."""
    share = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, open_, rest = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(share[i] for i in open_)
        full = {i for i in open_ if rest * share[i] / whole > cap * sizes[i]}
        if not full:
            for i in open_:
                out[i] = rest * share[i] / whole
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        rest -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def solve(counts: DataFrame, sources: list[dict], cap: int) -> None:
    """Set ``tilt`` of every source: the root of sum(n * size * min(cap, exp(tilt * x))) = target."""
    spark, top = counts.sparkSession, math.log(cap)
    for s in sources:
        s |= {"tilt": 0.0, "low": -math.inf, "high": math.inf, "done": s["target"] <= 0 or s["target"] >= cap * s["size"]}
        if s["done"]:
            s["tilt"] = math.inf if s["target"] > 0 else -math.inf
    for _ in range(MAX_STEPS):
        todo = [s for s in sources if not s["done"]]
        if not todo:
            return
        at = spark.createDataFrame([(s["s"], s["tilt"]) for s in todo], "s int, tilt double")
        power = F.col("tilt") * F.col("x")
        rate = F.exp(F.least(power, F.lit(top)))
        words = F.col("n") * F.col("size")
        sums = counts.join(at, "s").groupBy("s").agg(
            F.sum(words * rate).alias("got"),
            F.sum(F.when(power < top, words * F.col("x") * rate).otherwise(0.0)).alias("slope"),
        )
        for row in sums.collect():
            s = sources[row["s"]]
            miss = row["got"] - s["target"]
            if abs(miss) <= TOLERANCE * s["target"]:
                s["done"] = True
                continue
            s["high" if miss > 0 else "low"] = s["tilt"]
            step = s["tilt"] - miss / row["slope"] if row["slope"] > 0 else math.nan
            if not s["low"] < step < s["high"]:
                ends = s["low"], s["high"]
                if all(map(math.isfinite, ends)):
                    step = sum(ends) / 2
                else:
                    step = 2 * s["tilt"] + (1 if miss < 0 else -1)
            s["done"] = step == s["tilt"] or s["high"] - s["low"] <= 1e-13 * max(1.0, abs(step))
            s["tilt"] = step


def round_groups(cap: int):
    """Whole copies for each size of one source, from large to small; what one size misses the next makes up."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False, ignore_index=True)
        carry, copies = 0.0, []
        for size, n, rate in zip(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist()):
            if size == 0:
                copies.append(n)
                continue
            want = carry + n * rate * size
            take = min(max(round(want / size), 0), cap * n)
            carry = want - take * size
            copies.append(take)
        rows["base"] = np.array(copies, np.int64) // rows["n"].clip(lower=1)
        rows["extra"] = np.array(copies, np.int64) - rows["base"] * rows["n"]
        return rows[["source", "size", "n", "source_size", "target", "base", "extra"]]

    return run


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (source, size, u): source, size, source_size, target, base and cut; a row takes base copies, one more if u <= cut."""
    spark = sized.sparkSession
    counts = common.durable(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    found = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["size"] for r in found], weights, cap)
    sources = [{"s": i, "source": r["source"], "size": r["size"], "target": goal[i], "scale": max(1.0, r["size"] / max(1, r["n"]))} for i, r in enumerate(found)]
    table = spark.createDataFrame([(s["s"], s["source"], s["size"], s["target"], s["scale"]) for s in sources], "s int, _source string, source_size long, target double, scale double")
    counts = counts.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("x", F.col("size") / F.col("scale"))
    counts = common.durable(counts, "tilted")
    solve(counts, sources, cap)
    tilt = spark.createDataFrame([(s["s"], s["tilt"]) for s in sources], "s int, tilt double")
    rate = F.when(F.col("tilt") == math.inf, float(cap)).when(F.col("tilt") == -math.inf, 0.0).otherwise(F.exp(F.least(F.col("tilt") * F.col("x"), F.lit(math.log(cap)))))
    rated = counts.join(tilt, "s").withColumn("rate", F.least(rate, F.lit(float(cap)))).select("s", "source", "size", "n", "source_size", "target", "rate")
    groups = rated.groupBy("s").applyInPandas(round_groups(cap), "source string, size long, n long, source_size long, target double, base long, extra long")
    groups = common.durable(groups, "copies")
    cuts = cut_hashes(sized, groups.where("extra > 0"))
    keys = F.col("g.source").eqNullSafe(F.col("c.source")) & (F.col("g.size") == F.col("c.size"))
    return common.durable(groups.alias("g").join(cuts.alias("c"), keys, "left").select("g.source", "g.size", "g.source_size", "g.target", "g.base", F.coalesce("c.cut", F.lit(-1.0)).alias("cut")), "plan")


def cut_hashes(sized: DataFrame, groups: DataFrame) -> DataFrame:
    """The extra-th smallest u of each group.

    Hashes are counted in so many equal ranges that one holds about
    SORT_TOGETHER of them; only the range in which the cut falls is sorted.
    """
    keys = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))
    members = sized.alias("m").join(groups.alias("g"), keys("m", "g")).select("m.source", "m.size", "m.u", "g.extra", F.floor(F.col("m.u") * F.ceil(F.col("g.n") / SORT_TOGETHER)).alias("b"))
    ranges = members.groupBy("source", "size", "b", "extra").agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy("source", "size").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("need", F.col("extra") - before).where("need > 0 AND need <= k")
    same = keys("m", "r") & (F.col("m.b") == F.col("r.b"))
    near = members.alias("m").join(ranges.alias("r"), same).select("m.source", "m.size", "m.u", "r.need")
    return near.groupBy("source", "size", "need").agg(F.sort_array(F.collect_list("u")).alias("us")).select("source", "size", F.expr("us[int(need) - 1]").alias("cut"))


def with_copies(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """All rows of (source, size, u, ...) with source_size, target and copies."""
    small = planned.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    right = planned.select(group_key().alias("group"), "source_size", "target", "base", "cut")
    rows = sized.withColumn("group", group_key())
    rows = rows.join(F.broadcast(right), "group") if small else common.meet(rows, right, ["group"], "u")
    return rows.withColumn("copies", F.col("base") + (F.col("u") <= F.col("cut")).cast("long")).drop("group", "base", "cut")


def group_key() -> Column:
    """Source and size as one key without nulls."""
    return F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")), F.col("size"))


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """source, size, the keys of the row and the columns ``keep``."""
    rows = docs.select(*keep, F.col("doc_id").cast("long").alias("_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), common.text_hash().alias("th"))
    return common.keyed(rows, "_id").drop("_id")


def repeats(sized: DataFrame) -> DataFrame | None:
    """The keys of rows that agree in id and text, or None if no two do."""
    found = common.durable(sized.groupBy(*common.ROW).count().where("count > 1").select(*common.ROW, F.lit(True).alias("repeated")), "repeats")
    return found if found.limit(1).count() else None


def hashed(sized: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Add u: a hash of id, text and, among rows of one source that agree in both, of a number from 1.

    Rows that agree in all three are alike, so whichever gets a number, a
    source's hashes are the same over any partitions.  Numbers count on from one input partition to the next, so that a row that
    is repeated very often is numbered in many tasks.
    """
    if repeated is None:
        return sized.withColumn("u", common.unit_hash(*map(F.col, common.ROW), F.lit(1).cast("long")))
    rows = sized.withColumn("uid", F.monotonically_increasing_id()).withColumn("part", F.shiftright("uid", 33))
    rows = common.meet(rows, repeated, common.ROW, "uid", "left")
    once = rows.where("repeated IS NULL").withColumn("number", F.lit(1).cast("long"))
    own = [*common.ROW, "_source"]
    more = rows.where("repeated").withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("none")))
    keys = [*own, "part"]
    counts = more.groupBy(*keys).agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy(*own).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*keys, before.alias("before"))
    more = more.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy("uid")))
    more = more.join(counts, keys).withColumn("number", (F.col("number") + F.col("before")).cast("long"))
    every = once.unionByName(more.select(*once.columns))
    return every.withColumn("u", common.unit_hash(*map(F.col, common.ROW), F.col("number"))).select(*sized.columns, "u")


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The measured rows as a stored table with their hashes, and the keys of those that repeat."""
    sized = common.durable(rows, "measured")
    repeated = repeats(sized)
    return hashed(sized, None) if repeated is None else common.durable(hashed(sized, repeated), "hashed"), repeated


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of each document, repeats counted."""
    sized, _ = numbered(measured(docs, "doc_id"))
    rows = with_copies(sized, plan(sized, weights, cap))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def resample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.

    ``docs`` must give its rows in the same partitions whenever it is read, as
    stored tables do, if rows repeat.  Texts are exchanged only if rows repeat
    or there are more than BROADCAST_ROWS groups.
    """
    columns = docs.columns
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), "doc_id", "text", "source")
    sized, repeated = numbered(measured(docs))
    rows = with_copies(hashed(measured(whole, "row"), repeated), plan(sized, weights, cap))
    return rows.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.documents(spark, sf_dir))
