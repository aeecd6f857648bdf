"""The best pairs of a similarity join, without a row for every pair that shares a word.

Vectors of word counts meet in one order of the words, rare ones first.  Of a
pair's common words take the rarest: all that the pair has in common lies at or
behind it, so its cosine is at most the product of what both vectors weigh from
there on (their tails).  Once the least score of interest is known, a word of a
vector whose tail is too light to reach it needn't be looked up, and a pair that
meets on a word with too light a product isn't one.  What is left is scored
exactly.

The least score of interest is that of the k-th best pair among a few seeds: of
each vector some words that promise most and its most frequent one, each with
the vectors of the other side in which it weighs most.  The seeds only set the
bound; nothing is capped by them.

Scores are compared to a millionth, ties go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of a vector that give seeds, beside the widest spread one, and the vectors of the other side for each.
SEED_WORDS, SEED_VECTORS = 5, 5
#: Seeds of a search for the best pairs of all.
SEED_PAIRS = 2000
#: What scores are compared to, and what sums of doubles may be off.
STEP, SLACK = 1e-6, 1e-9

Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(df: DataFrame, name: str) -> DataFrame:
    return df


def postings(left: DataFrame, right: DataFrame, left_key: str, right_key: str, keep: Keep = as_it_is) -> tuple[DataFrame, DataFrame]:
    """Both sides, (key, token, tf), with the squared norm, the weight and the tail of each word; words of one side alone only count for the norm."""
    seen = left.groupBy("token").agg(F.count("*").alias("_l")).join(right.groupBy("token").agg(F.count("*").alias("_r")), "token")
    order = keep(seen.select("token", (F.col("_l") + F.col("_r")).alias("_n"), "_r"), "tokens")

    def side(df: DataFrame, key: str, name: str) -> DataFrame:
        whole = Window.partitionBy(key)
        norms = df.groupBy(key).agg(F.sum(F.col("tf") * F.col("tf")).alias("norm2"))
        rows = df.join(order, "token").join(norms, key).withColumn("w", F.col("tf") / F.sqrt(F.col("norm2").cast("double")))
        behind = whole.orderBy(F.col("_n").desc(), F.col("token").desc()).rowsBetween(Window.unboundedPreceding, 0)
        widest = whole.orderBy(F.col("_r").desc(), F.col("token").desc())
        rows = rows.withColumns({"tail": F.sqrt(F.sum(F.col("w") * F.col("w")).over(behind)), "_widest": F.row_number().over(widest) == 1})
        return keep(rows.drop("_n", "_r"), name)

    return side(left, left_key, "left"), side(right, right_key, "right")


def seeds(left: DataFrame, right: DataFrame, left_key: str, right_key: str, words: int = SEED_WORDS, vectors: int = SEED_VECTORS) -> DataFrame:
    """Pairs that are likely to be good: at most (words + 1) x vectors a vector of the left."""
    heavy = Window.partitionBy("token").orderBy(F.col("w").desc(), right_key)
    # The filter on the row number reaches below the exchange, so that a word of all vectors sends a few rows a task.
    best = right.select("token", right_key, "w").withColumn("_rn", F.row_number().over(heavy)).where(F.col("_rn") <= vectors)
    best = best.groupBy("token").agg(F.max("w").alias("_top"), F.collect_list(right_key).alias("_best"))
    promise = Window.partitionBy(left_key).orderBy((F.col("w") * F.col("_top")).desc(), "token")
    rows = left.join(best, "token").withColumn("_rn", F.row_number().over(promise)).where((F.col("_rn") <= words) | F.col("_widest"))
    return rows.select(left_key, F.explode("_best").alias(right_key)).distinct()


def best_seeds(left: DataFrame, right: DataFrame, left_key: str, right_key: str, pairs: int = SEED_PAIRS) -> DataFrame:
    """Of the seeds the ``pairs`` with the largest products of weights, summed over the words that gave them; enough where the best pairs of all are asked for.

    They only set the bound, as all seeds do.
    """
    heavy = Window.partitionBy("token").orderBy(F.col("w").desc(), right_key)
    best = right.select("token", right_key, "w").withColumn("_rn", F.row_number().over(heavy)).where(F.col("_rn") <= SEED_VECTORS)
    best = best.groupBy("token").agg(F.max("w").alias("_top"), F.collect_list(F.struct(right_key, F.col("w").alias("_w"))).alias("_best"))
    promise = Window.partitionBy(left_key).orderBy((F.col("w") * F.col("_top")).desc(), "token")
    rows = left.join(best, "token").withColumn("_rn", F.row_number().over(promise)).where((F.col("_rn") <= SEED_WORDS) | F.col("_widest"))
    rows = rows.select(left_key, "w", F.explode("_best").alias("_b")).groupBy(left_key, F.col(f"_b.{right_key}").alias(right_key)).agg(F.sum(F.col("w") * F.col("_b._w")).alias("_part"))
    return rows.orderBy(F.col("_part").desc(), left_key, right_key).limit(pairs).select(left_key, right_key)


def exact(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The cosine of each pair; pairs without a common word have none and don't come back."""
    a = left.select(left_key, "token", F.col("tf").alias("_ltf"), F.col("norm2").alias("_l2"))
    b = right.select(right_key, "token", F.col("tf").alias("_rtf"), F.col("norm2").alias("_r2"))
    met = pairs.join(a, left_key).join(b, [right_key, "token"])
    dots = met.groupBy(left_key, right_key).agg(F.sum(F.col("_ltf") * F.col("_rtf")).alias("_dot"), F.first("_l2").alias("_l2"), F.first("_r2").alias("_r2"))
    norm = F.sqrt(F.col("_l2").cast("double")) * F.sqrt(F.col("_r2").cast("double"))
    return dots.select(left_key, right_key, (F.col("_dot") / norm).alias("text_score"))


def met(left: DataFrame, right: DataFrame, least: Column, also: Column | None = None) -> DataFrame:
    """The rows of both sides' words that can be the rarest common word of a pair whose cosine is ``least`` (over columns of the left) or more.

    ``also`` is a condition on the rows, over columns of both sides; the
    right's tail is ``_tail`` there.
    """
    asked = left.withColumn("_need", (least - SLACK) / F.col("tail"))
    lowest = asked.groupBy("token").agg(F.min("_need").alias("_low"))
    offered = right.withColumnRenamed("tail", "_tail").join(lowest, "token").where(F.col("_tail") >= F.col("_low")).drop("_low", "w", "tf", "norm2", "_widest")
    highest = offered.groupBy("token").agg(F.max("_tail").alias("_high"))
    asked = asked.join(highest, "token").where(F.col("_need") <= F.col("_high")).drop("_high", "w", "tf", "norm2", "_widest")
    rows = asked.join(offered, "token").where(F.col("_tail") >= F.col("_need"))
    return rows if also is None else rows.where(also)


def step(score: Column) -> Column:
    return F.floor(score / STEP + 0.5).cast("long")


def bounds(first: DataFrame, left_key: str, k: int) -> DataFrame:
    """By vector of the left the least cosine that could be among its ``k`` best, from the scores of its few seeds."""
    kth = F.try_element_at(F.sort_array(F.collect_list(step(F.col("text_score"))), False), F.lit(k))
    return first.groupBy(left_key).agg(((F.coalesce(kth, F.lit(0)) - 0.5) * STEP).alias("_least"))


def top_k(left: DataFrame, right: DataFrame, left_key: str, right_key: str, k: int, keep: Keep = as_it_is) -> DataFrame:
    """For each vector of the left the ``k`` of the right with the largest cosines: both keys, text_score, rank.

    The inputs are rows (key, token, tf).  ``keep`` stores the tables that are
    used more than once.
    """
    a, b = postings(left, right, left_key, right_key, keep)
    first = keep(exact(seeds(a, b, left_key, right_key, vectors=max(k, SEED_VECTORS)), a, b, left_key, right_key), "seeds")
    rest = met(a.join(bounds(first, left_key, k), left_key), b, F.col("_least")).select(left_key, right_key).distinct()
    rest = exact(rest.join(first, [left_key, right_key], "left_anti"), a, b, left_key, right_key)
    best = Window.partitionBy(left_key).orderBy(step(F.col("text_score")).desc(), right_key)
    return first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k_of_few(left: DataFrame, right: DataFrame, left_key: str, right_key: str, k: int) -> DataFrame:
    """The same rows as ``top_k``, where the left is small enough to reach every task.

    Words of the right meet those of the left where they lie, so a right that
    is partitioned by its key sends none of its words and none of its pairs:
    a vector's products are summed in its own partition, and of each partition
    no more than the ``k`` best pairs of a vector of the left go on.
    """
    a = left.withColumn("_l2", F.sum(F.col("tf") * F.col("tf")).over(Window.partitionBy(left_key))).withColumnRenamed("tf", "_ltf")
    b = right.withColumn("_r2", F.sum(F.col("tf") * F.col("tf")).over(Window.partitionBy(right_key))).withColumnRenamed("tf", "_rtf")
    dots = b.join(a, "token").groupBy(right_key, left_key).agg(F.sum(F.col("_ltf") * F.col("_rtf")).alias("_dot"), F.first("_l2").alias("_l2"), F.first("_r2").alias("_r2"))
    norm = F.sqrt(F.col("_l2").cast("double")) * F.sqrt(F.col("_r2").cast("double"))
    scores = dots.select(left_key, right_key, (F.col("_dot") / norm).alias("text_score"))
    best = Window.partitionBy(left_key).orderBy(step(F.col("text_score")).desc(), right_key)
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
