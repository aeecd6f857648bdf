"""Similar scenes of two devices: shared words and nearness in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions import text
from timeloom.functions.times import seconds_between
from timeloom.operators import similarity

# Weights of text and time in a pair's score.
TEXT_WEIGHT, TIME_WEIGHT = 0.65, 0.35


def blob(column: str = "metadata_json") -> Column:
    """All that a scene's metadata says, as one text."""
    of = lambda k: F.coalesce(F.get_json_object(column, f"$.{k}"), F.lit(""))
    listed = lambda k: F.array_join(F.coalesce(F.from_json(F.get_json_object(column, f"$.{k}"), "array<string>"), F.array().cast("array<string>")), " ")
    parts = [of("transcript_excerpt"), of("transcript"), of("visual_summary"), of("setting"), *[listed(k) for k in ("scene_labels", "actions", "people_present", "notable_objects", "visible_text")]]
    return F.concat_ws(" ", *parts)


def term_counts(docs: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, token, tf)."""
    return docs.select(key, F.explode(words).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"))


def time_score(left: Column, right: Column, max_gap_minutes: float) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(seconds_between(left, right)) / 60 / max_gap_minutes)


def bucket(at: str, width: int) -> Column:
    """The number of the stretch of ``width`` microseconds that an instant lies in."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp"), F.col(at).cast("timestamp")) / width)


def near_in_time(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_at: str, right_at: str, gap_minutes: float) -> DataFrame:
    """Pairs of keys no more than the gap apart: equal buckets of that length, or neighbouring ones."""
    width = max(1, int(gap_minutes * 60_000_000))
    a = left.select(left_key, left_at, bucket(left_at, width).alias("_b"))
    b = right.select(right_key, right_at, F.explode(F.sequence(bucket(right_at, width) - 1, bucket(right_at, width) + 1)).alias("_b"))
    near = F.abs(seconds_between(F.col(left_at), F.col(right_at))) <= gap_minutes * 60
    return a.join(b, "_b").where(near).select(left_key, right_key)


#: Scores are rounded to this before they are compared, gaps in minutes to the next.
SCORE_STEP, GAP_STEP = 1e-4, 1e-2
#: Parts of the time limit in each of which one pair is a seed.
STRETCHES = 16


def rounded(x: Column, step: float) -> Column:
    """A number of steps."""
    return F.floor(x / step + 0.5).cast("long")


def report(left: DataFrame, right: DataFrame, max_gap_minutes: float = 90.0, top_k: int = 12, keep: similarity.Keep = similarity.as_it_is) -> DataFrame:
    """The best pairs of (id, start_at, text) rows by 0.65 text and 0.35 time.

    Scores are compared after rounding to four places; of equals the nearer
    comes first (minutes to two places), then the earlier left row, then ids.

    The k-th best of some seeds, by shared words and by time, is a bound.  If
    it is beyond what time alone can give, a better pair needs words in common
    of a known weight, and meets on its rarest common one; otherwise a pair
    needs half of the bound from words or the other half from time, so that the
    time limit shrinks as the bound grows.  One number reaches the driver.
    """
    if max_gap_minutes <= 0:
        raise ValueError("max_gap_minutes must be above 0")
    ids = ["left_id", "right_id"]
    a, b = (df.select(F.col("id").alias(f"{s}_id"), F.col("start_at").alias(f"{s}_start"), F.col("text").alias(f"{s}_text")) for df, s in ((left, "left"), (right, "right")))
    a, b = keep(a, "left-rows"), keep(b, "right-rows")
    starts = a.select("left_id", "left_start"), b.select("right_id", "right_start")
    l_words, r_words = similarity.postings(term_counts(a, "left_id", text.tokens(F.col("left_text"))), term_counts(b, "right_id", text.tokens(F.col("right_text"))), *ids, keep)

    def scored(pairs: DataFrame) -> DataFrame:
        found = pairs.join(similarity.exact(pairs, l_words, r_words, *ids), ids, "left").join(starts[0], "left_id").join(starts[1], "right_id")
        words = F.coalesce("text_score", F.lit(0.0))
        time = time_score(F.col("left_start"), F.col("right_start"), max_gap_minutes)
        return found.select(*ids, "left_start", words.alias("text_score"), time.alias("time_score"), (words * TEXT_WEIGHT + time * TIME_WEIGHT).alias("score"), F.abs(seconds_between(F.col("left_start"), F.col("right_start"))).alias("gap_seconds"))

    stretch = max(1, int(max_gap_minutes * 60_000_000 / STRETCHES))
    one = lambda df, key, at: df.groupBy(bucket(at, stretch).alias("_b")).agg(F.min(key).alias(key))
    pairs = similarity.best_seeds(l_words, r_words, *ids).unionByName(one(a, "left_id", "left_start").join(one(b, "right_id", "right_start"), "_b").select(*ids)).distinct()
    first = keep(scored(pairs), "seeds")
    kth = first.select(rounded(F.col("score"), SCORE_STEP).alias("s")).orderBy(F.col("s").desc()).limit(top_k).agg(F.min("s"), F.count("*")).first()
    least = max(0.0, (kth[0] - 0.5) * SCORE_STEP - similarity.SLACK) if kth[1] == top_k else 0.0

    half = least <= TIME_WEIGHT
    from_text = least / 2 if half else least - TIME_WEIGHT
    l_at, r_at = l_words.join(starts[0], "left_id"), r_words.join(starts[1], "right_id")
    most = F.col("tail") * F.col("_tail") * TEXT_WEIGHT + time_score(F.col("left_start"), F.col("right_start"), max_gap_minutes) * TIME_WEIGHT
    rest = similarity.met(l_at, r_at, F.lit(from_text / TEXT_WEIGHT), most >= least - similarity.SLACK).select(*ids)
    if half:
        rest = rest.unionByName(near_in_time(a, b, *ids, "left_start", "right_start", max_gap_minutes * (1 - least / 2 / TIME_WEIGHT)))
    rest = scored(rest.distinct().join(first, ids, "left_anti"))
    order = [rounded(F.col("score"), SCORE_STEP).desc(), rounded(F.col("gap_seconds") / 60, GAP_STEP), "left_start", *ids]
    return first.unionByName(rest).where(rounded(F.col("score"), SCORE_STEP) > 0).orderBy(*order).limit(top_k)
