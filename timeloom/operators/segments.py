"""Capture segments: packets with counts, flags and confidence, and the events made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import scoring
from timeloom.functions.ids import stable_id
from timeloom.functions.times import iso_z, seconds_between
from timeloom.operators.windows import Keep, anchored_segments, as_it_is, first_distinct, ordered, sample_places

# What each flag takes off a segment's confidence.
FLAG_COST = {"thin_window_strip": 0.25, "missing_window_titles": 0.15, "brief_glimpse": 0.1, "mostly_idle": 0.2, "mostly_unchanged": 0.15, "idle_unchanged_run": 0.1}
# Thresholds of flags and of leaving a segment uninterpreted.
IDLE_SHARE, UNCHANGED_SHARE = 0.6, 0.6
SKIP_CAPTURES, SKIP_NOVEL, SKIP_NEAR_SHARE, SKIP_IDLE_SHARE = 4, 2, 0.85, 0.5


def flags(median_height: Column, title_share: Column, captures: Column, category: Column, idle_share: Column, unchanged_share: Column) -> Column:
    on = {
        "thin_window_strip": median_height <= 100,
        "missing_window_titles": title_share < 0.2,
        "brief_glimpse": captures == 1,
        "self_capture": category == "capture_control",
        "mostly_idle": idle_share >= IDLE_SHARE,
        "mostly_unchanged": unchanged_share >= UNCHANGED_SHARE,
        "idle_unchanged_run": (idle_share >= IDLE_SHARE) & (unchanged_share >= UNCHANGED_SHARE),
    }
    return F.filter(F.array(*[F.when(test, name) for name, test in on.items()]), lambda x: x.isNotNull())


def confidence(found: Column) -> Column:
    cost = F.lit(0.9)
    for flag, part in FLAG_COST.items():
        cost = cost - F.when(F.array_contains(found, flag), part).otherwise(0.0)
    return F.greatest(F.lit(0.2), cost)


def skip_reasons(category: Column, captures: Column, idle_share: Column, near_share: Column, novel: Column, title_share: Column, found: Column) -> Column:
    has = lambda flag: F.array_contains(found, flag)
    unchanged = (captures >= 3) & has("mostly_unchanged") & has("missing_window_titles")
    heavy = (captures >= SKIP_CAPTURES) & (near_share >= SKIP_NEAR_SHARE) & (novel <= SKIP_NOVEL)
    low = (title_share < 0.2) | has("missing_window_titles") | (category == "unknown")
    late = heavy & low & ~unchanged
    reasons = [
        F.when(unchanged, "low_signal_duplicate_run"),
        F.when(has("idle_unchanged_run") & (captures >= 2), "idle_unchanged_run"),
        F.when(late, "low_signal_duplicate_run").when(heavy & (idle_share >= SKIP_IDLE_SHARE), "idle_duplicate_run"),
    ]
    return F.filter(F.array(*reasons), lambda x: x.isNotNull())


def segment(observations: DataFrame, gap_seconds: float = 45.0, keep: Keep = as_it_is) -> DataFrame:
    """Observations with change signals and segment_no, by user and device."""
    return anchored_segments(observations, ["user_id", "device_id"], ["at", "json_path"], "at", "app_name", "window_title", "sha256", "dhash", near=None, gap=gap_seconds, keep=keep)


def packets(rows: DataFrame, image_limit: int = 3) -> DataFrame:
    """One row a segment; ``rows`` carry segment_no and the change signals."""
    key = ["user_id", "device_id", "segment_no"]
    rows = rows.withColumn("n", F.row_number().over(ordered(key, ["at", "json_path"])))
    later, titled = F.col("n") > 1, F.coalesce("window_title", F.lit("")) != ""
    image = lambda test: F.transform(F.array_sort(F.collect_list(F.when(F.col("image_path").isNotNull() & test, F.struct("n", "image_path")))), lambda x: x["image_path"])
    out = rows.groupBy(*key).agg(
        F.min("at").alias("start_at"),
        F.max("at").alias("end_at"),
        F.min_by("app_name", "n").alias("primary_app_name"),
        F.min_by("platform", "n").alias("platform"),
        F.min_by("window_id", "n").alias("window_id"),
        F.count("*").alias("capture_count"),
        F.count_if(F.col("was_input_idle")).alias("idle_capture_count"),
        F.count_if(later & F.col("exact_duplicate")).alias("exact_duplicate_capture_count"),
        F.count_if(later & F.col("near_duplicate")).alias("near_duplicate_capture_count"),
        F.count_if(titled).alias("titled"),
        F.median("width").alias("median_width"),
        F.median("height").alias("median_height"),
        first_distinct(F.col("n"), F.col("window_title"), 3).alias("window_title_examples"),
        image(~later | ~F.col("near_duplicate")).alias("_novel_images"),
        image(F.lit(True)).alias("_images"),
        F.min_by("json_path", "n").alias("first_json_path"),
        F.max_by("json_path", "n").alias("last_json_path"),
        F.min_by("image_path", "n").alias("first_image_path"),
        F.max_by("image_path", "n").alias("last_image_path"),
    )
    n, near = F.col("capture_count"), F.col("near_duplicate_capture_count")
    out = out.withColumn("coarse_category", scoring.app_category(F.col("primary_app_name")))
    out = out.withColumn("idle_share", F.col("idle_capture_count") / n).withColumn("title_share", F.col("titled") / n).withColumn("near_share", near / F.greatest(F.lit(1), n - 1))
    out = out.withColumn("novel_capture_count", F.greatest(F.lit(1), n - near))
    out = out.withColumn("quality_flags", flags(F.col("median_height"), F.col("title_share"), n, F.col("coarse_category"), F.col("idle_share"), F.col("near_share")))
    out = out.withColumn("segment_confidence", F.round(confidence(F.col("quality_flags")), 2))
    rounded = lambda c: F.round(c, 3)
    reasons = skip_reasons(F.col("coarse_category"), n, rounded("idle_share"), rounded("near_share"), F.col("novel_capture_count"), rounded("title_share"), F.col("quality_flags"))
    out = out.withColumn("interpretation_skip_reasons", reasons).withColumn("should_queue_interpretation", F.size(reasons) == 0)
    images = F.when(F.size("_novel_images") > 0, F.col("_novel_images")).otherwise(F.col("_images"))
    places = F.transform(sample_places(F.size(images)), lambda i: F.get(images, i.cast("int")))
    out = out.withColumn("sample_image_paths", F.when(F.size(images) <= image_limit, images).otherwise(F.slice(places, 1, image_limit)))
    out = out.withColumn("duration_seconds", seconds_between(F.col("start_at"), F.col("end_at")))
    ident = stable_id("tl-segment", F.col("user_id"), F.col("device_id"), iso_z(F.col("start_at")), iso_z(F.col("end_at")), F.col("primary_app_name"), F.col("window_id"))
    out = out.withColumn("id", ident).withColumn("segment_index", F.row_number().over(ordered(["user_id", "device_id"], ["segment_no"])))
    return out.drop("_novel_images", "_images", "titled")


def focus_events(found: DataFrame, created_at, created_by: str = "metadata_categorizer_v1") -> DataFrame:
    """One app_focus event a segment."""
    payload = F.struct(
        F.col("coarse_category").alias("category"),
        F.col("primary_app_name").alias("frontmost_app_name"),
        "platform",
        "capture_count",
        "idle_capture_count",
        F.round("idle_share", 3).alias("idle_capture_ratio"),
        "exact_duplicate_capture_count",
        "near_duplicate_capture_count",
        F.round("near_share", 3).alias("near_duplicate_ratio"),
        "novel_capture_count",
        "should_queue_interpretation",
        "interpretation_skip_reasons",
        "window_id",
        "window_title_examples",
        F.round("title_share", 3).alias("window_title_present_rate"),
        F.struct(F.round("median_width", 1).alias("median_width"), F.round("median_height", 1).alias("median_height")).alias("window_bounds_summary"),
        F.col("quality_flags").alias("flags"),
        "first_json_path",
        "last_json_path",
        "first_image_path",
        "last_image_path",
        F.col("id").alias("segment_packet_id"),
    )
    rows = found.select(
        stable_id("tl-event", F.col("user_id"), F.col("device_id"), iso_z(F.col("start_at")), iso_z(F.col("end_at")), F.col("primary_app_name"), F.col("window_id")).alias("id"),
        "user_id",
        "device_id",
        F.lit("app_focus").alias("event_type"),
        "start_at",
        "end_at",
        F.lit(1).alias("source_priority"),
        F.col("segment_confidence").alias("confidence"),
        F.lit("app_metadata").alias("primary_source_type"),
        F.to_json(payload).alias("payload_json"),
        F.lit(created_by).alias("created_by"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )
    return schema.shaped(rows, "event")


def day_overview(found: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """By day: captures by category and by application, the heaviest of each, and what is left uninterpreted; rows without a key drop out.

    Each segment is counted once by its category and once by its application, in
    one pass over ``found``; the sums of the day are those over its categories.
    """
    sums = {
        "capture_count": F.col("capture_count"),
        "segment_count": F.lit(1),
        "idle_capture_count": F.col("idle_capture_count"),
        "near_duplicate_capture_count": F.col("near_duplicate_capture_count"),
        "suppressed_segment_count": F.when(~F.col("should_queue_interpretation"), 1).otherwise(0),
        "suppressed_capture_count": F.when(F.col("should_queue_interpretation"), 0).otherwise(F.col("capture_count")),
    }
    named = {"category": "coarse_category", "app": "primary_app_name"}
    by = F.explode(F.array(*[F.struct(F.lit(name).alias("by"), F.col(column).cast("string").alias("value")) for name, column in named.items()]))
    rows = found.where(F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x)).select(*keys, "start_at", "end_at", position.alias("_position"), *[c.cast("long").alias(n) for n, c in sums.items()], by.alias("_by"))
    counts = rows.groupBy(*keys, "_by").agg(F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at"), F.min("_position").alias("_first"), *[F.sum(n).alias(n) for n in sums])
    n, value = F.col("capture_count"), F.col("_by.value")
    whole = lambda c: F.when(F.col("_by.by") == "category", F.col(c))
    columns = []
    for name in named:
        mine = F.col("_by.by") == name
        columns.append(F.map_from_entries(F.array_sort(F.collect_list(F.when(mine, F.struct(value.alias("key"), n.alias("value")))))).alias(f"{name}_counts"))
        # One struct decides: most captures, then earliest position.
        best = F.min(F.when(mine & (F.coalesce(value, F.lit("")) != ""), F.struct((-n).alias("n"), F.col("_first").alias("f"), value.alias("v"))))
        columns.append(F.coalesce(best["v"], F.lit("unknown")).alias(f"dominant_{name}"))
    return counts.groupBy(*keys).agg(F.min(whole("start_at")).alias("start_at"), F.max(whole("end_at")).alias("end_at"), *[F.sum(whole(c)).alias(c) for c in sums], *columns)


def overview_events(found: DataFrame, created_at, created_by: str = "metadata_categorizer_v1") -> DataFrame:
    """One activity_context event a user, device and day."""
    found = found.withColumn("day", F.date_format("start_at", "yyyy-MM-dd"))
    rows = day_overview(found, ["user_id", "device_id", "day"], F.col("segment_no"))
    payload = F.struct(
        F.lit("capture_day_overview").alias("summary_type"),
        "capture_count",
        "segment_count",
        "idle_capture_count",
        "near_duplicate_capture_count",
        "suppressed_segment_count",
        "suppressed_capture_count",
        "dominant_category",
        F.col("dominant_app").alias("dominant_app_name"),
        "category_counts",
        "app_counts",
    )
    rows = rows.select(
        stable_id("tl-summary", F.col("user_id"), F.col("device_id"), F.col("day"), iso_z(F.col("start_at")), iso_z(F.col("end_at"))).alias("id"),
        "user_id",
        "device_id",
        F.lit("activity_context").alias("event_type"),
        "start_at",
        "end_at",
        F.lit(1).alias("source_priority"),
        F.lit(0.75).alias("confidence"),
        F.lit("app_metadata").alias("primary_source_type"),
        F.to_json(payload).alias("payload_json"),
        F.lit(created_by).alias("created_by"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )
    return schema.shaped(rows, "event")
