"""Episodes: blocks of work that absorb short interruptions, recording control, and the rest.

Whether a row is absorbed depends on its two neighbours alone, so the whole
grouping is a look at the rows before and after and a running sum, by ranges of time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import text
from timeloom.functions.ids import stable_id
from timeloom.functions.times import day_of, iso_z, seconds_between
from timeloom.operators.ranges import Scan
from timeloom.operators.windows import dominant, numbered, ordered

# Activities by the class that groups them.
WORK = ["development", "mixed_work"]
CAPTURE = ["capture_control"]
INTERRUPTIBLE = ["browser", "browser_research", "unknown", "documents", "system_navigation", "system_settings"]


@dataclass(frozen=True)
class Config:
    max_gap_seconds: float = 300.0
    interruption_max_seconds: float = 120.0
    builder_version: int = 1
    event_types: tuple[str, ...] = ("activity_context",)
    day_offset_hours: float = 0.0


def activity_class(activity: Column) -> Column:
    return F.when(activity.isin(WORK), "work").when(activity.isin(CAPTURE), "capture").when(activity.isin(INTERRUPTIBLE), "interruptible").otherwise("other")


def label(df: DataFrame, keys: list[str], order: list, start: str, end: str, kind: str, max_gap: float = 300.0, interruption_max: float = 120.0) -> DataFrame:
    """Add role, episode_type and group_no.

    ``kind`` holds work, capture, interruptible or other.  A null end is the
    start; gaps count from the end of the row before, never below 0.
    """
    last = F.coalesce(F.col(end), F.col(start))
    # Null where there is no row on one of the sides.
    gap = lambda a_end, b_start: F.when(a_end.isNotNull() & b_start.isNotNull(), F.greatest(F.lit(0.0), seconds_between(a_end, b_start)))
    scan = Scan(df, keys, order)
    gap_in, gap_out = gap(scan.before(last), F.col(start)), gap(last, scan.after(start))
    absorbed = (
        (F.col(kind) == "interruptible")
        & (scan.before(kind) == "work")
        & (scan.after(kind) == "work")
        & (F.greatest(F.lit(0.0), seconds_between(F.col(start), last)) <= interruption_max)
        & (gap_in <= max_gap)
        & (gap_out <= max_gap)
    )
    rows = scan.rows().select(*df.columns, gap_in.alias("_gap"), F.coalesce(absorbed, F.lit(False)).alias("_absorbed"))
    rows = rows.withColumn("episode_type", F.when(F.col(kind) == "capture", "capture_control").when((F.col(kind) == "work") | F.col("_absorbed"), "work_block").otherwise("unclassified"))
    scan = Scan(rows, keys, order)
    last_type = scan.before("episode_type")
    new = last_type.isNull() | (F.col("episode_type") != last_type) | (F.col("_gap") > max_gap)
    role = F.when(F.col("_absorbed"), "interruption").otherwise("primary")
    rows = scan.rows().select(*df.columns, "episode_type", role.alias("role"), F.coalesce(new, F.lit(False)).cast("int").alias("_new"))
    return numbered(rows, keys, order, "_new", "group_no")


def inputs(events: DataFrame, config: Config = Config()) -> DataFrame:
    """Events with day, activity, app, summary and signal taken from their payloads."""
    field = lambda path: text.truthy(F.get_json_object("payload_json", f"$.{path}"))
    focus = F.col("event_type") == "app_focus"
    activity = F.when(focus, field("category")).otherwise(F.coalesce(field("activity_type"), field("coarse_category")))
    app = F.when(focus, field("frontmost_app_name")).otherwise(F.coalesce(field("primary_app_name"), field("frontmost_app_name")))
    return events.where(F.col("event_type").isin(*config.event_types)).select(
        "id",
        "user_id",
        "start_at",
        F.coalesce("end_at", "start_at").alias("end_at"),
        "confidence",
        day_of(F.col("start_at"), config.day_offset_hours).alias("day"),
        F.coalesce(F.lower(F.trim(activity)), F.lit("unknown")).alias("activity"),
        app.alias("app"),
        F.coalesce(field("summary"), field("specific_activity"), field("coarse_category"), F.lit("Unclassified activity")).alias("summary"),
        F.lower(field("quality_assessment.signal_quality")).alias("signal"),
    )


def confidence(kind: Column, base: Column, interruptions: Column, interrupted: Column, total: Column, low_share: Column, primaries: Column, apps: Column) -> Column:
    """The mean confidence of the primary events, less what speaks against the block, more for a long one."""
    long = F.greatest(F.lit(1.0), total)
    cut = F.when(interruptions > 0, 0.05 + F.least(F.lit(0.2), interrupted / long * 0.25)).otherwise(0.0)
    value = base - F.when(kind == "unclassified", 0.15).otherwise(0.0) - cut - F.when(low_share > 0.5, 0.1).otherwise(0.0)
    value = value + F.when((kind == "work_block") & (primaries >= 2) & (long >= 600), 0.05).otherwise(0.0) - F.when(apps > 2, 0.05).otherwise(0.0)
    return F.greatest(F.lit(0.15), F.least(F.lit(0.95), value))


#: Values that can matter for a text of SEARCH_CHARS, each of which takes a character and a separator of three.
SEARCH_CHARS = 2000
SHOWN = SEARCH_CHARS // 4 + 1


def tallied(rows: DataFrame, group: list[str], columns: list[str], place: str) -> DataFrame:
    """For each group and column c: c_counts, JSON of how often each value occurs, by value; and c_values, the first ones in order.

    Two aggregations: values with partial counts first, then the few of each
    group, so that no list of a group's rows is made.
    """
    each = rows.select(*group, F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v"), F.col(place).alias("at")) for c in columns])).alias("x")).select(*group, "x.*").where("v IS NOT NULL")
    values = each.groupBy(*group, "c", "v").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    parts = []
    for c in columns:
        mine = F.col("c") == c
        counts = F.array_sort(F.collect_list(F.when(mine, F.struct(F.col("v").alias("key"), F.col("n").alias("value")))))
        first = F.slice(F.array_sort(F.collect_list(F.when(mine, F.struct("first", "v")))), 1, SHOWN)
        parts += [F.to_json(F.map_from_entries(counts)).alias(f"{c}_counts"), F.transform(first, lambda x: x["v"]).alias(f"{c}_values")]
    return values.groupBy(*group).agg(*parts)


def title(kind: Column, app: Column) -> Column:
    name = F.when(kind == "capture_control", "Capture control").when(kind == "work_block", "Work block").otherwise("Unclassified activity")
    return F.concat(name, F.coalesce(F.concat(F.lit(" in "), app), F.lit("")))


def hundredths(x: Column) -> Column:
    """Rounded to two places; what is a half but for an error in the last bits goes up."""
    return F.round(x.cast("decimal(18,12)"), 2).cast("double")


def build(events: DataFrame, built_at, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """The tables episode and episode_event of all users and days in ``events``."""
    rows = inputs(events, config).withColumn("kind", activity_class(F.col("activity")))
    order = ["start_at", "end_at", "id"]
    group = ["user_id", "day", "group_no"]
    rows = label(rows, ["user_id", "day"], order, "start_at", "end_at", "kind", config.max_gap_seconds, config.interruption_max_seconds)
    rows = rows.withColumn("ordinal", F.row_number().over(ordered(group, order)).cast("long"))
    # Whole microseconds, so that sums don't depend on the order of the rows.
    rows = rows.withColumn("micros", F.greatest(F.lit(0), F.timestamp_diff("MICROSECOND", F.col("start_at"), F.col("end_at"))))
    primary = F.col("role") == "primary"
    # The metadata lists every summary; of other columns each value is there once, with its count and first place.
    said = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.col("summary").alias("v")))), lambda x: x["v"])
    tallies = tallied(rows, group, ["activity", "app", "signal"], "ordinal")

    blocks = rows.groupBy(*group).agg(
        F.first("episode_type").alias("episode_type"),
        F.min("start_at").alias("started_at"),
        F.max("end_at").alias("ended_at"),
        F.count("*").alias("event_count"),
        F.count_if(primary).alias("primaries"),
        F.count_if(~primary).alias("interruptions"),
        F.avg(F.when(primary, F.col("confidence"))).alias("base"),
        (F.sum("micros") / 1e6).alias("total"),
        (F.sum(F.when(primary, F.col("micros")).otherwise(0)) / 1e6).alias("primary_seconds"),
        (F.sum(F.when(primary, 0).otherwise(F.col("micros"))) / 1e6).alias("interrupted"),
        (F.count_if(primary & (F.col("signal") == "low")) / F.greatest(F.lit(1), F.count_if(primary))).alias("low_share"),
        F.count_distinct(F.when(primary, F.col("app"))).alias("apps"),
        said.alias("summaries"),
    )
    blocks = blocks.join(tallies, group, "left")
    main = rows.where(primary)
    for name, value in (("dominant_app", "app"), ("dominant_activity", "activity")):
        blocks = blocks.join(dominant(main, group, value, F.col("ordinal"), out=name).drop(f"{name}_count"), group, "left")
    blocks = blocks.withColumn("title", title(F.col("episode_type"), F.col("dominant_app")))
    found = F.concat(F.array("title", "episode_type"), F.col("summaries"), *[F.coalesce(f"{c}_values", F.array().cast("array<string>")) for c in ("activity", "app")])
    blocks = blocks.withColumn("search_text", F.substring(F.array_join(F.array_distinct(F.transform(F.filter(found, lambda x: F.coalesce(x, F.lit("")) != ""), lambda x: F.trim(x))), " | "), 1, SEARCH_CHARS))
    meta = F.struct(
        "day",
        "title",
        "event_count",
        F.col("primaries").alias("primary_event_count"),
        F.col("interruptions").alias("interruption_count"),
        F.coalesce("dominant_activity", "episode_type").alias("dominant_activity_type"),
        F.col("dominant_app").alias("dominant_app_name"),
        *[F.coalesce(f"{c}_counts", F.lit("{}")).alias(n) for c, n in (("activity", "activity_counts"), ("app", "app_counts"), ("signal", "signal_quality_counts"))],
        F.col("primary_seconds").alias("primary_duration_seconds"),
        F.col("interrupted").alias("interruption_duration_seconds"),
        F.col("summaries").alias("event_summaries"),
    )
    score = confidence(*[F.col(c) for c in ("episode_type", "base", "interruptions", "interrupted", "total", "low_share", "primaries", "apps")])
    ident = stable_id("tl-episode", F.col("user_id"), F.col("day"), F.lit(config.builder_version), F.col("group_no"), F.col("episode_type"), iso_z(F.col("started_at")), iso_z(F.col("ended_at")))
    blocks = blocks.select(
        "*", ident.alias("id"), hundredths(score).alias("confidence"), F.lit(config.builder_version).alias("builder_version"), F.lit(built_at).cast("timestamp").alias("built_at"), F.to_json(meta).alias("metadata_json")
    )
    links = rows.join(blocks.select(*group, F.col("id").alias("episode_id")), group).select("episode_id", F.col("id").alias("event_id"), "ordinal", "role")
    return schema.shaped(blocks, "episode", status="provisional"), schema.shaped(links, "episode_event")
