"""Scenes of several devices brought together on one clock."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import scoring
from timeloom.functions.ids import stable_id
from timeloom.functions.times import iso_z, seconds_between, without_offset
from timeloom.operators.windows import capped_overlaps


@dataclass(frozen=True)
class Config:
    tolerance_seconds: float = 8.0
    max_group_span_seconds: float = 900.0
    processor_version: str = "v1"


@dataclass(frozen=True)
class References:
    reference_scene: DataFrame
    reference_scene_member: DataFrame
    event: DataFrame


def members(scene_window: DataFrame) -> DataFrame:
    """Scenes with their clock's offset and the instants without it; an offset of 0 gives way to the other key."""
    basis = lambda k: F.get_json_object("metadata_json", f"$.time_alignment_basis.{k}")
    number = lambda k: F.nullif(basis(k).cast("double").cast("long"), F.lit(0))
    rows = scene_window.withColumn("offset_ms", F.coalesce(number("median_clock_offset_ms"), number("clock_offset_ms"), F.lit(0).cast("long")))
    rows = rows.withColumn("clock_confidence", F.coalesce(F.nullif(basis("clock_confidence"), F.lit("")), F.lit("low")))
    rows = rows.withColumn("primary_source_type", F.coalesce(F.nullif("primary_source_type", F.lit("")), F.lit("unknown")))
    rows = rows.withColumn("adjusted_start", without_offset(F.col("start_at"), F.col("offset_ms"))).withColumn("adjusted_end", without_offset(F.col("end_at"), F.col("offset_ms")))
    return rows.withColumn("priority", scoring.source_priority(F.col("primary_source_type"))).withColumn("direct", scoring.is_direct(F.col("primary_source_type")))


def election() -> Column:
    """The smallest of a group's structs is its primary member."""
    return F.struct("priority", F.when(F.col("direct"), 0).otherwise(1).alias("d"), (-F.col("confidence")).alias("c"), (-scoring.clock_rank(F.col("clock_confidence"))).alias("k"), "adjusted_start", "id")


def build(scene_window: DataFrame, created_at, config: Config = Config()) -> References:
    """Groups of scenes that overlap within the tolerance and span several devices, of all users at once."""
    rows = members(scene_window)
    rows = capped_overlaps(rows, ["user_id"], ["adjusted_start", "adjusted_end", "id"], "adjusted_start", "adjusted_end", config.tolerance_seconds, config.max_group_span_seconds)
    key = ["user_id", "group_no"]
    context = lambda k: F.get_json_object("metadata_json", f"$.screen_context.{k}")
    has_context = F.get_json_object("metadata_json", "$.screen_context").startswith("{")
    screen = F.struct(F.col("id").alias("scene_window_id"), F.col("primary_device_id").alias("device_id"), context("status").alias("status"), context("attention_score").alias("attention_score"), context("screen_device_hits").alias("screen_device_hits"))
    inside = F.struct("adjusted_start", "adjusted_end", "id")
    in_order = lambda x: F.transform(F.array_sort(F.collect_list(F.struct(inside.alias("o"), x.alias("v")))), lambda s: s["v"])
    member = F.struct(F.col("id").alias("scene_window_id"), F.col("primary_device_id").alias("device_id"), "primary_source_type", "confidence", F.col("offset_ms").alias("alignment_offset_ms"), "clock_confidence")
    groups = rows.groupBy(*key).agg(
        F.min("adjusted_start").alias("start_at"),
        F.max("adjusted_end").alias("end_at"),
        F.count("*").alias("member_count"),
        F.count_if("direct").alias("direct_member_count"),
        F.array_sort(F.collect_set("primary_device_id")).alias("device_ids"),
        F.size(F.collect_set(F.coalesce("primary_device_id", F.lit("\u0000")))).alias("devices"),
        F.array_sort(F.collect_set("primary_source_type")).alias("source_types"),
        F.max("confidence").alias("confidence"),
        F.min_by(F.struct("id", "primary_device_id", "primary_source_type", "priority"), election()).alias("primary"),
        in_order(member).alias("members"),
        F.count_if(has_context).alias("evaluated"),
        in_order(F.when(has_context & (context("status") == "attached"), screen)).alias("screens"),
    )
    groups = groups.where("devices > 1").withColumn("screens", F.filter("screens", lambda s: s.isNotNull()))
    ident = stable_id("tl-reference-scene", F.col("user_id"), iso_z(F.col("start_at")), iso_z(F.col("end_at")), F.col("primary.id"), F.lit(config.processor_version))
    by_member = lambda field: F.map_from_entries(F.transform("members", lambda m: F.struct(m["scene_window_id"].alias("key"), m[field].alias("value"))))
    meta = F.struct(
        F.transform("members", lambda m: m["scene_window_id"]).alias("member_scene_window_ids"),
        "device_ids",
        "member_count",
        "direct_member_count",
        "source_types",
        F.struct(
            F.lit("scene_window_overlap_plus_clock_offset").alias("method"),
            F.lit(config.tolerance_seconds).alias("tolerance_seconds"),
            F.round(seconds_between(F.col("start_at"), F.col("end_at")), 3).alias("aligned_span_seconds"),
            by_member("alignment_offset_ms").alias("member_offsets_ms"),
            by_member("clock_confidence").alias("member_clock_confidence"),
        ).alias("time_alignment"),
        F.struct(
            F.lit("source_priority_then_confidence").alias("method"),
            F.lit(True).alias("preferred_direct_device"),
            F.col("primary.id").alias("primary_scene_window_id"),
            F.col("primary.primary_source_type").alias("primary_source_type"),
            F.col("primary.primary_device_id").alias("primary_device_id"),
        ).alias("arbitration"),
        F.struct(F.size("screens").alias("attached_member_count"), F.col("evaluated").alias("evaluated_member_count"), F.col("screens").alias("attached_members")).alias("screen_context"),
        F.lit(config.processor_version).alias("builder_version"),
    )
    groups = groups.withColumn("id", ident).withColumn("metadata_json", F.to_json(meta))
    scenes = groups.select(
        "id", "user_id", F.col("primary.primary_device_id").alias("primary_device_id"), F.col("primary.id").alias("primary_scene_window_id"), "start_at", "end_at",
        F.col("primary.priority").alias("source_priority"), F.round("confidence", 3).alias("confidence"), F.col("primary.primary_source_type").alias("primary_source_type"), "metadata_json",
    )
    links = groups.select(F.col("id").alias("reference_scene_id"), F.col("primary.id").alias("_primary"), F.explode("members").alias("m")).select(
        "reference_scene_id", "m.scene_window_id", F.when(F.col("m.scene_window_id") == F.col("_primary"), "primary").otherwise("supporting").alias("role"), "m.alignment_offset_ms", "m.confidence"
    )
    payload = F.struct(
        F.col("id").alias("reference_scene_id"),
        F.col("primary.primary_device_id").alias("primary_device_id"),
        F.col("primary.id").alias("primary_scene_window_id"),
        F.col("members").alias("member_scene_windows"),
        F.lit(True).alias("preferred_direct_device"),
        F.lit("scene_window_overlap_plus_clock_offset").alias("time_alignment_method"),
    )
    events = groups.select(
        stable_id("tl-reference-event", F.col("id"), F.lit(config.processor_version)).alias("id"), "user_id", F.col("primary.primary_device_id").alias("device_id"), F.lit("cross_device_reference").alias("event_type"),
        "start_at", "end_at", F.col("primary.priority").alias("source_priority"), F.round("confidence", 3).alias("confidence"), F.col("primary.primary_source_type").alias("primary_source_type"),
        F.to_json(payload).alias("payload_json"), F.lit(f"cross_device_aligner_{config.processor_version}").alias("created_by"), F.lit(created_at).cast("timestamp").alias("created_at"),
    )
    return References(schema.shaped(scenes, "reference_scene", status="stable"), schema.shaped(links, "reference_scene_member"), schema.shaped(events, "event"))
