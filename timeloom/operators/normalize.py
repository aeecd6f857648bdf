"""Content spans: what scenes and events say, as searchable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import scoring, text
from timeloom.functions.ids import stable_id
from timeloom.functions.times import day_of

NAME = "content_normalizer"


def reference_of_scene(reference_scene: DataFrame, member: DataFrame) -> DataFrame:
    """The first reference scene of each scene."""
    rows = member.join(reference_scene.select(F.col("id").alias("reference_scene_id"), "start_at"), "reference_scene_id")
    return rows.groupBy("scene_window_id").agg(F.min_by("reference_scene_id", F.struct("start_at", "reference_scene_id")).alias("reference_scene_id"))


def _field(column: str, key: str) -> Column:
    return text.truthy(F.get_json_object(column, f"$.{key}"))


def visual_text(column: str = "metadata_json") -> Column:
    """The visual fields of a scene as labelled lines; lists and objects of any depth become text."""
    labels = {"setting": "Setting", "scene_labels": "Scene labels", "actions": "Actions", "people_present": "People present", "notable_objects": "Objects", "visible_text": "Visible text", "timeline_events": "Timeline events"}
    said = lambda k: text.json_text(F.nullif(F.nullif(_field(column, k), F.lit("[]")), F.lit("{}")))
    return text.join_parts(_field(column, "visual_summary"), *[F.concat(F.lit(f"{label}: "), said(k)) for k, label in labels.items()])


def activity_text(column: str = "payload_json") -> Column:
    facts = text.joined_facts(F.from_json(F.get_json_object(column, "$.observed_facts"), "array<string>"), limit=4)
    return text.join_parts(_field(column, "summary"), _field(column, "specific_activity"), F.concat(F.lit("Facts: "), facts))


def scene_spans(scene_window: DataFrame, references: DataFrame, version: str) -> DataFrame:
    """Up to two spans a scene: its transcript, unless it is media or foreign room sound, and its picture."""
    rows = scene_window.join(references.withColumnRenamed("scene_window_id", "id"), "id", "left").drop("status")
    of = lambda k: _field("metadata_json", k)
    source = F.col("primary_source_type")
    heard = F.coalesce(text.squeeze(of("english_translation")), text.squeeze(of("transcript")))
    common = ["user_id", F.col("primary_device_id").alias("device_id"), F.col("id").alias("scene_window_id"), "reference_scene_id", "start_at", "end_at", "source_priority"]
    meta = lambda **more: F.to_json(F.struct(F.lit("scene_window").alias("source_table"), source.alias("primary_source_type"), *[v.alias(k) for k, v in more.items()]))
    spoken = rows.where(heard.isNotNull() & scoring.keeps_speech(of("source_type"), of("primary_language_code"))).select(
        stable_id("tl-content-span", F.col("id"), F.lit("transcript"), F.lit(version)).alias("id"), *common, of("transcript_artifact_id").alias("artifact_id"), F.lit("transcript").alias("span_type"),
        F.when(source.isin("camera_audio", "camera_visual"), "camera_audio").otherwise(source).alias("modality"), F.coalesce(of("file_name"), of("clip_stem")).alias("title"), heard.alias("text"),
        F.coalesce(of("primary_language_code"), of("language")).alias("language"), "confidence",
        meta(has_translation=of("english_translation").isNotNull(), quality_flags=of("quality_flags"), source_type=of("source_type")).alias("metadata_json"),
    )
    seen = rows.withColumn("_text", visual_text()).where("_text IS NOT NULL").select(
        stable_id("tl-content-span", F.col("id"), F.lit("visual_summary"), F.lit(version)).alias("id"), *common, of("visual_artifact_id").alias("artifact_id"), F.lit("visual_summary").alias("span_type"),
        F.lit("camera_visual").alias("modality"), F.coalesce(of("clip_stem"), of("recording_group")).alias("title"), F.col("_text").alias("text"), F.lit(None).cast("string").alias("language"),
        F.coalesce(F.nullif(of("visual_confidence").try_cast("double"), F.lit(0.0)), F.col("confidence")).alias("confidence"),
        meta(clip_stem=of("clip_stem"), recording_group=of("recording_group"), setting=of("setting"), scene_labels=of("scene_labels"), actions=of("actions"), people_present=of("people_present"), notable_objects=of("notable_objects"), visible_text=of("visible_text"), timeline_events=of("timeline_events")).alias("metadata_json"),
    )
    return spoken.unionByName(seen)


def event_spans(events: DataFrame, version: str) -> DataFrame:
    """At most one span an event: what was said at the desk, or what was done."""
    of = lambda k: _field("payload_json", k)
    common = ["user_id", "device_id", F.col("id").alias("event_id"), "start_at", "end_at", "source_priority", "confidence"]
    kind = F.col("event_type")
    speaker = F.get_json_object("payload_json", "$.speaker_id")
    meta = lambda *keys: F.to_json(F.struct(F.lit("event").alias("source_table"), kind.alias("event_type"), *[of(k).alias(k) for k in keys]))
    spoken = events.withColumn("_text", text.squeeze(of("transcription"))).where((kind == "desktop_audio_context") & F.col("_text").isNotNull()).select(
        stable_id("tl-content-span", F.col("id"), F.lit("desktop_audio"), F.lit(version)).alias("id"), *common, F.lit("transcript").alias("span_type"), F.lit("desktop_audio").alias("modality"),
        F.coalesce(of("app_name"), of("device_name")).alias("title"), F.col("_text").alias("text"), F.concat(F.lit("speaker_"), speaker).alias("speaker_label"), meta("device_name", "app_name", "machine_id").alias("metadata_json"),
    )
    done = events.withColumn("_text", activity_text()).where((kind == "activity_context") & F.col("_text").isNotNull()).select(
        stable_id("tl-content-span", F.col("id"), F.lit("activity_summary"), F.lit(version)).alias("id"), *common, F.lit("activity_summary").alias("span_type"), F.col("primary_source_type").alias("modality"),
        F.coalesce(of("activity_type"), of("coarse_category")).alias("title"), F.col("_text").alias("text"), F.lit(None).cast("string").alias("speaker_label"), meta("activity_type", "coarse_category", "primary_app_name").alias("metadata_json"),
    )
    return spoken.unionByName(done)


def build(scene_window: DataFrame, events: DataFrame, reference_scene: DataFrame, member: DataFrame, created_at, version: str = "v1") -> DataFrame:
    """The table content_span of all users and days."""
    spans = scene_spans(scene_window, reference_of_scene(reference_scene, member), version).unionByName(event_spans(events, version), allowMissingColumns=True)
    spans = spans.withColumn("created_by", F.lit(f"{NAME}_{version}")).withColumn("created_at", F.lit(created_at).cast("timestamp"))
    return schema.shaped(spans, "content_span", status="active")


def days(events: DataFrame, scene_window: DataFrame, offset_hours: float = 0.0) -> DataFrame:
    """Every user's days with events or scenes."""
    one = lambda df: df.select("user_id", day_of(F.col("start_at"), offset_hours).alias("day"))
    return one(events).unionByName(one(scene_window)).distinct()
