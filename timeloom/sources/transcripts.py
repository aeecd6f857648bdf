"""Transcripts of a recorder and of cameras, from their JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.functions import text
from timeloom.functions.times import local_instant

CHUNK = (
    "struct<chunk_index:bigint,start_seconds:double,end_seconds:double,duration_seconds:double,source_type:string,primary_language_code:string,transcript:string,english_translation:string,"
    "translation_note:string,notes:string>"
)
FILES = (
    "struct<files:array<struct<file_name:string,source_path:string,duration_seconds:double,recorder_timestamp:string,modified_time:string,language:string,transcript:string,segment_count:bigint,"
    f"avg_logprob:double,chunks:array<{CHUNK}>>>>"
)
CLIPS = "struct<clips:array<struct<clip_stem:string,timestamp:string,recording_group:string,duration_seconds:double,source_paths:struct<wav:string,mp4:string>,clip_metadata:string>>>"
UNITS = (
    "struct<transcripts:array<struct<transcription_unit_id:string,clip_stem:string,recording_group:string,start_seconds:double,end_seconds:double,duration_seconds:double,transcript:string,language:string,"
    "source_path:string,quality_flags:array<string>>>>"
)
RECORDS = "struct<records:array<string>>"


def recorder_chunks(documents: DataFrame, zone: str) -> DataFrame:
    """One row a chunk of (path, text) documents; a file without chunks is one chunk of its whole transcript.

    A file's instant is its recorder's timestamp, or else its modification time,
    naive ones in ``zone``; numbers that are missing are 0.
    """
    rows = documents.select("path", F.explode(F.from_json("text", FILES)["files"]).alias("f")).where("f IS NOT NULL")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    f = F.col("f")
    whole = F.struct(
        F.lit(1).cast("bigint").alias("chunk_index"), F.lit(0.0).alias("start_seconds"), zero(f["duration_seconds"]).alias("end_seconds"), zero(f["duration_seconds"]).alias("duration_seconds"), F.lit("unclear").alias("source_type"),
        f["language"].alias("primary_language_code"), f["transcript"].alias("transcript"), F.lit(None).cast("string").alias("english_translation"), F.lit(None).cast("string").alias("translation_note"),
        F.lit("No chunked transcript was available; file-level transcript used as a fallback.").alias("notes"),
    )
    chunks = F.filter(F.coalesce(f["chunks"], F.array().cast(f"array<{CHUNK}>")), lambda c: c.isNotNull())
    rows = rows.withColumn("c", F.explode(F.when(F.size(chunks) > 0, chunks).otherwise(F.array(whole))))
    at = F.coalesce(local_instant(text.nonblank(f["recorder_timestamp"]), zone), local_instant(text.nonblank(f["modified_time"]), zone))
    return rows.select(
        "path", F.trim(f["file_name"]).alias("file_name"), text.nonblank(f["source_path"]).alias("source_path"), zero(f["duration_seconds"]).alias("file_seconds"), "f.recorder_timestamp", "f.modified_time", text.nonblank(f["language"]).alias("language"),
        F.trim(F.coalesce(f["transcript"], F.lit(""))).alias("file_transcript"), F.coalesce(f["segment_count"], F.lit(0)).alias("segment_count"), "f.avg_logprob", F.size(chunks).alias("chunk_count"), at.alias("captured_at"),
        F.coalesce(F.col("c.chunk_index"), F.lit(0)).alias("chunk_index"), zero(F.col("c.start_seconds")).alias("start_seconds"), zero(F.col("c.end_seconds")).alias("end_seconds"), zero(F.col("c.duration_seconds")).alias("duration_seconds"),
        F.lower(F.trim(F.coalesce(F.col("c.source_type"), F.lit("unclear")))).alias("source_type"), text.nonblank(F.col("c.primary_language_code")).alias("primary_language_code"), F.trim(F.coalesce(F.col("c.transcript"), F.lit(""))).alias("transcript"),
        text.nonblank(F.col("c.english_translation")).alias("english_translation"), "c.translation_note", "c.notes",
    )


def _last_of_each(rows: DataFrame, key: str) -> DataFrame:
    """Of repeated keys the last in the document."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "pos")]), "pos").alias("x")).select(key, "x.*")


def camera_clips(documents: DataFrame, zone: str) -> DataFrame:
    rows = documents.select(F.posexplode(F.from_json("text", CLIPS)["clips"]).alias("pos", "c")).select("pos", F.trim("c.clip_stem").alias("clip_stem"), local_instant(text.nonblank(F.col("c.timestamp")), zone).alias("clip_start"), "c.recording_group", "c.duration_seconds", "c.source_paths.wav", "c.source_paths.mp4", "c.clip_metadata")
    return _last_of_each(rows.where("coalesce(clip_stem, '') <> '' AND clip_start IS NOT NULL"), "clip_stem")


def camera_units(documents: DataFrame) -> DataFrame:
    rows = documents.select("path", F.explode(F.from_json("text", UNITS)["transcripts"]).alias("u")).select("path", "u.*").where("transcription_unit_id IS NOT NULL")
    flags = F.filter(F.coalesce("quality_flags", F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return rows.withColumn("quality_flags", flags).withColumn("transcript", F.trim(F.coalesce("transcript", F.lit(""))))


def camera_records(documents: DataFrame) -> DataFrame:
    """What a model saw, by unit, as JSON text."""
    rows = documents.select(F.posexplode(F.from_json("text", RECORDS)["records"]).alias("pos", "record")).where(F.ltrim("record").startswith("{"))
    rows = rows.select("pos", text.truthy(F.get_json_object("record", "$.transcription_unit_id")).alias("transcription_unit_id"), "record")
    return _last_of_each(rows.where("transcription_unit_id IS NOT NULL"), "transcription_unit_id")


def unit_join(units: DataFrame, clips: DataFrame, records: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Units with their clip and record, and how many had no clip."""
    both = units.drop("recording_group", "duration_seconds").join(clips.withColumn("_clip", F.lit(True)), "clip_stem", "left")
    missing = both.agg(F.count_if(F.col("_clip").isNull()).alias("missing_clips"))
    both = both.where("_clip").drop("_clip")
    both = both.join(records, "transcription_unit_id", "left") if records is not None else both.withColumn("record", F.lit(None).cast("string"))
    return both, missing


