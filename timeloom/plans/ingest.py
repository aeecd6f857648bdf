"""From sources to the tables artifact, event, scene_window, their links, and job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import scoring, text
from timeloom.functions.ids import file_artifact_id, stable_id
from timeloom.functions.times import add_micros, iso_z, without_offset
from timeloom.operators import segments
from timeloom.operators.windows import first_distinct, frame_segments, ordered, sample_places


@dataclass(frozen=True)
class Who:
    """Whose data, from which device, taken in when."""

    user_id: str
    device_id: str
    received_at: str
    version: str = "v1"


@dataclass(frozen=True)
class Ingested:
    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def _artifact(rows: DataFrame, who: Who, **columns: Column) -> DataFrame:
    """Artifact rows; what isn't given takes the table's usual value."""
    usual = {
        "user_id": F.lit(who.user_id), "device_id": F.lit(who.device_id), "received_at": F.lit(who.received_at).cast("timestamp"), "clock_confidence": F.lit("high"), "schema_version": F.lit("v1"), "status": F.lit("stored"),
        "processor_version": F.lit(who.version),
    }
    return schema.shaped(rows.select(*[v.alias(k) for k, v in (usual | columns).items()]), "artifact")


def virtual(payload: Column) -> dict[str, Column]:
    """Hash and size of a payload kept as canonical JSON."""
    payload = text.canonical_json(payload)
    return {"sha256": F.sha2(payload, 256), "byte_size": F.octet_length(payload).cast("long"), "mime_type": F.lit("application/json")}


def _event(rows: DataFrame, who: Who, **columns: Column) -> DataFrame:
    usual = {"user_id": F.lit(who.user_id), "device_id": F.lit(who.device_id), "created_at": F.lit(who.received_at).cast("timestamp")}
    return schema.shaped(rows.select(*[v.alias(k) for k, v in (usual | columns).items()]), "event")


def _json(*columns) -> Column:
    return F.to_json(F.struct(*columns))


def captures(observations: DataFrame, who: Who, root: str, gap_seconds: float = 45.0, image_limit: int = 3) -> Ingested:
    """Artifacts of sidecars and images, segments as packets, and a job for each packet worth interpreting under one for the batch."""
    rows = observations.withColumn("user_id", F.lit(who.user_id)).withColumn("device_id", F.lit(who.device_id))
    rows = rows.withColumn("meta_id", file_artifact_id(F.lit("app_metadata"), F.col("json_path"), F.col("user_id"), F.col("device_id")))
    rows = rows.withColumn("image_id", F.when(F.col("image_path").isNotNull(), file_artifact_id(F.lit("screenshot"), F.col("image_path"), F.col("user_id"), F.col("device_id"))))
    clock = {"clock_offset_ms": F.col("clock_offset_ms"), "clock_confidence": scoring.capture_clock_confidence(F.col("clock_offset_ms"), F.col("platform")), "captured_at_monotonic_ms": F.col("monotonic_ms")}
    seen = {"captured_at_wall": F.col("at"), "normalized_at": F.col("at"), "processor_version": F.lit(None)}
    bounds = F.struct("width", "height").alias("window_bounds")
    of_meta = _artifact(
        rows, who, id=F.col("meta_id"), artifact_type=F.lit("app_metadata"), storage_uri=F.col("json_path"), **virtual(F.col("raw_json")), **seen, **clock,
        metadata_json=_json(F.col("app_name").alias("frontmost_app_name"), "window_title", "window_id", bounds, "platform", "capture_method", "image_path"),
    )
    size = F.col("image_bytes") if "image_bytes" in rows.columns else F.lit(None)
    of_image = _artifact(
        rows.where("image_id IS NOT NULL"), who, id=F.col("image_id"), artifact_type=F.lit("screenshot"), storage_uri=F.col("image_path"), sha256=F.col("sha256"), byte_size=size,
        mime_type=F.when(F.lower("image_path").endswith("png"), "image/png").otherwise("image/jpeg"), **seen, **clock,
        metadata_json=_json(F.col("app_name").alias("foreground_app"), "window_title", "window_id", "capture_method", bounds, F.col("json_path").alias("linked_json_path"), "platform"),
    ).dropDuplicates(["id"])
    cut = segments.segment(rows, gap_seconds)
    packets = segments.packets(cut, image_limit)
    key = ["user_id", "device_id", "segment_no"]
    sources = cut.withColumn("o", F.struct("at", "json_path")).groupBy(*key).agg(
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("o", F.filter(F.array("meta_id", "image_id"), lambda x: x.isNotNull()).alias("ids")))), lambda s: s["ids"]))).alias("source_artifact_ids")
    )
    packets = packets.join(sources, key)
    batch = stable_id("tl-batch-job", F.lit(who.user_id), F.lit(who.device_id), F.lit(root), F.lit(gap_seconds), F.lit(who.version))
    job = {"user_id": F.lit(who.user_id), "device_id": F.lit(who.device_id), "job_type": F.lit("fuse"), "processor_version": F.lit(who.version), "state": F.lit("queued"), "attempt_count": F.lit(0), "queued_at": F.lit(who.received_at)}
    make = lambda df, **c: schema.shaped(df.select(*[v.alias(k) for k, v in (job | c).items()]), "job")
    parent = make(
        packets.agg(F.count("*").alias("segment_count"), F.sum("capture_count").alias("capture_count")), id=batch, target_type=F.lit("batch"), target_id=F.lit(root), processor_name=F.lit("segment_interpret_batch"), priority=F.lit(100), max_attempts=F.lit(1),
        input_json=_json(F.lit(root).alias("input_root"), "capture_count", "segment_count", F.lit(gap_seconds).alias("gap_seconds")),
    )
    child = make(
        packets.where("should_queue_interpretation"), id=stable_id("tl-segment-job", batch, F.col("id"), F.lit(who.version)), parent_job_id=batch, target_type=F.lit("segment_packet"), target_id=F.col("id"),
        processor_name=F.lit("segment_interpreter"), priority=F.lit(10), max_attempts=F.lit(2), input_json=_json(F.col("id").alias("packet_id"), "start_at", "end_at", "primary_app_name", "capture_count", "sample_image_paths", "source_artifact_ids"),
    )
    return Ingested({"artifact": of_meta.unionByName(of_image), "segment_packet": packets, "job": parent.unionByName(child)})


def frames(rows: DataFrame, who: Who, database: str, gap_seconds: float = 45.0) -> Ingested:
    """Frame artifacts, and an activity event a run of frames with first, middle and last picture."""
    made = {"captured_at_wall": F.col("at"), "normalized_at": F.col("at")}
    uri = F.concat(F.lit(f"{database}#frames/"), F.col("id").cast("string"))
    rows = rows.withColumn("app", scoring.frame_app(F.col("app_name"), F.col("ocr_text"), F.col("window_name"))).withColumn("meta_id", stable_id("tl-frame-metadata", F.lit(who.user_id), F.lit(who.device_id), F.col("id"), F.lit(who.version)))
    rows = rows.withColumn("shot_id", F.when(F.coalesce("snapshot_path", F.lit("")) != "", file_artifact_id(F.lit("screenshot"), F.col("snapshot_path"), F.lit(who.user_id), F.lit(who.device_id))))
    rows = rows.withColumn("best_text", F.coalesce(*[text.truthy(F.col(c)) for c in ("ocr_text", "full_text", "accessibility_text")]))
    shown = [F.lit("linux").alias("platform"), F.col("id").alias("frame_id"), F.col("app_name").alias("raw_app_name"), F.col("window_name").alias("window_title"), "browser_url", "device_name", "machine_id", "capture_trigger", "text_source"]
    whole = _json("id", "timestamp", "app_name", "window_name", "browser_url", "device_name", "machine_id", "snapshot_path", "capture_trigger", "text_source", "focused", "full_text", "accessibility_text", "content_hash", "simhash", "ocr_text", "ocr_text_json", "ocr_engine")
    of_meta = _artifact(rows, who, id=F.col("meta_id"), artifact_type=F.lit("app_metadata"), storage_uri=uri, **virtual(whole), **made, metadata_json=_json(F.lit("screen_frame").alias("source_kind"), F.col("app").alias("frontmost_app_name"), *shown), processor_name=F.lit("screen_frame_ingest"))
    of_shot = _artifact(rows.where("shot_id IS NOT NULL"), who, id=F.col("shot_id"), artifact_type=F.lit("screenshot"), storage_uri=F.col("snapshot_path"), sha256=F.lit(""), byte_size=F.lit(0), **made, metadata_json=_json(F.col("app").alias("foreground_app"), *shown))
    cut = frame_segments(rows, ["device_name", "machine_id"], ["at", "id"], "at", "app_name", "host", "window_name", gap_seconds)
    key = ["device_name", "machine_id", "segment_no"]
    cut = cut.withColumn("n", F.row_number().over(ordered(key, ["at", "id"])))
    at_first = lambda c: F.min_by(c, "n")
    values = lambda c: F.array_sort(F.collect_set(F.nullif(c, F.lit(""))))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("n", F.col(c).alias("v")))), lambda x: x["v"])
    runs = cut.groupBy(*key).agg(
        F.min("at").alias("start_at"), F.max("at").alias("end_at"), F.min("n").alias("_n"), at_first("id").alias("first_id"), F.max_by("id", "n").alias("last_id"), at_first("app").alias("app"), at_first("window_name").alias("title"),
        at_first("host").alias("host"), F.count("*").alias("captures"), F.get(first_distinct(F.col("n"), F.col("best_text"), 1), F.lit(0)).alias("said"), F.bool_or(F.coalesce("snapshot_path", F.lit("")) != "").alias("shots"),
        values("capture_trigger").alias("triggers"), values("text_source").alias("text_sources"), values("host").alias("hosts"), in_order("id").alias("frame_ids"),
        F.slice(F.filter(in_order("window_name"), lambda v: F.coalesce(v, F.lit("")) != ""), 1, 4).alias("titles"), at_first("snapshot_path").alias("first_shot"), F.max_by("snapshot_path", "n").alias("last_shot"),
        in_order("shot_id").alias("shot_ids"),
    )
    said = text.excerpt(F.col("said"), 180)
    blank = lambda c: F.nullif(c, F.lit(""))
    facts = F.array(
        F.concat(F.lit("screen device: "), blank(F.col("device_name"))), F.concat(F.lit("browser host: "), F.col("host")), F.when(F.size("triggers") > 0, F.concat(F.lit("capture triggers: "), F.array_join("triggers", ", "))),
        F.when(F.size("text_sources") > 0, F.concat(F.lit("text sources: "), F.array_join("text_sources", ", "))), F.concat(F.lit("text excerpt: "), said),
    )
    confidence = F.least(F.lit(0.95), F.round(0.62 + F.when(F.col("said").isNotNull(), 0.12).otherwise(0.0) + F.when(F.col("shots"), 0.08).otherwise(0.0) + F.when(F.col("captures") >= 3, 0.08).otherwise(0.0), 3))
    runs = runs.withColumn("id", stable_id("tl-frame-event", F.lit(who.user_id), F.lit(who.device_id), F.col("first_id"), F.col("last_id"), F.lit(who.version))).withColumn("confidence", confidence)
    payload = _json(
        F.lit("screen_frame_segment").alias("summary_type"), F.concat_ws(" · ", F.col("app"), F.coalesce(blank(F.col("title")), F.col("host"))).alias("summary"),
        F.coalesce(F.concat(F.lit("Browser context on "), F.col("host")), blank(F.col("title")), said).alias("specific_activity"), F.slice(F.filter(facts, lambda x: x.isNotNull()), 1, 6).alias("observed_facts"),
        scoring.app_category(F.col("app")).alias("coarse_category"), F.col("app").alias("frontmost_app_name"), F.col("titles").alias("window_title_examples"), F.col("captures").alias("capture_count"), "frame_ids", "device_name", "machine_id",
        F.col("hosts").alias("browser_hosts"), F.col("triggers").alias("capture_triggers"), "text_sources", F.col("first_shot").alias("first_snapshot_path"), F.col("last_shot").alias("last_snapshot_path"),
    )
    events = _event(runs, who, id=F.col("id"), event_type=F.lit("activity_context"), start_at=F.col("start_at"), end_at=F.col("end_at"), source_priority=F.lit(1), confidence=F.col("confidence"), primary_source_type=F.lit("app_metadata"), payload_json=payload, created_by=F.lit(f"screen_frame_ingest_{who.version}"))
    members = cut.join(runs.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("id").alias("event_id"), "confidence"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    support = members.select("event_id", F.col("meta_id").alias("artifact_id"), F.lit("supporting").alias("role"), "confidence")
    sampled = runs.select(F.col("id").alias("event_id"), "confidence", F.explode(F.transform(sample_places(F.col("captures")), lambda i: F.get("shot_ids", i.cast("int")))).alias("artifact_id")).where("artifact_id IS NOT NULL")
    links = support.unionByName(sampled.select("event_id", "artifact_id", F.lit("primary").alias("role"), "confidence"))
    return Ingested({"artifact": of_meta.unionByName(of_shot), "event": events, "event_artifact": schema.shaped(links, "event_artifact")})


def desk_audio(rows: DataFrame, who: Who, database: str) -> Ingested:
    """An event an utterance, with its transcript and its file."""
    raw = F.when(F.coalesce("file_path", F.lit("")) != "", file_artifact_id(F.lit("desktop_audio"), F.col("file_path"), F.lit(who.user_id), F.lit(who.device_id)))
    rows = rows.withColumn("raw_id", raw).withColumn("said_id", stable_id("tl-audio-transcript", F.lit(who.user_id), F.lit(who.device_id), F.col("id"), F.lit(who.version)))
    rows = rows.withColumn("event_id", stable_id("tl-audio-event", F.lit(who.user_id), F.lit(who.device_id), F.col("id"), F.lit(who.version))).withColumn("confidence", F.when(F.coalesce("transcription", F.lit("")) != "", 0.78).otherwise(0.45))
    made = {"captured_at_wall": F.col("start_at"), "normalized_at": F.col("start_at")}
    shown = [F.col("id").alias("transcription_id"), "audio_chunk_id", F.col("device").alias("device_name"), "machine_id", "is_input_device"]
    whole = _json("id", "audio_chunk_id", "timestamp", "transcription", "device", "is_input_device", "transcription_engine", "start_time", "end_time", "speaker_id", "file_path", "machine_id")
    of_raw = _artifact(rows.where("raw_id IS NOT NULL"), who, id=F.col("raw_id"), artifact_type=F.lit("desktop_audio"), storage_uri=F.col("file_path"), sha256=F.lit(""), byte_size=F.lit(0), **made, metadata_json=_json(*shown)).dropDuplicates(["id"])
    of_said = _artifact(rows, who, id=F.col("said_id"), artifact_type=F.lit("transcript"), storage_uri=F.concat(F.lit(f"{database}#audio_transcriptions/"), F.col("id").cast("string")), **virtual(whole), **made, parent_artifact_id=F.col("raw_id"), metadata_json=_json(*shown, "speaker_id"), processor_name=F.lit("audio_ingest"))
    payload = _json("transcription", text.excerpt(F.col("transcription"), 180).alias("summary"), F.col("device").alias("device_name"), "is_input_device", "speaker_id", "transcription_engine", "audio_chunk_id", "machine_id")
    events = _event(rows, who, id=F.col("event_id"), event_type=F.lit("desktop_audio_context"), start_at=F.col("start_at"), end_at=F.col("end_at"), source_priority=F.lit(4), confidence=F.col("confidence"), primary_source_type=F.lit("desktop_audio"), payload_json=payload, created_by=F.lit(f"audio_ingest_{who.version}"))
    links = rows.where("raw_id IS NOT NULL").select("event_id", F.col("raw_id").alias("artifact_id"), F.lit("primary").alias("role"), "confidence")
    links = links.unionByName(rows.select("event_id", F.col("said_id").alias("artifact_id"), F.lit("supporting").alias("role"), F.lit(1.0).alias("confidence")))
    return Ingested({"artifact": of_raw.unionByName(of_said), "event": events, "event_artifact": schema.shaped(links, "event_artifact")})


def ui_events(rows: DataFrame, frame_artifacts: DataFrame, who: Who, database: str) -> Ingested:
    """An event an input, linked to its own record and, where that was taken in, to its frame (frame_id, artifact_id)."""
    rows = rows.withColumn("meta_id", stable_id("tl-ui-event", F.lit(who.user_id), F.lit(who.device_id), F.col("id"), F.lit(who.version))).withColumn("event_id", stable_id("tl-ui-input", F.lit(who.user_id), F.lit(who.device_id), F.col("id"), F.lit(who.version)))
    whole = _json(*[c for c in rows.columns if c not in ("at", "meta_id", "event_id")])
    made = {"captured_at_wall": F.col("at"), "normalized_at": F.col("at")}
    meta = _json(F.lit("ui_event").alias("source_kind"), F.col("id").alias("ui_event_id"), "event_type", F.col("app_name").alias("frontmost_app_name"), "window_title", "browser_url", "machine_id", "frame_id")
    of_meta = _artifact(rows, who, id=F.col("meta_id"), artifact_type=F.lit("app_metadata"), storage_uri=F.concat(F.lit(f"{database}#ui_events/"), F.col("id").cast("string")), **virtual(whole), **made, metadata_json=meta, processor_name=F.lit("ui_ingest"))
    events = _event(rows, who, id=F.col("event_id"), event_type=F.lit("screen_input_event"), start_at=F.col("at"), end_at=F.col("at"), source_priority=F.lit(1), confidence=F.lit(0.96), primary_source_type=F.lit("app_metadata"), payload_json=whole, created_by=F.lit(f"ui_ingest_{who.version}"))
    own = rows.select("event_id", F.col("meta_id").alias("artifact_id"), F.lit("primary").alias("role"), F.lit(1.0).alias("confidence"))
    near = rows.join(frame_artifacts.select("frame_id", "artifact_id"), "frame_id").select("event_id", "artifact_id", F.lit("supporting").alias("role"), F.lit(0.9).alias("confidence"))
    return Ingested({"artifact": of_meta, "event": events, "event_artifact": schema.shaped(own.unionByName(near), "event_artifact")})


def _scene(rows: DataFrame, who: Who, source: Column, meta: Column) -> DataFrame:
    out = rows.select(
        F.col("scene_id").alias("id"), F.lit(who.user_id).alias("user_id"), F.lit(who.device_id).alias("primary_device_id"), F.when(scoring.is_direct(source), "device_segment").otherwise("sensor_segment").alias("window_type"), "start_at", "end_at",
        scoring.source_priority(source).alias("source_priority"), "confidence", source.alias("primary_source_type"), F.lit("stable").alias("status"), meta.alias("metadata_json"),
    )
    return schema.shaped(out, "scene_window")


def recorder(chunks: DataFrame, who: Who, zone: str, offset_ms: int | None = None, clock: str | None = None, existing: DataFrame | None = None) -> Ingested:
    """A scene a chunk of speech worth keeping, with artifacts of its file, its transcript and the file's.

    ``existing`` lists the audio files there are (path); without it a declared path counts as there.
    """
    offset = F.lit(offset_ms).cast("long")
    confidence_of_clock = scoring.clock_confidence(F.lit(clock).cast("string"), offset)
    rows = chunks.withColumn("here", F.col("source_path"))
    if existing is not None:
        rows = rows.drop("here").join(existing.select(F.col("path").alias("here")).distinct(), F.col("source_path") == F.col("here"), "left")
    sid = lambda prefix, *parts: stable_id(prefix, F.lit(who.user_id), F.lit(who.device_id), *parts, F.lit(who.version))
    rows = rows.withColumn("raw_id", F.when(F.col("here").isNotNull(), file_artifact_id(F.lit("audio_chunk"), F.col("here"), F.lit(who.user_id), F.lit(who.device_id))))
    rows = rows.withColumn("file_id", sid("tl-recorder-file", F.col("file_name"))).withColumn("said_id", sid("tl-recorder-chunk", F.col("file_name"), F.col("chunk_index"))).withColumn("scene_id", sid("tl-recorder-scene", F.col("file_name"), F.col("chunk_index")))
    rows = rows.withColumn("start_at", add_micros(F.col("captured_at"), F.col("start_seconds") * 1_000_000)).withColumn("end_at", add_micros(F.col("captured_at"), F.col("end_seconds") * 1_000_000))
    rows = rows.withColumn("confidence", scoring.chunk_confidence(F.col("source_type"), F.col("transcript")))
    one = rows.dropDuplicates(["file_id"])
    common = {"clock_offset_ms": offset, "clock_confidence": confidence_of_clock}
    file_made = {"captured_at_wall": F.col("captured_at"), "normalized_at": without_offset(F.col("captured_at"), offset)}
    about = ["file_name", F.col("file_seconds").alias("duration_seconds"), "recorder_timestamp", "modified_time", "language", "segment_count", "avg_logprob"]
    of_raw = _artifact(one.where("raw_id IS NOT NULL"), who, id=F.col("raw_id"), artifact_type=F.lit("audio_chunk"), storage_uri=F.col("here"), sha256=F.lit(""), byte_size=F.lit(0), **file_made, **common, metadata_json=_json(F.lit("recorder_wav").alias("source_kind"), *about))
    of_file = _artifact(
        one, who, id=F.col("file_id"), artifact_type=F.lit("transcript"), storage_uri=F.concat("path", F.lit("#file="), "file_name"), **virtual(_json(*about, F.col("file_transcript").alias("transcript"), "chunk_count")), **file_made, **common,
        metadata_json=_json(F.lit("recorder_transcript_file").alias("source_kind"), *about, "chunk_count", F.col("raw_id").isNotNull().alias("raw_audio_available")), processor_name=F.lit("recorder_transcribe"),
    )
    kept = rows.where(scoring.keeps_speech(F.col("source_type"), F.col("primary_language_code")))
    chunk_about = ["file_name", "chunk_index", "start_seconds", "end_seconds", "duration_seconds", "source_type", "primary_language_code", "transcript", "english_translation", "translation_note", "notes"]
    of_said = _artifact(
        kept, who, id=F.col("said_id"), artifact_type=F.lit("transcript"), parent_artifact_id=F.col("file_id"), storage_uri=F.concat("path", F.lit("#file="), "file_name", F.lit("&chunk="), F.col("chunk_index").cast("string")), **virtual(_json(*chunk_about)),
        captured_at_wall=F.col("start_at"), normalized_at=without_offset(F.col("start_at"), offset), **common, metadata_json=_json(F.lit("recorder_transcript_chunk").alias("source_kind"), "file_name", "chunk_index", "source_type", "primary_language_code"),
        processor_name=F.lit("recorder_transcribe"),
    )
    basis = F.struct(F.lit("recorder_filename_timestamp_plus_manual_offset").alias("method"), F.lit(zone).alias("timezone"), "recorder_timestamp", "modified_time", offset.alias("median_clock_offset_ms"), offset.alias("clock_offset_ms"), confidence_of_clock.alias("clock_confidence"))
    meta = _json(
        *chunk_about, text.excerpt(F.trim("transcript"), 600).alias("transcript_excerpt"), "source_path", basis.alias("time_alignment_basis"), F.col("raw_id").alias("raw_audio_artifact_id"), F.col("said_id").alias("transcript_artifact_id"),
        F.col("file_id").alias("transcript_file_artifact_id"), F.lit(who.version).alias("builder_version"),
    )
    link = lambda df, artifact, role, confidence: df.select(F.col("scene_id").alias("scene_window_id"), F.col(artifact).alias("artifact_id"), role.alias("role"), confidence.cast("double").alias("confidence"))
    links = link(kept.where("raw_id IS NOT NULL"), "raw_id", F.lit("primary"), F.col("confidence"))
    links = links.unionByName(link(kept, "said_id", F.when(F.col("raw_id").isNull(), "primary").otherwise("supporting"), F.lit(1.0))).unionByName(link(kept, "file_id", F.lit("supporting"), F.lit(1.0)))
    return Ingested({"artifact": of_raw.unionByName(of_file).unionByName(of_said), "scene_window": _scene(kept, who, F.lit("ambient_audio"), meta), "scene_window_artifact": schema.shaped(links, "scene_window_artifact")})


def camera(units: DataFrame, who: Who, zone: str, offset_ms: int | None = None, clock: str | None = None) -> Ingested:
    """A scene a spoken unit of a clip, with what was seen in it; ``units`` come from the join of units, clips and records."""
    offset = F.lit(offset_ms).cast("long")
    confidence_of_clock = scoring.clock_confidence(F.lit(clock).cast("string"), offset)
    sid = lambda prefix, *parts: stable_id(prefix, F.lit(who.user_id), F.lit(who.device_id), *parts, F.lit(who.version))
    file_id = lambda kind, path: F.when(F.coalesce(path, F.lit("")) != "", file_artifact_id(F.lit(kind), path, F.lit(who.user_id), F.lit(who.device_id)))
    rows = units.withColumn("wav_id", file_id("camera_audio", F.col("wav"))).withColumn("mp4_id", file_id("camera_visual", F.col("mp4")))
    rows = rows.withColumn("said_id", sid("tl-camera-transcript", F.col("transcription_unit_id"))).withColumn("scene_id", sid("tl-camera-scene", F.col("transcription_unit_id")))
    rows = rows.withColumn("seen_id", F.when(F.col("record").isNotNull(), sid("tl-camera-visual", F.col("transcription_unit_id"))))
    rows = rows.withColumn("start_at", add_micros(F.col("clip_start"), F.coalesce("start_seconds", F.lit(0.0)) * 1_000_000)).withColumn("end_at", add_micros(F.col("clip_start"), F.coalesce("end_seconds", F.lit(0.0)) * 1_000_000))
    seen = lambda k: F.get_json_object("record", f"$.gemini.{k}")
    rows = rows.withColumn("visual_confidence", seen("confidence").try_cast("double")).withColumn("confidence", scoring.camera_confidence(F.col("transcript"), F.col("visual_confidence")))
    common = {"clock_offset_ms": offset, "clock_confidence": confidence_of_clock}
    clip_made = {"captured_at_wall": F.col("clip_start"), "normalized_at": without_offset(F.col("clip_start"), offset)}
    made = {"captured_at_wall": F.col("start_at"), "normalized_at": without_offset(F.col("start_at"), offset)}

    def raw(ident: str, kind: str, path: str) -> DataFrame:
        one = rows.where(F.col(ident).isNotNull()).dropDuplicates([ident])
        return _artifact(one, who, id=F.col(ident), artifact_type=F.lit(kind), storage_uri=F.col(path), sha256=F.lit(""), byte_size=F.lit(0), **clip_made, **common, metadata_json=_json("clip_stem", "recording_group", "duration_seconds", "clip_metadata"))

    spoken = _json("transcription_unit_id", "clip_stem", "recording_group", "start_seconds", "end_seconds", "transcript", "language", "quality_flags")
    of_said = _artifact(
        rows, who, id=F.col("said_id"), artifact_type=F.lit("transcript"), parent_artifact_id=F.col("wav_id"), storage_uri=F.concat("path", F.lit("#unit="), "transcription_unit_id"), **virtual(spoken), **made, **common,
        metadata_json=_json("clip_stem", "recording_group", F.col("record").isNotNull().alias("has_visual_context"), "quality_flags"), processor_name=F.lit("camera_transcribe"),
    )
    of_seen = _artifact(
        rows.where("seen_id IS NOT NULL"), who, id=F.col("seen_id"), artifact_type=F.lit(scoring.INTERPRETED), parent_artifact_id=F.col("mp4_id"), storage_uri=F.concat("path", F.lit("#window="), F.coalesce(F.get_json_object("record", "$.visual_window_id"), F.lit(""))),
        **virtual(F.col("record")), **made, **common, metadata_json=_json("clip_stem", "recording_group", F.get_json_object("record", "$.visual_window_id").alias("visual_window_id")), processor_name=F.lit("camera_visual_pass"),
    )
    basis = F.struct(F.lit("camera_clip_local_timestamp_plus_manual_offset").alias("method"), F.lit(zone).alias("timezone"), iso_z(F.col("clip_start")).alias("clip_start"), offset.alias("median_clock_offset_ms"), offset.alias("clock_offset_ms"), confidence_of_clock.alias("clock_confidence"), F.get_json_object("clip_metadata", "$.gps_datetime").alias("gps_datetime"))
    pictured = [seen(k).alias(k) for k in ("setting", "scene_labels", "actions", "people_present", "notable_objects", "visible_text", "timeline_events")]
    meta = _json(
        "clip_stem", "recording_group", "transcription_unit_id", "transcript", text.excerpt(F.trim("transcript"), 500).alias("transcript_excerpt"), "language", "quality_flags", "start_seconds", "end_seconds", seen("window_summary").alias("visual_summary"), *pictured,
        "visual_confidence", basis.alias("time_alignment_basis"), F.col("wav_id").alias("raw_audio_artifact_id"), F.col("mp4_id").alias("raw_video_artifact_id"), F.col("said_id").alias("transcript_artifact_id"), F.col("seen_id").alias("visual_artifact_id"),
        F.lit(who.version).alias("builder_version"),
    )
    source = F.when(F.col("record").isNotNull(), "camera_visual").otherwise("camera_audio")
    link = lambda ident, role, confidence: rows.where(F.col(ident).isNotNull()).select(F.col("scene_id").alias("scene_window_id"), F.col(ident).alias("artifact_id"), role.alias("role"), confidence.alias("confidence"))
    links = link("wav_id", F.lit("supporting"), F.lit(0.8)).unionByName(link("mp4_id", F.lit("supporting"), F.lit(0.8)))
    links = links.unionByName(link("said_id", F.when(F.col("mp4_id").isNull(), "primary").otherwise("supporting"), F.lit(1.0))).unionByName(link("seen_id", F.lit("primary"), F.col("confidence")))
    artifacts = raw("wav_id", "camera_audio", "wav").unionByName(raw("mp4_id", "camera_visual", "mp4")).unionByName(of_said).unionByName(of_seen)
    return Ingested({"artifact": artifacts, "scene_window": _scene(rows, who, source, meta), "scene_window_artifact": schema.shaped(links, "scene_window_artifact")})


def counters(made: Ingested) -> DataFrame:
    """How many rows each table got."""
    out = None
    for name, df in made.tables.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out
