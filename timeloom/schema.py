"""Tables of the timeline store, as Spark schemas, with their keys and what an upsert may change."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """``fixed`` columns keep the value of the first insert; all others but the key are updated."""

    ddl: str
    key: tuple[str, ...]
    fixed: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def updated(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.key and c not in self.fixed]


TABLES = {
    "artifact": Table(
        "id string, user_id string, device_id string, capture_session_id string, parent_artifact_id string, artifact_type string, mime_type string, storage_uri string, sha256 string, byte_size bigint, "
        "captured_at_wall timestamp, captured_at_monotonic_ms bigint, received_at timestamp, normalized_at timestamp, clock_offset_ms bigint, clock_confidence string, processor_name string, processor_version string, "
        "schema_version string, status string, metadata_json string",
        ("id",),
        ("user_id",),
    ),
    "job": Table(
        "id string, user_id string, device_id string, parent_job_id string, job_type string, target_type string, target_id string, processor_name string, processor_version string, state string, priority bigint, "
        "attempt_count bigint, max_attempts bigint, queued_at timestamp, started_at timestamp, finished_at timestamp, error_code string, error_message string, input_json string, output_json string",
        ("id",),
    ),
    "processor_run": Table("id string, job_id string, run_number bigint, worker_name string, worker_host string, started_at timestamp, finished_at timestamp, status string, logs_uri string, metrics_json string", ("id",)),
    "event": Table(
        "id string, user_id string, device_id string, event_type string, start_at timestamp, end_at timestamp, source_priority bigint, confidence double, primary_source_type string, payload_json string, created_by string, created_at timestamp",
        ("id",),
        ("user_id", "device_id", "event_type", "start_at", "end_at", "source_priority", "primary_source_type"),
    ),
    "event_artifact": Table("event_id string, artifact_id string, role string, confidence double", ("event_id", "artifact_id")),
    "scene_window": Table(
        "id string, user_id string, primary_device_id string, window_type string, start_at timestamp, end_at timestamp, source_priority bigint, confidence double, primary_source_type string, status string, metadata_json string",
        ("id",),
        ("user_id",),
    ),
    "scene_window_artifact": Table("scene_window_id string, artifact_id string, role string, confidence double", ("scene_window_id", "artifact_id")),
    "candidate_claim": Table(
        "id string, user_id string, scene_window_id string, claim_type string, value_json string, base_confidence double, quality_score double, support_score double, conflict_score double, final_confidence double, "
        "disposition string, produced_by string, produced_at timestamp",
        ("id",),
        ("user_id", "scene_window_id", "claim_type"),
    ),
    "candidate_claim_evidence": Table("candidate_claim_id string, artifact_id string, event_id string, evidence_role string, confidence double, notes string", ("candidate_claim_id", "artifact_id", "event_id", "evidence_role")),
    "reference_scene": Table(
        "id string, user_id string, primary_device_id string, primary_scene_window_id string, start_at timestamp, end_at timestamp, source_priority bigint, confidence double, primary_source_type string, status string, metadata_json string",
        ("id",),
        ("user_id",),
    ),
    "reference_scene_member": Table("reference_scene_id string, scene_window_id string, role string, alignment_offset_ms bigint, confidence double", ("reference_scene_id", "scene_window_id")),
    "content_span": Table(
        "id string, user_id string, device_id string, artifact_id string, event_id string, scene_window_id string, reference_scene_id string, span_type string, modality string, title string, text string, language string, "
        "speaker_label string, start_at timestamp, end_at timestamp, source_priority bigint, confidence double, status string, created_by string, created_at timestamp, metadata_json string",
        ("id",),
        ("user_id",),
    ),
    "person": Table("id string, user_id string, display_name string, status string, metadata_json string, created_at timestamp, updated_at timestamp", ("id",), ("created_at",)),
    "person_voiceprint": Table(
        "id string, user_id string, person_id string, provider string, model string, label string, voiceprint string, source_storage_uri string, source_artifact_id string, source_start_seconds double, source_end_seconds double, "
        "metadata_json string, status string, enrolled_at timestamp, updated_at timestamp",
        ("id",),
        ("user_id", "enrolled_at"),
    ),
    "identity_hypothesis": Table(
        "id string, user_id string, person_id string, speaker_key string, clip_normalized_stem string, chunk_index bigint, start_at timestamp, end_at timestamp, display_label string, basis string, confidence double, "
        "disposition string, payload_json string, created_by string, created_at timestamp",
        ("id",),
        ("speaker_key", "clip_normalized_stem", "chunk_index", "start_at", "end_at"),
    ),
    "identity_hypothesis_evidence": Table("identity_hypothesis_id string, evidence_type string, evidence_ref string, confidence double, notes string", ("identity_hypothesis_id", "evidence_type", "evidence_ref")),
    "episode": Table(
        "id string, user_id string, day string, episode_type string, title string, search_text string, started_at timestamp, ended_at timestamp, confidence double, status string, builder_version bigint, built_at timestamp, metadata_json string",
        ("id",),
        ("user_id", "day"),
    ),
    "episode_event": Table("episode_id string, event_id string, ordinal bigint, role string", ("episode_id", "event_id")),
    "memory_build": Table("id string, user_id string, source_kind string, source_hash string, status string, generated_at timestamp, notes_json string", ("id",)),
    "day_summary": Table(
        "id string, day string, user_id string, build_id string, status string, completeness double, biography_md string, day_arc string, modality_coverage_json string, source_counts_json string, sidecar_json string, notes_json string, generated_at timestamp",
        ("id",),
    ),
    "coverage_span": Table(
        "id string, day string, user_id string, build_id string, start_at timestamp, end_at timestamp, span_kind string, modality string, completeness double, confidence double, notes string, metadata_json string", ("id",)
    ),
    "memory_chunk": Table(
        "id string, day string, user_id string, build_id string, day_summary_id string, chunk_type string, title string, text string, start_at timestamp, end_at timestamp, sort_key bigint, completeness double, confidence double, "
        "salience double, metadata_json string",
        ("id",),
    ),
    "chunk_tag": Table("chunk_id string, tag_type string, tag_value string", ("chunk_id", "tag_type", "tag_value")),
    "chunk_ref": Table("chunk_id string, ref_kind string, ref_id string, role string, weight double", ("chunk_id", "ref_kind", "ref_id", "role")),
}


def shaped(df: DataFrame, table: str, extra: list[Column] | None = None, **defaults) -> DataFrame:
    """The columns of a table in order and type, and ``extra`` ones; a column that ``df`` lacks takes its default, or null."""
    have = set(df.columns)
    return df.select(*(extra or []), *[(F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in TABLES[table].schema])


def orphans(child: DataFrame, parent: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Rows of ``child`` whose non-null ``column`` refers to no row of ``parent``."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
