"""Scenes from interpreted events, the claims made of them, and the evidence for each claim."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import scoring, text
from timeloom.functions.ids import stable_id
from timeloom.functions.times import iso_z
from timeloom.operators.windows import capped_scenes, ordered

# Final confidence from which a claim is accepted, or ambiguous.
ACCEPTED, AMBIGUOUS = 0.72, 0.45


@dataclass(frozen=True)
class Config:
    gap_seconds: float = 75.0
    max_window_seconds: float = 180.0
    processor_version: str = "v1"
    event_type: str = "activity_context"
    created_by_like: str | None = "%interpreter%"
    #: A part of an application's name that marks the recorder itself.
    recorder_name: str = "timeloom"
    #: End scenes at the latest end instead of the last event's.
    latest_end: bool = False


def contexts(events: DataFrame, event_artifact: DataFrame, artifact: DataFrame, config: Config = Config()) -> DataFrame:
    """Each event with what its payload and all its artifacts say, joined as sets."""
    rows = events.where(F.col("event_type") == config.event_type)
    if config.created_by_like:
        rows = rows.where(F.col("created_by").ilike(config.created_by_like))
    links = event_artifact.alias("l").join(artifact.alias("a"), F.col("l.artifact_id") == F.col("a.id"))
    field = lambda k: text.nonblank(F.get_json_object("a.metadata_json", f"$.{k}"))
    kind = F.col("a.artifact_type")
    app = F.when(kind == "app_metadata", field("frontmost_app_name")).when(kind == "screenshot", field("foreground_app"))
    heading = F.when(kind.isin("app_metadata", "screenshot"), field("window_title"))
    rank = F.when(F.col("l.role") == "primary", 0).when(F.col("l.role") == "supporting", 1).otherwise(2)
    links = links.select(
        F.col("l.event_id").alias("id"),
        F.struct(
            F.struct(rank.alias("rank"), F.col("a.captured_at_wall").alias("at"), F.col("a.id").alias("artifact_id")).alias("o"),
            F.struct(
                F.col("a.id").alias("artifact_id"), kind.alias("artifact_type"), F.col("a.storage_uri").alias("storage_uri"), F.col("l.confidence").alias("confidence"), field("frontmost_app_name").alias("app_name")
            ).alias("artifact"),
            app.alias("app"),
            heading.alias("heading"),
            F.when(kind.isin(*scoring.ARTIFACT_SOURCE), scoring.artifact_source(kind)).alias("source"),
            F.col("a.clock_offset_ms").alias("offset"),
            F.col("a.clock_confidence").alias("clock"),
        ).alias("x"),
    )
    listed = lambda c: F.filter(F.transform("all", lambda x: x[c]), lambda v: v.isNotNull())
    # One list an event, sorted once.
    found = links.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("all")).select(
        "id",
        F.transform("all", lambda x: x["artifact"]).alias("artifacts"),
        F.get(listed("app"), F.lit(0)).alias("app"),
        F.get(listed("heading"), F.lit(0)).alias("heading"),
        listed("source").alias("sources"),
        listed("offset").alias("offsets"),
        listed("clock").alias("clocks"),
    )
    payload = lambda k: F.get_json_object("payload_json", f"$.{k}")
    facts = F.coalesce(F.from_json(payload("observed_facts"), "array<string>"), F.array().cast("array<string>"))
    summaries = F.slice(F.array_distinct(F.filter(F.transform(F.concat(F.array(payload("summary"), payload("specific_activity")), facts), text.nonblank), lambda x: x.isNotNull())), 1, 4)
    out = rows.join(found, "id", "left")
    return out.select(
        "id",
        "user_id",
        "device_id",
        "start_at",
        F.coalesce("end_at", "start_at").alias("end_at"),
        "confidence",
        "app",
        text.nonblank(payload("coarse_category")).alias("category"),
        "heading",
        summaries.alias("summaries"),
        F.when(F.size(F.coalesce("sources", F.array())) > 0, F.col("sources")).otherwise(F.array("primary_source_type")).alias("sources"),
        F.coalesce("offsets", F.array().cast("array<bigint>")).alias("offsets"),
        F.coalesce("clocks", F.array().cast("array<string>")).alias("clocks"),
        "artifacts",
    )


def quality(base: Column, titles: Column, app_share: Column, direct_share: Column) -> Column:
    return scoring.clamp(base * 0.5 + titles * 0.2 + app_share * 0.15 + direct_share * 0.15)


def final(base: Column, quality_score: Column, app_share: Column, category_share: Column, direct_share: Column, apps: Column, categories: Column) -> Column:
    penalty = F.when(apps > 1, 0.15).otherwise(0.0) + F.when(categories > 1, 0.1).otherwise(0.0)
    return scoring.clamp(base * 0.5 + quality_score * 0.2 + app_share * 0.1 + category_share * 0.1 + direct_share * 0.15 - penalty)


def disposition(final_confidence: Column) -> Column:
    return F.when(final_confidence >= ACCEPTED, "accepted").when(final_confidence >= AMBIGUOUS, "ambiguous").otherwise("rejected")


def claim_confidence(base: Column, quality_score: Column, support: Column, conflict: Column) -> Column:
    return scoring.clamp(base * 0.55 + quality_score * 0.2 + support * 0.25 - conflict * 0.3)


@dataclass(frozen=True)
class Scenes:
    scene_window: DataFrame
    scene_window_artifact: DataFrame
    candidate_claim: DataFrame
    candidate_claim_evidence: DataFrame
    event: DataFrame
    event_artifact: DataFrame


def scored(rows: DataFrame, config: Config = Config()) -> DataFrame:
    """One row a scene with all that is scored of it; ``rows`` carry scene_no."""
    key = ["user_id", "device_id", "scene_no"]
    rows = rows.withColumn("n", F.row_number().over(ordered(key, ["start_at", "end_at", "id"])))
    direct = F.exists("sources", scoring.is_direct)
    end = F.max("end_at") if config.latest_end else F.max_by("end_at", "n")
    told = F.struct("n", "id", "app", "category", "heading", "sources", "offsets", "clocks", "summaries", "artifacts")
    # One list a scene, sorted once; a scene is capped in time.
    out = rows.groupBy(*key).agg(
        F.min("start_at").alias("start_at"),
        end.alias("end_at"),
        F.count("*").alias("events"),
        F.avg("confidence").alias("base"),
        F.avg(F.when(F.coalesce("heading", F.lit("")) != "", 1.0).otherwise(0.0)).alias("titles"),
        F.avg(F.when(direct, 1.0).otherwise(0.0)).alias("direct_share"),
        F.sort_array(F.collect_list(told)).alias("told"),
    )
    each = lambda c: F.col(f"told.{c}")
    known = lambda c: F.filter(each(c), lambda x: x != "")
    flat = lambda c: F.flatten(each(c))
    # The most frequent value, of equals the one that came first.
    often = lambda c: F.array_min(F.transform(F.array_distinct(known(c)), lambda v, i: F.struct((-F.size(F.filter(each(c), lambda x: x == v))).alias("n"), i.alias("i"), v.alias("v"))))
    out = out.select(
        *[c for c in out.columns if c != "told"],
        F.size(F.array_distinct(F.filter(each("app"), lambda x: x.isNotNull()))).alias("apps"),
        F.size(F.array_distinct(F.filter(each("category"), lambda x: x.isNotNull()))).alias("categories"),
        F.slice(F.array_distinct(known("heading")), 1, 4).alias("title_examples"),
        F.sort_array(F.array_distinct(F.filter(flat("sources"), lambda s: s != ""))).alias("source_types"),
        flat("offsets").alias("offsets"),
        flat("clocks").alias("clocks"),
        F.slice(flat("summaries"), 1, 6).alias("summary_examples"),
        each("id").alias("event_ids"),
        flat("artifacts").alias("artifacts"),
        often("app").alias("_app"),
        often("category").alias("_category"),
    )
    for name in ("app", "category"):
        most = F.col(f"_{name}")
        out = out.withColumns({f"dominant_{name}": most["v"], f"{name}_share": F.coalesce(-most["n"], F.lit(0)) / F.col("events")}).drop(f"_{name}")
    ordered_offsets, half = F.sort_array("offsets"), F.floor((F.size("offsets") - 1) / 2).cast("int")
    median = (F.get(ordered_offsets, half) + F.get(ordered_offsets, F.floor(F.size("offsets") / 2).cast("int"))) / 2
    ranked = F.transform("clocks", lambda c, i: F.struct((-scoring.clock_rank(c)).alias("r"), i.alias("i"), c.alias("c")))
    out = out.withColumn("median_clock_offset_ms", F.coalesce(F.bround(median, 0).cast("long"), F.lit(0).cast("long")))
    out = out.withColumn("clock_confidence", F.coalesce(F.array_min(ranked)["c"], F.lit("low")))
    out = out.withColumn("raw_quality", quality(*[F.col(c) for c in ("base", "titles", "app_share", "direct_share")]))
    out = out.withColumn("raw_confidence", final(*[F.col(c) for c in ("base", "raw_quality", "app_share", "category_share", "direct_share", "apps", "categories")]))
    flags = {"missing_window_titles": F.col("titles") < 0.5, "mixed_app_focus": F.col("apps") > 1, "mixed_category_context": F.col("categories") > 1, "indirect_only": F.col("direct_share") <= 0}
    out = out.withColumn("quality_flags", F.filter(F.array(*[F.when(on, name) for name, on in flags.items()]), lambda x: x.isNotNull()))
    out = out.withColumn("primary_source_type", scoring.primary_source(F.col("source_types"), scoring.INTERPRETED))
    out = out.withColumn("direct", scoring.is_direct(F.col("primary_source_type"))).withColumn("confidence", F.round("raw_confidence", 3))
    ident = stable_id("tl-scene-window", F.col("user_id"), F.col("device_id"), iso_z(F.col("start_at")), iso_z(F.col("end_at")), F.col("dominant_app"), F.lit(config.processor_version))
    return out.withColumn("id", ident)


def claims_of(scenes: DataFrame, config: Config, produced_at) -> DataFrame:
    """One to four claims a scene."""
    c, direct = F.col("confidence"), F.col("direct")
    text_of = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    basis = F.struct(F.lit("wall_clock_plus_median_clock_offset").alias("method"), "median_clock_offset_ms", "clock_confidence")
    capture = F.coalesce(F.col("dominant_category") == "capture_control", F.lit(False)) | F.coalesce(F.lower("dominant_app").contains(config.recorder_name), F.lit(False))
    mixed = lambda flag, cost: F.when(F.array_contains("quality_flags", flag), cost).otherwise(0.0)

    # By kind: where it is made, value_json, base, support, conflict.
    made = [
        (
            "device_attended",
            F.lit(True),
            text_of(device_id=F.col("device_id"), basis=F.when(direct, "direct_device_segment").otherwise("indirect_sensor_inference"), time_alignment=basis),
            F.greatest(c, F.when(direct, 0.75).otherwise(0.55)),
            F.when(direct, 0.95).otherwise(0.6),
            F.lit(0.0),
        ),
        (
            "app_in_focus",
            F.col("dominant_app").isNotNull(),
            text_of(app_name=F.col("dominant_app"), window_title_examples=F.col("title_examples")),
            c * F.greatest(F.col("app_share"), F.lit(0.5)),
            F.col("app_share"),
            mixed("mixed_app_focus", 0.35),
        ),
        (
            "task_context",
            F.col("dominant_category").isNotNull(),
            text_of(coarse_category=F.col("dominant_category"), summary_examples=F.col("summary_examples")),
            c * F.greatest(F.col("category_share"), F.lit(0.5)),
            F.col("category_share"),
            mixed("mixed_category_context", 0.2),
        ),
        (
            "capture_control",
            capture,
            text_of(coarse_category=F.coalesce("dominant_category", F.lit("capture_control")), app_name=F.col("dominant_app")),
            F.greatest(c, F.lit(0.8)),
            F.lit(0.95),
            F.lit(0.0),
        ),
    ]
    kinds = F.array(*[F.when(on, kind) for kind, on, *_ in made])
    rows = scenes.withColumn("claim_type", F.explode(F.array_compact(kinds)))

    def of(place):
        """What this kind has at a place, a column of its own, so that what isn't asked isn't made."""
        return F.coalesce(*[F.when(F.col("claim_type") == one[0], one[place]) for one in made])

    rows = rows.withColumns({"value_json": of(2), "base": of(3), "support": of(4), "conflict": of(5).cast("double")})
    rows = rows.withColumn("raw_final", claim_confidence(F.col("base"), scoring.clamp(c), F.col("support"), F.col("conflict")))
    return rows.select(
        stable_id("tl-claim", F.col("id"), F.col("claim_type")).alias("id"),
        "user_id",
        F.col("id").alias("scene_window_id"),
        "claim_type",
        "value_json",
        F.round("base", 3).alias("base_confidence"),
        F.round(scoring.clamp(c), 3).alias("quality_score"),
        F.round("support", 3).alias("support_score"),
        F.round("conflict", 3).alias("conflict_score"),
        F.round("raw_final", 3).alias("final_confidence"),
        disposition(F.col("raw_final")).alias("disposition"),
        F.lit(f"scene_claims_{config.processor_version}").alias("produced_by"),
        F.lit(produced_at).cast("timestamp").alias("produced_at"),
        "dominant_app",
        "device_id",
        "scene_no",
    )


def evidence_of(claims: DataFrame, members: DataFrame) -> DataFrame:
    """What supports and contradicts each claim: the scene's events and their artifacts."""
    scene = ["user_id", "device_id", "scene_no"]
    rows = claims.select(F.col("id").alias("candidate_claim_id"), *scene, "dominant_app").join(members, scene)
    free = F.col("dominant_app").isNull()
    role = F.when(free | F.coalesce(F.col("app") == F.col("dominant_app"), F.lit(False)), "supporting").otherwise("contradictory")
    name = lambda c: F.coalesce(c, F.lit("unknown"))
    of_events = rows.select(
        "candidate_claim_id",
        F.lit(None).cast("string").alias("artifact_id"),
        F.col("id").alias("event_id"),
        role.alias("evidence_role"),
        "confidence",
        F.concat(F.lit("activity_context app="), name(F.col("app")), F.lit(" category="), name(F.col("category"))).alias("notes"),
    )
    a = F.col("a")
    other = ~free & F.coalesce(a["app_name"] != F.col("dominant_app"), F.lit(False))
    part = F.when(a["artifact_type"] == "app_metadata", F.when(other, "contradictory").otherwise("metadata_support")).otherwise("supporting")
    notes = F.when(a["artifact_type"] == "app_metadata", F.concat(F.lit("app_metadata app="), name(a["app_name"]))).when(a["artifact_type"] == "screenshot", F.concat(F.lit("screenshot path="), a["storage_uri"]))
    of_artifacts = rows.select(*scene, "candidate_claim_id", "dominant_app", F.explode("artifacts").alias("a"))
    of_artifacts = of_artifacts.select(*scene, "candidate_claim_id", a["artifact_id"].alias("artifact_id"), F.lit(None).cast("string").alias("event_id"), part.alias("evidence_role"), a["confidence"].alias("confidence"), notes.alias("notes"))
    # A claim has one scene; with it in the key the rows stay where the join put them.
    once = of_artifacts.dropDuplicates([*scene, "candidate_claim_id", "artifact_id", "evidence_role"])
    return of_events.unionByName(once.drop(*scene))


def artifact_roles(scenes: DataFrame) -> DataFrame:
    """Each artifact of a scene once, primary if its source is the most direct one there."""
    rows = scenes.select(F.col("id").alias("scene_window_id"), F.posexplode("artifacts").alias("pos", "a"))
    rows = rows.withColumn("priority", scoring.source_priority(scoring.artifact_source(F.col("a.artifact_type"))))
    once = rows.groupBy("scene_window_id", F.col("a.artifact_id").alias("artifact_id")).agg(F.min_by(F.struct("a.confidence", "priority", "pos"), "pos").alias("x"))
    best = once.groupBy("scene_window_id").agg(F.min("x.priority").alias("best"))
    out = once.join(best, "scene_window_id")
    return out.select("scene_window_id", "artifact_id", F.when(F.col("x.priority") == F.col("best"), "primary").otherwise("supporting").alias("role"), F.col("x.confidence").alias("confidence"), F.col("x.pos").alias("pos"))


def build(events: DataFrame, event_artifact: DataFrame, artifact: DataFrame, produced_at, config: Config = Config(), keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Scenes:
    """All tables of the scene stage, for every user and device at once.

    ``keep`` may store what several of them are made of, the events in their
    scenes and the scored scenes, so that it is computed once.
    """
    # The scans take what decides on scenes; lists of artifacts and texts wait in the stored rows.
    rows = contexts(events, event_artifact, artifact, config)
    # Rows that repeat an id are told apart by the rest of them; an id may be null inside the key.
    rest = ordered(["id"], ["start_at", "end_at", "user_id", "device_id", "category", "confidence", "sources", "summaries"])
    rows = keep(rows.withColumn("_row", F.struct("id", F.row_number().over(rest).alias("copy"))))
    narrow = rows.select("_row", "id", "user_id", "device_id", "start_at", "end_at", "app", "category")
    numbers = capped_scenes(narrow, ["user_id", "device_id"], ["start_at", "end_at", "id"], "start_at", "end_at", "app", "category", config.gap_seconds, config.max_window_seconds)
    rows = keep(rows.join(numbers.select("_row", "scene_no"), "_row").drop("_row"))
    scenes = keep(scored(rows, config))
    meta = F.struct(
        F.col("dominant_app").alias("dominant_app_name"),
        "dominant_category",
        "title_examples",
        "source_types",
        F.round("direct_share", 3).alias("direct_evidence_ratio"),
        "median_clock_offset_ms",
        "clock_confidence",
        "quality_flags",
        "event_ids",
        F.col("events").alias("event_count"),
        F.array("device_id").alias("participating_device_ids"),
        "summary_examples",
        F.struct(F.lit("wall_clock_plus_median_clock_offset").alias("method"), "median_clock_offset_ms", "clock_confidence").alias("time_alignment_basis"),
        F.col("direct").alias("direct_device_preferred"),
        F.lit(config.processor_version).alias("builder_version"),
    )
    window = scenes.select(
        "*",
        F.col("device_id").alias("primary_device_id"),
        F.when(F.col("direct"), "device_segment").otherwise("sensor_segment").alias("window_type"),
        scoring.source_priority(F.col("primary_source_type")).alias("source_priority"),
        F.to_json(meta).alias("metadata_json"),
    )
    claims = claims_of(scenes, config, produced_at)
    members = rows.select("user_id", "device_id", "scene_no", "id", "app", "category", "confidence", "artifacts")
    accepted = claims.where("disposition = 'accepted'").groupBy("scene_window_id").agg(
        F.array_sort(F.collect_list(F.struct("claim_type", F.col("value_json").alias("value"), F.col("final_confidence").alias("confidence")))).alias("accepted_claims")
    )
    fused = window.join(accepted, F.col("id") == F.col("scene_window_id"), "left")
    payload = F.struct(F.col("id").alias("scene_window_id"), F.col("dominant_app").alias("dominant_app_name"), "dominant_category", "title_examples", "quality_flags", "summary_examples", "accepted_claims", F.col("event_ids").alias("source_event_ids"))
    fused = fused.select(
        stable_id("tl-scene-event", F.col("id"), F.lit(config.processor_version)).alias("id"),
        "user_id",
        F.col("primary_device_id").alias("device_id"),
        F.lit("fused_interaction").alias("event_type"),
        "start_at",
        "end_at",
        "source_priority",
        "confidence",
        "primary_source_type",
        F.to_json(payload).alias("payload_json"),
        F.lit(f"scene_claims_{config.processor_version}").alias("created_by"),
        F.lit(produced_at).cast("timestamp").alias("created_at"),
    )
    roles = artifact_roles(scenes)
    first = roles.where("role = 'primary'").groupBy("scene_window_id").agg(F.min("pos").alias("first"))
    links = roles.join(first, "scene_window_id", "left").join(window.select(F.col("id").alias("scene_window_id"), F.col("confidence").alias("scene_confidence")), "scene_window_id")
    one = F.col("pos") == F.col("first")
    links = links.select(
        stable_id("tl-scene-event", F.col("scene_window_id"), F.lit(config.processor_version)).alias("event_id"),
        "artifact_id",
        F.when(one, "primary").otherwise("supporting").alias("role"),
        F.when(one, F.col("scene_confidence")).alias("confidence"),
    )
    return Scenes(
        schema.shaped(window, "scene_window", status="stable"),
        schema.shaped(roles, "scene_window_artifact"),
        schema.shaped(claims, "candidate_claim"),
        schema.shaped(evidence_of(claims, members), "candidate_claim_evidence"),
        schema.shaped(fused, "event"),
        schema.shaped(links, "event_artifact"),
    )
