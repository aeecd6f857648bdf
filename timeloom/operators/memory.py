"""The memory store: day summaries, coverage, and searchable chunks with tags and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import text
from timeloom.functions.ids import stable_id
from timeloom.functions.times import add_micros, block_range, day_of
from timeloom.operators.windows import ordered

# Of each kind of plain chunk, the sidecar's key, the first sort key, the tag it gives and the title it falls back to.
PLAIN = [
    ("decision", "decisions_observed", 300, None, None),
    ("work_pattern", "work_patterns", 400, None, None),
    ("notable_moment", "notable_moments", 500, None, None),
    ("emotional_signal", "emotional_signals", 600, None, None),
    ("person_context", "people", 700, "person", "person"),
    ("topic", "topics", 800, "topic", "topic"),
    ("tool_used", "tools_used", 900, "tool", "tool"),
    ("location", "locations", 950, "location", "location"),
]
# By kind of chunk, its confidence and salience.
WEIGHTS = {"biography": (0.92, 1.0), "day_arc": (0.88, 0.95), "time_block": (0.8, 0.85), "plain": (0.78, 0.7), "activity_total": (0.82, 0.72)}


@dataclass(frozen=True)
class Memory:
    memory_build: DataFrame
    day_summary: DataFrame
    coverage_span: DataFrame
    memory_chunk: DataFrame
    chunk_tag: DataFrame
    chunk_ref: DataFrame


def day_status(biography: Column, sidecar: Column, incomplete: Column, spans: Column) -> tuple[Column, Column]:
    """Status and completeness of a day from what there is of it."""
    both, one = biography.isNotNull() & sidecar.isNotNull(), biography.isNotNull() | sidecar.isNotNull()
    status = F.when(incomplete.isNotNull(), "incomplete").when(both, "complete").when(one, "partial").when(spans > 0, "evidence_only").otherwise("empty")
    share = F.when(incomplete.isNotNull(), 0.6).when(both, 0.95).when(one, 0.55).when(spans > 0, 0.35).otherwise(0.0)
    return status, share


def active_build(memory_build: DataFrame, user: str | None = None) -> DataFrame:
    """The latest active build of each user."""
    rows = memory_build.where("status = 'active'")
    if user is not None:
        rows = rows.where(F.col("user_id") == user)
    return rows.groupBy("user_id").agg(F.max_by("id", F.struct("generated_at", "id")).alias("build_id"))


def supersede(memory_build: DataFrame, users: DataFrame) -> DataFrame:
    """Active builds of the given users, superseded."""
    mine = users.select("user_id").distinct().withColumn("_mine", F.lit(True))
    rows = memory_build.join(mine, "user_id", "left")
    return rows.withColumn("status", F.when(F.col("_mine") & (F.col("status") == "active"), "superseded").otherwise(F.col("status"))).select(*memory_build.columns)


def coverage(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans by day and modality with the counts of each type inside the modality."""
    typed = spans.groupBy(*keys, "modality", "span_type").agg(F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("span_type").alias("key"), F.col("n").alias("value"))))
    return typed.groupBy(*keys, "modality").agg(F.sum("n").alias("n"), F.map_from_entries(entries).alias("by_type"))


def items(sidecar: Column, key: str) -> Column:
    """A list of the sidecar, each element as JSON text."""
    return F.coalesce(F.from_json(F.get_json_object(sidecar, f"$.{key}"), "array<string>"), F.array().cast("array<string>"))


def _of(x: Column, *keys: str) -> Column:
    """The first non-empty of some keys of a JSON object."""
    return F.coalesce(*[text.truthy(F.get_json_object(x, f"$.{k}")) for k in keys])


def _is_object(x: Column) -> Column:
    return F.coalesce(x.startswith("{"), F.lit(False))


def build(content_span: DataFrame, folders: DataFrame, generated_at, offset_hours: float = -7.0) -> Memory:
    """The memory tables of all users and days in one build each.

    ``folders`` has user_id, day, biography, sidecar (JSON text) and incomplete.
    Days of spans and of folders follow one offset from UTC.
    """
    now = F.lit(generated_at).cast("timestamp")
    spans = content_span.where("status = 'active'").withColumn("day", day_of(F.col("start_at"), offset_hours))
    folders = folders.select(
        "user_id", F.col("day").cast("string").alias("day"), text.strip_front_matter(F.col("biography")).alias("biography"), F.when(F.try_parse_json("sidecar").isNotNull() & F.ltrim("sidecar").startswith("{"), F.col("sidecar")).alias("sidecar"),
        text.nonblank(F.col("incomplete")).alias("incomplete"),
    )
    by_modality = coverage(spans, ["user_id", "day"])
    modal = by_modality.groupBy("user_id", "day").agg(F.sum("n").alias("spans"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("modality").alias("key"), F.col("n").alias("value"))))).alias("modalities"))
    typed = spans.groupBy("user_id", "day", "span_type").agg(F.count("*").alias("n")).groupBy("user_id", "day")
    typed = typed.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("span_type").alias("key"), F.col("n").alias("value"))))).alias("types"))
    days = folders.join(modal, ["user_id", "day"], "full").join(typed, ["user_id", "day"], "left").withColumn("spans", F.coalesce("spans", F.lit(0)))
    status, share = day_status(F.col("biography"), F.col("sidecar"), F.col("incomplete"), F.col("spans"))
    build_id = stable_id("tl-memory-build", F.col("user_id"), F.lit(str(generated_at)))
    days = days.withColumn("build_id", build_id).withColumn("status", status).withColumn("completeness", share)
    start = add_micros(F.col("day").cast("timestamp"), F.lit(int(-offset_hours * 3_600_000_000)))
    days = days.withColumn("day_summary_id", stable_id("tl-day-summary", F.col("user_id"), F.col("build_id"), F.col("day")))
    days = days.withColumn("day_start", start).withColumn("day_end", add_micros(start, F.lit(86_400_000_000))).withColumn("day_arc", text.squeeze(_of(F.col("sidecar"), "day_arc")))
    builds = days.select(F.col("build_id").alias("id"), "user_id", F.lit("content_span+day_folders").alias("source_kind"), F.lit("active").alias("status"), now.alias("generated_at"), F.lit("{}").alias("notes_json")).distinct()
    modal_json = F.to_json(
        F.struct("modalities", F.map_keys("modalities").alias("present_modalities"), F.col("biography").isNotNull().alias("has_biography"), F.col("sidecar").isNotNull().alias("has_sidecar"), F.col("incomplete").alias("incomplete_note"))
    )
    counts_json = F.to_json(F.struct(F.col("spans").alias("content_spans_total"), F.col("types").alias("content_spans_by_type"), F.col("modalities").alias("content_spans_by_modality")))
    summary = days.select(
        F.col("day_summary_id").alias("id"), "day", "user_id", "build_id", "status", "completeness", F.col("biography").alias("biography_md"), "day_arc", modal_json.alias("modality_coverage_json"),
        counts_json.alias("source_counts_json"), F.col("sidecar").alias("sidecar_json"), F.to_json(F.struct(F.col("incomplete").alias("incomplete_note"))).alias("notes_json"), now.alias("generated_at"),
    )

    base = ["day", "user_id", "build_id", "day_summary_id", "completeness"]
    blocks = days.select(*base, "status", F.posexplode(items(F.col("sidecar"), "time_blocks")).alias("i", "b")).where(_is_object(F.col("b")))
    first, last = block_range(F.col("day"), F.coalesce(_of(F.col("b"), "start_utc"), _of(F.col("b"), "start_hour")), F.coalesce(_of(F.col("b"), "end_utc"), _of(F.col("b"), "end_hour")))
    blocks = blocks.withColumn("start_at", first).withColumn("end_at", last).withColumn("description", text.squeeze(_of(F.col("b"), "description")))
    of_modality = by_modality.join(days, ["user_id", "day"]).select(
        stable_id("tl-coverage", F.col("build_id"), F.col("day"), F.col("modality"), F.lit("day_modality")).alias("id"), "day", "user_id", "build_id", F.col("day_start").alias("start_at"), F.col("day_end").alias("end_at"),
        F.lit("day_modality").alias("span_kind"), "modality", "completeness", F.lit(0.95).alias("confidence"), F.concat(F.col("n").cast("string"), F.lit(" normalized content spans")).alias("notes"),
        F.to_json(F.struct(F.col("n").alias("content_span_count"), F.col("by_type").alias("counts_by_type"))).alias("metadata_json"),
    )
    of_blocks = blocks.select(
        stable_id("tl-coverage", F.col("build_id"), F.col("day"), F.lit("time_block"), F.col("i")).alias("id"), "day", "user_id", "build_id", "start_at", "end_at", F.lit("time_block").alias("span_kind"),
        text.squeeze(_of(F.col("b"), "primary_activity", "label", "source")).alias("modality"), "completeness", F.lit(0.7).alias("confidence"), F.col("description").alias("notes"), F.col("b").alias("metadata_json"),
    )

    none, no_tags = F.lit(None).cast("timestamp"), F.array().cast("array<struct<tag_type:string,tag_value:string>>")
    tag = lambda kind, value: F.struct(F.lit(kind).alias("tag_type"), value.alias("tag_value"))
    tags_of = lambda kind, values: F.transform(values, lambda v: tag(kind, v))
    summary_ref = F.array(F.struct(F.lit("day_summary").alias("ref_kind"), F.col("day_summary_id").alias("ref_id"), F.lit("summary").alias("role"), F.lit(1.0).alias("weight")))

    def chunk(rows: DataFrame, kind, ident: list, title, body, start_at, end_at, sort_key, weights, meta, tags=no_tags, refs=summary_ref) -> DataFrame:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return rows.select(
            stable_id("tl-chunk", F.col("build_id"), *ident).alias("id"), *base, kind.alias("chunk_type"), title.alias("title"), body.alias("text"), start_at.alias("start_at"), end_at.alias("end_at"),
            sort_key.cast("long").alias("sort_key"), F.lit(weights[0]).alias("confidence") if isinstance(weights, tuple) else weights["confidence"].alias("confidence"),
            F.lit(weights[1]).alias("salience") if isinstance(weights, tuple) else weights["salience"].alias("salience"), meta.alias("metadata_json"), tags.alias("tags"), refs.alias("refs"),
        )

    c, day, side = F.col, F.col("day"), F.col("sidecar")
    topics, tools = text.distinct_clean(items(side, "topics")), text.distinct_clean(items(side, "tools_used"))
    people = F.filter(items(side, "people"), _is_object)
    about = F.concat(tags_of("topic", topics), tags_of("tool", tools), tags_of("person", F.transform(people, lambda p: F.get_json_object(p, "$.name"))))
    parts = [
        chunk(days.where("biography IS NOT NULL"), "biography", [day, F.lit("biography")], F.concat(day, F.lit(" biography")), c("biography"), c("day_start"), c("day_end"), F.lit(0), WEIGHTS["biography"], F.to_json(F.struct("status")), about),
        chunk(days.where("day_arc IS NOT NULL"), "day_arc", [day, F.lit("day_arc")], F.concat(day, F.lit(" arc")), c("day_arc"), c("day_start"), c("day_end"), F.lit(10), WEIGHTS["day_arc"], F.lit("{}")),
    ]
    named = F.coalesce(_of(c("b"), "primary_activity", "label"), F.concat(F.lit("time block "), (c("i") + 1).cast("string")))
    parts.append(
        chunk(blocks.where("description IS NOT NULL"), "time_block", [day, F.lit("time_block"), c("i")], text.squeeze(named), c("description"), c("start_at"), c("end_at"), 100 + c("i"), WEIGHTS["time_block"], c("b"), F.array(tag("activity", _of(c("b"), "primary_activity", "label"))))
    )
    source = {"people": people, "topics": topics, "tools_used": tools}

    def as_plain(kind: str, at: int, tag_type: str | None, prefix: str | None):
        return lambda v, i: F.struct(
            F.lit(kind).alias("kind"), (i + at).alias("sort_key"), i.alias("i"), v.alias("v"), F.lit(tag_type).cast("string").alias("tag_type"), F.lit(prefix).cast("string").alias("prefix")
        )

    listed = F.concat(*[F.transform(source.get(key, items(side, key)), as_plain(kind, at, tag_type, prefix)) for kind, key, at, tag_type, prefix in PLAIN])
    plain = days.select(*base, F.explode(listed).alias("x")).select(*base, "x.*")
    plain = plain.withColumn("_title", F.when(_is_object(c("v")), text.squeeze(_of(c("v"), "name", "title", "label"))))
    plain = plain.withColumn("_text", F.when(_is_object(c("v")), text.squeeze(_of(c("v"), "context", "description", "value"))).otherwise(text.squeeze(c("v"))))
    plain = plain.where("_title IS NOT NULL OR _text IS NOT NULL").withColumn("_text", F.coalesce("_text", "_title")).withColumn("title", F.coalesce("_title", "prefix"))
    kept = F.when(c("tag_type").isNotNull(), F.array(F.struct(c("tag_type"), F.coalesce("title", "_text").alias("tag_value")))).otherwise(no_tags)
    parts.append(chunk(plain, c("kind"), [day, c("kind"), c("i")], c("title"), c("_text"), none, none, c("sort_key"), WEIGHTS["plain"], F.when(_is_object(c("v")), c("v")).otherwise("{}"), kept))
    hours = F.coalesce(F.from_json(_of(side, "activities"), "map<string,string>"), F.from_json(_of(side, "activities_hours"), "map<string,string>"))
    totals = days.select(*base, F.posexplode(F.array_sort(F.map_entries(hours))).alias("i", "e"))
    totals = totals.select(*base, "i", c("e.key").alias("activity"), c("e.value").alias("hours"))
    parts.append(
        chunk(totals, "activity_total", [day, F.lit("activity_total"), c("activity")], c("activity"), F.concat(c("activity"), F.lit(": "), c("hours"), F.lit(" hours")), none, none, 1000 + c("i"), WEIGHTS["activity_total"], F.to_json(F.struct("hours")), F.array(tag("activity", c("activity"))))
    )
    said = spans.select("user_id", "day", *[F.col(x).alias(f"s_{x}") for x in ("id", "span_type", "modality", "title", "text", "start_at", "end_at", "confidence", "speaker_label", "artifact_id", "event_id", "scene_window_id", "reference_scene_id")])
    said = said.withColumn("i", F.row_number().over(ordered(["user_id", "day"], ["s_start_at", F.col("s_end_at").asc_nulls_first(), "s_id"])) - 1)
    said = said.join(days.select(*base, "status"), ["user_id", "day"])
    ref = lambda kind, column, weight: F.struct(F.lit(kind).alias("ref_kind"), c(column).alias("ref_id"), F.lit("source").alias("role"), F.lit(weight).alias("weight"))
    said_refs = F.array(ref("content_span", "s_id", 1.0), ref("artifact", "s_artifact_id", 0.95), ref("event", "s_event_id", 0.95), ref("scene_window", "s_scene_window_id", 0.95), ref("reference_scene", "s_reference_scene_id", 0.95))
    said_tags = F.array(tag("modality", c("s_modality")), tag("span_type", c("s_span_type")), tag("speaker", c("s_speaker_label")))
    weights = {"confidence": F.coalesce(F.nullif("s_confidence", F.lit(0.0)), F.lit(0.5)), "salience": F.when(c("s_span_type") == "transcript", 0.6).otherwise(0.78)}
    meta = F.to_json(F.struct(c("s_id").alias("content_span_id"), c("s_modality").alias("modality"), c("s_span_type").alias("span_type"), c("s_speaker_label").alias("speaker_label")))
    said = said.withColumn("completeness", F.when(c("status") == "complete", 1.0).otherwise(c("completeness")))
    title = F.coalesce(text.squeeze(c("s_title")), F.concat_ws(" ", "s_modality", "s_span_type"))
    parts.append(chunk(said, F.concat(F.lit("content_"), c("s_span_type")), [c("s_id")], title, F.coalesce(text.squeeze(c("s_text")), F.lit("")), c("s_start_at"), c("s_end_at"), 2000 + c("i"), weights, meta, said_tags, said_refs))

    chunks = parts[0]
    for part in parts[1:]:
        chunks = chunks.unionByName(part)
    tagged = chunks.select(F.col("id").alias("chunk_id"), F.explode("tags").alias("t")).select("chunk_id", "t.tag_type", text.squeeze(F.col("t.tag_value")).alias("tag_value")).where("tag_value IS NOT NULL").distinct()
    refs = chunks.select(F.col("id").alias("chunk_id"), F.explode("refs").alias("r")).select("chunk_id", "r.*").where("coalesce(ref_id, '') <> ''").dropDuplicates(["chunk_id", "ref_kind", "ref_id", "role"])
    return Memory(
        schema.shaped(builds, "memory_build"), schema.shaped(summary, "day_summary"), schema.shaped(of_modality.unionByName(of_blocks), "coverage_span"), schema.shaped(chunks, "memory_chunk"),
        schema.shaped(tagged, "chunk_tag"), schema.shaped(refs, "chunk_ref"),
    )
