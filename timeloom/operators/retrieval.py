"""Read-only views of the memory store: days, timelines, chunks, evidence, state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.operators.memory import active_build
from timeloom.operators.inverted import Stored
from timeloom.operators.search import Keep, as_it_is, clamp_limit, search


@dataclass(frozen=True)
class Store:
    """Tables by name, of the memory store and of the timeline it refers to."""

    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def current(store: Store, table: str, user: str) -> DataFrame:
    """A table's rows of the user's active build."""
    build = active_build(store["memory_build"], user).select("build_id")
    return store[table].where(F.col("user_id") == user).join(F.broadcast(build), "build_id", "left_semi")


def with_tags_and_refs(chunks: DataFrame, chunk_tag: DataFrame, chunk_ref: DataFrame) -> DataFrame:
    """Chunks with ``tags`` (type -> values) and ``refs``."""
    mine = chunks.select(F.col("id").alias("chunk_id"))
    by_type = chunk_tag.join(mine, "chunk_id", "left_semi").groupBy("chunk_id", "tag_type").agg(F.array_sort(F.collect_list("tag_value")).alias("values"))
    tags = by_type.groupBy("chunk_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag_type", "values")))).alias("tags"))
    refs = chunk_ref.join(mine, "chunk_id", "left_semi").groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("ref_kind", "ref_id", "role", "weight"))).alias("refs"))
    return chunks.join(tags.withColumnRenamed("chunk_id", "id"), "id", "left").join(refs.withColumnRenamed("chunk_id", "id"), "id", "left")


def in_order() -> list[Column]:
    return [F.col("sort_key"), F.col("start_at").asc_nulls_first(), F.col("id")]


def timeline(store: Store, user: str, day: str, limit: int | None = 50) -> DataFrame:
    """A day's chunks in order."""
    rows = current(store, "memory_chunk", user).where(F.col("day") == day).orderBy(*in_order()).limit(clamp_limit(limit or 50, 1, 200))
    return with_tags_and_refs(rows, store["chunk_tag"], store["chunk_ref"]).orderBy(*in_order())


def day(store: Store, user: str, which: str, chunks: int = 24) -> DataFrame:
    """A day's summary with its coverage, its chunk counts by type and its first chunks."""
    summary = current(store, "day_summary", user).where(F.col("day") == which)
    mine = current(store, "memory_chunk", user).where(F.col("day") == which)
    counts = mine.groupBy("day", "chunk_type").agg(F.count("*").alias("n"))
    counts = counts.groupBy("day").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "chunk_type", "n"))), lambda x: F.struct(x["chunk_type"].alias("chunk_type"), x["n"].alias("n"))).alias("chunk_counts"))
    first = mine.orderBy(*in_order()).limit(chunks).groupBy("day").agg(F.array_sort(F.collect_list(F.struct("sort_key", "start_at", "id", "chunk_type", "title", "text"))).alias("timeline"))
    spans = current(store, "coverage_span", user).where(F.col("day") == which)
    spans = spans.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("start_at", "end_at", "span_kind", "modality", "completeness", "notes"))).alias("coverage"))
    return summary.join(counts, "day", "left").join(first, "day", "left").join(spans, "day", "left")


def chunk(store: Store, user: str, chunk_id: str) -> DataFrame:
    rows = store["memory_chunk"].where((F.col("user_id") == user) & (F.col("id") == chunk_id))
    return with_tags_and_refs(rows, store["chunk_tag"], store["chunk_ref"])


def search_memory(store: Store, user: str, query: str | None, limit: int | None = 10, ix: Stored | None = None, keep: Keep = as_it_is, **filters) -> tuple[str, DataFrame]:
    """``search`` over the user's active build, with tags and references; ``ix`` is an index whose segments are the builds, ``keep`` stores what was found."""
    if ix is not None:
        ix = ix.of(active_build(store["memory_build"], user).select("build_id"))
    how, rows = search(current(store, "memory_chunk", user), store["chunk_tag"], query, limit, ix, keep, **filters)
    return how, with_tags_and_refs(keep(rows, "found"), store["chunk_tag"], store["chunk_ref"])


# What a reference of each kind shows of its record.
SHOWN = {
    "day_summary": ["day", "status", "completeness", "day_arc"],
    "content_span": ["span_type", "modality", "title", "text", "start_at", "end_at", "confidence"],
    "artifact": ["artifact_type", "storage_uri", "mime_type", "captured_at_wall", "status"],
    "event": ["event_type", "device_id", "start_at", "end_at", "confidence", "primary_source_type"],
    "scene_window": ["window_type", "primary_device_id", "start_at", "end_at", "confidence", "status"],
    "reference_scene": ["primary_device_id", "primary_scene_window_id", "start_at", "end_at", "confidence", "status"],
}


def evidence(store: Store, chunk_ids: DataFrame) -> DataFrame:
    """The records that chunks refer to, whatever their kind; references to nothing drop out."""
    refs = store["chunk_ref"].join(chunk_ids.select("chunk_id").distinct(), "chunk_id", "left_semi")
    out = None
    for kind, columns in SHOWN.items():
        records = store[kind].select(F.col("id").alias("ref_id"), F.to_json(F.struct(*columns)).alias("record_json"))
        rows = refs.where(F.col("ref_kind") == kind).join(records, "ref_id").select("chunk_id", "ref_kind", "ref_id", "role", "weight", "record_json")
        out = rows if out is None else out.unionByName(rows)
    return out


def environment(store: Store, user: str) -> DataFrame:
    """Days by status, and which of them aren't complete, of the user's active build."""
    days = current(store, "day_summary", user)
    return days.groupBy("build_id").agg(
        F.count("*").alias("days"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.array_sort(F.collect_set("status")).alias("statuses"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "complete", F.struct("day", "status")))).alias("open_days"),
    )


def status_counts(days: DataFrame) -> DataFrame:
    return days.groupBy("status").agg(F.count("*").alias("n"))


def coverage(store: Store, user: str, which: str) -> DataFrame:
    return current(store, "coverage_span", user).where(F.col("day") == which).orderBy(F.col("start_at").asc_nulls_first(), "id")
