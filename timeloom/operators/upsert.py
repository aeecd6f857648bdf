"""Keyed upserts, replacements and cascades, as queries over snapshots.

Plain files can't be changed in place: each operator returns the new snapshot,
and ``plans.store`` swaps it in, whole or by the days that it touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.schema import TABLES, shaped


#: Times that say when a row was written, those of most weight first.
WRITTEN = ["updated_at", "created_at", "produced_at", "built_at", "generated_at", "normalized_at", "received_at", "finished_at", "started_at", "queued_at"]


def written_order(source: DataFrame, columns: list[str]) -> list[Column]:
    """What orders the rows of a batch that has no order of its own: primary roles last, then the times of writing, then a digest of the row."""
    role = [(F.col("role") == "primary")] if "role" in columns else []
    return [*role, *[F.col(c) for c in WRITTEN if c in columns], F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.to_json(F.struct(*columns))]


def last_writer(source: DataFrame, key: list[str], order: list[str] | None = None, fixed: list[str] | None = None) -> DataFrame:
    """One row a key, as if the rows had been written one after another: the last one's values, and the first one's in the ``fixed`` columns.

    ``order`` names columns of the batch that say which came first (they are
    left out of the result if it has others); without it ``written_order``
    decides.  Either way all that is equal there is told apart by a digest, so
    that reruns over other partitions agree.  Two partial aggregations, no sort.
    """
    columns = [c for c in source.columns if c not in (order or [])] if order else source.columns
    place = F.struct(*[F.col(c) if isinstance(c, str) else c for c in [*(order or []), *written_order(source, columns)]])
    first = [c for c in columns if c in (fixed or [])]
    last = [c for c in columns if c not in key and c not in first]
    parts = [F.max_by(F.struct(*last), place).alias("_last")] if last else []
    parts += [F.min_by(F.struct(*first), place).alias("_first")] if first else []
    if not parts:
        return source.select(*columns).distinct()
    rows = source.groupBy(*key).agg(*parts)
    return rows.select(*[F.col(c) if c in key else F.col(f"_first.{c}" if c in first else f"_last.{c}").alias(c) for c in columns])


def merge(target: DataFrame, source: DataFrame, key: list[str], updated: list[str]) -> DataFrame:
    """Insert the new keys and set the ``updated`` columns of the known ones; keys may be null and then are equal."""
    a, b = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    same = reduce(Column.__and__, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
    both = a.join(b, same, "full")

    def value(c: str) -> Column:
        new = F.col("s._s").isNotNull() if c in updated else F.col("t._t").isNull()
        return F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return both.select(*[value(c) for c in target.columns])


def upsert(target: DataFrame, source: DataFrame, table: str, order: list[str] | None = None) -> DataFrame:
    """``merge`` by a table's own key and update rules; rows of one batch may repeat a key and are taken in the ``order`` of those columns."""
    t = TABLES[table]
    keep = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order or [])]
    # The columns that give the order stand aside: they may be the table's own.
    rows = shaped(source, table, extra=keep)
    batch = last_writer(rows, list(t.key), [f"_order{i}" for i in range(len(keep))] or None, list(t.fixed))
    return merge(shaped(target, table), batch, list(t.key), t.updated)


def insert_missing(target: DataFrame, source: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The snapshot with the rows of unknown keys added, and those rows."""
    new = last_writer(source, key, fixed=[c for c in source.columns if c not in key]).join(target.select(*key), key, "left_anti").select(*target.columns)
    return target.unionByName(new), new


def replace(target: DataFrame, source: DataFrame, where: Column) -> DataFrame:
    """The rows outside ``where`` and all of ``source``."""
    return target.where(~F.coalesce(where, F.lit(False))).unionByName(source)


def replace_days(target: DataFrame, source: DataFrame, days: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the (user, day) pairs in ``days`` give way to ``source``."""
    return target.join(days.select(*by).distinct(), by, "left_anti").unionByName(source)


def delete_like(target: DataFrame, where: Column, created_by_like: str) -> tuple[DataFrame, DataFrame]:
    """The snapshot without the rows of ``where`` whose creator matches, and how many those were."""
    out = F.coalesce(where & F.col("created_by").ilike(created_by_like), F.lit(False))
    return target.where(~out), target.agg(F.count_if(out).alias("deleted"))


def set_where(target: DataFrame, where: Column, **values) -> DataFrame:
    """A conditional update."""
    test = F.coalesce(where, F.lit(False))
    return target.withColumns({c: F.when(test, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(target.schema[c].dataType) for c, v in values.items()})


def voiceprint_status(target: DataFrame, user: str, person: str, before: str, after: str, except_ids: list[str], updated_at) -> DataFrame:
    where = (F.col("user_id") == user) & (F.col("person_id") == person) & (F.col("status") == before)
    if except_ids:
        where = where & ~F.col("id").isin(except_ids)
    return set_where(target, where, status=after, updated_at=F.lit(updated_at).cast("timestamp"))


def without(target: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` isn't among the ids, which may repeat: an anti join asks for one, so no task keeps a set of them."""
    return target.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_anti").select(*target.columns)


def cascade_scenes(tables: dict[str, DataFrame], where: Column, created_by: str = "scene_claims_%") -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Delete scenes and all that hangs on them: claims, their evidence, links and fused events.

    ``where`` is over scene_window.  Scenes are those with claims by the
    builder and those that its fused events name.
    """
    inside = tables["scene_window"].where(where).select(F.col("id").alias("scene_window_id"))
    claims = tables["candidate_claim"].where(F.col("produced_by").ilike(created_by)).join(inside, "scene_window_id", "left_semi")
    fused = tables["event"].where((F.col("event_type") == "fused_interaction") & F.col("created_by").ilike(created_by))
    fused = fused.select("id", F.get_json_object("payload_json", "$.scene_window_id").alias("scene_window_id")).join(inside, "scene_window_id", "left_semi")
    scenes = claims.select("scene_window_id").unionByName(fused.select("scene_window_id")).distinct()
    claim_ids, event_ids = claims.select("id"), fused.select("id")
    out = dict(tables)
    out["candidate_claim_evidence"] = without(tables["candidate_claim_evidence"], claim_ids, "candidate_claim_id")
    out["candidate_claim"] = without(tables["candidate_claim"], claim_ids, "id")
    out["scene_window_artifact"] = without(tables["scene_window_artifact"], scenes, "scene_window_id")
    out["event_artifact"] = without(tables["event_artifact"], event_ids, "event_id")
    out["event"] = without(tables["event"], event_ids, "id")
    out["scene_window"] = without(tables["scene_window"], scenes, "id")
    return out, {"claims": claim_ids, "events": event_ids, "scenes": scenes}


def cascade_references(tables: dict[str, DataFrame], where: Column, created_by: str = "cross_device_aligner_%") -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Delete reference scenes with their members and events; ``where`` is over reference_scene."""
    ids = tables["reference_scene"].where(where).select(F.col("id").alias("reference_scene_id"))
    events = tables["event"].where((F.col("event_type") == "cross_device_reference") & F.col("created_by").ilike(created_by))
    events = events.select("id", F.get_json_object("payload_json", "$.reference_scene_id").alias("reference_scene_id")).join(ids, "reference_scene_id", "left_semi").select("id")
    out = dict(tables)
    out["reference_scene_member"] = without(tables["reference_scene_member"], ids, "reference_scene_id")
    out["event_artifact"] = without(tables["event_artifact"], events, "event_id")
    out["event"] = without(tables["event"], events, "id")
    out["reference_scene"] = without(tables["reference_scene"], ids, "id")
    return out, {"references": ids, "events": events}
