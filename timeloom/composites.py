"""Queries that run whole operators over the driver's tables, and the SQL that says the same.

The operators read the timeline's own tables; their inputs are made of the
driver's rows, in Spark and in SQL alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import ids, scoring, text, times
from timeloom.operators import align, episodes, inverted, jobs, memory, normalize, overlap, ranges, resources, retrieval, scans, scenes, search, segments, upsert
from timeloom.plans import ingest
from timeloom.plans.driver_tables import EV, events, table
from timeloom.plans.stages import keeper, stored
from timeloom.plans.store import TableStore
from timeloom.queries import GROUPED, HALF_DAY, LABELLED, index_once, query
from timeloom.schema import TABLES
from timeloom.session import work_folder
from timeloom.sources import files, screen, transcripts

NOW = "2026-01-02 03:04:05"


def us(ts: Column) -> Column:
    """Microseconds since 1970 of an instant."""
    return F.unix_micros(ts.cast("timestamp"))


def chosen(names: list, n: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in names]), n.cast("int"))


def listed(names: list) -> str:
    """The same list in SQL."""
    return "[" + ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in names) + "]"


# Scalars

TAILS = ["Z", "+02:00", ".1234567-05:30", " "]


@query(
    f"""SELECT event_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || 'Z' AS iso,
    CASE event_id % 4 WHEN 0 THEN s * 1000000 WHEN 1 THEN (s - 7200) * 1000000 WHEN 2 THEN (s + 19800) * 1000000 + 123456 ELSE s * 1000000 END AS parsed_us,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE (s - 32400) * 1000000 END AS tokyo_us,
    epoch_us(ts) + CAST(value * 1000000 AS BIGINT) AS said_us, epoch_us(ts) + CAST((value + CASE WHEN event_id % 3 = 0 THEN 0 ELSE 2 END) * 1000000 AS BIGINT) AS end_us,
    CASE event_id % 4 WHEN 0 THEN d + 9 * 3600 WHEN 1 THEN d + 23 * 3600 + 1800 WHEN 2 THEN d + 300 END * 1000000 AS block_start_us,
    CASE event_id % 4 WHEN 0 THEN d + 10 * 3600 + 900 WHEN 1 THEN d + 86400 + 3600 WHEN 2 THEN d + 86400 + 300 END * 1000000 AS block_end_us,
    ts >= TIMESTAMP '2024-01-03 07:00:00' AND ts < TIMESTAMP '2024-01-04 07:00:00' AS on_day
    FROM (SELECT *, epoch_us(ts) // 1000000 AS s, epoch(date_trunc('day', ts))::BIGINT AS d FROM events)"""
)
def scalar_times(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    n = F.col("event_id")
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    said, end = times.audio_times(F.col("ts"), F.col("value"), F.when(n % 3 != 0, F.col("value") + 2))
    day = F.date_format("ts", "yyyy-MM-dd")
    first, last = times.block_range(day, chosen(["9", "23:30", "0:05:00", "25"], n % 4), chosen(["10:15", "1:00", "0:05", "1"], n % 4))
    start, after = times.day_range("2024-01-03", -7.0)
    return e.select(
        "event_id",
        times.iso_z(F.col("ts")).alias("iso"),
        us(times.parse_instant(F.concat(plain, chosen(TAILS, n % 4)))).alias("parsed_us"),
        us(times.local_instant(F.when(n % 5 != 0, plain).otherwise("soon"), "Asia/Tokyo")).alias("tokyo_us"),
        us(said).alias("said_us"),
        us(end).alias("end_us"),
        us(first).alias("block_start_us"),
        us(last).alias("block_end_us"),
        ((F.col("ts") >= start) & (F.col("ts") < after)).alias("on_day"),
    )


SUFFIXES = [".PNG", ".jpeg", ".md", ".xyz", "", ".wav"]
UUID5 = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


def uuid5_sql(name: str) -> str:
    """The name-based UUID of a SQL text."""
    h = f"sha1(unhex('{ids.URL_NAMESPACE}') || encode({name}))"
    return UUID5.replace("(h,", f"({h},")


@query(
    f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS first_present,
    'a: x; b: ' || lang || CASE WHEN doc_id % 2 = 0 THEN '; c: ' || source ELSE '' END || '; n: 1.5; t: True' AS spoken, lang || '|' || source AS clean,
    ' said ' || lang || '  ' || source || ' one two ' || lang || '    ' AS blob,
    CASE doc_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'text/markdown' WHEN 5 THEN 'audio/x-wav' ELSE 'application/octet-stream' END AS mime,
    {uuid5_sql("'tl-artifact|screenshot|/a/' || doc_id || '|' || lang || '|'")} AS artifact_id FROM documents"""
)
def scalar_text(spark, sf_dir):
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    both = F.to_json(F.struct(F.array(F.lit("x"), F.lit(None).cast("string"), F.lit("")).alias("a"), F.struct(F.col("lang").alias("b")).alias("z")))
    made = F.concat(
        F.lit('{"a": ["x", null, "", {"b": "'), F.col("lang"), F.lit('"}, []], "c": '), F.when(n % 2 == 0, F.concat(F.lit('" '), F.col("source"), F.lit('  "'))).otherwise("{}"), F.lit(', "n": 1.5, "t": true}')
    )
    meta = F.to_json(F.struct(F.concat(F.lit("said "), F.col("lang")).alias("transcript"), F.col("source").alias("setting"), F.array(F.lit("one"), F.lit("two"), F.col("lang")).alias("scene_labels")))
    rows = d.withColumn("metadata_json", meta).withColumn("both", both)
    return rows.select(
        "doc_id",
        text.first_nonblank(F.lit(None).cast("string"), F.when(n % 3 == 0, "  ").otherwise(F.col("lang")), F.col("source")).alias("first_present"),
        text.json_text(made).alias("spoken"),
        F.array_join(text.distinct_clean(F.array(F.concat(F.lit("  "), F.col("lang")), F.lit(" "), F.col("source"), F.col("lang"), F.lit(None).cast("string"))), "|").alias("clean"),
        F.concat(overlap.blob(), F.lit("")).alias("blob"),
        files.mime_type(F.concat(F.lit("/x.y/z"), chosen(SUFFIXES, n % 6))).alias("mime"),
        ids.file_artifact_id(F.lit("screenshot"), F.concat(F.lit("/a/"), n.cast("string")), F.col("lang"), F.lit(None).cast("string")).alias("artifact_id"),
    )


# Policies

ARTIFACTS = ["app_metadata", "screenshot", "audio_chunk", "camera_frame", "video_excerpt", "audio_excerpt", "note", None]
STATES = [None, "restored", " Suppressed ", "quarantined", "odd"]
KINDS = ["room", "Mixed", "media", "unclear", "?"]
SAID = "a text of twenty-five chars"


@query(
    f"""SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'app_metadata' WHEN 1 THEN 'screenshot' WHEN 2 THEN 'ambient_audio' WHEN 3 THEN 'camera_visual' WHEN 4 THEN 'camera_visual' WHEN 5 THEN 'camera_audio' ELSE 'codex_interpretation' END AS source,
    CASE event_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS clock_rank,
    CASE event_id % 5 WHEN 2 THEN 'suppressed' WHEN 3 THEN 'quarantined' WHEN 4 THEN CASE WHEN event_id % 2 = 0 THEN 'suppressed' ELSE 'active' END WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN 'suppressed' ELSE 'active' END ELSE 'active' END AS retention,
    CASE event_id % 6 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE WHEN 3 THEN FALSE END AS truth,
    CASE WHEN event_id % 3 = 0 THEN 'high' WHEN event_id % 3 = 1 THEN 'medium' ELSE 'low' END AS clock, CASE WHEN event_id % 3 = 1 THEN 'high' WHEN event_id % 2 = 0 THEN 'medium' ELSE 'low' END AS capture_clock,
    CAST(round(1000 * (CASE event_id % 5 WHEN 0 THEN 0.82 WHEN 1 THEN 0.58 WHEN 2 THEN 0.3 WHEN 3 THEN 0.18 ELSE 0.2 END - CASE WHEN event_id % 2 = 0 THEN 0.1 ELSE 0 END)) AS BIGINT) AS chunk_ppt,
    CAST(round(1000 * CASE WHEN event_id % 3 = 0 THEN CASE event_id % 2 WHEN 0 THEN 0.2 ELSE 0.62 END WHEN event_id % 2 = 0 THEN least(0.95, 0.35 + 0.55 * (event_id % 11) / 10) ELSE least(0.98, 0.45 + 0.45 * (event_id % 11) / 10) END) AS BIGINT) AS camera_ppt,
    CASE event_id % 4 WHEN 0 THEN 'Mutter' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'A title' ELSE 'Real' END AS app,
    CAST(bit_count(xor(event_id, event_id // 2)) AS INTEGER) AS bits, CASE WHEN event_id % 2 = 0 THEN -1 ELSE event_id END AS signed FROM events"""
)
def scalar_policies(spark, sf_dir):
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    long = F.lit(SAID + " and " + SAID)
    nothing = F.lit(None).cast("string")
    seen = F.when(n % 3 != 0, (n % 11) / 10)
    offset = F.when(n % 3 == 1, F.lit(5))
    return e.select(
        "event_id",
        scoring.artifact_source(chosen(ARTIFACTS, n % 8)).alias("source"),
        scoring.clock_rank(chosen(["high", "medium", "low", "?"], n % 4)).alias("clock_rank"),
        scoring.retention(chosen(STATES, n % 5), F.when(n % 2 == 0, "SUPPRESSED")).alias("retention"),
        scoring.truth(chosen(["Yes", "1", "no", " FALSE", "maybe", None], n % 6)).alias("truth"),
        scoring.clock_confidence(F.when(n % 3 == 0, "high").when(n % 3 == 2, " "), offset).alias("clock"),
        scoring.capture_clock_confidence(offset, F.when(n % 2 == 0, "linux").otherwise("")).alias("capture_clock"),
        F.round(scoring.chunk_confidence(chosen(KINDS, n % 5), F.when(n % 2 == 0, "short").otherwise(long)) * 1000).cast("long").alias("chunk_ppt"),
        F.round(scoring.camera_confidence(F.when(n % 2 == 1, long), seen) * 1000).cast("long").alias("camera_ppt"),
        scoring.frame_app(
            chosen(["Mutter", "gnome-shell", "", "Real"], n % 4), chosen([None, "x mozilla firefox y", "nothing", "slack | x"], n % 4), chosen(["Main Stage", "t", "A title", "u"], n % 4)
        ).alias("app"),
        scoring.hamming(n, F.floor(n / 2)).cast("int").alias("bits"),
        scoring.signed_hash(F.when(n % 2 == 0, F.lit("18446744073709551615")).otherwise(n.cast("string"))).alias("signed"),
    )


# Upserts of every table

SMALL = ["person", "job", "artifact", "event", "event_artifact", "scene_window", "scene_window_artifact", "candidate_claim", "candidate_claim_evidence", "reference_scene", "reference_scene_member", "content_span", "person_voiceprint"]
UPSERTED = [*SMALL, "identity_hypothesis", "identity_hypothesis_evidence", "episode", "episode_event", "memory_build", "day_summary", "coverage_span", "memory_chunk", "chunk_tag", "chunk_ref", "processor_run"]


def cell(name: str, kind: str, k: Column, turn: str) -> Column:
    """A value of a column that tells its row and whether it is an old or a new one."""
    number = k + {"old": 0, "between": 500, "new": 1000}[turn]
    if kind in ("bigint", "double"):
        return number.cast(kind)
    if kind == "timestamp":
        return F.timestamp_seconds(number.cast("long"))
    return F.concat(F.lit(f"{turn} {name} "), k.cast("string"))


def cell_sql(name: str, kind: str, turn: str) -> str:
    number = {"old": "n_nationkey", "between": "n_nationkey + 500", "new": "n_nationkey + 1000"}[turn]
    if kind == "double":
        return f"CAST(CAST({number} AS DOUBLE) AS VARCHAR)"
    if kind == "timestamp":
        return f"strftime(make_timestamp(({number}) * 1000000), '%Y-%m-%d %H:%M:%S')"
    return f"CAST({number} AS VARCHAR)" if kind == "bigint" else f"'{turn} {name} ' || n_nationkey"


def key_cell(name: str, k: Column) -> Column:
    """Keys are texts."""
    return F.concat(F.lit(f"{name} "), k.cast("string"))


def upsert_sql(name: str) -> str:
    """Old rows are nations 0 to 14, new ones 10 to 24, each written twice in one batch, with other values in between: what is fixed comes from the first that was written, the rest from the last."""
    t = TABLES[name]
    parts = []
    for column, kind in (x.split() for x in t.ddl.split(", ")):  # there may be no session yet that could parse it
        if column in t.key:
            parts.append(f"'{column} ' || n_nationkey")
            continue
        new, turn = ("n_nationkey >= 15", "between") if column in t.fixed else ("n_nationkey >= 10", "new")
        parts.append(f"CASE WHEN {new} THEN {cell_sql(column, kind, turn)} ELSE {cell_sql(column, kind, 'old')} END")
    return f"SELECT '{name}' AS tbl, CAST(n_nationkey AS BIGINT) AS k, concat_ws('|', {', '.join(parts)}) AS content FROM nation"


@query(" UNION ALL ".join(map(upsert_sql, UPSERTED)))
def upsert_tables(spark, sf_dir):
    n, out = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), None
    for name in UPSERTED:
        t = TABLES[name]
        old, between, new = (
            n.where(where).select(*[(key_cell(f.name, F.col("k")) if f.name in t.key else cell(f.name, f.dataType.simpleString(), F.col("k"), turn)).alias(f.name) for f in t.schema], F.lit(line).alias("line"))
            for line, turn, where in ((0, "old", "k < 15"), (1, "between", "k >= 10"), (2, "new", "k >= 10"))
        )
        rows = upsert.upsert(old, new.unionByName(between), name, ["line"])
        shown = F.concat_ws("|", *[F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.dataType.simpleString() == "timestamp" else F.col(f.name).cast("string") for f in t.schema])
        rows = rows.select(F.lit(name).alias("tbl"), F.regexp_extract(t.key[0], r"(\d+)$", 1).cast("long").alias("k"), shown.alias("content"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Conditional updates, deletions and cascades


def prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return schema.shaped(
        c.select(
            F.concat(F.lit("v"), F.col("c_custkey").cast("string")).alias("id"), F.when(F.col("c_nationkey") < 20, "u").otherwise("w").alias("user_id"), F.concat(F.lit("p"), F.col("c_nationkey").cast("string")).alias("person_id"),
            F.when(F.col("c_custkey") % 3 == 0, "retired").otherwise("active").alias("status"), F.timestamp_seconds(F.col("c_custkey")).alias("enrolled_at"), F.timestamp_seconds(F.lit(0)).alias("updated_at"),
        ),
        "person_voiceprint",
    )


@query(
    """SELECT 'v' || c_custkey AS id, CASE WHEN hit THEN 'retired' WHEN c_custkey % 3 = 0 THEN 'retired' ELSE 'active' END AS status, CAST(CASE WHEN hit THEN 1767323045 ELSE 0 END AS BIGINT) AS updated
    FROM (SELECT *, c_nationkey = 7 AND c_custkey % 3 <> 0 AND c_custkey NOT IN (5, 10) AS hit FROM customer)"""
)
def voiceprint_update(spark, sf_dir):
    rows = upsert.voiceprint_status(prints(spark, sf_dir), "u", "p7", "active", "retired", ["v5", "v10"], NOW)
    return rows.select("id", "status", F.unix_seconds("updated_at").alias("updated"))


@query(
    """SELECT 'v' || c_custkey AS id, 'name ' || c_nationkey AS display_name, c_custkey AS enrolled, row_number() OVER (ORDER BY c_custkey, 'v' || c_custkey) AS place FROM customer WHERE c_nationkey < 20 AND c_custkey % 3 <> 0 AND c_nationkey <> 3"""
)
def voiceprints_of_people(spark, sf_dir):
    people = table(spark, sf_dir, "nation").where("n_nationkey <> 3").select(F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("name "), F.col("n_nationkey").cast("string")).alias("display_name"))
    rows = scans.voiceprints(prints(spark, sf_dir), people, "u", status="active")
    rows = ranges.places(rows, scans.ordering("person_voiceprint"), keeper(spark))
    return rows.select("id", "display_name", F.unix_seconds("enrolled_at").alias("enrolled"), "place")


def _whole(*order):
    """A window over a few rows, to show the order in which an operator gives them."""
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(0)).orderBy(*order)


@query("SELECT 'e' || event_id AS id, CASE WHEN event_id % 10 = 3 THEN '{\"x\": 1}' ELSE NULL END AS metadata_json FROM events WHERE NOT (event_type = 'click' AND event_id % 2 = 0)")
def spans_deleted_and_set(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    made = F.when(F.col("event_id") % 2 == 0, "Content_Normalizer_v1").otherwise("by hand")
    rows = schema.shaped(e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), F.col("event_type").alias("span_type"), made.alias("created_by")), "content_span")
    left, _ = upsert.delete_like(rows, F.col("span_type") == "click", "content%")
    return upsert.set_where(left, F.col("id").endswith("3"), metadata_json='{"x": 1}').select("id", "metadata_json")


@query("SELECT count(*) AS deleted FROM events WHERE event_type = 'click' AND event_id % 2 = 0")
def spans_deleted_count(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("created_by", F.when(F.col("event_id") % 2 == 0, "Content_Normalizer_v1"))
    return upsert.delete_like(e, F.col("event_type") == "click", "content%")[1]


def story(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders as scenes, their lines as claims and evidence, some as fused events."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    sid = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    cid = F.concat(F.lit("c"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    fused = o.where("o_orderpriority = '2-HIGH'")
    eid = F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))
    return {
        "scene_window": o.select(sid("o_orderkey").alias("id"), F.col("o_orderstatus").alias("user_id")),
        "candidate_claim": li.select(cid.alias("id"), sid("l_orderkey").alias("scene_window_id"), F.when(F.col("l_returnflag") == "R", "Scene_Claims_v1").otherwise("hand").alias("produced_by")),
        "candidate_claim_evidence": li.select(cid.alias("candidate_claim_id"), F.lit("a").alias("artifact_id")),
        "scene_window_artifact": li.select(sid("l_orderkey").alias("scene_window_id"), F.col("l_linenumber").cast("string").alias("artifact_id")),
        "event": fused.select(eid.alias("id"), F.lit("fused_interaction").alias("event_type"), F.lit("scene_claims_v1").alias("created_by"), F.to_json(F.struct(sid("o_orderkey").alias("scene_window_id"))).alias("payload_json")),
        "event_artifact": fused.select(eid.alias("event_id"), F.lit("a").alias("artifact_id")),
    }


@query(
    """WITH inside AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F'), lines AS (SELECT *, 'c' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS c FROM lineitem),
    claims AS (SELECT * FROM lines WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT k FROM inside)),
    fused AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'), gone AS (SELECT l_orderkey AS k FROM claims UNION SELECT k FROM fused),
    events_left AS (SELECT 'e' || o_orderkey AS e FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderkey NOT IN (SELECT k FROM fused))
    SELECT 'scene_window' AS tbl, 's' || o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT k FROM gone)
    UNION ALL SELECT 'candidate_claim', c FROM lines WHERE c NOT IN (SELECT c FROM claims)
    UNION ALL SELECT 'candidate_claim_evidence', c || ' a' FROM lines WHERE c NOT IN (SELECT c FROM claims)
    UNION ALL SELECT 'scene_window_artifact', 's' || l_orderkey || ' ' || l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM gone)
    UNION ALL SELECT 'event', e FROM events_left UNION ALL SELECT 'event_artifact', e || ' a' FROM events_left
    UNION ALL SELECT 'gone claims', c FROM claims UNION ALL SELECT 'gone events', 'e' || k FROM fused UNION ALL SELECT 'gone scenes', 's' || k FROM gone"""
)
def cascade_scene_bundle(spark, sf_dir):
    after, gone = upsert.cascade_scenes(story(spark, sf_dir), F.col("user_id") == "F")
    return _rows_by_name({**after, **{f"gone {name}": df for name, df in gone.items()}})


#: What names a row of the tables that a cascade leaves, where it isn't the first column alone.
NAMED_BY = {
    "candidate_claim_evidence": ["candidate_claim_id", "artifact_id"],
    "scene_window_artifact": ["scene_window_id", "artifact_id"],
    "event_artifact": ["event_id", "artifact_id"],
    "reference_scene_member": ["reference_scene_id", "scene_window_id"],
}


def _rows_by_name(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of some tables, by what names them."""
    return _union([df.select(F.lit(name).alias("tbl"), F.concat_ws(" ", *NAMED_BY.get(name, df.columns[:1])).alias("id")) for name, df in tables.items()])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    """WITH kept AS (SELECT 'e' || o_orderkey AS e FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT')
    SELECT 'reference_scene' AS tbl, 'r' || o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'reference_scene_member', 'r' || l_orderkey || ' ' || l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
    UNION ALL SELECT 'event', e FROM kept UNION ALL SELECT 'event_artifact', e || ' a' FROM kept
    UNION ALL SELECT 'gone references', 'r' || o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'gone events', 'e' || o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'"""
)
def cascade_reference_bundle(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rid = lambda c: F.concat(F.lit("r"), F.col(c).cast("string"))
    eid = F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))
    tables = {
        "reference_scene": o.select(rid("o_orderkey").alias("id"), F.col("o_orderstatus").alias("user_id")),
        "reference_scene_member": li.select(rid("l_orderkey").alias("reference_scene_id"), F.col("l_linenumber").cast("string").alias("scene_window_id")),
        "event": o.select(
            eid.alias("id"), F.lit("cross_device_reference").alias("event_type"), F.when(F.col("o_orderpriority") == "1-URGENT", "hand").otherwise("cross_device_aligner_v1").alias("created_by"),
            F.to_json(F.struct(rid("o_orderkey").alias("reference_scene_id"))).alias("payload_json"),
        ),
        "event_artifact": o.select(eid.alias("event_id"), F.lit("a").alias("artifact_id")),
    }
    after, gone = upsert.cascade_references(tables, F.col("user_id") == "F")
    return _rows_by_name({**after, **{f"gone {name}": df for name, df in gone.items()}})


@query("SELECT event_type AS id, user_id AS user, CASE WHEN user_id % 2 = 0 THEN 'superseded' ELSE 'active' END AS status FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL")
def builds_superseded(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type IN ('view', 'click')").select(F.col("event_type").alias("id"), F.col("user_id").cast("string").alias("user_id")).distinct()
    builds = schema.shaped(e, "memory_build", status="active", generated_at=NOW)
    return memory.supersede(builds, e.where(F.col("user_id").cast("long") % 2 == 0)).select("id", F.col("user_id").cast("long").alias("user"), "status")


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, arg_max('b' || event_id, (ts, 'b' || event_id)) AS build_id FROM events WHERE event_type <> 'error' GROUP BY user_id")
def builds_active(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("id"), F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("generated_at"), F.when(F.col("event_type") == "error", "superseded").otherwise("active").alias("status"))
    return memory.active_build(schema.shaped(rows, "memory_build"))


# Jobs


def job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as children of their orders."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    key = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    state = F.when(F.col("l_returnflag") == "R", "running").when(F.col("l_returnflag") == "A", "done").otherwise("queued")
    child = F.concat(F.lit("c"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    children = li.select(child.alias("id"), key("l_orderkey").alias("parent_job_id"), state.alias("state"), (F.col("l_linenumber") % 3).alias("attempt_count"), F.lit(2).alias("max_attempts"))
    parents = o.select(key("o_orderkey").alias("id"), F.lit(None).cast("string").alias("parent_job_id"), F.lit("queued").alias("state"), F.lit(0).alias("attempt_count"), F.lit(1).alias("max_attempts"))
    return schema.shaped(parents.unionByName(children), "job")


JOB_SQL = "WITH j AS (SELECT l_orderkey AS k, 'c' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_linenumber % 3 AS a, CASE l_returnflag WHEN 'R' THEN 'running' WHEN 'A' THEN 'done' ELSE 'queued' END AS s FROM lineitem)"


@query(
    JOB_SQL
    + f""", f AS (SELECT *, CASE WHEN s = 'running' AND a < 2 THEN 'retrying' WHEN s = 'running' THEN 'failed' ELSE s END AS t FROM j),
    g AS (SELECT k, count(*) FILTER (t NOT IN ('done', 'failed', 'canceled')) AS left_, count(*) FILTER (t = 'failed') AS bad FROM f GROUP BY k)
    SELECT id, t AS state, CASE WHEN t = 'failed' THEN epoch(TIMESTAMP '{NOW}')::BIGINT END AS finished, CASE WHEN s = 'running' THEN 'E' END AS error_code FROM f
    UNION ALL SELECT 'p' || o_orderkey, CASE WHEN left_ > 0 OR left_ IS NULL THEN 'queued' WHEN bad > 0 THEN 'failed' ELSE 'done' END, CASE WHEN left_ = 0 THEN epoch(TIMESTAMP '{NOW}')::BIGINT END, NULL FROM orders LEFT JOIN g ON k = o_orderkey"""
)
def jobs_fail_and_parents_end(spark, sf_dir):
    rows = jobs.failed(job_rows(spark, sf_dir), F.col("state") == "running", NOW, "E", "boom")
    return jobs.complete_parents(rows, NOW).select("id", "state", F.unix_seconds("finished_at").alias("finished"), "error_code")


@query(
    JOB_SQL
    + f"""SELECT id, 'finished' AS status, CAST(a + 1 AS BIGINT) AS run_number, epoch(TIMESTAMP '{NOW}')::BIGINT AS started, {uuid5_sql("'tl-processor-run|' || id || '|' || (a + 1)")} AS run_id FROM j WHERE s = 'queued'"""
)
def job_runs(spark, sf_dir):
    rows = job_rows(spark, sf_dir)
    after, runs = jobs.start(rows, rows.where("state = 'queued' AND parent_job_id IS NOT NULL").select("id"), "w", NOW)
    ended = jobs.finish_runs(runs, F.col("status") == "running", "finished", NOW)
    return ended.select(F.col("job_id").alias("id"), "status", "run_number", F.unix_seconds("started_at").alias("started"), F.col("id").alias("run_id"))


@query(
    JOB_SQL
    + """, t AS (SELECT id, CASE WHEN s = 'running' THEN 'done' WHEN s = 'queued' THEN 'canceled' ELSE s END AS state, CASE WHEN s = 'running' THEN '{"ok": 1}' WHEN s = 'queued' THEN '[]' END AS output_json FROM j)
    SELECT * FROM t UNION ALL SELECT 'p' || o_orderkey, 'canceled', '[]' FROM orders"""
)
def jobs_done_and_set(spark, sf_dir):
    rows = jobs.done(job_rows(spark, sf_dir), F.col("state") == "running", NOW, '{"ok": 1}')
    return jobs.set_state(rows, F.col("state") == "queued", "canceled", finished_at=NOW, output_json="[]").select("id", "state", "output_json")


# Scans and the store


@query(
    """SELECT 'e' || event_id AS id, row_number() OVER (ORDER BY ts, event_id) AS place FROM (SELECT * FROM events WHERE event_type IN ('click', 'view') AND props LIKE '%k%'
      AND ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' ORDER BY ts, event_id LIMIT 40)"""
)
def event_scan(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("id"), F.lit("u").alias("user_id"), "event_type", F.col("ts").cast("timestamp").alias("start_at"), F.lit(None).cast("timestamp").alias("end_at"), F.col("props").alias("payload_json"))
    rows = scans.scan(rows, "event", start="2024-01-02", end="2024-01-20", like={"payload_json": "%_K_%", "event_type": None}, among={"event_type": ["click", "view"]}, limit=40, user_id="u", device_id=None)
    return rows.select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"), F.row_number().over(_whole("start_at", "id")).cast("long").alias("place"))


@query(
    """SELECT 'o' || l_orderkey AS id, 'a' || l_partkey AS artifact_id, CASE l_returnflag WHEN 'A' THEN 'primary' WHEN 'N' THEN 'supporting' ELSE 'context' END AS role, CAST(p_size AS BIGINT) AS captured
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""
)
def artifacts_of_events(spark, sf_dir):
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    key = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    role = F.when(F.col("l_returnflag") == "A", "primary").when(F.col("l_returnflag") == "N", "supporting").otherwise("context")
    links = li.select(key("o", "l_orderkey").alias("event_id"), key("a", "l_partkey").alias("artifact_id"), role.alias("role"))
    arts = p.select(key("a", "p_partkey").alias("id"), F.lit("u").alias("user_id"), F.timestamp_seconds(F.col("p_size").cast("long")).alias("captured_at_wall"))
    evs = table(spark, sf_dir, "orders").select(key("o", "o_orderkey").alias("id"))
    rows = scans.event_artifacts(evs, links, arts)
    return rows.select(F.col("event_id").alias("id"), "artifact_id", "role", F.unix_seconds("captured_at_wall").alias("captured"))


@query("SELECT 'd' || event_id % 3 AS device_id, strftime(ts - INTERVAL 7 HOURS, '%Y-%m-%d') AS day FROM events WHERE user_id % 5 = 2 GROUP BY ALL")
def device_days(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 5).cast("string").alias("user_id"), F.concat(F.lit("d"), (F.col("event_id") % 3).cast("string")).alias("device_id"), F.col("ts").alias("start_at"), F.col("ts").alias("end_at"))
    return scans.device_days(e, "2", -7.0)


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return schema.shaped(e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), (F.col("user_id") % 2).cast("string").alias("user_id"), "event_type", F.col("ts").cast("timestamp").alias("start_at"), F.col("props").alias("payload_json")), "event")


@query(
    """WITH e AS (SELECT event_id, event_type, user_id % 2 AS u, strftime(ts, '%Y-%m-%d') AS day FROM events), first_day AS (SELECT min(day) AS d FROM e), last_day AS (SELECT max(day) AS d FROM e)
    SELECT 'e' || event_id AS id, CASE WHEN event_id % 7 = 0 AND NOT (u = 1 AND day = (SELECT d FROM last_day)) THEN 'new' ELSE event_type END AS shown FROM e
    WHERE NOT (u = 0 AND day = (SELECT d FROM first_day)) AND (NOT (u = 1 AND day = (SELECT d FROM last_day)) OR event_type = 'view')"""
)
def store_replace_day(spark, sf_dir):
    """Write a table, upsert rows of every day, empty one day and replace another, then read."""
    store, e = TableStore(spark, work_folder(spark)), stored_events(spark, sf_dir)
    store.write("event", e)
    changed = e.where(F.substring("id", 2, 20).cast("long") % 7 == 0).withColumn("payload_json", F.lit("new"))
    store.upsert("event", changed)
    span = e.agg(F.min(times.day_of(F.col("start_at"))), F.max(times.day_of(F.col("start_at")))).first()
    one = lambda user, day: spark.createDataFrame([(user, day)], "user_id string, day string")
    store.replace_days("event", spark.createDataFrame([], e.schema), one("0", span[0]))
    store.replace_days("event", e.where((F.col("user_id") == "1") & (times.day_of(F.col("start_at")) == span[1]) & (F.col("event_type") == "view")), one("1", span[1]))
    return store.read("event").select("id", F.when(F.col("payload_json") == "new", "new").otherwise(F.col("event_type")).alias("shown"))


# Sources


@query(
    """WITH best AS (SELECT l_orderkey AS k, arg_max({'t': t, 'e': e}, (length(t), t, e)) AS o FROM (SELECT l_orderkey, repeat(l_returnflag || ' ', l_linenumber) || l_linestatus AS t, l_linestatus || l_suppkey AS e FROM lineitem) GROUP BY 1)
    SELECT o_orderkey AS id, epoch_us(CAST(o_orderdate AS TIMESTAMP)) - 3600000000 AS at_us, 'host' || o_custkey % 7 || '.org:80' AS host, regexp_replace(trim(o.t), ' +', ' ', 'g') AS ocr_text, o.e AS engine, 'a ' || o_orderstatus AS said
    FROM orders LEFT JOIN best ON k = o_orderkey"""
)
def frames_left_join(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    frame = o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00+01:00")).alias("timestamp"), (F.col("o_custkey") % 2).cast("string").alias("machine_id"),
        F.concat(F.lit(" a \n"), F.col("o_orderstatus")).alias("full_text"), F.lit("  ").alias("accessibility_text"), F.concat(F.lit("https://HOST"), (F.col("o_custkey") % 7).cast("string"), F.lit(".org:80/x?y")).alias("browser_url"),
    )
    said = F.concat(F.expr("repeat(concat(l_returnflag, ' '), int(l_linenumber))"), "l_linestatus")
    ocr = li.select(F.col("l_orderkey").alias("frame_id"), said.alias("text"), F.lit(None).cast("string").alias("text_json"), F.concat(F.col("l_linestatus"), F.col("l_suppkey").cast("string")).alias("ocr_engine"))
    rows = screen.frames(frame, ocr)
    return rows.select("id", us(F.col("at")).alias("at_us"), "host", "ocr_text", F.col("ocr_engine").alias("engine"), F.col("full_text").alias("said"))


@query(
    """SELECT l_orderkey AS chunk, l_linenumber AS n, 'f' || o_custkey AS file, s + 60000000 * l_linenumber + CAST(round(l_quantity * 1e5) AS BIGINT) AS start_us, s + 60000000 * l_linenumber + CAST(round((l_quantity + 1) * 1e5) AS BIGINT) AS end_us
    FROM (SELECT *, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE o_orderstatus <> 'P' AND s >= epoch_us(TIMESTAMP '1996-01-01')"""
)
def audio_of_chunks(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    said = rows.select(
        F.col("l_suppkey").alias("id"), F.col("l_orderkey").alias("audio_chunk_id"), "l_linenumber", F.date_format(times.add_micros(F.col("o_orderdate").cast("timestamp"), F.col("l_linenumber") * 60_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.lit(" said  it ").alias("transcription"), (F.col("l_quantity") / 10).alias("start_time"), ((F.col("l_quantity") + 1) / 10).alias("end_time"),
    )
    chunks = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("file_path"), F.lit("m").alias("machine_id"))
    found = screen.audio(said, chunks, machine="m", start="1996-01-01")
    return found.select(F.col("audio_chunk_id").alias("chunk"), F.col("l_linenumber").alias("n"), F.col("file_path").alias("file"), us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"))


@query(
    """SELECT event_id AS id, epoch_us(ts) - epoch_us(ts) % 1000000 AS at_us, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type || ' x' END AS said, row_number() OVER (ORDER BY epoch_us(ts) // 1000000, event_id) AS place
    FROM events WHERE user_id % 2 = 0 AND ts < TIMESTAMP '2024-01-20' ORDER BY place LIMIT 150"""
)
def ui_event_scan(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), (F.col("user_id") % 2).cast("string").alias("machine_id"), F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.concat("event_type", F.lit("\t x "))).alias("text_content"))
    rows = screen.ui_events(rows, machine="0", end="2024-01-20", limit=150)
    return rows.select("id", us(F.col("at")).alias("at_us"), F.col("text_content").alias("said"), F.row_number().over(_whole("at", "id")).cast("long").alias("place"))


def spoken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorder's document for each conversation; those of every third have no chunks."""
    c = table(spark, sf_dir, "conversations")
    chunk = F.struct(F.col("turn").alias("chunk_index"), (F.col("turn") * 2.5).alias("start_seconds"), F.when(F.col("role") == "user", " Room ").alias("source_type"), F.col("text").alias("transcript"), F.lit(" ").alias("primary_language_code"))
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", chunk.alias("c")))).alias("cs"))
    none = F.col("conv_id") % 3 == 0
    at = F.date_format(F.timestamp_seconds(1_700_000_000 + F.col("conv_id") * 3600), "yyyy-MM-dd HH:mm:ss")
    one = F.struct(
        F.concat(F.lit(" f"), F.col("conv_id").cast("string")).alias("file_name"), F.lit(7.5).alias("duration_seconds"), F.when(F.col("conv_id") % 2 == 0, at).alias("recorder_timestamp"), F.concat(at, F.lit("Z")).alias("modified_time"),
        F.lit(" whole ").alias("transcript"), F.lit("en").alias("language"), F.when(~none, F.transform("cs", lambda x: x["c"])).alias("chunks"),
    )
    return rows.select(F.concat(F.lit("/r/"), F.col("conv_id").cast("string"), F.lit(".json")).alias("path"), F.to_json(F.struct(F.array(one).alias("files"))).alias("text"))


@query(
    """WITH f AS (SELECT *, (1700000000 + conv_id * 3600 - CASE WHEN conv_id % 2 = 0 THEN 32400 ELSE 0 END) * 1000000 AS at_us FROM conversations)
    SELECT 'f' || conv_id AS file, turn AS chunk, CAST(turn * 2.5 AS DOUBLE) AS start_seconds, CASE WHEN role = 'user' THEN 'room' ELSE 'unclear' END AS source_type, trim(text, ' ') AS transcript, at_us FROM f WHERE conv_id % 3 <> 0
    UNION ALL SELECT DISTINCT 'f' || conv_id, 1, 0.0, 'unclear', 'whole', at_us FROM f WHERE conv_id % 3 = 0"""
)
def recorder_documents(spark, sf_dir):
    rows = transcripts.recorder_chunks(spoken_documents(spark, sf_dir), "Asia/Tokyo")
    return rows.select(F.col("file_name").alias("file"), F.col("chunk_index").alias("chunk"), "start_seconds", "source_type", "transcript", us(F.col("captured_at")).alias("at_us"))


def camera_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A camera's documents: clips, each named twice, of finished orders; units of their lines; records of some units.  A document holds 500 orders, however many there are."""
    o, li = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), table(spark, sf_dir, "lineitem")
    stem = lambda c: F.concat(F.lit("c"), F.col(c).cast("string"))
    at = lambda days: F.date_format(F.date_add("o_orderdate", days), "yyyy-MM-dd HH:mm:ss")
    clip = lambda days, group: F.struct(stem("o_orderkey").alias("clip_stem"), at(days).alias("timestamp"), F.lit(group).alias("recording_group"), F.lit(3.0).alias("duration_seconds"))
    clips = o.groupBy(F.floor(F.col("o_orderkey") / 500).alias("d")).agg(F.flatten(F.array(F.collect_list(clip(0, "old")), F.collect_list(clip(1, "new")))).alias("clips"))
    unit = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    units = li.groupBy(F.floor(F.col("l_orderkey") / 500).alias("d")).agg(F.collect_list(F.struct(unit.alias("transcription_unit_id"), stem("l_orderkey").alias("clip_stem"), F.concat(F.lit(" "), F.col("l_returnflag")).alias("transcript"), F.array(F.lit(" "), F.col("l_linestatus")).alias("quality_flags"))).alias("transcripts"))
    record = F.to_json(F.struct(unit.alias("transcription_unit_id"), F.col("l_quantity").alias("q")))
    records = li.where("l_linenumber = 1").groupBy(F.floor(F.col("l_orderkey") / 500).alias("d")).agg(F.collect_list(record).alias("rs"))
    records = records.select(F.concat(F.lit('{"records": ['), F.array_join("rs", ","), F.lit(', 7, {"x": 1}]}')).alias("text"))
    document = lambda df, c: df.select(F.concat(F.lit("/g/"), F.col("d").cast("string")).alias("path"), F.to_json(F.struct(c)).alias("text"))
    return document(clips, "clips"), document(units, "transcripts"), records


def camera_units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    clips, units, records = camera_tables(spark, sf_dir)
    return transcripts.unit_join(transcripts.camera_units(units), transcripts.camera_clips(clips, "UTC"), transcripts.camera_records(records))


@query(
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS unit, epoch(CAST(o_orderdate AS TIMESTAMP))::BIGINT + 86400 AS clip_start, 'new' AS recording_group, l_returnflag AS transcript, l_linestatus AS flags,
    CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS DOUBLE) END AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""
)
def camera_documents(spark, sf_dir):
    rows, _ = camera_units(spark, sf_dir)
    return rows.select(F.col("transcription_unit_id").alias("unit"), F.unix_seconds("clip_start").alias("clip_start"), "recording_group", "transcript", F.array_join("quality_flags", ",").alias("flags"), F.get_json_object("record", "$.q").cast("double").alias("q"))


@query("SELECT count(*) AS missing_clips FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def unmatched_units(spark, sf_dir):
    return camera_units(spark, sf_dir)[1]


# Spans

SQUEEZED = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
SPOKEN_KINDS = ["room", "media", "mixed", "Room"]
LANGUAGES = ["en-US", None, "de", "fr"]


def scene_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn of a conversation as a scene."""
    c, n = table(spark, sf_dir, "conversations"), F.col("conv_id") + F.col("turn")
    meta = F.to_json(
        F.struct(
            F.when(n % 5 != 0, F.col("text")).alias("transcript"), chosen(SPOKEN_KINDS, n % 4).alias("source_type"), chosen(LANGUAGES, F.floor(n / 4) % 4).alias("primary_language_code"),
            F.when(n % 7 == 0, F.concat(F.lit(" in  English "), F.col("role"))).alias("english_translation"), F.concat(F.lit("clip"), F.col("conv_id").cast("string")).alias("clip_stem"),
            F.when(n % 2 == 0, F.concat(F.lit("sees "), F.col("role"))).alias("visual_summary"), F.when(n % 6 == 0, "yard").alias("setting"), F.when(n % 6 == 0, F.array(F.lit("a"), F.lit("b"))).alias("scene_labels"),
            F.when(n % 4 == 0, 0.5).alias("visual_confidence"),
        )
    )
    start = F.timestamp_seconds(1_700_000_000 + F.col("conv_id") * 40_000 + F.col("turn") * 60)
    return schema.shaped(
        c.select(
            F.concat(F.lit("s"), F.concat_ws("-", "conv_id", "turn")).alias("id"), F.concat(F.lit("u"), (F.col("conv_id") % 3).cast("string")).alias("user_id"), F.concat(F.lit("d"), (F.col("turn") % 2).cast("string")).alias("primary_device_id"),
            start.alias("start_at"), times.add_micros(start, F.lit(30_000_000)).alias("end_at"), F.lit(5).alias("source_priority"), F.lit(0.7).alias("confidence"), chosen(["camera_visual", "ambient_audio"], n % 2).alias("primary_source_type"), meta.alias("metadata_json"),
        ),
        "scene_window", status="stable",
    )


def span_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as desk audio (errors), activities (clicks and views) and others."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    audio, work = F.col("event_type") == "error", F.col("event_type").isin("click", "view")
    payload = F.to_json(
        F.struct(
            F.when(audio & (n % 2 == 0), F.concat(F.lit(" heard \n"), "event_type")).alias("transcription"), F.when(n % 3 == 0, "App").alias("app_name"), F.lit("mic").alias("device_name"), (n % 4).alias("speaker_id"),
            F.when(n % 5 != 0, "did  it").alias("summary"), F.when(n % 2 == 0, "did it").otherwise("more").alias("specific_activity"), F.when(n % 5 != 0, F.array(*map(F.lit, ["f1", " ", "f2", "f3", "f4"]))).alias("observed_facts"),
            F.when(n % 7 == 0, F.col("event_type")).alias("activity_type"), F.lit("cat").alias("coarse_category"),
        )
    )
    kind = F.when(audio, "desktop_audio_context").when(work, "activity_context").otherwise("app_focus")
    rows = e.select(F.concat(F.lit("e"), n.cast("string")).alias("id"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("user_id"), F.lit("d0").alias("device_id"), kind.alias("event_type"), F.col("ts").cast("timestamp").alias("start_at"), F.lit(0.5).alias("confidence"), F.lit("app_metadata").alias("primary_source_type"), payload.alias("payload_json"))
    return schema.shaped(rows, "event")


def span_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every conversation's first turns in two reference scenes, of which the earlier counts."""
    c = table(spark, sf_dir, "conversations").where("turn < 3").select("conv_id", F.concat(F.lit("s"), F.concat_ws("-", "conv_id", "turn")).alias("scene_window_id"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("r"))
    ref = F.concat(F.col("r"), F.col("conv_id").cast("string"))
    scenes = c.select(ref.alias("id"), F.timestamp_seconds(F.when(F.col("r") == "x", 100).otherwise(50)).alias("start_at")).distinct()
    return schema.shaped(scenes, "reference_scene"), schema.shaped(c.select(ref.alias("reference_scene_id"), "scene_window_id"), "reference_scene_member")


SPANS = f"""WITH c AS (SELECT *, conv_id + turn AS n, 's' || conv_id || '-' || turn AS sid, {listed(SPOKEN_KINDS)}[(conv_id + turn) % 4 + 1] AS kind, {listed(LANGUAGES)}[((conv_id + turn) // 4) % 4 + 1] AS lang FROM conversations),
spoken AS (SELECT *, CASE WHEN n % 7 = 0 THEN 'in English ' || role WHEN n % 5 <> 0 THEN {SQUEEZED.format("text")} END AS heard FROM c),
said AS (SELECT * FROM spoken WHERE heard <> '' AND lower(kind) <> 'media' AND NOT (lower(kind) = 'room' AND coalesce(lang, '') <> '' AND NOT starts_with(lang, 'en'))),
seen AS (SELECT *, concat_ws(chr(10), CASE WHEN n % 2 = 0 THEN 'sees ' || role END, CASE WHEN n % 6 = 0 THEN 'Setting: yard' END, CASE WHEN n % 6 = 0 THEN 'Scene labels: a; b' END) AS t FROM c WHERE n % 2 = 0 OR n % 6 = 0),
spans AS (
  SELECT {uuid5_sql("'tl-content-span|' || sid || '|transcript|v1'")} AS id, 'u' || conv_id % 3 AS user_id, sid AS source, 'transcript' AS span_type, CASE WHEN n % 2 = 0 THEN 'camera_audio' ELSE 'ambient_audio' END AS modality, 'clip' || conv_id AS title, heard AS text, lang AS language,
    NULL AS speaker_label, 0.7 AS confidence, CASE WHEN turn < 3 THEN 'y' || conv_id END AS reference_scene_id, (1700000000 + conv_id * 40000 + turn * 60) AS start_s, (1700000000 + conv_id * 40000 + turn * 60) * 1000000 AS start_us FROM said
  UNION ALL SELECT {uuid5_sql("'tl-content-span|' || sid || '|visual_summary|v1'")}, 'u' || conv_id % 3, sid, 'visual_summary', 'camera_visual', 'clip' || conv_id, t, NULL, NULL, CASE WHEN n % 4 = 0 THEN 0.5 ELSE 0.7 END, CASE WHEN turn < 3 THEN 'y' || conv_id END, (1700000000 + conv_id * 40000 + turn * 60), (1700000000 + conv_id * 40000 + turn * 60) * 1000000 FROM seen
  UNION ALL SELECT {uuid5_sql("'tl-content-span|e' || event_id || '|desktop_audio|v1'")}, 'u' || user_id % 3, 'e' || event_id, 'transcript', 'desktop_audio', CASE WHEN event_id % 3 = 0 THEN 'App' ELSE 'mic' END, 'heard error', NULL, 'speaker_' || event_id % 4, 0.5, NULL, epoch_us(ts) // 1000000, epoch_us(ts)
    FROM events WHERE event_type = 'error' AND event_id % 2 = 0
  UNION ALL SELECT {uuid5_sql("'tl-content-span|e' || event_id || '|activity_summary|v1'")}, 'u' || user_id % 3, 'e' || event_id, 'activity_summary', 'app_metadata', CASE WHEN event_id % 7 = 0 THEN event_type ELSE 'cat' END,
    concat_ws(chr(10), CASE WHEN event_id % 5 <> 0 THEN 'did it' END, CASE WHEN event_id % 2 <> 0 THEN 'more' WHEN event_id % 5 = 0 THEN 'did it' END, CASE WHEN event_id % 5 <> 0 THEN 'Facts: f1; f2; f3' END), NULL, NULL, 0.5, NULL, epoch_us(ts) // 1000000, epoch_us(ts)
    FROM events WHERE event_type IN ('click', 'view'))"""


def span_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.build(scene_rows(spark, sf_dir), span_events(spark, sf_dir), *span_references(spark, sf_dir), NOW)


@query(SPANS + " SELECT * EXCLUDE (start_us) REPLACE (CAST(confidence AS DOUBLE) AS confidence) FROM spans")
def content_spans(spark, sf_dir):
    rows = span_table(spark, sf_dir)
    return rows.select("id", "user_id", F.coalesce("scene_window_id", "event_id").alias("source"), "span_type", "modality", "title", "text", "language", "speaker_label", "confidence", "reference_scene_id", F.unix_seconds("start_at").alias("start_s"))


@query("SELECT 'u' || user_id % 3 AS user_id, strftime(ts - INTERVAL 7 HOURS, '%Y-%m-%d') AS day FROM events UNION SELECT 'u' || conv_id % 3, strftime(make_timestamp((1700000000 + conv_id * 40000 + turn * 60 - 25200) * 1000000), '%Y-%m-%d') FROM conversations")
def content_days(spark, sf_dir):
    return normalize.days(span_events(spark, sf_dir), scene_rows(spark, sf_dir), -7.0)


# References


def adjusted_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scenes whose clocks are as many seconds ahead as their device's number."""
    e, n = events(spark, sf_dir), F.col("id")
    basis = F.struct(F.struct((F.col("device_id") * 1000).alias("median_clock_offset_ms"), F.lit("high").alias("clock_confidence")).alias("time_alignment_basis"))
    names = [s for s in scoring.SOURCE_PRIORITY if s != "unknown"]
    rows = e.select(
        F.concat(F.lit("e"), F.lpad(n.cast("string"), 12, "0")).alias("id"), F.col("user_id").cast("string").alias("user_id"), F.concat(F.lit("d"), F.col("device_id").cast("string")).alias("primary_device_id"), F.col("start_at").cast("timestamp").alias("start_at"),
        F.col("end_at").cast("timestamp").alias("end_at"), ((n % 4) / 4).alias("confidence"), chosen(names, n % 8).alias("primary_source_type"), F.to_json(basis).alias("metadata_json"),
    )
    return schema.shaped(rows, "scene_window", status="stable")


ALIGNED = align.Config(tolerance_seconds=21_600.0, max_group_span_seconds=172_800.0)
MEMBERS = (
    GROUPED
    + f""", m AS (SELECT *, 'e' || lpad(CAST(id AS VARCHAR), 12, '0') AS sid, id % 8 + 1 AS p, (id % 4) / 4.0 AS c, {listed([s for s in scoring.SOURCE_PRIORITY if s != "unknown"])}[id % 8 + 1] AS source FROM walk),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, group_no ORDER BY p, c DESC, s, sid) AS r, dense_rank() OVER (PARTITION BY user_id, group_no ORDER BY device_id) AS dr FROM m),
    groups AS (SELECT user_id, group_no, epoch_us(min(s)) AS start_us, epoch_us(max(e)) AS end_us, count(*) AS members, count(*) FILTER (p <= 5) AS direct, max(c) AS confidence, max(dr) AS devices,
      max(CASE WHEN r = 1 THEN sid END) AS primary_id, max(CASE WHEN r = 1 THEN source END) AS source, max(CASE WHEN r = 1 THEN 'd' || device_id END) AS device FROM ranked GROUP BY user_id, group_no HAVING max(dr) > 1)"""
)


@query(MEMBERS + "SELECT CAST(user_id AS VARCHAR) AS user_id, start_us, end_us, primary_id, device, source, CAST(confidence AS DOUBLE) AS confidence, CAST(members AS VARCHAR) AS members, CAST(direct AS VARCHAR) AS direct FROM groups")
def reference_primary(spark, sf_dir):
    rows = align.build(adjusted_scenes(spark, sf_dir), NOW, ALIGNED).reference_scene
    return rows.select(
        "user_id", us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"), F.col("primary_scene_window_id").alias("primary_id"), F.col("primary_device_id").alias("device"), F.col("primary_source_type").alias("source"), "confidence",
        F.get_json_object("metadata_json", "$.member_count").alias("members"), F.get_json_object("metadata_json", "$.direct_member_count").alias("direct"),
    )


@query(MEMBERS + "SELECT sid AS id, CASE WHEN sid = primary_id THEN 'primary' ELSE 'supporting' END AS role, device_id * 1000 AS offset_ms FROM m JOIN groups USING (user_id, group_no)")
def reference_members(spark, sf_dir):
    rows = align.build(adjusted_scenes(spark, sf_dir), NOW, ALIGNED).reference_scene_member
    return rows.select(F.col("scene_window_id").alias("id"), "role", F.col("alignment_offset_ms").alias("offset_ms"))


@query(MEMBERS + "SELECT CAST(user_id AS VARCHAR) AS user_id, start_us, end_us, primary_id, 'cross_device_aligner_v1' AS created_by, CAST(members AS INTEGER) AS members FROM groups")
def reference_events(spark, sf_dir):
    rows = align.build(adjusted_scenes(spark, sf_dir), NOW, ALIGNED).event
    members = F.size(F.from_json(F.get_json_object("payload_json", "$.member_scene_windows"), "array<string>"))
    return rows.select("user_id", us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"), F.get_json_object("payload_json", "$.primary_scene_window_id").alias("primary_id"), "created_by", members.alias("members"))


# Views of the memory store

REF_KINDS = ["content_span", "artifact", "event", "scene_window", "reference_scene", "day_summary"]
DAY = "'2026-01-0' || (1 + doc_id % 5)"


def memory_store(spark: SparkSession, sf_dir: str) -> retrieval.Store:
    """Documents as chunks of three builds, of which one is the active one; tags and references of each; records that they refer to."""
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    ident = F.concat(F.lit("c"), n.cast("string"))
    build = chosen(["old", "now", "now", "now", "gone"], F.floor(n / 5) % 5)
    day = F.concat(F.lit("2026-01-0"), (1 + n % 5).cast("string"))
    chunks = d.select(
        ident.alias("id"), day.alias("day"), F.lit("u").alias("user_id"), build.alias("build_id"), F.col("source").alias("chunk_type"), F.col("lang").alias("title"), "text", F.when(n % 2 == 0, F.timestamp_seconds(n % 100)).alias("start_at"),
        (n % 7).alias("sort_key"), ((n % 3) / 3.0).alias("confidence"), ((n % 4) / 4.0).alias("salience"),
    )
    tag = lambda kind, value: F.struct(F.lit(kind).alias("tag_type"), value.alias("tag_value"))
    tags = d.select(ident.alias("chunk_id"), F.explode(F.array(tag("lang", F.col("lang")), tag("n", (n % 3).cast("string")))).alias("t")).select("chunk_id", "t.*")
    kind = chosen(REF_KINDS, n % 6)
    refs = d.select(ident.alias("chunk_id"), F.explode(F.array(kind, chosen(REF_KINDS, (n + 1) % 6))).alias("ref_kind"), F.concat(F.lit("r"), (n % 10).cast("string")).alias("ref_id"), F.lit("source").alias("role"), F.lit(0.5).alias("weight"))
    # Records r0 to r7 exist, r8 and r9 don't.
    records = spark.range(8).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), F.lit("u").alias("user_id"), F.concat(F.lit("shown "), F.col("id").cast("string")).alias("text"), F.col("id").alias("k"))
    named = lambda name, column: schema.shaped(records.withColumn(column, F.col("text")), name)
    builds = spark.createDataFrame([("old", "active", "2026-01-01 00:00:00"), ("now", "active", "2026-01-02 00:00:00"), ("gone", "superseded", "2026-01-03 00:00:00")], "id string, status string, at string")
    days = d.select(day.alias("day"), build.alias("build_id")).distinct()
    status = F.when(F.col("day") == "2026-01-03", "partial").otherwise("complete")
    summaries = schema.shaped(days.select(F.concat(F.lit("s"), "build_id", "day").alias("id"), "*", F.lit("u").alias("user_id"), status.alias("status"), F.lit("arc").alias("day_arc")), "day_summary")
    spans = d.select(F.concat(F.lit("v"), n.cast("string")).alias("id"), day.alias("day"), build.alias("build_id"), F.lit("u").alias("user_id"), F.when(n % 2 == 0, F.timestamp_seconds(n)).alias("start_at"), F.col("lang").alias("modality"), F.lit("day_modality").alias("span_kind"))
    return retrieval.Store(
        {
            "memory_build": schema.shaped(builds.withColumn("generated_at", F.col("at")), "memory_build", user_id="u"), "memory_chunk": schema.shaped(chunks, "memory_chunk"), "chunk_tag": tags, "chunk_ref": refs,
            "day_summary": summaries.unionByName(named("day_summary", "day_arc")), "coverage_span": schema.shaped(spans, "coverage_span"), "content_span": named("content_span", "title"), "artifact": named("artifact", "storage_uri"),
            "event": named("event", "device_id"), "scene_window": named("scene_window", "primary_device_id"), "reference_scene": named("reference_scene", "primary_device_id"),
        }
    )


CURRENT = f"WITH d AS (SELECT *, 'c' || doc_id AS id, {DAY} AS day, doc_id % 7 AS sort_key, CASE WHEN doc_id % 2 = 0 THEN doc_id % 100 END AS start_s FROM documents), now AS (SELECT * FROM d WHERE (doc_id // 5) % 5 IN (1, 2, 3))"
REFS = f"{listed(REF_KINDS)}"


@query(
    CURRENT
    + f"""SELECT id, 'lang=' || lang || ';n=' || doc_id % 3 AS tags, array_to_string(list_sort([{REFS}[doc_id % 6 + 1] || ':r' || doc_id % 10, {REFS}[(doc_id + 1) % 6 + 1] || ':r' || doc_id % 10]), ',') AS refs,
    row_number() OVER (ORDER BY sort_key, start_s NULLS FIRST, id) AS place FROM (SELECT * FROM now WHERE day = '2026-01-02' ORDER BY sort_key, start_s NULLS FIRST, id LIMIT 200)"""
)
def chunk_tags_grouped(spark, sf_dir):
    """A day's timeline, of 200 chunks at most, with their tags and references."""
    rows = retrieval.timeline(memory_store(spark, sf_dir), "u", "2026-01-02", 999)
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    refs = F.array_join(F.transform("refs", lambda r: F.concat(r["ref_kind"], F.lit(":"), r["ref_id"])), ",")
    return rows.select("id", tags.alias("tags"), refs.alias("refs"), F.row_number().over(_whole(*retrieval.in_order())).cast("long").alias("place"))


@query(
    CURRENT
    + f"""SELECT id AS chunk_id, kind AS ref_kind, 'r' || doc_id % 10 AS ref_id, 'shown ' || doc_id % 10 AS shown FROM (SELECT *, unnest([{REFS}[doc_id % 6 + 1], {REFS}[(doc_id + 1) % 6 + 1]]) AS kind FROM d WHERE doc_id % 3 = 0) WHERE doc_id % 10 < 8"""
)
def evidence_lookup(spark, sf_dir):
    ids_asked = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"))
    rows = retrieval.evidence(memory_store(spark, sf_dir), ids_asked)
    shown = F.coalesce(*[F.get_json_object("record_json", f"$.{k}") for k in ("day_arc", "title", "storage_uri", "device_id", "primary_device_id")])
    return rows.select("chunk_id", "ref_kind", "ref_id", shown.alias("shown"))


@query(
    CURRENT
    + """, n AS (SELECT * FROM now WHERE day = '2026-01-03'), c AS (SELECT source, count(*) AS k FROM n GROUP BY 1), t AS (SELECT * FROM n ORDER BY sort_key, start_s NULLS FIRST, id LIMIT 24)
    SELECT '2026-01-03' AS day, 'partial' AS status, (SELECT string_agg(source || '=' || k, ',' ORDER BY k DESC, source) FROM c) AS counts, (SELECT string_agg(id, ',' ORDER BY sort_key, start_s NULLS FIRST, id) FROM t) AS first_chunks,
    (SELECT count(*) FROM n)::INTEGER AS spans"""
)
def day_view(spark, sf_dir):
    rows = retrieval.day(memory_store(spark, sf_dir), "u", "2026-01-03")
    counts = F.array_join(F.transform("chunk_counts", lambda x: F.concat(x["chunk_type"], F.lit("="), x["n"].cast("string"))), ",")
    return rows.select("day", "status", counts.alias("counts"), F.array_join(F.transform("timeline", lambda x: x["id"]), ",").alias("first_chunks"), F.size("coverage").alias("spans"))


@query(CURRENT + "SELECT 'now' AS build_id, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day, 'complete,partial' AS statuses, '2026-01-03' AS open_days FROM now")
def environment_view(spark, sf_dir):
    rows = retrieval.environment(memory_store(spark, sf_dir), "u")
    return rows.select("build_id", "days", "first_day", "last_day", F.array_join("statuses", ",").alias("statuses"), F.array_join(F.transform("open_days", lambda x: x["day"]), ",").alias("open_days"))


@query(CURRENT + "SELECT 'v' || doc_id AS id, lang AS modality, CASE WHEN doc_id % 2 = 0 THEN doc_id END AS start_s, row_number() OVER (ORDER BY CASE WHEN doc_id % 2 = 0 THEN doc_id END NULLS FIRST, 'v' || doc_id) AS place FROM now WHERE day = '2026-01-04'")
def coverage_view(spark, sf_dir):
    rows = retrieval.coverage(memory_store(spark, sf_dir), "u", "2026-01-04")
    rows = ranges.places(rows, [F.col("start_at").asc_nulls_first(), F.col("id")], keeper(spark))
    return rows.select("id", "modality", F.unix_seconds("start_at").alias("start_s"), "place")


@query(CURRENT + "SELECT id, lang AS title, sort_key, 'n=' || doc_id % 3 AS tag FROM d WHERE id = 'c17'")
def chunk_view(spark, sf_dir):
    return retrieval.chunk(memory_store(spark, sf_dir), "u", "c17").select("id", "title", "sort_key", F.concat(F.lit("n="), F.col("tags")["n"][0]).alias("tag"))


@query(
    CURRENT
    + """, asked AS (
      SELECT 'timeloom://chunk/' || id AS uri FROM d WHERE doc_id % 3 = 0 UNION SELECT 'timeloom://day/' || day FROM d UNION SELECT 'timeloom://coverage/' || day FROM d
      UNION SELECT 'timeloom://notes/corrections/' || CAST(o_orderdate AS DATE) FROM orders UNION SELECT 'timeloom://nobody' UNION SELECT 'other://day/2026-01-01' UNION SELECT 'timeloom://day/2026-01-01/x')
    SELECT a.uri, CASE WHEN c.id IS NOT NULL OR s.day IS NOT NULL THEN 'application/json' WHEN n.date IS NOT NULL THEN 'text/markdown' END AS mime_type,
      coalesce(c.lang || ' ' || c.sort_key, s.said, n.text) AS shown
    FROM asked a
    LEFT JOIN d c ON a.uri = 'timeloom://chunk/' || c.id
    LEFT JOIN (SELECT kind, day, CASE WHEN day = '2026-01-03' THEN 'partial ' ELSE 'complete ' END || count(*) AS said FROM now, (VALUES ('day'), ('coverage')) k(kind) GROUP BY kind, day) s ON a.uri = 'timeloom://' || s.kind || '/' || s.day
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date, 'orders ' || count(*) AS text FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) n ON a.uri = 'timeloom://notes/corrections/' || n.date"""
)
def resource_rows(spark, sf_dir):
    """Chunks, days, coverage and dated notes by their addresses, of which some name nothing."""
    store, d, o = memory_store(spark, sf_dir), table(spark, sf_dir, "documents"), table(spark, sf_dir, "orders")
    chunks = store["memory_chunk"]
    at = lambda path, c: F.concat(F.lit(f"timeloom://{path}/"), c)
    dated = F.date_format("o_orderdate", "yyyy-MM-dd")
    uris = d.where("doc_id % 3 = 0").select(at("chunk", F.concat(F.lit("c"), F.col("doc_id").cast("string"))).alias("uri"))
    for more in (chunks.select(at("day", F.col("day"))), chunks.select(at("coverage", F.col("day"))), o.select(at("notes/corrections", dated)), spark.createDataFrame([("timeloom://nobody",), ("other://day/2026-01-01",), ("timeloom://day/2026-01-01/x",)], "uri string")):
        uris = uris.union(more)
    notes = o.where("o_orderstatus <> 'P'").groupBy(F.concat(F.lit("notes/corrections/"), dated).alias("name")).agg(F.concat(F.lit("orders "), F.count("*").cast("string")).alias("text"))
    rows = resources.content(store, notes, uris, "u")
    field = lambda name: F.get_json_object("content", f"$.{name}")
    spans = F.size(F.from_json(field("coverage_spans"), "array<struct<modality:string>>")).cast("string")
    sort_key = chunks.select(at("chunk", F.col("id")).alias("uri"), F.col("sort_key").cast("string").alias("k"))
    rows = rows.join(sort_key, "uri", "left")
    shown = F.when(F.col("uri").contains("/chunk/"), F.concat_ws(" ", field("title"), "k")).when(F.col("mime_type") == resources.JSON, F.concat_ws(" ", field("status"), spans)).otherwise(F.col("content"))
    return rows.select("uri", "mime_type", shown.alias("shown"))


PLAIN_WORD = "regexp_replace(lower(strip_accents(w)), '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')"


@query(
    CURRENT
    + f""", w AS (SELECT *, regexp_extract_all(lower(strip_accents(coalesce(lang, ''))), '[\\p{{L}}\\p{{N}}]+') || regexp_extract_all(lower(strip_accents(coalesce(text, ''))), '[\\p{{L}}\\p{{N}}]+') AS ws FROM now),
    f AS (SELECT *, len(list_filter(ws, lambda x: x = 'license')) AS t1, len(list_filter(ws, lambda x: starts_with(x, 'reserv'))) AS t2, len(ws) AS n FROM w),
    st AS (SELECT count(*) AS nd, avg(n) AS av, count(*) FILTER (t1 > 0) AS n1, count(*) FILTER (t2 > 0) AS n2 FROM f),
    sc AS (SELECT f.*, greatest(1e-6, ln((nd - n1 + 0.5) / (n1 + 0.5))) * t1 * 2.2 / (t1 + 1.2 * (0.25 + 0.75 * n / av)) + greatest(1e-6, ln((nd - n2 + 0.5) / (n2 + 0.5))) * t2 * 2.2 / (t2 + 1.2 * (0.25 + 0.75 * n / av)) AS score FROM f, st
      WHERE (t1 > 0 OR t2 > 0) AND day >= '2026-01-02' AND day <= '2026-01-04' AND doc_id % 3 <> 1 AND doc_id % 3 = 0),
    p AS (SELECT *, regexp_split_to_array(trim(text, ' '), '\\s+') AS parts FROM sc ORDER BY score DESC, id LIMIT 50),
    q AS (SELECT *, len(parts) AS m, list_transform(parts, lambda w: CASE WHEN {PLAIN_WORD} = 'license' THEN 0 WHEN starts_with({PLAIN_WORD}, 'reserv') THEN 1 END) AS who FROM p),
    h AS (SELECT id, unnest(range(1, m + 1)) AS place, unnest(who) AS who FROM q),
    v AS (SELECT a.id, a.place, count(DISTINCT b.who) AS terms, count(b.who) AS n, max(b.place) AS last FROM h a JOIN h b ON b.id = a.id AND b.place >= a.place AND b.place < a.place + 16 AND b.who IS NOT NULL WHERE a.who IS NOT NULL GROUP BY ALL),
    g AS (SELECT q.*, (CASE WHEN v.place IS NULL THEN 1 ELSE greatest(1, least(v.place - floor((15 - (v.last - v.place)) / 2), m - 16 + 1)) END)::INTEGER AS b FROM q LEFT JOIN (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY terms DESC, n DESC, place) = 1) v USING (id))
    SELECT id, CAST(floor(score * 1e6 + 0.5) AS BIGINT) AS score_ppm, 'lang=' || lang AS tag, CASE WHEN b > 1 THEN '...' ELSE '' END
      || array_to_string(list_transform(list_zip(parts, who)[b:b + 15], lambda w: CASE WHEN w[2] IS NOT NULL THEN '[' || w[1] || ']' ELSE w[1] END), ' ') || CASE WHEN b + 16 <= m THEN '...' ELSE '' END AS snippet FROM g"""
)
def memory_search(spark, sf_dir):
    """Full-text search in the active build, with a range of days and a tag, with snippets and tags; the index is stored."""
    store = memory_store(spark, sf_dir)

    def build(folder: str) -> None:
        inverted.add(folder, store["memory_chunk"], "id", list(search.FIELDS), "build_id")

    ix = inverted.opened(spark, index_once(spark, sf_dir, "chunks", build), list(search.FIELDS), "string")
    how, rows = retrieval.search_memory(store, "u", "license OR reserv*", 50, ix, keeper(spark), day_from="2026-01-02", day_to="2026-01-04", tags=["n:0"])
    if how != "fts":
        raise AssertionError(how)
    return rows.select("id", F.floor(F.col("score") * 1e6 + 0.5).cast("long").alias("score_ppm"), F.concat(F.lit("lang="), F.col("tags")["lang"][0]).alias("tag"), "snippet")


# Scenes and claims

SCENES = scenes.Config(gap_seconds=HALF_DAY, max_window_seconds=86_400.0)


def interpreted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events with their artifacts: a video for every fifth, for others the application's data and, for every second, a screenshot."""
    e, n = events(spark, sf_dir), F.col("id")
    eid = F.concat(F.lit("e"), F.lpad(n.cast("string"), 12, "0"))
    category = F.when(F.col("kind") == "capture", "capture_control").otherwise(F.col("kind"))
    rows = e.select(
        eid.alias("id"), F.col("user_id").cast("string").alias("user_id"), F.concat(F.lit("d"), F.col("device_id").cast("string")).alias("device_id"), F.lit("activity_context").alias("event_type"), F.col("start_at").cast("timestamp").alias("start_at"),
        F.col("end_at").cast("timestamp").alias("end_at"), ((n % 4) / 4).alias("confidence"), F.to_json(F.struct(category.alias("coarse_category"), F.col("event_type").alias("summary"))).alias("payload_json"), F.lit("Interpreter_v1").alias("created_by"),
    )
    part = lambda kind, role: F.struct(F.concat(F.lit(f"{kind}-"), eid).alias("artifact_id"), F.lit(kind).alias("artifact_type"), F.lit(role).alias("role"))
    parts = F.when(n % 5 == 0, F.array(part("video_excerpt", "primary"))).when(n % 2 == 0, F.array(part("app_metadata", "primary"), part("screenshot", "supporting"))).otherwise(F.array(part("app_metadata", "primary")))
    links = e.select(eid.alias("event_id"), "event_type", "k", "device_id", n.alias("n"), F.explode(parts).alias("p")).select("*", "p.*")
    meta = F.when(F.col("artifact_type") == "app_metadata", F.to_json(F.struct(F.col("event_type").alias("frontmost_app_name"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("t"), F.col("k").cast("string"))).alias("window_title"))))
    artifacts = links.select(
        F.col("artifact_id").alias("id"), "artifact_type", F.concat(F.lit("/"), "artifact_id").alias("storage_uri"), (F.col("device_id") * 1000).alias("clock_offset_ms"), chosen(["high", "medium", "low"], F.col("n") % 3).alias("clock_confidence"), meta.alias("metadata_json"),
    )
    return schema.shaped(rows, "event"), schema.shaped(links.withColumn("confidence", F.lit(0.5)), "event_artifact"), schema.shaped(artifacts, "artifact")


def scene_tables(spark: SparkSession, sf_dir: str) -> scenes.Scenes:
    folder = work_folder(spark)
    return scenes.build(*interpreted(spark, sf_dir), NOW, SCENES, keep=lambda df: stored(df, folder, "scenes"))


R3 = "CAST(round(CAST(CAST({} AS VARCHAR) AS DECIMAL(38, 18)), 3) AS DOUBLE)"
SCENE_SQL = f"""WITH RECURSIVE {EV}, x AS (SELECT *, 'e' || lpad(CAST(id AS VARCHAR), 12, '0') AS sid, CASE WHEN id % 5 <> 0 THEN event_type END AS app, CASE WHEN kind = 'capture' THEN 'capture_control' ELSE kind END AS cat,
  CASE WHEN id % 5 <> 0 AND k % 2 = 0 THEN 't' || k END AS title, (id % 4) / 4.0 AS conf FROM ev),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, device_id ORDER BY start_at, end_at, sid) AS rn FROM x),
walk AS (
  SELECT sid, user_id, device_id, rn, end_at, app, cat, start_at AS first_at, 1 AS scene_no FROM n WHERE rn = 1
  UNION ALL
  SELECT n.sid, n.user_id, n.device_id, n.rn, n.end_at, n.app, n.cat, CASE WHEN y.ok THEN w.first_at ELSE n.start_at END, w.scene_no + CASE WHEN y.ok THEN 0 ELSE 1 END
  FROM walk w JOIN n ON n.user_id = w.user_id AND n.device_id = w.device_id AND n.rn = w.rn + 1,
    LATERAL (SELECT date_diff('microsecond', w.end_at, n.start_at) <= 43200000000 AND date_diff('microsecond', w.first_at, n.end_at) <= 86400000000 AND coalesce(n.app = w.app OR n.cat = w.cat, n.cat = w.cat) AS ok) y),
m AS (SELECT n.*, scene_no FROM n JOIN walk USING (user_id, device_id, rn)),
ac AS (SELECT user_id, device_id, scene_no, app, count(*) AS c, min(rn) AS f FROM m WHERE app IS NOT NULL GROUP BY ALL), cc AS (SELECT user_id, device_id, scene_no, cat, count(*) AS c, min(rn) AS f FROM m GROUP BY ALL),
ab AS (SELECT user_id, device_id, scene_no, arg_max(app, (c, -f)) AS dapp, max(c) AS app_n FROM ac GROUP BY ALL), cb AS (SELECT user_id, device_id, scene_no, arg_max(cat, (c, -f)) AS dcat, max(c) AS cat_n FROM cc GROUP BY ALL),
g AS (SELECT user_id, device_id, scene_no, min(start_at) AS st, arg_max(end_at, rn) AS en, count(*) AS n, sum(CAST(conf AS DOUBLE)) / count(*) AS base, count(title) / count(*) AS titles, count(*) FILTER (id % 5 <> 0) / count(*) AS ds,
  count(DISTINCT app) AS apps, count(DISTINCT cat) AS cats, min(id % 3) AS clock, bool_or(id % 5 <> 0 AND id % 2 = 0) AS shot, bool_or(id % 5 = 0) AS video FROM m GROUP BY ALL),
s AS (SELECT *, coalesce(app_n, 0) / n AS ash, cat_n / n AS csh, ds > 0 AS direct FROM g LEFT JOIN ab USING (user_id, device_id, scene_no) JOIN cb USING (user_id, device_id, scene_no)),
q AS (SELECT *, greatest(0.0, least(1.0, base * 0.5 + titles * 0.2 + ash * 0.15 + ds * 0.15)) AS qual FROM s),
r AS (SELECT *, {R3.format("greatest(0.0, least(1.0, base * 0.5 + qual * 0.2 + ash * 0.1 + csh * 0.1 + ds * 0.15 - (CASE WHEN apps > 1 THEN 0.15 ELSE 0.0 END + CASE WHEN cats > 1 THEN 0.1 ELSE 0.0 END)))")} AS conf FROM q),
claims AS (
  SELECT *, 'device_attended' AS claim_type, greatest(conf, CASE WHEN direct THEN 0.75 ELSE 0.55 END) AS cbase, CASE WHEN direct THEN 0.95 ELSE 0.6 END AS support, 0.0 AS conflict FROM r
  UNION ALL SELECT *, 'app_in_focus', conf * greatest(ash, 0.5), ash, CASE WHEN apps > 1 THEN 0.35 ELSE 0.0 END FROM r WHERE dapp IS NOT NULL
  UNION ALL SELECT *, 'task_context', conf * greatest(csh, 0.5), csh, CASE WHEN cats > 1 THEN 0.2 ELSE 0.0 END FROM r
  UNION ALL SELECT *, 'capture_control', greatest(conf, 0.8), 0.95, 0.0 FROM r WHERE dcat = 'capture_control'),
judged AS (SELECT *, greatest(0.0, least(1.0, cbase * 0.55 + conf * 0.2 + support * 0.25 - conflict * 0.3)) AS fin FROM claims),
scene_ids AS (SELECT user_id, device_id, scene_no, strftime(st, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(st) % 1000000 = 0 THEN '' ELSE '.' || strftime(st, '%f') END || 'Z' AS a, strftime(en, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(en) % 1000000 = 0 THEN '' ELSE '.' || strftime(en, '%f') END || 'Z' AS b, dapp FROM r),
named AS (SELECT user_id, device_id, scene_no, {uuid5_sql("'tl-scene-window|' || user_id || '|d' || device_id || '|' || a || '|' || b || '|' || coalesce(dapp, '') || '|v1'")} AS scene_id FROM scene_ids)"""
FLAGS_SQL = "concat_ws(',', CASE WHEN titles < 0.5 THEN 'missing_window_titles' END, CASE WHEN apps > 1 THEN 'mixed_app_focus' END, CASE WHEN cats > 1 THEN 'mixed_category_context' END, CASE WHEN ds <= 0 THEN 'indirect_only' END)"


@query(
    SCENE_SQL
    + f"""SELECT scene_id AS id, CAST(user_id AS VARCHAR) AS user_id, epoch_us(st) AS start_us, epoch_us(en) AS end_us, CAST(round(conf * 1000) AS BIGINT) AS confidence_ppt, CASE WHEN direct THEN 'device_segment' ELSE 'sensor_segment' END AS window_type,
    CASE WHEN direct THEN 'app_metadata' ELSE 'camera_visual' END AS source, dapp AS app, dcat AS category, {FLAGS_SQL} AS flags, concat_ws(',', CASE WHEN direct THEN 'app_metadata' END, CASE WHEN video THEN 'camera_visual' END, CASE WHEN shot THEN 'screenshot' END) AS source_types,
    device_id * 1000 AS offset_ms, {listed(["high", "medium", "low"])}[clock + 1] AS clock, CAST(n AS VARCHAR) AS n FROM r JOIN named USING (user_id, device_id, scene_no)"""
)
def scene_build(spark, sf_dir):
    w = scene_tables(spark, sf_dir).scene_window
    meta = "dominant_app_name string, dominant_category string, quality_flags array<string>, source_types array<string>, median_clock_offset_ms bigint, clock_confidence string, event_count string"
    w = w.withColumn("meta", F.from_json("metadata_json", meta))
    return w.select(
        "id", "user_id", us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"), F.round(F.col("confidence") * 1000).cast("long").alias("confidence_ppt"), "window_type", F.col("primary_source_type").alias("source"),
        F.col("meta.dominant_app_name").alias("app"), F.col("meta.dominant_category").alias("category"), F.array_join("meta.quality_flags", ",").alias("flags"), F.array_join("meta.source_types", ",").alias("source_types"),
        F.col("meta.median_clock_offset_ms").alias("offset_ms"), F.col("meta.clock_confidence").alias("clock"), F.col("meta.event_count").alias("n"),
    )


@query(
    SCENE_SQL
    + f"""SELECT scene_id, claim_type, CAST(round(1000 * {R3.format("fin")}) AS BIGINT) AS final_ppt, CASE WHEN fin >= 0.72 THEN 'accepted' WHEN fin >= 0.45 THEN 'ambiguous' ELSE 'rejected' END AS disposition
    FROM judged JOIN named USING (user_id, device_id, scene_no)"""
)
def scene_claims(spark, sf_dir):
    c = scene_tables(spark, sf_dir).candidate_claim
    return c.select(F.col("scene_window_id").alias("scene_id"), "claim_type", F.round(F.col("final_confidence") * 1000).cast("long").alias("final_ppt"), "disposition")


@query(
    SCENE_SQL
    + """, c AS (SELECT user_id, device_id, scene_no, scene_id, claim_type, dapp FROM judged JOIN named USING (user_id, device_id, scene_no)), cm AS (SELECT scene_id, claim_type, dapp, m.* FROM c JOIN m USING (user_id, device_id, scene_no))
    SELECT scene_id, claim_type, sid AS evidence, CASE WHEN dapp IS NULL OR app = dapp THEN 'supporting' ELSE 'contradictory' END AS role FROM cm
    UNION ALL SELECT scene_id, claim_type, 'video_excerpt-' || sid, 'supporting' FROM cm WHERE id % 5 = 0
    UNION ALL SELECT scene_id, claim_type, 'app_metadata-' || sid, CASE WHEN app <> dapp THEN 'contradictory' ELSE 'metadata_support' END FROM cm WHERE id % 5 <> 0
    UNION ALL SELECT scene_id, claim_type, 'screenshot-' || sid, 'supporting' FROM cm WHERE id % 5 <> 0 AND id % 2 = 0"""
)
def claim_evidence_roles(spark, sf_dir):
    made = scene_tables(spark, sf_dir)
    claims = made.candidate_claim.select(F.col("id").alias("candidate_claim_id"), F.col("scene_window_id").alias("scene_id"), "claim_type")
    rows = made.candidate_claim_evidence.join(claims, "candidate_claim_id")
    return rows.select("scene_id", "claim_type", F.coalesce("event_id", "artifact_id").alias("evidence"), F.col("evidence_role").alias("role"))


@query(
    SCENE_SQL
    + """, parts AS (SELECT user_id, device_id, scene_no, unnest(CASE WHEN id % 5 = 0 THEN ['video_excerpt-' || sid] WHEN id % 2 = 0 THEN ['app_metadata-' || sid, 'screenshot-' || sid] ELSE ['app_metadata-' || sid] END) AS artifact FROM m)
    SELECT scene_id, artifact, CASE WHEN starts_with(artifact, 'app') OR (starts_with(artifact, 'video') AND NOT direct) THEN 'primary' ELSE 'supporting' END AS role FROM parts JOIN r USING (user_id, device_id, scene_no) JOIN named USING (user_id, device_id, scene_no)"""
)
def scene_artifact_roles(spark, sf_dir):
    return scene_tables(spark, sf_dir).scene_window_artifact.select(F.col("scene_window_id").alias("scene_id"), F.col("artifact_id").alias("artifact"), "role")


@query(
    SCENE_SQL
    + f"""SELECT {uuid5_sql("'tl-scene-event|' || scene_id || '|v1'")} AS id, scene_id, CAST(n AS INTEGER) AS sources, accepted FROM r JOIN named USING (user_id, device_id, scene_no)
    LEFT JOIN (SELECT user_id, device_id, scene_no, string_agg(claim_type, ',' ORDER BY claim_type) AS accepted FROM judged WHERE fin >= 0.72 GROUP BY ALL) USING (user_id, device_id, scene_no)"""
)
def scene_events(spark, sf_dir):
    said = F.from_json("payload_json", "scene_window_id string, source_event_ids array<string>, accepted_claims array<struct<claim_type:string>>")
    made = scene_tables(spark, sf_dir).event.select("id", said.alias("said"))
    return made.select("id", F.col("said.scene_window_id").alias("scene_id"), F.size("said.source_event_ids").alias("sources"), F.array_join("said.accepted_claims.claim_type", ",").alias("accepted"))


# The memory store

SIDECAR = (
    '{"day_arc": " arc  %s", "topics": ["t1", " t1 ", "t2"], "tools_used": ["vim"], "people": [{"name": "P %s", "context": "c"}, "x"], "decisions_observed": ["d1", {"title": "T", "description": "D"}, {"x": 1}], '
    '"time_blocks": [{"start_utc": "9:00", "end_utc": "10:30", "description": " did ", "primary_activity": "code"}, {"start_hour": "23", "end_hour": "1", "label": "L"}], "activities": {"mail": "1", "code": "2.5"}}'
)


def day_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of notes for a day of each nation: some without biography, some with a broken sidecar, some incomplete."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("u"), (n % 3).cast("string")).alias("user_id"), F.date_format(F.date_add(F.lit("2023-11-15").cast("date"), n.cast("int")), "yyyy-MM-dd").alias("day"),
        F.when(n % 3 != 0, F.concat(F.lit("---\na: b\n---\n\nBio "), n.cast("string"))).alias("biography"), F.when(n % 4 == 0, "oops").otherwise(F.format_string(SIDECAR, n.cast("string"), n.cast("string"))).alias("sidecar"),
        F.when(n % 5 == 0, "why").when(n % 5 == 1, " ").alias("incomplete"),
    )


def memory_tables(spark: SparkSession, sf_dir: str) -> memory.Memory:
    return memory.build(stored(span_table(spark, sf_dir), work_folder(spark), "spans"), day_notes(spark, sf_dir), NOW)


def said_of(made: memory.Memory, rows: DataFrame) -> DataFrame:
    """Rows of tags or references with the chunk that they belong to."""
    return rows.join(made.memory_chunk.select(F.col("id").alias("chunk_id"), "user_id", "day", "chunk_type", "sort_key"), "chunk_id")


MEMORY = (
    SPANS
    + """, f AS (SELECT n_nationkey AS n, 'u' || n_nationkey % 3 AS user_id, strftime(DATE '2023-11-15' + n_nationkey::INTEGER, '%Y-%m-%d') AS day, CASE WHEN n_nationkey % 3 <> 0 THEN 'Bio ' || n_nationkey END AS bio, n_nationkey % 4 <> 0 AS side, CASE WHEN n_nationkey % 5 = 0 THEN 'why' END AS inc FROM nation),
    sp AS (SELECT *, strftime(make_timestamp(start_us - 25200000000), '%Y-%m-%d') AS day FROM spans), cnt AS (SELECT user_id, day, count(*) AS k FROM sp GROUP BY ALL),
    days AS (SELECT user_id, day, n, bio, coalesce(side, FALSE) AS side, inc, coalesce(k, 0) AS k FROM f FULL JOIN cnt USING (user_id, day)),
    st AS (SELECT *, CASE WHEN inc IS NOT NULL THEN 'incomplete' WHEN bio IS NOT NULL AND side THEN 'complete' WHEN bio IS NOT NULL OR side THEN 'partial' WHEN k > 0 THEN 'evidence_only' ELSE 'empty' END AS status,
      CASE WHEN inc IS NOT NULL THEN 0.6 WHEN bio IS NOT NULL AND side THEN 0.95 WHEN bio IS NOT NULL OR side THEN 0.55 WHEN k > 0 THEN 0.35 ELSE 0.0 END AS share FROM days),
    content AS (SELECT sp.*, status, share, row_number() OVER (PARTITION BY user_id, day ORDER BY start_us, id) - 1 AS i FROM sp JOIN st USING (user_id, day)),
    chunks AS (
      SELECT user_id, day, 'biography' AS chunk_type, 0 AS sort_key, day || ' biography' AS title, bio AS text, 0.92 AS confidence, 1.0 AS salience, share AS completeness FROM st WHERE bio IS NOT NULL
      UNION ALL SELECT user_id, day, 'day_arc', 10, day || ' arc', 'arc ' || n, 0.88, 0.95, share FROM st WHERE side UNION ALL SELECT user_id, day, 'time_block', 100, 'code', 'did', 0.8, 0.85, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'decision', 300, NULL, 'd1', 0.78, 0.7, share FROM st WHERE side UNION ALL SELECT user_id, day, 'decision', 301, 'T', 'D', 0.78, 0.7, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'person_context', 700, 'P ' || n, 'c', 0.78, 0.7, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'topic', 800, 'topic', 't1', 0.78, 0.7, share FROM st WHERE side UNION ALL SELECT user_id, day, 'topic', 801, 'topic', 't2', 0.78, 0.7, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'tool_used', 900, 'tool', 'vim', 0.78, 0.7, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'activity_total', 1000, 'code', 'code: 2.5 hours', 0.82, 0.72, share FROM st WHERE side UNION ALL SELECT user_id, day, 'activity_total', 1001, 'mail', 'mail: 1 hours', 0.82, 0.72, share FROM st WHERE side
      UNION ALL SELECT user_id, day, 'content_' || span_type, 2000 + i, title, trim(regexp_replace(text, '\\s+', ' ', 'g')), confidence, CASE WHEN span_type = 'transcript' THEN 0.6 ELSE 0.78 END, CASE WHEN status = 'complete' THEN 1.0 ELSE share END FROM content)"""
)


@query(MEMORY + " SELECT user_id, day, chunk_type, CAST(sort_key AS BIGINT) AS sort_key, title, text, CAST(confidence AS DOUBLE) AS confidence, CAST(salience AS DOUBLE) AS salience, CAST(completeness AS DOUBLE) AS completeness FROM chunks")
def memory_chunks_union(spark, sf_dir):
    return memory_tables(spark, sf_dir).memory_chunk.select("user_id", "day", "chunk_type", "sort_key", "title", "text", "confidence", "salience", "completeness")


@query(
    MEMORY
    + """, t AS (SELECT user_id, day, 'biography' AS chunk_type, 0 AS sort_key, unnest([['topic', 't1'], ['topic', 't2'], ['tool', 'vim'], ['person', 'P ' || n]]) AS x FROM st WHERE bio IS NOT NULL AND side
      UNION ALL SELECT user_id, day, chunk_type, sort_key, [CASE chunk_type WHEN 'person_context' THEN 'person' WHEN 'tool_used' THEN 'tool' WHEN 'topic' THEN 'topic' ELSE 'activity' END, title] FROM chunks WHERE chunk_type IN ('time_block', 'person_context', 'topic', 'tool_used', 'activity_total')
      UNION ALL SELECT user_id, day, 'content_' || span_type, 2000 + i, unnest([['modality', modality], ['span_type', span_type], ['speaker', speaker_label]]) FROM content)
    SELECT user_id, day, chunk_type, CAST(sort_key AS BIGINT) AS sort_key, x[1] AS tag_type, x[2] AS tag_value FROM t WHERE x[2] IS NOT NULL"""
)
def memory_tags(spark, sf_dir):
    made = memory_tables(spark, sf_dir)
    return said_of(made, made.chunk_tag).select("user_id", "day", "chunk_type", "sort_key", "tag_type", "tag_value")


@query(
    MEMORY
    + """, r AS (SELECT user_id, day, chunk_type, sort_key, 'day_summary' AS ref_kind, NULL AS ref_id, 'summary' AS role, 1.0 AS weight FROM chunks WHERE sort_key < 2000
      UNION ALL SELECT user_id, day, 'content_' || span_type, 2000 + i, 'content_span', id, 'source', 1.0 FROM content UNION ALL SELECT user_id, day, 'content_' || span_type, 2000 + i, CASE WHEN starts_with(source, 'e') THEN 'event' ELSE 'scene_window' END, source, 'source', 0.95 FROM content
      UNION ALL SELECT user_id, day, 'content_' || span_type, 2000 + i, 'reference_scene', reference_scene_id, 'source', 0.95 FROM content WHERE reference_scene_id IS NOT NULL)
    SELECT user_id, day, chunk_type, CAST(sort_key AS BIGINT) AS sort_key, ref_kind, ref_id, role, CAST(weight AS DOUBLE) AS weight FROM r"""
)
def memory_refs(spark, sf_dir):
    made = memory_tables(spark, sf_dir)
    shown = F.when(F.col("ref_kind") != "day_summary", F.col("ref_id"))
    return said_of(made, made.chunk_ref).select("user_id", "day", "chunk_type", "sort_key", "ref_kind", shown.alias("ref_id"), "role", "weight")


@query(MEMORY + " SELECT user_id, day, status, CAST(share AS DOUBLE) AS completeness, bio AS biography, CASE WHEN side THEN 'arc ' || n END AS day_arc, CAST(k AS VARCHAR) AS spans FROM st")
def memory_days(spark, sf_dir):
    total = F.get_json_object("source_counts_json", "$.content_spans_total")
    return memory_tables(spark, sf_dir).day_summary.select("user_id", "day", "status", "completeness", F.col("biography_md").alias("biography"), "day_arc", total.alias("spans"))


@query(
    MEMORY
    + """, m AS (SELECT user_id, day, modality, count(*) AS c FROM sp GROUP BY ALL), d AS (SELECT *, epoch(CAST(day AS TIMESTAMP))::BIGINT AS s FROM st)
    SELECT user_id, day, 'day_modality' AS span_kind, modality, s + 25200 AS start_s, s + 25200 + 86400 AS end_s, c || ' normalized content spans' AS notes FROM m JOIN d USING (user_id, day)
    UNION ALL SELECT user_id, day, 'time_block', 'code', s + 32400, s + 37800, 'did' FROM d WHERE side UNION ALL SELECT user_id, day, 'time_block', 'L', s + 82800, s + 90000, NULL FROM d WHERE side"""
)
def memory_coverage(spark, sf_dir):
    rows = memory_tables(spark, sf_dir).coverage_span
    return rows.select("user_id", "day", "span_kind", "modality", F.unix_seconds("start_at").alias("start_s"), F.unix_seconds("end_at").alias("end_s"), "notes")


@query(MEMORY + " SELECT DISTINCT user_id, 'active' AS status FROM st")
def memory_builds(spark, sf_dir):
    return memory_tables(spark, sf_dir).memory_build.select("user_id", "status")


# Canonical JSON


@query(
    """WITH j AS (SELECT doc_id, '{"a":' || doc_id || ',"b":{"x":"' || lang || '","y":[1,"z"]}}' AS t FROM documents) SELECT doc_id, t AS canonical, sha256(t) AS sha, CAST(strlen(t) AS BIGINT) AS bytes FROM j"""
)
def canonical_payloads(spark, sf_dir):
    d, n = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    one = F.concat(F.lit('{"b": {"y": [1, "z"], "x": "'), "lang", F.lit('"}, "a": '), n, F.lit("}"))
    two = F.concat(F.lit('{ "a":'), n, F.lit(', "b": {"x":"'), "lang", F.lit('", "y": [1,"z"]} }'))
    payload = F.when(F.col("doc_id") % 2 == 0, one).otherwise(two)
    made = ingest.virtual(payload)
    return d.select("doc_id", text.canonical_json(payload).alias("canonical"), made["sha256"].alias("sha"), made["byte_size"].alias("bytes"))


# Episodes

EPISODES = (
    LABELLED.replace("PARTITION BY user_id", "PARTITION BY user_id, day").replace("FROM ev WINDOW", "FROM (SELECT *, strftime(start_at, '%Y-%m-%d') AS day FROM ev) WINDOW")
    + f""", o AS (SELECT *, CASE kind WHEN 'work' THEN 'development' WHEN 'interruptible' THEN 'browser' WHEN 'capture' THEN 'capture_control' ELSE 'meeting' END AS activity, CASE WHEN id % 4 <> 0 THEN 'A' || id % 3 END AS app, (id % 4) / 4.0 AS conf,
      row_number() OVER (PARTITION BY user_id, day, group_no ORDER BY start_at, end_at, id) AS ordinal, role = 'primary' AS p FROM labelled),
    apps AS (SELECT user_id, day, group_no, app, count(*) AS c, min(ordinal) AS f FROM o WHERE p AND app IS NOT NULL GROUP BY ALL), acts AS (SELECT user_id, day, group_no, activity, count(*) AS c, min(ordinal) AS f FROM o WHERE p GROUP BY ALL),
    da AS (SELECT user_id, day, group_no, arg_max(app, (c, -f)) AS dapp, count(*) AS n_apps FROM apps GROUP BY ALL), dc AS (SELECT user_id, day, group_no, arg_max(activity, (c, -f)) AS dact FROM acts GROUP BY ALL),
    g AS (SELECT user_id, day, group_no, min(episode_type) AS t, min(start_at) AS st, max(end_at) AS en, count(*) AS n, count(*) FILTER (p) AS np, count(*) FILTER (NOT p) AS ni, sum(CAST(CASE WHEN p THEN conf END AS DOUBLE)) / count(*) FILTER (p) AS base,
      sum(dur) / 1e6 AS total, sum(CASE WHEN p THEN 0 ELSE dur END) / 1e6 AS cut, count(*) FILTER (p AND id % 2 = 1) / greatest(1, count(*) FILTER (p)) AS low, count(*) FILTER (app = 'A1') AS a1 FROM o GROUP BY ALL),
    e AS (SELECT *, CASE t WHEN 'capture_control' THEN 'Capture control' WHEN 'work_block' THEN 'Work block' ELSE 'Unclassified activity' END || coalesce(' in ' || dapp, '') AS title,
      greatest(0.15, least(0.95, base - CASE WHEN t = 'unclassified' THEN 0.15 ELSE 0.0 END - CASE WHEN ni > 0 THEN 0.05 + least(0.2, cut / greatest(1.0, total) * 0.25) ELSE 0.0 END - CASE WHEN low > 0.5 THEN 0.1 ELSE 0.0 END
        + CASE WHEN t = 'work_block' AND np >= 2 AND greatest(1.0, total) >= 600 THEN 0.05 ELSE 0.0 END - CASE WHEN coalesce(n_apps, 0) > 2 THEN 0.05 ELSE 0.0 END)) AS score
      FROM g LEFT JOIN da USING (user_id, day, group_no) LEFT JOIN dc USING (user_id, day, group_no)),
    said AS (SELECT user_id, day, group_no, 0 AS part, 0 AS ordinal, title AS v FROM e UNION ALL SELECT user_id, day, group_no, 1, 0, t FROM e UNION ALL SELECT user_id, day, group_no, 2, ordinal, event_type || ' done' FROM o
      UNION ALL SELECT user_id, day, group_no, 3, ordinal, activity FROM o UNION ALL SELECT user_id, day, group_no, 4, ordinal, app FROM o WHERE app IS NOT NULL),
    firsts AS (SELECT user_id, day, group_no, v, min((part, ordinal)) AS f FROM said GROUP BY ALL), search AS (SELECT user_id, day, group_no, substr(string_agg(v, ' | ' ORDER BY f), 1, 2000) AS search_text FROM firsts GROUP BY ALL)"""
)


def episode_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = events(spark, sf_dir), F.col("id")
    activity = F.when(F.col("kind") == "work", " Development").when(F.col("kind") == "interruptible", "browser").when(F.col("kind") == "capture", "capture_control").otherwise("meeting")
    payload = F.struct(
        activity.alias("activity_type"), F.when(n % 4 != 0, F.concat(F.lit("A"), (n % 3).cast("string"))).alias("primary_app_name"), F.concat("event_type", F.lit(" done")).alias("summary"),
        F.struct(F.when(n % 2 == 1, "LOW").otherwise("ok").alias("signal_quality")).alias("quality_assessment"),
    )
    return schema.shaped(
        e.select(
            F.concat(F.lit("e"), F.lpad(n.cast("string"), 12, "0")).alias("id"), F.col("user_id").cast("string").alias("user_id"), F.lit("activity_context").alias("event_type"), F.col("start_at").cast("timestamp").alias("start_at"),
            F.col("end_at").cast("timestamp").alias("end_at"), ((n % 4) / 4).alias("confidence"), F.to_json(payload).alias("payload_json"),
        ),
        "event",
    )


@query(
    EPISODES
    + """SELECT CAST(user_id AS VARCHAR) AS user_id, day, t AS episode_type, epoch_us(st) AS started_us, epoch_us(en) AS ended_us, title, search_text, CAST(round(100 * round(CAST(score AS DECIMAL(18, 12)), 2)) AS BIGINT) AS confidence_pct,
    CAST(n AS VARCHAR) AS n, dact AS activity, CASE WHEN a1 > 0 THEN CAST(a1 AS VARCHAR) END AS a1 FROM e JOIN search USING (user_id, day, group_no)"""
)
def episode_tables(spark, sf_dir):
    rows, _ = episodes.build(episode_inputs(spark, sf_dir), NOW, episodes.Config(max_gap_seconds=HALF_DAY))
    of = lambda k: F.get_json_object("metadata_json", f"$.{k}")
    return rows.select(
        "user_id", "day", "episode_type", us(F.col("started_at")).alias("started_us"), us(F.col("ended_at")).alias("ended_us"), "title", "search_text", F.round(F.col("confidence") * 100).cast("long").alias("confidence_pct"), of("event_count").alias("n"),
        of("dominant_activity_type").alias("activity"), F.get_json_object(of("app_counts"), "$.A1").alias("a1"),
    )


# Segments of captures


def capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = events(spark, sf_dir), F.col("id")
    return e.select(
        F.col("user_id").cast("string").alias("user_id"), F.concat(F.lit("d"), F.col("device_id").cast("string")).alias("device_id"), F.col("start_at").cast("timestamp").alias("at"), F.concat(F.lit("/j/"), F.lpad(n.cast("string"), 12, "0")).alias("json_path"),
        chosen(["Slack", "Terminal", "unknown"], F.col("k") % 3).alias("app_name"), F.when(n % 3 == 0, F.concat(F.lit("w"), (F.col("k") % 2).cast("string"))).otherwise("").alias("window_title"), F.lit(None).cast("string").alias("sha256"),
        F.when(F.col("k") % 2 == 0, 0).otherwise(1_048_575).cast("long").alias("dhash"), F.lit("linux").alias("platform"), (n % 7).alias("window_id"), (n % 2 == 0).alias("was_input_idle"), F.lit(10.0).alias("width"), (n % 300).cast("double").alias("height"),
        F.when(n % 4 != 0, F.concat(F.lit("/i/"), n.cast("string"))).alias("image_path"),
    )


CAPTURES = f"""WITH RECURSIVE {EV}, c AS (SELECT *, CASE k % 3 WHEN 0 THEN 'Slack' WHEN 1 THEN 'Terminal' ELSE 'unknown' END AS app, CASE WHEN id % 3 = 0 THEN 'w' || k % 2 ELSE '' END AS title, CASE WHEN k % 2 = 0 THEN 0 ELSE 1048575 END AS h FROM ev),
n AS (SELECT *, row_number() OVER w AS rn, coalesce(date_diff('microsecond', lag(start_at) OVER w, start_at) <= 300000000 AND h = lag(h) OVER w, FALSE) AS near FROM c WINDOW w AS (PARTITION BY user_id, device_id ORDER BY start_at, id)),
walk AS (
  SELECT id, user_id, device_id, rn, start_at, app, title, h AS anchor, 1 AS seg FROM n WHERE rn = 1
  UNION ALL
  SELECT n.id, n.user_id, n.device_id, n.rn, n.start_at, n.app, n.title, CASE WHEN x.ok AND (n.h = w.anchor OR n.near) THEN w.anchor ELSE n.h END, w.seg + CASE WHEN x.ok THEN 0 ELSE 1 END
  FROM walk w JOIN n ON n.user_id = w.user_id AND n.device_id = w.device_id AND n.rn = w.rn + 1,
    LATERAL (SELECT date_diff('microsecond', w.start_at, n.start_at) <= 172800000000 AND ((n.app = w.app AND n.app <> 'unknown') OR (n.title = w.title AND n.title <> '') OR n.near OR n.h = w.anchor) AS ok) x),
m AS (SELECT n.*, seg, row_number() OVER (PARTITION BY user_id, device_id, seg ORDER BY rn) AS i FROM n JOIN walk USING (user_id, device_id, rn)),
t AS (SELECT user_id, device_id, seg, title, min(i) AS f FROM m WHERE title <> '' GROUP BY ALL), tt AS (SELECT user_id, device_id, seg, string_agg(title, ',' ORDER BY f) AS titles FROM t GROUP BY ALL),
im AS (SELECT user_id, device_id, seg, i, '/i/' || id AS p, i = 1 OR NOT near AS novel FROM m WHERE id % 4 <> 0), iv AS (SELECT *, bool_or(novel) OVER (PARTITION BY user_id, device_id, seg) AS anyone FROM im),
il AS (SELECT user_id, device_id, seg, list(p ORDER BY i) AS ps FROM iv WHERE novel OR NOT anyone GROUP BY ALL),
g AS (SELECT user_id, device_id, seg, count(*) AS n, min(start_at) AS st, max(start_at) AS en, arg_min(app, i) AS app, count(*) FILTER (id % 2 = 0) AS idle, count(*) FILTER (near AND i > 1) AS nd, count(*) FILTER (title <> '') / count(*) AS ts, median(id % 300) AS hh FROM m GROUP BY ALL),
s AS (SELECT *, CASE app WHEN 'Slack' THEN 'communication' WHEN 'Terminal' THEN 'development' ELSE 'unknown' END AS cat, idle / n AS ish, nd / greatest(1, n - 1) AS nsh FROM g),
f AS (SELECT *, concat_ws(',', CASE WHEN hh <= 100 THEN 'thin_window_strip' END, CASE WHEN ts < 0.2 THEN 'missing_window_titles' END, CASE WHEN n = 1 THEN 'brief_glimpse' END, CASE WHEN ish >= 0.6 THEN 'mostly_idle' END, CASE WHEN nsh >= 0.6 THEN 'mostly_unchanged' END, CASE WHEN ish >= 0.6 AND nsh >= 0.6 THEN 'idle_unchanged_run' END) AS flags FROM s)"""


def packet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.packets(segments.segment(capture_rows(spark, sf_dir), 172_800.0, keeper(spark)))


@query(
    CAPTURES
    + """SELECT CAST(user_id AS VARCHAR) AS user_id, 'd' || device_id AS device_id, CAST(seg AS BIGINT) AS segment_no, n AS captures, epoch_us(st) AS start_us, epoch_us(en) AS end_us, app, cat AS category, idle, nd AS near_duplicates, CAST(hh AS DOUBLE) AS height, coalesce(titles, '') AS titles, flags,
    coalesce(array_to_string(CASE WHEN len(ps) <= 3 THEN ps ELSE [ps[1], ps[len(ps) // 2 + 1], ps[len(ps)]] END, ','), '') AS images FROM f LEFT JOIN tt USING (user_id, device_id, seg) LEFT JOIN il USING (user_id, device_id, seg)"""
)
def segment_packets(spark, sf_dir):
    return packet_rows(spark, sf_dir).select(
        "user_id", "device_id", "segment_no", F.col("capture_count").alias("captures"), us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"), F.col("primary_app_name").alias("app"), F.col("coarse_category").alias("category"),
        F.col("idle_capture_count").alias("idle"), F.col("near_duplicate_capture_count").alias("near_duplicates"), F.col("median_height").alias("height"), F.array_join("window_title_examples", ",").alias("titles"), F.array_join("quality_flags", ",").alias("flags"),
        F.array_join("sample_image_paths", ",").alias("images"),
    )


@query(CAPTURES + "SELECT CAST(user_id AS VARCHAR) AS user_id, 'd' || device_id AS device_id, epoch_us(st) AS start_us, 'app_focus' AS event_type, cat AS category, CAST(n AS VARCHAR) AS captures, CAST(greatest(1, n - nd) AS VARCHAR) AS novel FROM f")
def focus_events(spark, sf_dir):
    of = lambda k: F.get_json_object("payload_json", f"$.{k}")
    rows = segments.focus_events(packet_rows(spark, sf_dir), NOW)
    return rows.select("user_id", "device_id", us(F.col("start_at")).alias("start_us"), "event_type", of("category").alias("category"), of("capture_count").alias("captures"), of("novel_capture_count").alias("novel"))


@query(
    CAPTURES
    + """, d AS (SELECT *, strftime(st, '%Y-%m-%d') AS day FROM f), cats AS (SELECT user_id, device_id, day, cat, sum(n) AS k, min(seg) AS fs FROM d GROUP BY ALL)
    SELECT CAST(d.user_id AS VARCHAR) AS user_id, 'd' || d.device_id AS device_id, epoch_us(min(st)) AS start_us, CAST(sum(n) AS VARCHAR) AS captures, CAST(count(*) AS VARCHAR) AS segments,
    (SELECT arg_max(cat, (k, -fs)) FROM cats WHERE cats.user_id = d.user_id AND cats.device_id = d.device_id AND cats.day = d.day) AS category FROM d GROUP BY d.user_id, d.device_id, d.day"""
)
def overview_events(spark, sf_dir):
    of = lambda k: F.get_json_object("payload_json", f"$.{k}")
    rows = segments.overview_events(packet_rows(spark, sf_dir), NOW)
    return rows.select("user_id", "device_id", us(F.col("start_at")).alias("start_us"), of("capture_count").alias("captures"), of("segment_count").alias("segments"), of("dominant_category").alias("category"))


# What a recorder said

WHO = ingest.Who("u", "d", NOW)
SAID_CHUNKS = """WITH f AS (SELECT *, (1700000000 + conv_id * 3600 - CASE WHEN conv_id % 2 = 0 THEN 32400 ELSE 0 END) * 1000000 AS at_us FROM conversations),
c AS (SELECT conv_id, turn AS chunk, CASE WHEN role = 'user' THEN 'room' ELSE 'unclear' END AS kind, trim(text, ' ') AS said, at_us + turn * 2500000 AS start_us, at_us AS end_us FROM f WHERE conv_id % 3 <> 0
  UNION ALL SELECT DISTINCT conv_id, 1, 'unclear', 'whole', at_us, at_us + 7500000 FROM f WHERE conv_id % 3 = 0)"""


@query(
    SAID_CHUNKS
    + f"""SELECT {uuid5_sql("'tl-recorder-scene|u|d|f' || conv_id || '|' || chunk || '|v1'")} AS id, 'sensor_segment' AS x, start_us, end_us, 5 AS source_priority,
    CAST(round(1000 * greatest(0.05, least(0.95, CASE kind WHEN 'room' THEN 0.82 ELSE 0.18 END - CASE WHEN length(said) < 40 THEN 0.1 ELSE 0 END))) AS BIGINT) AS confidence_ppt FROM c""".replace("'sensor_segment' AS x", "'device_segment' AS window_type")
)
def recorder_scenes(spark, sf_dir):
    rows = ingest.recorder(transcripts.recorder_chunks(spoken_documents(spark, sf_dir), "Asia/Tokyo"), WHO, "Asia/Tokyo")["scene_window"]
    return rows.select("id", "window_type", us(F.col("start_at")).alias("start_us"), us(F.col("end_at")).alias("end_us"), F.col("source_priority").cast("int").alias("source_priority"), F.round(F.col("confidence") * 1000).cast("long").alias("confidence_ppt"))


@query(
    SAID_CHUNKS
    + f"""SELECT {uuid5_sql("'tl-recorder-scene|u|d|f' || conv_id || '|' || chunk || '|v1'")} AS scene, {uuid5_sql("'tl-recorder-chunk|u|d|f' || conv_id || '|' || chunk || '|v1'")} AS artifact, 'primary' AS role FROM c
    UNION ALL SELECT {uuid5_sql("'tl-recorder-scene|u|d|f' || conv_id || '|' || chunk || '|v1'")}, {uuid5_sql("'tl-recorder-file|u|d|f' || conv_id || '|v1'")}, 'supporting' FROM c"""
)
def recorder_links(spark, sf_dir):
    rows = ingest.recorder(transcripts.recorder_chunks(spoken_documents(spark, sf_dir), "Asia/Tokyo"), WHO, "Asia/Tokyo")["scene_window_artifact"]
    return rows.select(F.col("scene_window_id").alias("scene"), F.col("artifact_id").alias("artifact"), "role")


# What cameras and screens took in

UNIT = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


def camera_made(spark: SparkSession, sf_dir: str) -> ingest.Ingested:
    units, _ = camera_units(spark, sf_dir)
    return ingest.camera(units, WHO, "UTC")


@query(
    f"""SELECT {uuid5_sql(f"'tl-camera-scene|u|d|' || {UNIT} || '|v1'")} AS id, 'sensor_segment' AS window_type, CASE WHEN l_linenumber = 1 THEN 'camera_visual' ELSE 'camera_audio' END AS source, CAST(CASE WHEN l_linenumber = 1 THEN 6 ELSE 7 END AS BIGINT) AS source_priority,
    epoch(CAST(o_orderdate AS TIMESTAMP))::BIGINT + 86400 AS start_s, CAST(420 AS BIGINT) AS confidence_ppt FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""
)
def camera_scenes(spark, sf_dir):
    rows = camera_made(spark, sf_dir)["scene_window"]
    return rows.select("id", "window_type", F.col("primary_source_type").alias("source"), "source_priority", F.unix_seconds("start_at").alias("start_s"), F.round(F.col("confidence") * 1000).cast("long").alias("confidence_ppt"))


@query(
    """WITH u AS (SELECT l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'), n AS (SELECT count(*) AS a, count(*) FILTER (l_linenumber = 1) AS b FROM u)
    SELECT 'artifact' AS name, a + b AS n FROM n UNION ALL SELECT 'scene_window', a FROM n UNION ALL SELECT 'scene_window_artifact', a + b FROM n"""
)
def camera_counters(spark, sf_dir):
    return ingest.counters(camera_made(spark, sf_dir))


@query(
    f"""SELECT {uuid5_sql("'tl-ui-input|u|d|' || event_id || '|v1'")} AS event, {uuid5_sql("'tl-ui-event|u|d|' || event_id || '|v1'")} AS artifact, 'primary' AS role FROM events
    UNION ALL SELECT {uuid5_sql("'tl-ui-input|u|d|' || event_id || '|v1'")}, 'frame ' || event_id % 30, 'supporting' FROM events WHERE event_id % 30 % 3 = 0"""
)
def ui_event_links(spark, sf_dir):
    e, none = table(spark, sf_dir, "events"), F.lit(None).cast("string")
    rows = e.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") % 30).alias("frame_id"), "event_type", none.alias("app_name"), none.alias("window_title"), none.alias("browser_url"), none.alias("machine_id"))
    frames = spark.range(0, 30, 3).select(F.col("id").alias("frame_id"), F.concat(F.lit("frame "), F.col("id").cast("string")).alias("artifact_id"))
    links = ingest.ui_events(rows, frames, WHO, "db")["event_artifact"]
    return links.select(F.col("event_id").alias("event"), F.col("artifact_id").alias("artifact"), "role")


@query(
    f"""SELECT {uuid5_sql("'tl-audio-event|u|d|' || doc_id || '|v1'")} AS id, 'desktop_audio_context' AS event_type, CAST(CASE WHEN doc_id % 4 = 0 THEN 450 ELSE 780 END AS BIGINT) AS confidence_ppt, CASE WHEN doc_id % 4 <> 0 THEN 'said by ' || lang END AS summary,
    CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS links FROM documents"""
)
def desk_audio_events(spark, sf_dir):
    n, none = F.col("doc_id"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "documents").select(
        n.alias("id"), n.alias("audio_chunk_id"), F.lit("t").alias("timestamp"), F.when(n % 4 != 0, F.concat(F.lit("said by "), "lang")).alias("transcription"), F.lit("mic").alias("device"), F.lit(True).alias("is_input_device"), none.alias("transcription_engine"),
        F.lit(0.0).alias("start_time"), F.lit(1.0).alias("end_time"), (n % 2).alias("speaker_id"), F.when(n % 3 != 0, F.concat(F.lit("/f"), n.cast("string"))).alias("file_path"), none.alias("machine_id"), F.timestamp_seconds(n).alias("start_at"), F.timestamp_seconds(n + 1).alias("end_at"),
    )
    made = ingest.desk_audio(rows, WHO, "db")
    links = made["event_artifact"].groupBy(F.col("event_id").alias("id")).agg(F.count("*").cast("int").alias("links"))
    out = made["event"].select("id", "event_type", F.round(F.col("confidence") * 1000).cast("long").alias("confidence_ppt"), F.get_json_object("payload_json", "$.summary").alias("summary"))
    return out.join(links, "id")


@query(
    f"""WITH {EV}, b AS (SELECT *, CASE WHEN date_diff('microsecond', lag(start_at) OVER w, start_at) <= 43200000000 AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS brk FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY start_at, id)),
    s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY start_at, id ROWS UNBOUNDED PRECEDING) AS seg FROM b),
    g AS (SELECT user_id, seg, count(*) AS n, min(event_type) AS app, arg_min(id, (start_at, id)) AS first_id, arg_max(id, (start_at, id)) AS last_id, bool_or(id % 4 = 0) AS shots, arg_min(CASE WHEN id % 3 = 0 THEN 'text ' || id END, (start_at, id)) FILTER (id % 3 = 0) AS said,
      epoch_us(min(start_at)) AS start_us FROM s GROUP BY ALL)
    SELECT {uuid5_sql("'tl-frame-event|u|d|' || first_id || '|' || last_id || '|v1'")} AS id, start_us, CAST(n AS VARCHAR) AS captures, app AS summary, said AS activity,
    CAST(round(1000 * least(0.95, 0.62 + CASE WHEN said IS NOT NULL THEN 0.12 ELSE 0 END + CASE WHEN shots THEN 0.08 ELSE 0 END + CASE WHEN n >= 3 THEN 0.08 ELSE 0 END)) AS BIGINT) AS confidence_ppt FROM g"""
)
def frame_events(spark, sf_dir):
    n, none = F.col("id"), F.lit(None).cast("string")
    nothing = ["window_name", "browser_url", "capture_trigger", "text_source", "content_hash", "simhash", "accessibility_text", "ocr_text", "ocr_text_json", "ocr_engine", "host", "device_name", "timestamp"]
    rows = events(spark, sf_dir).select(
        "id", F.col("start_at").cast("timestamp").alias("at"), F.col("event_type").alias("app_name"), F.col("user_id").cast("string").alias("machine_id"), F.concat(F.lit("/s/"), n.cast("string")).alias("path"), F.when(n % 3 == 0, F.concat(F.lit("text "), n.cast("string"))).alias("full_text"),
        F.lit(True).alias("focused"), F.when(n % 4 == 0, F.concat(F.lit("/s/"), n.cast("string"))).alias("snapshot_path"), *[none.alias(c) for c in nothing],
    )
    made = ingest.frames(rows, WHO, "db", HALF_DAY)["event"]
    of = lambda k: F.get_json_object("payload_json", f"$.{k}")
    return made.select("id", us(F.col("start_at")).alias("start_us"), of("capture_count").alias("captures"), of("summary").alias("summary"), of("specific_activity").alias("activity"), F.round(F.col("confidence") * 1000).cast("long").alias("confidence_ppt"))
