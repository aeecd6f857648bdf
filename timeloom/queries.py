"""The queries over the driver's tables and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions import scoring, text
from timeloom.functions.ids import stable_id
from timeloom.functions.times import day_of, seconds_between, without_offset
from timeloom.operators import episodes, inverted, jobs, memory, overlap, scenes, search, segments, similarity, upsert, windows
from timeloom.plans.driver_tables import EV, as_intervals, events, micros, table
from timeloom.plans.stages import keeper
from timeloom.schema import orphans
from timeloom.session import shared_folder, work_folder
from timeloom.streaming import folds

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
HALF_DAY = 43_200.0
ORDER = ["start_at", "end_at", "id"]


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# Episodes

LABELLED = f"""WITH {EV}, near AS (
  SELECT *, lag(kind) OVER w AS pk, lead(kind) OVER w AS nk,
         CASE WHEN lag(id) OVER w IS NOT NULL THEN greatest(0, date_diff('microsecond', lag(end_at) OVER w, start_at)) END AS gap_in,
         CASE WHEN lead(id) OVER w IS NOT NULL THEN greatest(0, date_diff('microsecond', end_at, lead(start_at) OVER w)) END AS gap_out
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY start_at, end_at, id)
), roles AS (
  SELECT *, coalesce(kind = 'interruptible' AND pk = 'work' AND nk = 'work' AND dur <= 120000000 AND gap_in <= 43200000000 AND gap_out <= 43200000000, FALSE) AS absorbed FROM near
), typed AS (
  SELECT *, CASE WHEN kind = 'capture' THEN 'capture_control' WHEN kind = 'work' OR absorbed THEN 'work_block' ELSE 'unclassified' END AS episode_type FROM roles
), marked AS (
  SELECT *, CASE WHEN gap_in IS NULL OR gap_in > 43200000000 OR episode_type <> lag(episode_type) OVER w THEN 1 ELSE 0 END AS is_new
  FROM typed WINDOW w AS (PARTITION BY user_id ORDER BY start_at, end_at, id)
), labelled AS (
  SELECT *, CASE WHEN absorbed THEN 'interruption' ELSE 'primary' END AS role,
         CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY start_at, end_at, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_no
  FROM marked
)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.label(events(spark, sf_dir), ["user_id"], ORDER, "start_at", "end_at", "kind", HALF_DAY, 120.0)


@query(
    LABELLED
    + """SELECT user_id, group_no, episode_type, epoch_us(min(start_at)) AS started_us, epoch_us(max(end_at)) AS ended_us, count(*) AS n_events,
    count(*) FILTER (role = 'interruption') AS n_interruptions, CAST(sum(dur) AS BIGINT) AS total_us, CAST(sum(CASE WHEN role = 'interruption' THEN dur ELSE 0 END) AS BIGINT) AS interrupted_us
    FROM labelled GROUP BY user_id, group_no, episode_type"""
)
def episode_build(spark, sf_dir):
    return (
        labelled(spark, sf_dir)
        .groupBy("user_id", "group_no", "episode_type")
        .agg(
            micros(F.min("start_at")).alias("started_us"), micros(F.max("end_at")).alias("ended_us"), F.count("*").alias("n_events"), F.count_if(F.col("role") == "interruption").alias("n_interruptions"),
            F.sum("dur").alias("total_us"), F.sum(F.when(F.col("role") == "interruption", F.col("dur")).otherwise(0)).alias("interrupted_us"),
        )
    )


@query(LABELLED + "SELECT id AS event_id, user_id, group_no, role, row_number() OVER (PARTITION BY user_id, group_no ORDER BY start_at, end_at, id) AS ordinal FROM labelled")
def episode_members(spark, sf_dir):
    ordinal = F.row_number().over(windows.ordered(["user_id", "group_no"], ORDER)).cast("long")
    return labelled(spark, sf_dir).select(F.col("id").alias("event_id"), "user_id", "group_no", "role", ordinal.alias("ordinal"))


@query(
    LABELLED
    + """, counts AS (SELECT user_id, group_no, event_type, count(*) AS n, min(epoch_us(start_at)) AS first_us FROM labelled WHERE role = 'primary' GROUP BY ALL),
    best AS (SELECT *, row_number() OVER (PARTITION BY user_id, group_no ORDER BY n DESC, first_us) AS rn FROM counts)
    SELECT user_id, group_no, event_type AS dominant_activity, n AS dominant_n FROM best WHERE rn = 1"""
)
def episode_metadata(spark, sf_dir):
    rows = labelled(spark, sf_dir).where("role = 'primary'")
    best = windows.dominant(rows, ["user_id", "group_no"], "event_type", micros(F.col("start_at")), out="d")
    return best.select("user_id", "group_no", F.col("d").alias("dominant_activity"), F.col("d_count").alias("dominant_n"))


@query(
    LABELLED
    + """, kinds AS (SELECT user_id, group_no, episode_type, event_type, min(epoch_us(start_at)) AS f FROM labelled GROUP BY ALL)
    SELECT user_id, group_no, substr(CASE episode_type WHEN 'work_block' THEN 'Work block' WHEN 'capture_control' THEN 'Capture control' ELSE 'Unclassified activity' END || ' | ' || episode_type || ' | '
      || string_agg(event_type, ' | ' ORDER BY f), 1, 2000) AS search_text FROM kinds GROUP BY user_id, group_no, episode_type"""
)
def episode_title_search_text(spark, sf_dir):
    rows = labelled(spark, sf_dir).groupBy("user_id", "group_no", "episode_type").agg(windows.first_distinct(micros(F.col("start_at")), F.col("event_type")).alias("found"))
    whole = F.array_join(F.array_distinct(F.concat(F.array(episodes.title(F.col("episode_type"), F.lit(None).cast("string")), F.col("episode_type")), F.col("found"))), " | ")
    return rows.select("user_id", "group_no", F.substring(whole, 1, 2000).alias("search_text"))


@query(
    LABELLED
    + """, g AS (SELECT user_id, group_no, episode_type, count(*) FILTER (role = 'primary') AS p, count(*) FILTER (role <> 'primary') AS i, greatest(1.0, CAST(sum(dur) AS DOUBLE) / 1e6) AS total,
      CAST(sum(CASE WHEN role <> 'primary' THEN dur ELSE 0 END) AS DOUBLE) / 1e6 AS cut, count(DISTINCT CASE WHEN role = 'primary' THEN event_type END) AS apps FROM labelled GROUP BY ALL)
    SELECT user_id, group_no, CAST(floor(1e6 * greatest(0.15, least(0.95, 0.9 - CASE WHEN episode_type = 'unclassified' THEN 0.15 ELSE 0.0 END - CASE WHEN i > 0 THEN 0.05 + least(0.2, cut / total * 0.25) ELSE 0.0 END
      + CASE WHEN episode_type = 'work_block' AND p >= 2 AND total >= 600 THEN 0.05 ELSE 0.0 END - CASE WHEN apps > 2 THEN 0.05 ELSE 0.0 END)) + 0.5) AS BIGINT) AS confidence_ppm FROM g"""
)
def episode_confidence(spark, sf_dir):
    primary = F.col("role") == "primary"
    g = labelled(spark, sf_dir).groupBy("user_id", "group_no", "episode_type").agg(
        F.count_if(primary).alias("p"), F.count_if(~primary).alias("i"), (F.sum("dur").cast("double") / 1e6).alias("total"), (F.sum(F.when(primary, 0).otherwise(F.col("dur"))).cast("double") / 1e6).alias("cut"),
        F.count_distinct(F.when(primary, F.col("event_type"))).alias("apps"),
    )
    score = episodes.confidence(F.col("episode_type"), F.lit(0.9), F.col("i"), F.col("cut"), F.col("total"), F.lit(0.0), F.col("p"), F.col("apps"))
    return g.select("user_id", "group_no", F.floor(score * 1e6 + 0.5).cast("long").alias("confidence_ppm"))


# Change signals, islands, folds

SIGNAL = f"""WITH {EV}, s AS (
  SELECT *, CASE WHEN date_diff('microsecond', lag(start_at) OVER w, start_at) <= 43200000000 THEN bit_count(xor(k, lag(k) OVER w)) END AS bits
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY start_at, end_at, id)
), sig AS (SELECT *, coalesce(bits <= 1, FALSE) AS near FROM s)"""


def signalled(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("sha", F.lit("")).withColumn("title", F.lit(""))
    return windows.change_signal(rows, ["user_id"], ORDER, "start_at", "sha", "k", HALF_DAY, 1)


@query(SIGNAL + " SELECT id, user_id, coalesce(CAST(bits AS INTEGER), -1) AS bits_changed, near AS near_duplicate FROM sig")
def change_signal(spark, sf_dir):
    return signalled(spark, sf_dir).select("id", "user_id", F.coalesce("bits_changed", F.lit(-1)).alias("bits_changed"), "near_duplicate")


@query(
    f"""WITH {EV}, b AS (SELECT *, CASE WHEN date_diff('microsecond', lag(start_at) OVER w, start_at) <= 43200000000 AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS brk
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY start_at, end_at, id)),
    s AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY start_at, end_at, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_no FROM b)
    SELECT user_id, segment_no, min(event_type) AS app, count(*) AS n, epoch_us(min(start_at)) AS start_us, epoch_us(max(start_at)) AS last_us FROM s GROUP BY user_id, segment_no"""
)
def focus_segments(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("host", F.lit(None).cast("string"))
    rows = windows.frame_segments(rows, ["user_id"], ORDER, "start_at", "event_type", "host", "host", HALF_DAY)
    return rows.groupBy("user_id", "segment_no").agg(F.min("event_type").alias("app"), F.count("*").alias("n"), micros(F.min("start_at")).alias("start_us"), micros(F.max("start_at")).alias("last_us"))




@query(
    SIGNAL.replace("WITH ev", "WITH RECURSIVE ev")
    + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_at, end_at, id) AS rn FROM sig),
    walk AS (
      SELECT id, user_id, rn, start_at, event_type, k AS anchor, 1 AS segment_no FROM n WHERE rn = 1
      UNION ALL
      SELECT n.id, n.user_id, n.rn, n.start_at, n.event_type,
        CASE WHEN date_diff('microsecond', w.start_at, n.start_at) <= 43200000000 AND (n.event_type = w.event_type OR n.near OR bit_count(xor(n.k, w.anchor)) <= 2)
             AND (bit_count(xor(n.k, w.anchor)) <= 2 OR n.near) THEN w.anchor ELSE n.k END,
        w.segment_no + CASE WHEN date_diff('microsecond', w.start_at, n.start_at) <= 43200000000 AND (n.event_type = w.event_type OR n.near OR bit_count(xor(n.k, w.anchor)) <= 2) THEN 0 ELSE 1 END
      FROM walk w JOIN n ON n.user_id = w.user_id AND n.rn = w.rn + 1)
    SELECT id, user_id, CAST(segment_no AS BIGINT) AS segment_no FROM walk"""
)
def capture_segments_anchor(spark, sf_dir):
    rows = windows.anchored_segments(signalled(spark, sf_dir), ["user_id"], ORDER, "start_at", "event_type", "title", "sha", "k", gap=HALF_DAY, bits=2)
    return rows.select("id", "user_id", "segment_no")


SCENES_CAPPED = f"""WITH RECURSIVE {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_at, end_at, id) AS rn FROM ev),
    walk AS (
      SELECT id, user_id, rn, end_at, event_type, kind, start_at AS first_at, 1 AS scene_no FROM n WHERE rn = 1
      UNION ALL
      SELECT n.id, n.user_id, n.rn, n.end_at, n.event_type, n.kind, CASE WHEN x.ok THEN w.first_at ELSE n.start_at END, w.scene_no + CASE WHEN x.ok THEN 0 ELSE 1 END
      FROM walk w JOIN n ON n.user_id = w.user_id AND n.rn = w.rn + 1,
        LATERAL (SELECT date_diff('microsecond', w.end_at, n.start_at) <= 43200000000 AND date_diff('microsecond', w.first_at, n.end_at) <= 86400000000 AND (n.event_type = w.event_type OR n.kind = w.kind) AS ok) x)
    SELECT id, user_id, CAST(scene_no AS BIGINT) AS scene_no FROM walk"""


@query(SCENES_CAPPED)
def scene_windows_capped(spark, sf_dir):
    return windows.capped_scenes(events(spark, sf_dir), ["user_id"], ORDER, "start_at", "end_at", "event_type", "kind", HALF_DAY, 86_400.0).select("id", "user_id", "scene_no")


@query(SCENES_CAPPED)
def scene_windows_stream(spark, sf_dir):
    """The same by a stream with state over the table's files, run until it has taken them all."""
    folder, source = work_folder(spark), table(spark, sf_dir, "events")
    # A pattern, as a stream's plain path must be a folder and the table may be one file.
    stream = as_intervals(spark.readStream.schema(source.schema).parquet(f"{sf_dir}/[e]vents.parquet"))
    found = folds.scenes(stream, ["user_id"], "id", "start_at", "end_at", "event_type", "kind", HALF_DAY, 86_400.0, "0 seconds")
    with folds.configured(spark):
        written = found.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        written.awaitTermination()
    user = source.schema["user_id"].dataType
    return spark.read.schema("user_id string, id string, number long").parquet(f"{folder}/rows").select(F.col("id").cast("long").alias("id"), F.col("user_id").cast(user).alias("user_id"), F.col("number").alias("scene_no"))


GROUPED = f"""WITH RECURSIVE {EV}, adj AS (SELECT id, user_id, device_id, event_type, start_at - to_milliseconds(device_id * 1000) AS s, end_at - to_milliseconds(device_id * 1000) AS e FROM ev),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, e, id) AS rn FROM adj),
walk AS (
  SELECT id, user_id, device_id, event_type, s, e, rn, s AS lo, e AS hi, 1 AS group_no FROM n WHERE rn = 1
  UNION ALL
  SELECT n.id, n.user_id, n.device_id, n.event_type, n.s, n.e, n.rn, CASE WHEN x.ok THEN least(w.lo, n.s) ELSE n.s END, CASE WHEN x.ok THEN greatest(w.hi, n.e) ELSE n.e END, w.group_no + CASE WHEN x.ok THEN 0 ELSE 1 END
  FROM walk w JOIN n ON n.user_id = w.user_id AND n.rn = w.rn + 1,
    LATERAL (SELECT date_diff('microsecond', w.hi, n.s) <= 21600000000 AND date_diff('microsecond', least(w.lo, n.s), greatest(w.hi, n.e)) <= 172800000000 AS ok) x)"""


def grouped(spark, sf_dir):
    rows = events(spark, sf_dir)
    offset = F.col("device_id") * 1000
    rows = rows.withColumn("s", without_offset(F.col("start_at"), offset)).withColumn("e", without_offset(F.col("end_at"), offset))
    return windows.capped_overlaps(rows, ["user_id"], ["s", "e", "id"], "s", "e", 21_600.0, 172_800.0)


@query(
    GROUPED
    + """SELECT user_id, CAST(group_no AS BIGINT) AS group_no, count(*) AS members, count(DISTINCT device_id) AS devices, epoch_us(min(s)) AS start_us, epoch_us(max(e)) AS end_us FROM walk
    GROUP BY user_id, group_no HAVING count(DISTINCT device_id) > 1"""
)
def cross_device_groups(spark, sf_dir):
    g = grouped(spark, sf_dir).groupBy("user_id", "group_no").agg(F.count("*").alias("members"), F.count_distinct("device_id").alias("devices"), micros(F.min("s")).alias("start_us"), micros(F.max("e")).alias("end_us"))
    return g.where("devices > 1")


# Scores

SCENE_SCORE = f"""WITH {EV}, g AS (SELECT user_id, strftime(start_at, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT event_type) AS apps, count(DISTINCT kind) AS kinds,
  count(*) FILTER (kind = 'work') AS titled, count(*) FILTER (device_id = 0) AS direct FROM ev GROUP BY ALL),
c AS (SELECT user_id, strftime(start_at, '%Y-%m-%d') AS day, event_type, count(*) AS m FROM ev GROUP BY ALL), a AS (SELECT user_id, day, max(m) AS app_n FROM c GROUP BY ALL),
s AS (SELECT *, least(1.0, greatest(0.0, 0.8 * 0.5 + titled / n * 0.2 + app_n / n * 0.15 + direct / n * 0.15)) AS q FROM g JOIN a USING (user_id, day)),
f AS (SELECT *, least(1.0, greatest(0.0, 0.8 * 0.5 + q * 0.2 + app_n / n * 0.1 + app_n / n * 0.1 + direct / n * 0.15 - CASE WHEN apps > 1 THEN 0.15 ELSE 0.0 END - CASE WHEN kinds > 1 THEN 0.1 ELSE 0.0 END)) AS fin FROM s)"""


def scene_scored(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("day", day_of(F.col("start_at")))
    g = rows.groupBy("user_id", "day").agg(
        F.count("*").alias("n"), F.count_distinct("event_type").alias("apps"), F.count_distinct("kind").alias("kinds"), F.count_if(F.col("kind") == "work").alias("titled"), F.count_if(F.col("device_id") == 0).alias("direct")
    )
    top = windows.dominant(rows, ["user_id", "day"], "event_type", micros(F.col("start_at")), out="app")
    g = g.join(top, ["user_id", "day"])
    share = lambda c: F.col(c) / F.col("n")
    g = g.withColumn("q", scenes.quality(F.lit(0.8), share("titled"), share("app_count"), share("direct")))
    return g.withColumn("fin", scenes.final(F.lit(0.8), F.col("q"), share("app_count"), share("app_count"), share("direct"), F.col("apps"), F.col("kinds")))


def ppm(c):
    return F.floor(c * 1e6 + 0.5).cast("long")


@query(SCENE_SCORE + " SELECT user_id, day, CAST(floor(q * 1e6 + 0.5) AS BIGINT) AS quality_ppm, CAST(floor(fin * 1e6 + 0.5) AS BIGINT) AS confidence_ppm FROM f")
def scene_score(spark, sf_dir):
    return scene_scored(spark, sf_dir).select("user_id", "day", ppm(F.col("q")).alias("quality_ppm"), ppm(F.col("fin")).alias("confidence_ppm"))


CLAIM = SCENE_SCORE + """, k AS (SELECT *, least(1.0, greatest(0.0, fin * greatest(app_n / n, 0.5) * 0.55 + fin * 0.2 + app_n / n * 0.25 - CASE WHEN apps > 1 THEN 0.35 ELSE 0.0 END * 0.3)) AS final FROM f)"""


def claim_scored(spark, sf_dir):
    rows = scene_scored(spark, sf_dir)
    share = F.col("app_count") / F.col("n")
    return rows.withColumn("final", scenes.claim_confidence(F.col("fin") * F.greatest(share, F.lit(0.5)), F.col("fin"), share, F.when(F.col("apps") > 1, 0.35).otherwise(0.0)))


@query(CLAIM + " SELECT user_id, day, CAST(floor(final * 1e6 + 0.5) AS BIGINT) AS final_ppm FROM k")
def claim_score(spark, sf_dir):
    return claim_scored(spark, sf_dir).select("user_id", "day", ppm(F.col("final")).alias("final_ppm"))


@query(CLAIM + " SELECT CASE WHEN final >= 0.72 THEN 'accepted' WHEN final >= 0.45 THEN 'ambiguous' ELSE 'rejected' END AS disposition, count(*) AS n FROM k GROUP BY 1")
def claim_disposition(spark, sf_dir):
    return claim_scored(spark, sf_dir).groupBy(scenes.disposition(F.col("final")).alias("disposition")).agg(F.count("*").alias("n"))


@query(
    f"""WITH {EV}, c AS (SELECT device_id, strftime(start_at, '%Y-%m-%d') AS day, kind, CAST(sum(k) AS BIGINT) AS m, min(id) AS f FROM ev GROUP BY ALL)
    SELECT device_id, day, kind AS dominant_category, m AS captures FROM (SELECT *, row_number() OVER (PARTITION BY device_id, day ORDER BY m DESC, f) AS r FROM c) WHERE r = 1"""
)
def dominant_category_day(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("day", day_of(F.col("start_at")))
    best = windows.dominant(rows, ["device_id", "day"], "kind", F.col("id"), F.col("k"), out="d")
    return best.select("device_id", "day", F.col("d").alias("dominant_category"), F.col("d_count").alias("captures"))


PACKET = f"""WITH {EV}, b AS (SELECT *, CASE WHEN date_diff('microsecond', lag(start_at) OVER w, start_at) <= 43200000000 AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS brk,
  coalesce(bit_count(xor(k, lag(k) OVER w)) <= 1 AND date_diff('microsecond', lag(start_at) OVER w, start_at) <= 43200000000, FALSE) AS near FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY start_at, end_at, id)),
s AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY start_at, end_at, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_no FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, segment_no ORDER BY start_at, end_at, id) AS rn FROM s),
p AS (SELECT user_id, segment_no, min(kind) AS kind, count(*) AS n, count(*) FILTER (device_id = 0) AS idle, count(*) FILTER (near AND rn > 1) AS nd, count(*) FILTER (k > 3) AS titled, median(k * 10) AS h FROM r GROUP BY ALL),
t AS (SELECT *, idle / n AS idle_share, nd / greatest(1, n - 1) AS near_share, titled / n AS title_share FROM p),
f AS (SELECT *, h <= 100 AS f1, title_share < 0.2 AS f2, n = 1 AS f3, kind = 'capture_control' AS f4, idle_share >= 0.6 AS f5, near_share >= 0.6 AS f6 FROM t)"""


def packeted(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("host", F.lit(None).cast("string")).withColumn("sha", F.lit(""))
    rows = windows.change_signal(rows, ["user_id"], ORDER, "start_at", "sha", "k", HALF_DAY, 1)
    rows = windows.frame_segments(rows, ["user_id"], ORDER, "start_at", "event_type", "host", "host", HALF_DAY)
    rows = rows.withColumn("rn", F.row_number().over(windows.ordered(["user_id", "segment_no"], ORDER)))
    p = rows.groupBy("user_id", "segment_no").agg(
        F.min("kind").alias("kind"), F.count("*").alias("n"), F.count_if(F.col("device_id") == 0).alias("idle"), F.count_if(F.col("near_duplicate") & (F.col("rn") > 1)).alias("nd"), F.count_if(F.col("k") > 3).alias("titled"), F.median(F.col("k") * 10).alias("h")
    )
    p = p.withColumn("idle_share", F.col("idle") / F.col("n")).withColumn("near_share", F.col("nd") / F.greatest(F.lit(1), F.col("n") - 1)).withColumn("title_share", F.col("titled") / F.col("n"))
    return p.withColumn("flags", segments.flags(F.col("h"), F.col("title_share"), F.col("n"), F.col("kind"), F.col("idle_share"), F.col("near_share")))


@query(
    PACKET
    + """SELECT user_id, segment_no, n AS captures, nd AS near_duplicates, concat_ws(',', CASE WHEN f1 THEN 'thin_window_strip' END, CASE WHEN f2 THEN 'missing_window_titles' END, CASE WHEN f3 THEN 'brief_glimpse' END,
    CASE WHEN f4 THEN 'self_capture' END, CASE WHEN f5 THEN 'mostly_idle' END, CASE WHEN f6 THEN 'mostly_unchanged' END, CASE WHEN f5 AND f6 THEN 'idle_unchanged_run' END) AS flags,
    CAST(floor(1e6 * greatest(0.2, 0.9 - CASE WHEN f1 THEN 0.25 ELSE 0.0 END - CASE WHEN f2 THEN 0.15 ELSE 0.0 END - CASE WHEN f3 THEN 0.1 ELSE 0.0 END - CASE WHEN f5 THEN 0.2 ELSE 0.0 END - CASE WHEN f6 THEN 0.15 ELSE 0.0 END
    - CASE WHEN f5 AND f6 THEN 0.1 ELSE 0.0 END) + 0.5) AS BIGINT) AS confidence_ppm FROM f"""
)
def focus_segment_packet(spark, sf_dir):
    rows = packeted(spark, sf_dir)
    return rows.select("user_id", "segment_no", F.col("n").alias("captures"), F.col("nd").alias("near_duplicates"), F.array_join("flags", ",").alias("flags"), ppm(segments.confidence(F.col("flags"))).alias("confidence_ppm"))


@query(
    PACKET
    + """, r2 AS (SELECT *, n >= 3 AND f6 AND f2 AS unchanged, n >= 4 AND near_share >= 0.85 AND greatest(1, n - nd) <= 2 AS heavy, title_share < 0.2 OR f2 OR kind = 'unknown' AS low FROM f)
    SELECT user_id, segment_no, concat_ws(',', CASE WHEN unchanged THEN 'low_signal_duplicate_run' END, CASE WHEN f5 AND f6 AND n >= 2 THEN 'idle_unchanged_run' END,
    CASE WHEN heavy AND low AND NOT unchanged THEN 'low_signal_duplicate_run' WHEN heavy AND idle_share >= 0.5 THEN 'idle_duplicate_run' END) AS reasons FROM r2"""
)
def interpretation_skips(spark, sf_dir):
    novel = F.greatest(F.lit(1), F.col("n") - F.col("nd"))
    rows = packeted(spark, sf_dir)
    return rows.select("user_id", "segment_no", F.array_join(segments.skip_reasons(F.col("kind"), F.col("n"), F.col("idle_share"), F.col("near_share"), novel, F.col("title_share"), F.col("flags")), ",").alias("reasons"))


@query(
    f"""WITH {EV}, d AS (SELECT user_id, strftime(start_at, '%Y-%m-%d') AS day, kind, event_type, CAST(k + 1 AS BIGINT) AS captures, id FROM ev),
    t AS (SELECT user_id, day, count(*) AS segments, CAST(sum(captures) AS BIGINT) AS captures FROM d GROUP BY ALL),
    c AS (SELECT user_id, day, kind, sum(captures) AS m, min(id) AS f FROM d GROUP BY ALL), a AS (SELECT user_id, day, event_type, sum(captures) AS m, min(id) AS f FROM d GROUP BY ALL),
    cb AS (SELECT user_id, day, arg_max(kind, (m, -f)) AS dominant_category, string_agg(kind || '=' || m, ',' ORDER BY kind) AS category_counts FROM c GROUP BY ALL),
    ab AS (SELECT user_id, day, arg_max(event_type, (m, -f)) AS dominant_app FROM a GROUP BY ALL)
    SELECT user_id, day, segments, captures, dominant_category, category_counts, dominant_app FROM t JOIN cb USING (user_id, day) JOIN ab USING (user_id, day)"""
)
def day_overview(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "user_id", day_of(F.col("start_at")).alias("day"), "start_at", "end_at", F.col("kind").alias("coarse_category"), F.col("event_type").alias("primary_app_name"), (F.col("k") + 1).alias("capture_count"), F.lit(0).alias("idle_capture_count"),
        F.lit(0).alias("near_duplicate_capture_count"), F.lit(True).alias("should_queue_interpretation"), "id",
    )
    out = segments.day_overview(rows, ["user_id", "day"], F.col("id"))
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries("category_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("user_id", "day", F.col("segment_count").alias("segments"), F.col("capture_count").alias("captures"), "dominant_category", pairs.alias("category_counts"), "dominant_app")


# Policy, ids, days

SOURCES = "['app_metadata', 'screenshot', 'screen_ocr', 'desktop_audio', 'ambient_audio', 'camera_visual', 'camera_audio', 'codex_interpretation']"


@query(
    f"""WITH s AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, {SOURCES}[event_id % 8 + 1] AS source, event_id % 8 + 1 AS priority FROM events)
    SELECT user_id, day, arg_min(source, priority) AS primary_source, min(priority) <= 5 AS direct FROM s GROUP BY ALL"""
)
def source_priority_pick(spark, sf_dir):
    names = [s for s in scoring.SOURCE_PRIORITY if s != "unknown"]
    rows = table(spark, sf_dir, "events").select("user_id", day_of(F.col("ts")).alias("day"), F.get(F.array(*map(F.lit, names)), (F.col("event_id") % 8).cast("int")).alias("source"))
    best = rows.groupBy("user_id", "day").agg(scoring.primary_source(F.collect_set("source")).alias("primary_source"))
    return best.select("user_id", "day", "primary_source", scoring.is_direct(F.col("primary_source")).alias("direct"))


@query(
    """WITH h AS (SELECT o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('tl-order|' || o_orderkey || '|' || o_orderstatus)) AS h FROM orders)
    SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h"""
)
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", stable_id("tl-order", F.col("o_orderkey"), F.col("o_orderstatus")).alias("id"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS utc_day, strftime(ts - INTERVAL 7 HOURS, '%Y-%m-%d') AS shifted_day, count(*) AS n FROM events GROUP BY ALL")
def day_buckets_shifted(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.groupBy(day_of(F.col("ts")).alias("utc_day"), day_of(F.col("ts"), -7.0).alias("shifted_day")).agg(F.count("*").alias("n"))


@query(f"WITH {EV} SELECT id, epoch_us(start_at - to_milliseconds(device_id * 1500)) AS adjusted_us, CAST(dur AS DOUBLE) / 1e6 AS seconds FROM ev")
def clock_adjustment(spark, sf_dir):
    return events(spark, sf_dir).select("id", micros(without_offset(F.col("start_at"), F.col("device_id") * 1500)).alias("adjusted_us"), seconds_between(F.col("start_at"), F.col("end_at")).alias("seconds"))


# Jobs and upserts

JOBS = """WITH j AS (SELECT l_orderkey AS parent, CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'O' THEN 'queued' ELSE 'done' END AS state FROM lineitem)"""


@query(
    JOBS
    + """, g AS (SELECT parent, count(*) AS children, count(*) FILTER (state NOT IN ('done', 'canceled', 'failed')) AS remaining, count(*) FILTER (state = 'failed') AS failed FROM j GROUP BY parent)
    SELECT *, CASE WHEN remaining > 0 THEN 'running' WHEN failed > 0 THEN 'failed' ELSE 'done' END AS parent_state FROM g"""
)
def parent_job_status(spark, sf_dir):
    state = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "O", "queued").otherwise("done")
    return jobs.parent_states(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), state.alias("state")), "parent", "state")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < l_suppkey % 7 THEN 'retrying' ELSE 'failed' END AS state FROM lineitem WHERE l_returnflag = 'R'")
def job_retry_state(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_linenumber", jobs.after_failure(F.col("l_linenumber"), F.col("l_suppkey") % 7).alias("state"))


@query("SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY o_orderpriority DESC, o_orderdate, o_orderkey LIMIT 50")
def job_queue_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("queued_at"))
    return jobs.queue(rows, ["O", "P"], 50).select("id", F.col("priority").alias("o_orderpriority"))


@query(
    """WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'), s AS (SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'O')
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_orderstatus, s.o_orderstatus) AS o_orderstatus, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey"""
)
def upsert_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    new = o.where("o_orderstatus = 'O'").select("o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    old = o.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return upsert.merge(old, new, ["o_orderkey"], ["o_totalprice"])


@query("SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'old' ELSE 'new' END AS origin FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'O'")
def insert_if_missing(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows, _ = upsert.insert_missing(o.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", F.lit("old").alias("origin")), o.where("o_orderstatus = 'O'").select("o_orderkey", F.lit("new").alias("origin")), ["o_orderkey"])
    return rows


@query(
    """WITH e AS (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day, event_type FROM events), t AS (SELECT DISTINCT user_id, day FROM e WHERE event_type = 'signup')
    SELECT event_id, CASE WHEN t.user_id IS NULL THEN 'old' ELSE 'new' END AS origin FROM e LEFT JOIN t ON e.user_id = t.user_id AND e.day = t.day WHERE t.user_id IS NULL OR event_type <> 'error'"""
)
def replace_day(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", day_of(F.col("ts")).alias("day"), "event_type")
    days = e.where("event_type = 'signup'").select("user_id", "day").distinct()
    new = e.join(days, ["user_id", "day"], "left_semi").where("event_type <> 'error'").select(*e.columns, F.lit("new").alias("origin"))
    return upsert.replace_days(e.withColumn("origin", F.lit("old")).select(*new.columns), new, days, ["user_id", "day"]).select("event_id", "origin")


@query(
    """WITH gone AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM gone)) AS lines_left, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT * FROM gone)) AS orders_left"""
)
def cascade_delete(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    gone = o.where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    left = upsert.without(li, gone, "l_orderkey").agg(F.count("*").alias("lines_left"))
    return left.crossJoin(upsert.without(o, gone, "o_orderkey").agg(F.count("*").alias("orders_left")))  # one row each


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) GROUP BY o_custkey")
def orphan_check(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").where("c_nationkey < 20")
    return orphans(table(spark, sf_dir, "orders"), parents, "o_custkey", "c_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"))


# Text


@query(
    """SELECT doc_id, CASE WHEN lang = source THEN lang ELSE 'Language: ' || lang || chr(10) || source END || CASE WHEN s IN ('Language: ' || lang, source) OR s = '' THEN '' ELSE chr(10) || s END AS parts
    FROM (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM documents)"""
)
def join_parts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.join_parts(F.concat(F.lit("Language: "), F.col("lang")), F.col("source"), F.col("text"), F.col("source")).alias("parts"))


@query(
    """SELECT doc_id, kind FROM (SELECT doc_id, lang, CASE doc_id % 4 WHEN 0 THEN 'room' WHEN 1 THEN 'mixed' WHEN 2 THEN 'media' ELSE 'unclear' END AS kind FROM documents)
    WHERE kind <> 'media' AND NOT (kind = 'room' AND lang <> '' AND NOT starts_with(lang, 'en'))"""
)
def language_filter(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, ["room", "mixed", "media", "unclear"])), (F.col("doc_id") % 4).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", kind.alias("kind")).where(scoring.keeps_speech(F.col("kind"), F.col("lang"))).select("doc_id", "kind")


APPS = ["Google Chrome", "xterm-shell", "neovim-qt", "My Files", "Slack", "Zoom", "org.gnome.Nautilus", "Tool"]


@query(
    """WITH a AS (SELECT event_id, ['Google Chrome', 'xterm-shell', 'neovim-qt', 'My Files', 'Slack', 'Zoom', 'org.gnome.Nautilus', 'Tool'][event_id % 8 + 1] AS app FROM events)
    SELECT event_id, CASE app WHEN 'Google Chrome' THEN 'browser' WHEN 'xterm-shell' THEN 'development' WHEN 'neovim-qt' THEN 'development' WHEN 'My Files' THEN 'system_navigation' WHEN 'Slack' THEN 'communication'
      WHEN 'Zoom' THEN 'meeting' WHEN 'org.gnome.Nautilus' THEN 'system_navigation' ELSE 'unknown' END AS category FROM a"""
)
def app_category(spark, sf_dir):
    app = F.get(F.array(*map(F.lit, APPS)), (F.col("event_id") % 8).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", scoring.app_category(app).alias("category"))


HINTS = "".join(f"WHEN contains(t, '{hint}') THEN '{app}' " for hint, app in scoring.SCREEN_HINTS)


@query(f"SELECT page_id, CASE {HINTS} END AS app FROM (SELECT page_id, lower(substr(html || ' firefox' || CASE WHEN page_id % 2 = 0 THEN ' google docs' ELSE '' END, 1, 2000)) AS t FROM pages)")
def ocr_hint(spark, sf_dir):
    shown = F.concat(F.col("html"), F.lit(" firefox"), F.when(F.col("page_id") % 2 == 0, " google docs").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", scoring.app_on_screen(shown).alias("app"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host FROM pages")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.browser_host(F.col("url")).alias("host"))


@query("SELECT doc_id, CASE WHEN length(text) > 120 THEN rtrim(substr(text, 1, 119), ' ') || '…' ELSE text END AS excerpt FROM documents")
def excerpt_clip(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.excerpt(F.col("text"), 120).alias("excerpt"))


@query("SELECT doc_id, nullif(trim(text, ' '), '') AS body FROM documents")
def strip_front_matter(spark, sf_dir):
    whole = F.concat(F.lit("---\nlang: "), F.col("lang"), F.lit("\n---\n\n"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_front_matter(whole).alias("body"))


STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP_WORDS)
TOKENS = f"list_filter(regexp_extract_all(lower(text), '[a-z0-9][a-z0-9''-]+'), lambda w: length(w) > 2 AND NOT list_contains([{STOP}], w))"


@query(f"SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS token FROM documents) GROUP BY ALL")
def token_tf(spark, sf_dir):
    return overlap.term_counts(table(spark, sf_dir, "documents"), "doc_id", text.tokens(F.col("text")))


@query(
    f"""WITH b AS (SELECT item_id, token, count(*) AS tf FROM (SELECT item_id, unnest({TOKENS}) AS token FROM benchmark) GROUP BY ALL), d AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS token FROM documents) GROUP BY ALL),
    bn AS (SELECT item_id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS n FROM b GROUP BY 1), dn AS (SELECT doc_id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS n FROM d GROUP BY 1),
    p AS (SELECT item_id, doc_id, sum(b.tf * d.tf) AS dot FROM b JOIN d USING (token) GROUP BY ALL),
    r AS (SELECT item_id, doc_id, dot / (bn.n * dn.n) AS c FROM p JOIN bn USING (item_id) JOIN dn USING (doc_id))
    SELECT item_id, doc_id, CAST(floor(c * 1e6 + 0.5) AS BIGINT) AS cosine_ppm FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY floor(c * 1e6 + 0.5) DESC, doc_id) AS rn FROM r) WHERE rn <= 5"""
)
def tf_cosine_topk(spark, sf_dir):
    b = keeper(spark)(overlap.term_counts(table(spark, sf_dir, "benchmark"), "item_id", text.tokens(F.col("text"))), "items")
    d = overlap.term_counts(table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id"), "doc_id", text.tokens(F.col("text")))
    rows = similarity.top_k_of_few(b, d, "item_id", "doc_id", 5)
    return rows.select("item_id", "doc_id", ppm(F.col("text_score")).alias("cosine_ppm"))


@query(
    f"""WITH c AS (SELECT conv_id * 1000 + turn AS id, TIMESTAMP '2026-01-01' + to_seconds(conv_id * 600 + turn * 60) AS start_at, text, role FROM conversations),
    l AS (SELECT * FROM c WHERE role = 'user'), r AS (SELECT * FROM c WHERE role = 'assistant'),
    lt AS (SELECT id, token, count(*) AS tf FROM (SELECT id, unnest({TOKENS}) AS token FROM l) GROUP BY ALL), rt AS (SELECT id, token, count(*) AS tf FROM (SELECT id, unnest({TOKENS}) AS token FROM r) GROUP BY ALL),
    ln AS (SELECT id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS n FROM lt GROUP BY 1), rn AS (SELECT id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS n FROM rt GROUP BY 1),
    dots AS (SELECT lt.id AS left_id, rt.id AS right_id, sum(lt.tf * rt.tf) AS dot FROM lt JOIN rt USING (token) GROUP BY ALL),
    s AS (SELECT l.id AS left_id, r.id AS right_id, coalesce(dot / (ln.n * rn.n), 0) AS ts, greatest(0.0, 1 - abs(date_diff('microsecond', l.start_at, r.start_at)) / 60e6 / 90) AS tm, abs(date_diff('microsecond', l.start_at, r.start_at)) AS gap, l.start_at
      FROM l CROSS JOIN r LEFT JOIN dots ON dots.left_id = l.id AND dots.right_id = r.id LEFT JOIN ln ON ln.id = l.id LEFT JOIN rn ON rn.id = r.id)
    SELECT left_id, right_id, CAST(floor((ts * 0.65 + tm * 0.35) * 1e6 + 0.5) AS BIGINT) AS score_ppm FROM s
    WHERE floor((ts * 0.65 + tm * 0.35) / 1e-4 + 0.5) > 0 ORDER BY floor((ts * 0.65 + tm * 0.35) / 1e-4 + 0.5) DESC, floor(gap / 1e6 / 60 / 1e-2 + 0.5), start_at, left_id, right_id LIMIT 12"""
)
def overlap_report(spark, sf_dir):
    at = F.timestamp_add("SECOND", F.col("conv_id") * 600 + F.col("turn") * 60, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), at.alias("start_at"), "text", "role")
    out = overlap.report(c.where("role = 'user'"), c.where("role = 'assistant'"), keep=keeper(spark))
    return out.select("left_id", "right_id", ppm(F.col("score")).alias("score_ppm"))


# Search

WORDS = "regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{N}]+')"
POSTINGS = f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents), lens AS (SELECT doc_id, len(ws) AS n FROM w), post AS (SELECT doc_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM w)"""


_indexes: dict[tuple[str, ...], str] = {}


def index_once(spark, sf_dir: str, name: str, build) -> str:
    """The folder of an index that a session builds once for a folder of tables, and its queries share."""
    key = (spark.sparkContext.applicationId, shared_folder(spark), sf_dir, name)
    if key not in _indexes:
        folder = work_folder(spark)
        build(folder)
        _indexes[key] = folder
    return _indexes[key]


def documents_index(spark, sf_dir: str) -> inverted.Stored:
    """Texts of documents; one segment."""

    def build(folder: str) -> None:
        inverted.add(folder, table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("all").alias("segment")), "doc_id", ["text"])

    return inverted.opened(spark, index_once(spark, sf_dir, "documents", build), ["text"])


def builds_index(spark, sf_dir: str) -> inverted.Stored:
    """Languages and texts of documents in seven builds, of which two came later and one is superseded."""

    def build(folder: str) -> None:
        name = F.concat(F.lit("b"), (F.col("doc_id") % 7).cast("string"))
        docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", name.alias("segment"))
        inverted.add(folder, docs.where("segment < 'b5'"), "doc_id", ["lang", "text"])
        inverted.add(folder, docs.where("segment >= 'b5'"), "doc_id", ["lang", "text"])
        inverted.remove(folder, docs.where("segment = 'b2'").select("segment").distinct())

    return inverted.opened(spark, index_once(spark, sf_dir, "builds", build), ["lang", "text"])


def fts(spark, sf_dir, ask: str) -> DataFrame:
    return search.bm25(documents_index(spark, sf_dir), ask)


@query(
    POSTINGS
    + """, tf AS (SELECT doc_id, token, count(*) AS tf FROM post WHERE token IN ('idiot', 'clown') GROUP BY ALL), df AS (SELECT token, count(*) AS n FROM tf GROUP BY 1), st AS (SELECT count(*) AS nd, avg(n) AS av FROM lens),
    sc AS (SELECT doc_id, sum(greatest(1e-6, ln((nd - df.n + 0.5) / (df.n + 0.5))) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lens.n / av))) AS s FROM tf JOIN df USING (token) JOIN lens USING (doc_id) CROSS JOIN st GROUP BY doc_id)
    SELECT doc_id, CAST(floor(s * 1e6 + 0.5) AS BIGINT) AS score_ppm FROM sc ORDER BY floor(s * 1e6 + 0.5) DESC, doc_id LIMIT 20"""
)
def fts_bm25_topk(spark, sf_dir):
    rows = inverted.top(documents_index(spark, sf_dir), "idiot OR clown", 20)
    return rows.select(F.col("doc").alias("doc_id"), ppm(F.col("score")).alias("score_ppm"))


@query(POSTINGS + " SELECT DISTINCT a.doc_id FROM post a JOIN post b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.token = 'apache' AND b.token = 'license'")
def fts_phrase(spark, sf_dir):
    return fts(spark, sf_dir, '"apache license"').select(F.col("doc").alias("doc_id"))


@query(POSTINGS + " SELECT DISTINCT doc_id FROM post WHERE starts_with(token, 'licen') AND doc_id NOT IN (SELECT doc_id FROM post WHERE token = 'apache')")
def fts_prefix_not(spark, sf_dir):
    return fts(spark, sf_dir, "licen* NOT apache").select(F.col("doc").alias("doc_id"))


@query(
    POSTINGS
    + """, t AS (SELECT doc_id, pos, CASE WHEN token = 'version' THEN 0 WHEN starts_with(token, 'licens') THEN 1 ELSE 2 END AS who FROM post WHERE token IN ('version', 'the') OR starts_with(token, 'licens'))
    SELECT DISTINCT x.doc_id FROM t x JOIN t y ON y.doc_id = x.doc_id AND y.pos <= x.pos AND x.pos - y.pos - 1 <= 2 GROUP BY x.doc_id, x.pos HAVING count(DISTINCT y.who) = 3"""
)
def fts_near(spark, sf_dir):
    """Three words in any order, the last of which begins no more than 2 tokens behind the end of each other one."""
    return fts(spark, sf_dir, "NEAR(version licens* the, 2)").select(F.col("doc").alias("doc_id"))


BUILT = f"""WITH live AS (SELECT *, {WORDS.replace('text', "coalesce(text, '')")} AS ws, {WORDS.replace('text', "coalesce(lang, '')")} AS ls FROM documents WHERE doc_id % 7 <> 2),
    st AS (SELECT count(*) AS nd, avg(len(ws) + len(ls)) AS av FROM live)"""
SATURATED = "{tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * (len(ws) + len(ls)) / av))"


@query(
    BUILT
    + f""", f AS (SELECT *, len(list_filter(ls, lambda x: x = 'en')) AS t1, len(list_filter(ws, lambda x: x = 'license')) + len(list_filter(ls, lambda x: x = 'license')) AS t2,
      len(list_filter(ws, lambda x: x = 'en')) AS t3 FROM live), n AS (SELECT count(*) FILTER (t1 > 0) AS n1, count(*) FILTER (t2 > 0) AS n2 FROM f)
    SELECT doc_id, CAST(floor((greatest(1e-6, ln((nd - n1 + 0.5) / (n1 + 0.5))) * {SATURATED.format(tf="t1")} + greatest(1e-6, ln((nd - n2 + 0.5) / (n2 + 0.5))) * {SATURATED.format(tf="t2")}) * 1e6 + 0.5) AS BIGINT) AS score_ppm
    FROM f, st, n WHERE t1 > 0 AND t2 > 0 AND t3 = 0"""
)
def fts_column(spark, sf_dir):
    """Words of one field, of any field, and not of another, over the builds that count."""
    rows = search.bm25(builds_index(spark, sf_dir), "lang : en AND license NOT text : en")
    return rows.select(F.col("doc").alias("doc_id"), ppm(F.col("score")).alias("score_ppm"))


@query(
    BUILT
    + f""", f AS (SELECT *, {", ".join(f"len(list_filter(ws, lambda x: x = '{w}')) AS t{i}" for i, w in enumerate(("software", "license", "apache")))} FROM live),
    n AS (SELECT {", ".join(f"count(*) FILTER (t{i} > 0) AS n{i}" for i in range(3))} FROM f),
    s AS (SELECT doc_id, CAST(floor(({" + ".join(f"greatest(1e-6, ln((nd - n{i} + 0.5) / (n{i} + 0.5))) * " + SATURATED.format(tf=f"t{i}") for i in range(2))}) * 1e6 + 0.5) AS BIGINT) AS score_ppm
      FROM f, st, n WHERE (t0 > 0 OR t1 > 0) AND t2 = 0)
    SELECT * FROM s ORDER BY score_ppm DESC, doc_id LIMIT 25"""
)
def fts_segments(spark, sf_dir):
    """The best documents of an index of several builds, after an append and without a superseded one."""
    rows = inverted.top(builds_index(spark, sf_dir), "(software OR license) NOT apache", 25)
    return rows.select(F.col("doc").alias("doc_id"), ppm(F.col("score")).alias("score_ppm"))


CHUNKS = "SELECT doc_id AS id, lang AS title, text, doc_id % 7 AS sort_key, (doc_id % 5) / 5.0 AS salience, (doc_id % 3) / 3.0 AS confidence FROM documents"


def chunked(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), "text", (F.col("doc_id") % 7).alias("sort_key"), ((F.col("doc_id") % 5) / 5.0).alias("salience"), ((F.col("doc_id") % 3) / 3.0).alias("confidence"), F.col("source").alias("chunk_type"), F.lit("2026-01-01").alias("day"))
    return rows, d.select(F.col("doc_id").alias("chunk_id"), F.lit("source").alias("tag_type"), F.col("source").alias("tag_value"))


@query(f"SELECT id, substr(text, 1, 240) AS snippet FROM ({CHUNKS}) WHERE title ILIKE '%license, v%' OR text ILIKE '%license, v%' ORDER BY salience DESC, confidence DESC, sort_key, id LIMIT 10")
def like_fallback(spark, sf_dir):
    how, rows = search.search(*chunked(spark, sf_dir), "license, v")
    if how != "like":
        raise AssertionError(how)
    return rows.select("id", "snippet")


@query(f"SELECT id, substr(text, 1, 240) AS snippet FROM ({CHUNKS}) ORDER BY salience DESC, confidence DESC, sort_key, id LIMIT 10")
def latest_listing(spark, sf_dir):
    return search.search(*chunked(spark, sf_dir), " ")[1].select("id", "snippet")


@query("SELECT doc_id AS id FROM documents WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id AND quality = 1) AND source = 'src3'")
def tag_semi_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    tags = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("chunk_id"), F.lit("quality").alias("tag_type"), F.lit("1").alias("tag_value"))
    tags = tags.unionByName(d.select(F.col("id").alias("chunk_id"), F.lit("source").alias("tag_type"), F.col("source").alias("tag_value")))
    return search.tag_filter(d, tags, ["quality:1", "source:src3"]).select("id")


# Memory


@query(
    """SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'incomplete' WHEN u > 0 AND a > 0 THEN 'complete' WHEN u > 0 OR a > 0 THEN 'partial' WHEN n > 0 THEN 'evidence_only' ELSE 'empty' END AS status,
    (CASE WHEN conv_id % 5 = 0 THEN 0.6 WHEN u > 0 AND a > 0 THEN 0.95 WHEN u > 0 OR a > 0 THEN 0.55 WHEN n > 0 THEN 0.35 ELSE 0.0 END)::DOUBLE AS completeness
    FROM (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'user' AND turn > 1) AS u, count(*) FILTER (role = 'assistant' AND turn > 2) AS a FROM conversations GROUP BY 1)"""
)
def day_status(spark, sf_dir):
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.when((F.col("role") == "user") & (F.col("turn") > 1), "x")).alias("bio"), F.max(F.when((F.col("role") == "assistant") & (F.col("turn") > 2), "x")).alias("side"))
    status, share = memory.day_status(F.col("bio"), F.col("side"), F.when(F.col("conv_id") % 5 == 0, "x"), F.col("n"))
    return g.select("conv_id", status.alias("status"), share.cast("double").alias("completeness"))


@query(
    """SELECT user_id, day, modality, CAST(sum(n) AS BIGINT) AS n, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS by_type
    FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, 'm' || (event_id % 3) AS modality, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id, day, modality"""
)
def modality_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", day_of(F.col("ts")).alias("day"), F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("modality"), F.col("event_type").alias("span_type"))
    out = memory.coverage(rows, ["user_id", "day"])
    return out.select("user_id", "day", "modality", "n", F.array_join(F.transform(F.map_entries("by_type"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("by_type"))


@query("SELECT CASE WHEN user_id % 3 = 0 THEN 'complete' ELSE 'partial' END AS status, count(DISTINCT (user_id, strftime(ts, '%Y-%m-%d'))) AS n FROM events GROUP BY 1")
def env_status(spark, sf_dir):
    from timeloom.operators.retrieval import status_counts

    days = table(spark, sf_dir, "events").select("user_id", day_of(F.col("ts")).alias("day")).distinct()
    return status_counts(days.withColumn("status", F.when(F.col("user_id") % 3 == 0, "complete").otherwise("partial")))
