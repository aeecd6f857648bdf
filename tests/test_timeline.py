"""The timeline stages on small inputs, from sources to retrieval."""

import json
import math
import random
import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions import ids, scoring, text, times
from timeloom.operators import align, episodes, jobs, memory, normalize, overlap, retrieval, scenes, search, segments, upsert, windows
from timeloom.plans import ingest
from timeloom.plans.stages import stored, stored_all
from timeloom.sources import files, screen, sidecars, transcripts

NOW = "2026-01-02 00:00:00"
T0 = datetime(2026, 1, 1, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'bigint' if isinstance(v, int) else 'double'}" for n, v in values.items())).select(column.alias("x")).first()["x"] if names else spark.range(1).select(column.alias("x")).first()["x"]


def event(ident, start, end, activity, app=None, kind="activity_context", **payload):
    body = {"activity_type": activity, "primary_app_name": app} | payload
    return (ident, "u", "d", kind, at(start), None if end is None else at(end), 1, 0.9, "app_metadata", json.dumps(body), "an_interpreter_v1", at(0))


def events(spark, rows):
    return spark.createDataFrame(rows, schema.TABLES["event"].schema)


# Scalars


def test_uuid5_matches_python(spark):
    names = ["", "a", "héllo|x", "🙂", "x" * 300]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(ids.uuid5(F.col("n"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]
    assert one(spark, ids.stable_id("p", F.col("a"), F.col("b")), a="1", b=None) == str(uuid.uuid5(uuid.NAMESPACE_URL, "p|1|"))


def test_instants(spark):
    z = lambda s: one(spark, times.iso_z(times.parse_instant(F.col("s"))), s=s)
    assert z("2026-01-01T12:00:00Z") == "2026-01-01T12:00:00Z"
    assert z("2026-01-01T12:00:00.1234567891+02:00") == "2026-01-01T10:00:00.123456Z"
    assert z("nonsense") is None and z("") is None
    assert one(spark, times.iso_z(times.local_instant(F.col("s"), "America/Los_Angeles")), s="2026-07-01 12:00:00") == "2026-07-01T19:00:00Z"
    assert one(spark, times.iso_z(times.local_instant(F.col("s"), "America/Los_Angeles")), s="2026-07-01T12:00:00+00:00") == "2026-07-01T12:00:00Z"
    assert one(spark, times.day_of(F.col("s").cast("timestamp"), -7), s="2026-01-02 06:59:59") == "2026-01-01"


@pytest.mark.parametrize("start,end,want", [("23:00", "01:00", ("2026-01-01T23:00:00Z", "2026-01-02T01:00:00Z")), ("9", "10:30", ("2026-01-01T09:00:00Z", "2026-01-01T10:30:00Z")), ("25", "26", (None, None)), ("x", "1", (None, None))])
def test_block_range(spark, start, end, want):
    a, b = times.block_range(F.lit("2026-01-01"), F.col("s"), F.col("e"))
    row = spark.createDataFrame([(start, end)], "s string, e string").select(times.iso_z(a), times.iso_z(b)).first()
    assert tuple(row) == want


def test_text_scalars(spark):
    assert one(spark, text.squeeze(F.col("s")), s="  a \n b ") == "a b" and one(spark, text.squeeze(F.col("s")), s=" \t") is None
    assert one(spark, text.join_parts(F.lit("b"), F.lit(" a "), F.lit("b"), F.lit(""))) == "b\na"
    assert one(spark, text.excerpt(F.col("s"), 5), s="abcdefgh") == "abcd…" and one(spark, text.excerpt(F.col("s"), 5), s="abc") == "abc"
    assert one(spark, text.strip_front_matter(F.col("s")), s="---\na: 1\n---\n\nbody") == "body" and one(spark, text.strip_front_matter(F.col("s")), s="body --- x") == "body --- x"
    assert one(spark, text.browser_host(F.col("s")), s="https://Host.example:8443/a?b") == "host.example:8443"
    assert one(spark, text.tokens(F.col("s")), s="It's the RED-car, a 42x! ok") == ["it's", "red-car", "42x"]
    assert text.spoken({"a": [1, {"b": "x  y"}], "c": None, "d": []}) == "a: 1; b: x y"
    assert one(spark, text.json_text(F.col("s")), s='["a", {"k": [1, 2]}]') == "a; k: 1; 2"


def test_policies(spark):
    assert one(spark, scoring.primary_source(F.array(F.lit("codex_interpretation"), F.lit("camera_visual"), F.lit("app_metadata")))) == "app_metadata"
    assert one(spark, scoring.primary_source(F.array().cast("array<string>"), "codex_interpretation")) == "codex_interpretation"
    got = {a: one(spark, scoring.app_category(F.col("s")), s=a) for a in ("Google Chrome", "my browser", "gnome-shell", "PowerShell", "nvim code", "Files", "?")}
    assert got == {"Google Chrome": "browser", "my browser": "browser", "gnome-shell": "unknown", "PowerShell": "development", "nvim code": "development", "Files": "system_navigation", "?": "unknown"}
    frame = lambda app, seen, title: one(spark, scoring.frame_app(F.col("a"), F.col("s"), F.col("t")), a=app, s=seen, t=title)
    assert frame("Slack", "firefox", "x") == "Slack" and frame("mutter", "Mozilla Firefox", "x") == "Firefox" and frame("mutter", "zzz", "Notes") == "Notes" and frame("", "zzz", "Main stage") == "unknown"
    keep = lambda kind, lang: one(spark, scoring.keeps_speech(F.col("k"), F.col("l")), k=kind, l=lang)
    assert [keep("media", None), keep("room", "fr"), keep("mixed", "fr"), keep("room", ""), keep("room", "en-GB")] == [False, False, True, True, True]
    assert one(spark, scoring.signed_hash(F.col("s")), s="18446744073709551615") == -1 and one(spark, scoring.hamming(F.lit(6), F.lit(9))) == 4
    assert one(spark, scoring.retention(F.col("a"), F.col("b")), a="Restored", b="suppressed") == "active" and one(spark, scoring.retention(F.col("a"), F.col("b")), a=None, b="suppressed") == "suppressed"
    assert one(spark, scoring.chunk_confidence(F.lit("room"), F.lit("short"))) == pytest.approx(0.72)
    assert one(spark, scoring.camera_confidence(F.lit("x" * 40), F.lit(None).cast("double"))) == 0.62


# Episodes


def folded_episodes(rows, gap=300, longest=120):
    """The grouping as a walk over the rows: (class, start, end) -> (type, role, group)."""
    out, i, group = [], 0, 0
    apart = lambda a, b: max(0, b[1] - a[2])
    while i < len(rows):
        group += 1
        kind = {"capture": "capture_control", "work": "work_block"}.get(rows[i][0], "unclassified")
        out.append((kind, "primary", group))
        i += 1
        while i < len(rows) and apart(rows[i - 1], rows[i]) <= gap:
            cls = rows[i][0]
            if kind == "work_block" and cls == "interruptible":
                after = rows[i + 1] if i + 1 < len(rows) else None
                ok = rows[i - 1][0] == "work" and rows[i][2] - rows[i][1] <= longest and after and after[0] == "work" and apart(rows[i], after) <= gap
                if not ok:
                    break
                out.append((kind, "interruption", group))
            elif {"capture": "capture_control", "work": "work_block"}.get(cls, "unclassified") == kind:
                out.append((kind, "primary", group))
            else:
                break
            i += 1
    return out


def test_episode_windows_equal_the_walk(spark):
    rng, rows, want = random.Random(1), [], []
    for user in range(150):
        clock, mine = 0, []
        for _ in range(rng.randint(1, 14)):
            clock += rng.choice([0, 5, 299, 300, 301])
            length = rng.choice([0, 60, 120, 121])
            mine.append((rng.choice(["work", "work", "interruptible", "capture", "other"]), clock, clock + length))
            clock += length
        want += [(user, i, *x) for i, x in enumerate(folded_episodes(mine))]
        rows += [(user, i, k, at(s), at(e)) for i, (k, s, e) in enumerate(mine)]
    df = spark.createDataFrame(rows, "user_id int, id int, kind string, start_at timestamp, end_at timestamp")
    got = episodes.label(df, ["user_id"], ["start_at", "id"], "start_at", "end_at", "kind").select("user_id", "id", "episode_type", "role", "group_no").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_two_events_make_one_episode_and_rebuild_alike(spark, tmp_path):
    payload = json.dumps({"activity_type": "coding", "app_name": "Example editor", "summary": "Synthetic editing activity"})
    rows = [(f"synthetic-{i}", "example-user", "example-device", "activity_context", s, e, 1, 0.9, "app_metadata", payload, "synthetic-test", at(360)) for i, s, e in ((0, at(0), at(180)), (1, at(190), at(300)))]
    df = events(spark, rows)
    made, links = stored_all(dict(zip("ab", episodes.build(df, NOW))), str(tmp_path)).values()
    r = made.collect()
    assert len(r) == 1 and (r[0]["episode_type"], r[0]["title"], r[0]["confidence"]) == ("unclassified", "Unclassified activity", 0.75)
    assert r[0]["search_text"] == "Unclassified activity | unclassified | Synthetic editing activity | coding" and r[0]["ended_at"] == at(300)
    assert r[0]["id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "tl-episode|example-user|2026-01-01|1|1|unclassified|2026-01-01T12:00:00Z|2026-01-01T12:05:00Z"))
    assert sorted(map(tuple, links.select("event_id", "ordinal", "role").collect())) == [("synthetic-0", 1, "primary"), ("synthetic-1", 2, "primary")]
    again, again_links = episodes.build(df, "2026-02-02 00:00:00")
    assert again.select("id", "started_at", "ended_at").collect() == made.select("id", "started_at", "ended_at").collect() and again_links.count() == 2
    assert schema.orphans(links, df, "event_id").count() == 0


def test_episode_score_title_and_metadata(spark):
    rows = [event("a", 0, 400, "development", "Editor", summary="s1"), event("b", 410, 470, "browser", "Chrome"), event("c", 480, 900, "development", "Editor", quality_assessment={"signal_quality": "LOW"}), event("e", 5000, None, "capture_control")]
    made, _ = episodes.build(events(spark, rows), NOW)
    work, capture = sorted(made.collect(), key=lambda r: r["started_at"])
    assert (work["title"], capture["title"]) == ("Work block in Editor", "Capture control")
    assert work["confidence"] == pytest.approx(round(0.9 - 0.05 - 60 / 880 * 0.25 + 0.05, 2))
    meta = json.loads(work["metadata_json"])
    assert (meta["interruption_count"], meta["dominant_app_name"], meta["interruption_duration_seconds"]) == (1, "Editor", 60) and json.loads(meta["activity_counts"]) == {"browser": 1, "development": 2}


# Folds


def test_folds_equal_the_walk(spark):
    rng, rows, scenes_want, groups_want = random.Random(2), [], [], []
    for user in range(60):
        clock, mine = 0, []
        for i in range(rng.randint(1, 20)):
            clock += rng.choice([0, 8, 9, 75, 76])
            length = rng.choice([0, 30, 100])
            mine.append((user, i, at(clock), at(clock + length), rng.choice(["x", "y", None]), rng.choice(["p", "q"])))
        rows += mine
        first = last = None
        number = 0
        for j, r in enumerate(mine):
            before = mine[j - 1]
            ok = j and (r[2] - last).total_seconds() <= 75 and (r[3] - first).total_seconds() <= 180 and ((r[4] and r[4] == before[4]) or r[5] == before[5])
            if not ok:
                number, first = number + 1, r[2]
            last = r[3]
            scenes_want.append((user, r[1], number))
        low = high = None
        number = 0
        for r in sorted(mine, key=lambda r: (r[2], r[3], r[1])):
            ok = high and (r[2] - high).total_seconds() <= 8 and (max(high, r[3]) - min(low, r[2])).total_seconds() <= 200
            number, low, high = (number, min(low, r[2]), max(high, r[3])) if ok else (number + 1, r[2], r[3])
            groups_want.append((user, r[1], number))
    df = spark.createDataFrame(rows, "user_id int, id int, s timestamp, e timestamp, app string, cat string")
    got = windows.capped_scenes(df, ["user_id"], ["s", "id"], "s", "e", "app", "cat").select("user_id", "id", "scene_no").collect()
    assert sorted(map(tuple, got)) == sorted(scenes_want)
    got = windows.capped_overlaps(df, ["user_id"], ["s", "e", "id"], "s", "e", 8, 200).select("user_id", "id", "group_no").collect()
    assert sorted(map(tuple, got)) == sorted(groups_want)


# Captures


def sidecar(i, second, app, title="", **more):
    return (f"/cap/{i:03}.json", json.dumps({"timestampUTC": f"2026-01-01T12:{second // 60:02}:{second % 60:02}Z", "frontmostAppName": app, "windowTitle": title} | more))


def test_captures_to_packets_and_jobs(spark, tmp_path):
    rows = [sidecar(0, 0, "Terminal", "a", visual_dhash=0, windowBounds={"width": 10, "height": 500}), sidecar(1, 10, "terminal", "", visual_dhash=1, wasInputIdle="yes"), sidecar(2, 30, "Slack", "b", visual_dhash=2**64 - 1)]
    rows += [sidecar(3, 40, "Slack", "c", retention_state="suppressed"), ("/cap/x.json", '{"frontmostAppName": "no time"}'), sidecar(4, 400, "", "", foregroundApp="Zoom", sha256="s"), sidecar(5, 420, "Zoom", "", sha256="s")]
    df = spark.createDataFrame(rows, "path string, text string")
    obs = sidecars.observations(df)
    assert obs.count() == 5 and sidecars.observations(df, include_suppressed=True).count() == 6
    made = ingest.Ingested(stored_all(ingest.captures(obs, ingest.Who("u", "d", NOW), "/cap").tables, str(tmp_path)))
    packets = sorted(made["segment_packet"].collect(), key=lambda r: r["segment_index"])
    assert [(p["primary_app_name"], p["capture_count"], p["near_duplicate_capture_count"], p["exact_duplicate_capture_count"]) for p in packets] == [("Terminal", 2, 1, 0), ("Slack", 1, 0, 0), ("Zoom", 2, 1, 1)]
    assert packets[0]["coarse_category"] == "development" and packets[0]["median_height"] == 500 and packets[1]["quality_flags"] == ["brief_glimpse"]
    assert packets[1]["segment_confidence"] == pytest.approx(0.8)
    jobs_made = made["job"].collect()
    parent = [j for j in jobs_made if j["parent_job_id"] is None]
    assert len(parent) == 1 and {j["parent_job_id"] for j in jobs_made if j["parent_job_id"]} == {parent[0]["id"]} and made["artifact"].count() == 5
    focus = segments.focus_events(made["segment_packet"], NOW)
    assert focus.count() == 3 and segments.overview_events(made["segment_packet"], NOW).count() == 1
    overview = json.loads(segments.overview_events(made["segment_packet"], NOW).first()["payload_json"])
    assert overview["capture_count"] == 5 and overview["dominant_app_name"] == "Terminal"


def test_anchor_bridges_and_resets(spark):
    row = lambda i, t, app, h: (i, at(t), app, "", None, h)
    rows = [row(0, 0, "a", 0), row(1, 10, "b", 0b1111111111), row(2, 20, "c", 0b11111111111111111111), row(3, 30, "d", 2**40 - 1), row(4, 90, "d", 2**40 - 1)]
    df = spark.createDataFrame(rows, "id int, at timestamp, app string, title string, sha string, h bigint").withColumn("u", F.lit(1))
    df = windows.change_signal(df, ["u"], ["at"], "at", "sha", "h")
    got = windows.anchored_segments(df, ["u"], ["at"], "at", "app", "title", "sha", "h").orderBy("id").select("segment_no").collect()
    assert [r[0] for r in got] == [1, 1, 2, 3, 4]


def test_files_and_sidecar_images(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, body in (("a.json", b'{"timestampUTC": "2026-01-01T00:00:00Z"}'), ("a.png", b"png"), ("b.json", b'{"timestampUTC": "2026-01-01T00:00:10Z", "imagePath": "up.jpg"}'), ("broken.json", b"{"), ("../up.jpg", b"jpg")):
        (tmp_path / "d" / name).write_bytes(body)
    rows = {r["json_path"].rsplit("/", 1)[1]: r for r in sidecars.read(spark, str(tmp_path)).collect()}
    assert rows["a.json"]["image_path"].endswith("/d/a.png") and rows["b.json"]["image_path"].endswith("/up.jpg") and len(rows) == 2
    assert rows["a.json"]["sha256"] is not None and rows["b.json"]["image_bytes"] == 3
    day = tmp_path / "days" / "2026-01-01"
    day.mkdir(parents=True)
    (day / "biography.md").write_text("---\nx: 1\n---\nA day.")
    (day / "sidecar.json").write_text('{"day_arc": "up"}')
    assert files.day_folders(spark, str(tmp_path / "days"), "u").first().asDict() == {"user_id": "u", "day": "2026-01-01", "biography": "---\nx: 1\n---\nA day.", "sidecar": '{"day_arc": "up"}', "incomplete": None}
    assert files.staging_root("/s", "laptop-macos", "2026-01-02") == "/s/laptop-macos/2026-01-02" and files.staging_root("/s", "desktop-linux", "2026-01-02") == "/s/desktop-linux/2026/01/02"


# Recorder, camera, screen


def test_recorder(spark):
    body = {"files": [
        {"file_name": "f1", "source_path": "/a.wav", "duration_seconds": 60, "recorder_timestamp": "2026-01-01 04:00:00", "transcript": "all", "chunks": [
            {"chunk_index": 1, "start_seconds": 0, "end_seconds": 30, "source_type": "room", "primary_language_code": "en", "transcript": "hello " * 10},
            {"chunk_index": 2, "start_seconds": 30, "end_seconds": 60, "source_type": "media", "transcript": "song"},
            {"chunk_index": 3, "start_seconds": 30, "end_seconds": 60, "source_type": "room", "primary_language_code": "fr", "transcript": "chanson"}]},
        {"file_name": "f2", "duration_seconds": 5, "modified_time": "2026-01-01T12:30:00Z", "transcript": "whole", "chunks": []}]}
    chunks = transcripts.recorder_chunks(spark.createDataFrame([("/t.json", json.dumps(body))], "path string, text string"), "America/Los_Angeles")
    made = ingest.recorder(chunks, ingest.Who("u", "r", NOW), "America/Los_Angeles", 1500)
    scene = sorted(made["scene_window"].collect(), key=lambda r: r["start_at"])
    assert [(s["start_at"], s["confidence"]) for s in scene] == [(at(0), 0.82), (at(1800), 0.08)]
    meta = json.loads(scene[0]["metadata_json"])
    assert meta["time_alignment_basis"]["clock_confidence"] == "medium" and meta["source_type"] == "room"
    roles = {(r["scene_window_id"] == scene[0]["id"], r["role"]) for r in made["scene_window_artifact"].collect()}
    assert roles == {(True, "primary"), (True, "supporting"), (False, "primary"), (False, "supporting")} and made["artifact"].count() == 5
    normal = made["artifact"].where("artifact_type = 'audio_chunk'").first()
    assert normal["normalized_at"] == at(-1.5)


def test_camera(spark):
    docs = lambda body: spark.createDataFrame([("/c.json", json.dumps(body))], "path string, text string")
    clips = transcripts.camera_clips(docs({"clips": [{"clip_stem": "c1", "timestamp": "2026-01-01T11:00:00"}, {"clip_stem": "c1", "timestamp": "2026-01-01T12:00:00", "source_paths": {"wav": "/w.wav", "mp4": "/m.mp4"}}, {"clip_stem": " "}]}), "UTC")
    units = transcripts.camera_units(docs({"transcripts": [{"transcription_unit_id": f"u{i}", "clip_stem": c, "start_seconds": 10, "end_seconds": 20, "transcript": "hi", "quality_flags": ["", "x"]} for i, c in enumerate(["c1", "c1", "gone"])]}))
    records = transcripts.camera_records(docs({"records": [{"transcription_unit_id": "u0", "visual_window_id": "v", "gemini": {"window_summary": "street", "scene_labels": ["a", "b"], "confidence": 0.5}}]}))
    joined, missing = transcripts.unit_join(units, clips, records)
    assert missing.first()[0] == 1
    made = ingest.camera(joined, ingest.Who("u", "cam", NOW), "UTC")
    scene = {json.loads(r["metadata_json"])["transcription_unit_id"]: r for r in made["scene_window"].collect()}
    assert scene["u0"]["primary_source_type"] == "camera_visual" and scene["u0"]["confidence"] == pytest.approx(0.675) and scene["u1"]["confidence"] == 0.42 and scene["u0"]["start_at"] == at(10)
    assert made["artifact"].groupBy("artifact_type").count().count() == 4 and made["artifact"].count() == 5
    spans = normalize.scene_spans(made["scene_window"], spark.createDataFrame([], "scene_window_id string, reference_scene_id string"), "v1")
    seen = [r["text"] for r in spans.where("span_type = 'visual_summary'").collect()]
    assert seen == ["street\nScene labels: a; b"] and spans.where("span_type = 'transcript'").count() == 2


def test_screen(spark):
    cols = "id bigint, timestamp string, app_name string, window_name string, browser_url string, device_name string, machine_id string, snapshot_path string, capture_trigger string, text_source string, full_text string, accessibility_text string, accessibility_tree_json string, content_hash bigint, simhash bigint, focused boolean"
    f = lambda i, t, app, win, url: (i, f"2026-01-01T12:00:{t:02}.1234567Z", app, win, url, "m1", "k", f"/s/{i}.png", "timer", "ocr", None, None, None, 1, 2, True)
    frame = spark.createDataFrame([f(1, 0, "Firefox", "t1", "https://a.example/x"), f(2, 10, "Firefox", "t2", "https://a.example/y"), f(3, 20, "Firefox", "t2", "https://b.example"), f(4, 30, "mutter", "Main stage", None)], cols)
    ocr = spark.createDataFrame([(1, "short", None, "e"), (1, "the  longer text", None, "e"), (4, "Slack | general", None, "e")], "frame_id bigint, text string, text_json string, ocr_engine string")
    rows = screen.frames(frame, ocr, "k", end="2026-01-01 13:00:00")
    assert rows.count() == 4
    made = ingest.frames(rows, ingest.Who("u", "d", NOW), "/db")
    found = sorted(made["event"].collect(), key=lambda r: r["start_at"])
    payloads = [json.loads(r["payload_json"]) for r in found]
    assert [p["frontmost_app_name"] for p in payloads] == ["Firefox", "Firefox", "Slack"] and payloads[0]["frame_ids"] == [1, 2] and payloads[0]["specific_activity"] == "Browser context on a.example"
    assert found[0]["confidence"] == pytest.approx(0.82) and made["event_artifact"].where("role = 'primary'").count() == 4
    audio = spark.createDataFrame([(7, 1, "2026-01-01T12:00:00Z", " hello  there ", "mic", True, "w", 1.0, None, 3)], "id bigint, audio_chunk_id bigint, timestamp string, transcription string, device string, is_input_device boolean, transcription_engine string, start_time double, end_time double, speaker_id bigint")
    chunks = spark.createDataFrame([(1, "/a.wav", "k")], "id bigint, file_path string, machine_id string")
    heard = ingest.desk_audio(screen.audio(audio, chunks), ingest.Who("u", "d", NOW), "/db")
    e = heard["event"].first()
    assert (e["start_at"], e["end_at"], e["confidence"]) == (at(1), at(1), 0.78)
    span = normalize.event_spans(heard["event"].unionByName(made["event"]), "v1")
    assert {(r["span_type"], r["speaker_label"]) for r in span.collect()} == {("transcript", "speaker_3"), ("activity_summary", None)}
    ui = spark.createDataFrame([(9, "2026-01-01T12:00:05Z", "s", 5, "click", 1, 4, None), (10, "2026-01-01T12:00:06Z", "s", 6, "key", 1, 99, "x")], "id bigint, timestamp string, session_id string, relative_ms bigint, event_type string, x bigint, frame_id bigint, text_content string")
    ui = ui.withColumns({c: F.lit(None).cast("string") for c in ("app_name", "window_title", "browser_url", "machine_id")})
    known = rows.select(F.col("id").alias("frame_id"), ids.stable_id("tl-frame-metadata", F.lit("u"), F.lit("d"), F.col("id"), F.lit("v1")).alias("artifact_id"))
    clicks = ingest.ui_events(screen.ui_events(ui), known, ingest.Who("u", "d", NOW), "/db")
    assert clicks["event_artifact"].where("role = 'supporting'").count() == 1 and clicks["event"].count() == 2
    assert {r["name"]: r["n"] for r in ingest.counters(clicks).collect()} == {"artifact": 2, "event": 2, "event_artifact": 3}


# Scenes, alignment, spans, memory, retrieval


@pytest.fixture(scope="module")
def story(spark, tmp_path_factory):
    """Two devices over some minutes, as far as scenes."""
    art = lambda i, kind, meta, off=None, clock="low": (i, "u", "d", None, None, kind, None, f"/{i}", "", 0, at(0), None, at(0), at(0), off, clock, None, None, "v1", "stored", json.dumps(meta))
    artifacts = spark.createDataFrame(
        [art("m1", "app_metadata", {"frontmost_app_name": "Editor", "window_title": "t"}, 100, "high"), art("s1", "screenshot", {"foreground_app": "Editor", "window_title": "t"}, 300), art("m2", "app_metadata", {"frontmost_app_name": "Editor"}), art("m3", "app_metadata", {"frontmost_app_name": "Chrome"})],
        schema.TABLES["artifact"].schema,
    )
    links = spark.createDataFrame([("e1", "m1", "primary", 0.9), ("e1", "s1", "supporting", 0.8), ("e2", "m2", "supporting", 0.7), ("e3", "m3", "supporting", 0.6)], schema.TABLES["event_artifact"].schema)
    rows = [event("e1", 0, 60, "x", coarse_category="development", summary="wrote code"), event("e2", 70, 130, "x", coarse_category="development", observed_facts=["f1", "f2"]), event("e3", 500, 520, "x", coarse_category="browser")]
    ev = events(spark, rows)
    made = scenes.build(ev, links, artifacts, NOW)
    return ev, links, artifacts, scenes.Scenes(**stored_all(vars(made), str(tmp_path_factory.mktemp("scenes"))))


def test_scenes_and_claims(spark, story):
    _, _, _, made = story
    rows = sorted(made.scene_window.collect(), key=lambda r: r["start_at"])
    meta = json.loads(rows[0]["metadata_json"])
    assert len(rows) == 2 and meta["event_ids"] == ["e1", "e2"] and meta["dominant_app_name"] == "Editor" and meta["median_clock_offset_ms"] == 200 and meta["clock_confidence"] == "high"
    q = min(1, 0.9 * 0.5 + 0.5 * 0.2 + 1 * 0.15 + 1 * 0.15)
    assert rows[0]["confidence"] == pytest.approx(round(min(1, 0.9 * 0.5 + q * 0.2 + 0.1 + 0.1 + 0.15), 3)) and rows[0]["window_type"] == "device_segment"
    claims = {(r["scene_window_id"], r["claim_type"]): r for r in made.candidate_claim.collect()}
    mine = {k[1] for k in claims if k[0] == rows[0]["id"]}
    assert mine == {"device_attended", "app_in_focus", "task_context"} and claims[(rows[0]["id"], "app_in_focus")]["disposition"] == "accepted"
    assert made.candidate_claim_evidence.where("evidence_role = 'contradictory'").count() == 0
    assert made.scene_window_artifact.where("role = 'primary'").count() == 3  # every artifact of the scene's best source
    fused = {r["id"]: json.loads(r["payload_json"]) for r in made.event.collect()}
    assert any(p["source_event_ids"] == ["e1", "e2"] and p["accepted_claims"] for p in fused.values())
    assert made.event_artifact.where("role = 'primary'").count() == 2
    assert schema.orphans(made.candidate_claim, made.scene_window, "scene_window_id").count() == 0


def test_alignment(spark, story, tmp_path):
    made = story[3]
    row = lambda i, s, e, offset: (i, "u", "cam", "sensor_segment", at(s), at(e), 6, 0.6, "camera_visual", "stable", json.dumps({"time_alignment_basis": {"clock_offset_ms": offset}, "screen_context": {"status": "attached"}, "transcript": "hello camera"}))
    both = made.scene_window.unionByName(spark.createDataFrame([row("c1", 140, 150, 3000), row("c2", 3000, 3010, 0)], schema.TABLES["scene_window"].schema))
    refs = align.References(**stored_all(vars(align.build(both, NOW)), str(tmp_path)))
    scene = refs.reference_scene.collect()
    assert len(scene) == 1 and scene[0]["primary_device_id"] == "d" and scene[0]["end_at"] == at(147)
    roles = {r["scene_window_id"]: r["role"] for r in refs.reference_scene_member.collect()}
    assert roles["c1"] == "supporting" and len(roles) == 2
    meta = json.loads(scene[0]["metadata_json"])
    assert meta["screen_context"]["attached_member_count"] == 1 and meta["time_alignment"]["member_offsets_ms"]["c1"] == 3000
    spans = normalize.build(both, story[0], refs.reference_scene, refs.reference_scene_member, NOW)
    assert {r["reference_scene_id"] for r in spans.where("scene_window_id = 'c1'").collect()} == {scene[0]["id"]}
    assert spans.where("span_type = 'activity_summary'").count() == 2
    assert normalize.days(story[0], both).count() == 1


@pytest.fixture(scope="module")
def store(spark, story, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("memory"))
    ev, links, artifacts, made = story
    none = lambda t: spark.createDataFrame([], schema.TABLES[t].schema)
    spans = stored(normalize.build(made.scene_window, ev, none("reference_scene"), none("reference_scene_member"), NOW), folder, "spans")
    side = {"day_arc": "steady", "time_blocks": [{"start_utc": "9:00", "end_utc": "10:00", "primary_activity": "code", "description": "Wrote the café parser"}, "junk"], "topics": ["parsers", " parsers ", "tests"], "people": [{"name": "Ann", "context": "met"}, "x"], "activities": {"code": 2, "rest": 1}}
    folders = spark.createDataFrame([("u", "2026-01-01", "---\na: b\n---\nBiography of a day", json.dumps(side), None), ("u", "2026-01-05", None, "not json", "lost")], "user_id string, day string, biography string, sidecar string, incomplete string")
    m = memory.build(spans, folders, NOW)
    tables = stored_all(vars(m), folder)
    tables |= {"content_span": spans, "artifact": artifacts, "event": ev, "scene_window": made.scene_window, "reference_scene": none("reference_scene")}
    return retrieval.Store(tables)


def test_memory_build(store):
    days = {r["day"]: (r["status"], r["completeness"]) for r in store["day_summary"].collect()}
    assert days == {"2026-01-01": ("complete", 0.95), "2026-01-05": ("incomplete", 0.6)}
    chunks = store["memory_chunk"].collect()
    kinds = {}
    for c in chunks:
        kinds.setdefault(c["chunk_type"], []).append(c["sort_key"])
    assert {k: sorted(v) for k, v in kinds.items()} == {"biography": [0], "day_arc": [10], "time_block": [100], "person_context": [700], "topic": [800, 801], "activity_total": [1000, 1001], "content_activity_summary": [2000, 2001]}
    tags = {(r["tag_type"], r["tag_value"]) for r in store["chunk_tag"].collect()}
    assert {("topic", "parsers"), ("person", "Ann"), ("activity", "code"), ("span_type", "activity_summary")} <= tags
    assert store["coverage_span"].where("span_kind = 'time_block'").first()["start_at"] == datetime(2026, 1, 1, 9)
    assert schema.orphans(store["chunk_ref"], store["memory_chunk"], "chunk_id").count() == 0
    old = memory.supersede(store["memory_build"], store["memory_build"].select("user_id"))
    assert {r["status"] for r in old.collect()} == {"superseded"} and memory.active_build(old).count() == 0


def test_retrieval(spark, store):
    how, rows = retrieval.search_memory(store, "u", "cafe pars*")
    hit = rows.collect()
    assert how == "fts" and [r["chunk_type"] for r in hit] == ["time_block"] and "[café]" in hit[0]["snippet"] and hit[0]["tags"] == {"activity": ["code"]}
    assert retrieval.search_memory(store, "u", "(((")[0] == "like" and retrieval.search_memory(store, "u", "")[0] == "latest"
    assert retrieval.search_memory(store, "u", "biography", chunk_types=["topic"])[1].count() == 0
    assert retrieval.search_memory(store, "u", "biography", tags=["topic:parsers"], day_from="2026-01-01", day_to="2026-01-02")[1].count() == 1
    assert [r["sort_key"] for r in retrieval.timeline(store, "u", "2026-01-01", 3).collect()] == [0, 10, 100]
    day = retrieval.day(store, "u", "2026-01-01").first()
    assert day["status"] == "complete" and day["chunk_counts"][0]["n"] == 2 and len(day["timeline"]) == 10 and day["coverage"]
    span_chunks = store["memory_chunk"].where("chunk_type = 'content_activity_summary'").select(F.col("id").alias("chunk_id"))
    kinds = [r["ref_kind"] for r in retrieval.evidence(store, span_chunks).collect()]
    assert sorted(kinds) == ["content_span", "content_span", "event", "event"]
    env = retrieval.environment(store, "u").first()
    assert env["days"] == 2 and [d["day"] for d in env["open_days"]] == ["2026-01-05"]
    one_id = span_chunks.first()[0]
    assert retrieval.chunk(store, "u", one_id).first()["refs"] and retrieval.coverage(store, "u", "2026-01-01").count() == 2


def test_query_language(spark):
    docs = spark.createDataFrame([(1, "T", "red car fast"), (2, "T", "red blue car"), (3, "Red", "green"), (4, None, "car red")], "id int, title string, text string")
    ix = search.index(docs, "id", ["title", "text"])
    found = lambda q: sorted(r["doc"] for r in search.bm25(ix, q).collect())
    assert found("red car") == [1, 2, 4] and found('"red car"') == [1] and found("red NOT car") == [3] and found("gre* OR blue") == [2, 3] and found("red AND (green OR fast)") == [1, 3]
    for bad in ("", "AND", '"open', "a)", "(a", "NOT x", "a-b"):
        with pytest.raises(search.QuerySyntaxError):
            search.parse(bad)


# Similarity, upserts, jobs


def test_overlap_report_equals_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = lambda p: [(f"{p}{i}", at(rng.randint(0, 20000)), " ".join(rng.choices(vocabulary, k=3))) for i in range(25)]
    left, right = rows("l"), rows("r")
    want = []
    for a in left:
        for b in right:
            ta, tb = ({w: x[2].split().count(w) for w in x[2].split()} for x in (a, b))
            dot = sum(n * tb.get(w, 0) for w, n in ta.items())
            cos = dot / (sum(n * n for n in ta.values()) * sum(n * n for n in tb.values())) ** 0.5
            gap = abs((a[1] - b[1]).total_seconds())
            score = cos * 0.65 + max(0, 1 - gap / 60 / 90) * 0.35
            if score > 0:
                want.append((-math.floor(score / 1e-4 + 0.5), math.floor(gap / 60 / 1e-2 + 0.5), a[1], a[0], b[0]))
    frame = lambda x: spark.createDataFrame(x, "id string, start_at timestamp, text string")
    got = [(r["left_id"], r["right_id"]) for r in overlap.report(frame(left), frame(right)).collect()]
    assert got == [w[3:] for w in sorted(want)[:12]]
    with pytest.raises(ValueError):
        overlap.report(frame(left), frame(right), 0)


def test_upserts(spark):
    table = schema.TABLES["event"]
    old = events(spark, [event("a", 0, 10, "x"), event("b", 0, 10, "x")])
    new = events(spark, [event("a", 500, 510, "y"), event("c", 0, 1, "z")]).withColumn("confidence", F.lit(0.1))
    rows = {r["id"]: r for r in upsert.upsert(old, new, "event").collect()}
    assert rows["a"]["start_at"] == at(0) and rows["a"]["confidence"] == 0.1 and json.loads(rows["a"]["payload_json"])["activity_type"] == "y" and len(rows) == 3 and table.updated == ["confidence", "payload_json", "created_by", "created_at"]
    evidence = spark.createDataFrame([("k", None, "e", "supporting", 0.5, "n"), ("k", "a", None, "supporting", 0.5, "n")], schema.TABLES["candidate_claim_evidence"].schema)
    assert upsert.upsert(upsert.upsert(evidence.limit(0), evidence, "candidate_claim_evidence"), evidence, "candidate_claim_evidence").count() == 2
    link = spark.createDataFrame([("e", "a", "supporting", 0.1), ("e", "a", "primary", 0.2)], schema.TABLES["event_artifact"].schema)
    assert upsert.upsert(link.limit(0), link, "event_artifact").first()["role"] == "primary"
    rows, new_rows = upsert.insert_missing(old, new, ["id"])
    assert rows.count() == 3 and new_rows.count() == 1
    left, gone = upsert.delete_like(old, F.col("id") == "a", "AN_INTER%")
    assert left.count() == 1 and gone.first()["deleted"] == 1
    assert upsert.replace(old, new.limit(0), F.col("id") == "a").count() == 1


def test_cascades(spark, story):
    ev, _, _, made = story
    tables = {"scene_window": made.scene_window, "candidate_claim": made.candidate_claim, "candidate_claim_evidence": made.candidate_claim_evidence, "scene_window_artifact": made.scene_window_artifact, "event_artifact": made.event_artifact, "event": ev.unionByName(made.event)}
    after, ids_gone = upsert.cascade_scenes(tables, F.col("start_at") < F.lit(at(100)))
    assert after["scene_window"].count() == 1 and after["event"].count() == 4 and ids_gone["scenes"].count() == 1
    assert schema.orphans(after["candidate_claim_evidence"], after["candidate_claim"], "candidate_claim_id").count() == 0
    refs = align.build(made.scene_window.withColumn("primary_device_id", F.col("id")), NOW, align.Config(tolerance_seconds=1000))
    tables |= {"reference_scene": refs.reference_scene, "reference_scene_member": refs.reference_scene_member, "event": refs.event}
    after, _ = upsert.cascade_references(tables, F.lit(True))
    assert after["reference_scene_member"].count() == 0 and after["event"].count() == 0 and refs.event.count() == 1


def test_job_transitions(spark):
    base = {"user_id": "u", "job_type": "fuse", "attempt_count": 0, "max_attempts": 2, "state": "queued", "priority": 1}
    rows = [base | {"id": "p"}, base | {"id": "a", "parent_job_id": "p", "priority": 5}, base | {"id": "b", "parent_job_id": "p"}]
    df = schema.shaped(spark.createDataFrame(rows, "id string, user_id string, job_type string, attempt_count bigint, max_attempts bigint, state string, priority bigint, parent_job_id string"), "job", queued_at=NOW)
    assert [r["id"] for r in jobs.queue(df, ["queued"], 1).collect()] == ["a"]
    df, runs = jobs.start(df, df.where("id <> 'p'").select("id"), "w", NOW)
    assert runs.count() == 2 and {r["attempt_count"] for r in df.where("id <> 'p'").collect()} == {1}
    df = jobs.failed(df, F.col("id") == "a", NOW, "E", "boom")
    assert df.where("id = 'a'").first()["state"] == "retrying"
    df, _ = jobs.start(df, df.where("id = 'a'").select("id"), "w", NOW)
    df = jobs.failed(df, F.col("id") == "a", NOW, "E", "boom")
    assert df.where("id = 'a'").first()["state"] == "failed" and jobs.complete_parents(df, NOW).where("id = 'p'").first()["state"] == "queued"
    df = jobs.done(df, F.col("id") == "b", NOW, "{}")
    assert jobs.complete_parents(df, NOW).where("id = 'p'").first()["state"] == "failed"
    assert jobs.finish_runs(runs, F.col("job_id") == "a", "failed", NOW).where("status = 'failed'").count() == 1
    assert jobs.set_state(df, F.col("id") == "p", "canceled", finished_at=NOW).where("id = 'p'").first()["state"] == "canceled"


# Scans and the store


def test_scans(spark):
    from timeloom.operators import scans

    df = events(spark, [event("b", 50, None, "x"), event("a", 0, 10, "x"), event("c", 90_000, None, "y", kind="app_focus")])
    rows = lambda **k: [r["id"] for r in scans.scan(df, "event", **k).collect()]
    assert rows() == ["a", "b", "c"] and rows(event_type="app_focus") == ["c"] and rows(start=at(0), end=at(50)) == ["a"] and rows(day="2026-01-01") == ["a", "b"]
    assert rows(like={"created_by": "%INTERPRETER%"}, among={"id": ["a", "c"]}, limit=1) == ["a"] and rows(device_id=None, day="2026-01-02", offset_hours=-7) == ["c"]
    assert [r["day"] for r in scans.event_days(df, "u").collect()] == ["2026-01-01", "2026-01-02"] and scans.device_days(df, "u").count() == 2 and scans.get(df, "a").count() == 1


def test_store_swaps_touched_days(spark, tmp_path):
    from timeloom.plans.store import TableStore

    store = TableStore(spark, str(tmp_path / "store"))
    store.write("event", events(spark, [event("a", 0, 10, "x"), event("b", 90_000, None, "x"), event("c", 180_000, None, "x")]))
    days = spark.createDataFrame([("u", "2026-01-02")], "user_id string, day string")
    first = store.current("event")
    store.replace_days("event", events(spark, []), days)  # the day becomes empty
    assert sorted(r["id"] for r in store.read("event").collect()) == ["a", "c"]
    kept = {r["_version"] for r in store._manifest("event", store.current("event")).collect()}
    assert kept == {first}  # the other days weren't rewritten
    moved = event("a", 90_000, None, "x")
    store.write("scene_window", spark.createDataFrame([("s", "u", at(0), None)], "id string, user_id string, start_at timestamp, end_at timestamp"))
    store.upsert("scene_window", spark.createDataFrame([("s", "u", at(90_000), None)], "id string, user_id string, start_at timestamp, end_at timestamp"))
    rows = store.read("scene_window").collect()  # moved to another day, and gone from its first
    assert [(r["id"], r["start_at"]) for r in rows] == [("s", at(90_000))] and moved
    nobody = spark.createDataFrame([("n", None, None, None)], "id string, user_id string, start_at timestamp, end_at timestamp")
    store.upsert("scene_window", nobody)
    store.upsert("scene_window", nobody)
    assert store.read("scene_window").count() == 2
    one = store.read("event", spark.createDataFrame([("u-u", "2026-01-03")], "_user string, _day string"))
    assert [r["id"] for r in one.collect()] == ["c"] and "PartitionFilters: [" in one._jdf.queryExecution().toString()
    store.vacuum("event"), store.vacuum("scene_window")
    assert store.read("event").count() == 2 and store.read("scene_window").count() == 2
    assert len(list((tmp_path / "store/event/manifest").iterdir())) == 1


def test_a_write_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    from timeloom.plans.store import TableStore

    store = TableStore(spark, str(tmp_path / "store"))
    store.write("event", events(spark, [event("a", 0, 10, "x")]))
    monkeypatch.setattr(TableStore, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.write("event", events(spark, [event("b", 0, 10, "x")]))
    assert [r["id"] for r in store.read("event").collect()] == ["a"]


def test_store_upserts_partitions(spark, tmp_path):
    from timeloom.plans.store import TableStore

    store = TableStore(spark, str(tmp_path / "store"))
    assert store.read("event").count() == 0
    store.upsert("event", events(spark, [event("a", 0, 10, "x"), event("b", 90_000, None, "x")]))
    store.upsert("event", events(spark, [event("a", 0, 10, "y"), event("c", 0, 10, "z")]))
    rows = {r["id"]: json.loads(r["payload_json"])["activity_type"] for r in store.read("event").collect()}
    assert rows == {"a": "y", "b": "x", "c": "z"}
    store.upsert("event_artifact", spark.createDataFrame([("a", "m", "primary", 0.5)], schema.TABLES["event_artifact"].schema))
    store.upsert("event_artifact", spark.createDataFrame([("a", "n", "primary", 0.5)], schema.TABLES["event_artifact"].schema))
    assert store.read("event_artifact").count() == 2


def test_scenes_exchange_each_event_once(spark):
    """No row is sent for each distinct count, and no scene is joined with its own most frequent values."""
    keys = {"user_id": "u", "device_id": "d", "scene_no": 1}
    rows = [("a", 0, "x", "m"), ("b", 1, "y", None), ("c", 2, "y", "m"), ("d", 3, "x", ""), ("e", 4, None, "n")]
    df = spark.createDataFrame([(n, at, app, kind) for n, at, app, kind in rows], "id string, at long, app string, category string").select(
        *[F.lit(v).alias(k) for k, v in keys.items()], "id", F.timestamp_seconds("at").alias("start_at"), F.timestamp_seconds("at").alias("end_at"), F.lit(0.5).alias("confidence"), "app", "category", F.col("app").alias("heading"),
        F.array(F.lit("screenshot")).alias("sources"), F.array(F.lit(4).cast("long")).alias("offsets"), F.array(F.lit("low")).alias("clocks"), F.array("id").alias("summaries"), F.array(F.struct("id")).alias("artifacts"),
    )
    got = scenes.scored(df)
    one = got.first()
    assert (one["dominant_app"], one["app_share"], one["apps"]) == ("x", 0.4, 2)
    assert (one["dominant_category"], one["category_share"], one["categories"]) == ("m", 0.4, 3)
    assert (one["title_examples"], one["event_ids"], one["summary_examples"]) == (["x", "y"], list("abcde"), list("abcde"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Expand" not in plan


def test_without_keeps_no_set_of_ids(spark):
    target, ids = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n long"), spark.createDataFrame([("b",), ("b",)], "x string")
    left = upsert.without(target, ids, "id")
    assert [tuple(r) for r in left.collect()] == [("a", 1)]
    assert "Aggregate" not in left._jdf.queryExecution().optimizedPlan().toString()
