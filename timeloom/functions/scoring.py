"""Source policy, categories and confidences as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sources from the most to the least direct.
SOURCE_PRIORITY = {
    "app_metadata": 1,
    "screenshot": 2,
    "screen_ocr": 3,
    "desktop_audio": 4,
    "ambient_audio": 5,
    "camera_visual": 6,
    "camera_audio": 7,
    "codex_interpretation": 8,
    "unknown": 99,
}
DIRECT_SOURCES = ["app_metadata", "screenshot", "screen_ocr", "desktop_audio", "ambient_audio"]
CLOCK_RANK = {"high": 3, "medium": 2, "low": 1}
ARTIFACT_SOURCE = {
    "app_metadata": "app_metadata",
    "screenshot": "screenshot",
    "desktop_audio": "desktop_audio",
    "audio_chunk": "ambient_audio",
    "camera_frame": "camera_visual",
    "video_excerpt": "camera_visual",
    "gopro_frame": "camera_visual",
    "audio_excerpt": "camera_audio",
    "gopro_audio": "camera_audio",
}
INTERPRETED = "codex_interpretation"

# The category of each application.
APP_CATEGORY = {
    "terminal": "development",
    "iterm2": "development",
    "warp": "development",
    "ghostty": "development",
    "ptyxis": "development",
    "gnome-terminal": "development",
    "konsole": "development",
    "alacritty": "development",
    "kitty": "development",
    "claude code": "development",
    "visual studio code": "development",
    "cursor": "development",
    "xcode": "development",
    "google chrome": "browser",
    "chrome": "browser",
    "safari": "browser",
    "arc": "browser",
    "firefox": "browser",
    "brave browser": "browser",
    "gnome-shell": "unknown",
    "mutter": "unknown",
    "slack": "communication",
    "discord": "communication",
    "signal": "communication",
    "messages": "communication",
    "zoom": "meeting",
    "microsoft teams": "meeting",
    "meet": "meeting",
    "notion": "documents",
    "preview": "documents",
    "google docs": "documents",
    "loupe": "documents",
    "eye of gnome": "documents",
    "finder": "system_navigation",
    "org.gnome.nautilus": "system_navigation",
    "nautilus": "system_navigation",
    "system settings": "system_settings",
    "gnome-control-center": "system_settings",
}
# The recorder's own applications; name yours here or where they are a parameter.
CAPTURE_APPS = ("timeloom capture",)
# What a screen's text shows of the application in front, in order of precedence.
SCREEN_HINTS = [
    ("visual studio code", "Visual Studio Code"),
    ("cursor", "Cursor"),
    ("— claude", "Claude Code"),
    ("chrome://", "Google Chrome"),
    ("chrome available", "Google Chrome"),
    ("newchrome", "Google Chrome"),
    ("new chrome", "Google Chrome"),
    ("google chrome", "Google Chrome"),
    ("firefox", "Firefox"),
    ("mozilla firefox", "Firefox"),
    ("brave browser", "Brave Browser"),
    ("ptyxis", "Terminal"),
    ("ghostty", "Ghostty"),
    ("slack |", "Slack"),
    ("discord |", "Discord"),
    ("signal |", "Signal"),
    ("notion.so", "Notion"),
    ("google docs", "Google Docs"),
]
COMPOSITORS = ["gnome-shell", "mutter", "gala"]
# Parts of names that tell a category, in order of precedence.
APP_PARTS = [
    ("browser", ["chrome", "safari", "firefox", "browser"]),
    ("development", ["terminal", "shell", "console"]),
    ("development", ["code", "vim", "emacs", "neovim"]),
    ("system_navigation", ["nautilus", "files"]),
]
ROOM_CONFIDENCE = {"room": 0.82, "mixed": 0.58, "media": 0.3, "unclear": 0.18}


def looked_up(key: Column, table: dict, default) -> Column:
    literal = F.create_map(*[F.lit(x) for x in chain(*table.items())])
    return F.coalesce(F.try_element_at(literal, F.coalesce(key, F.lit(""))), F.lit(default))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def source_priority(source: Column) -> Column:
    return looked_up(source, SOURCE_PRIORITY, 99)


def is_direct(source: Column) -> Column:
    return F.coalesce(source.isin(DIRECT_SOURCES), F.lit(False))


def primary_source(sources: Column, fallback: str = "unknown") -> Column:
    """The most direct of an array of sources; the first of equals."""
    known = F.filter(sources, lambda s: s.isNotNull() & (s != ""))
    ranked = F.transform(known, lambda s, i: F.struct(source_priority(s).alias("p"), i.alias("i"), s.alias("s")))
    return F.coalesce(F.array_min(ranked)["s"], F.lit(fallback))


def clock_rank(confidence: Column) -> Column:
    return looked_up(confidence, CLOCK_RANK, 0)


def artifact_source(kind: Column) -> Column:
    return looked_up(kind, ARTIFACT_SOURCE, INTERPRETED)


def app_category(name: Column, capture_apps: tuple[str, ...] = CAPTURE_APPS) -> Column:
    """Whole names first, then parts of names in their order."""
    key = F.lower(F.trim(name))
    exact = APP_CATEGORY | dict.fromkeys(capture_apps, "capture_control")
    out = F.lit("unknown")
    for category, parts in reversed(APP_PARTS):
        hit = F.lit(False)
        for part in parts:
            hit = hit | key.contains(part)
        out = F.when(hit, category).otherwise(out)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*exact.items())]), F.coalesce(key, F.lit(""))), out)


def retention(state: Column, upload_status: Column) -> Column:
    """active, suppressed or quarantined; restored rows are active again."""
    s, legacy = F.lower(F.trim(F.coalesce(state, F.lit("")))), F.lower(F.trim(F.coalesce(upload_status, F.lit(""))))
    return F.when(s == "restored", "active").when(s.isin("active", "suppressed", "quarantined"), s).when(legacy == "suppressed", "suppressed").otherwise("active")


def truth(text: Column) -> Column:
    """true/1/yes and false/0/no, anything else null."""
    low = F.lower(F.trim(text.cast("string")))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def signed_hash(unsigned: Column) -> Column:
    """An unsigned 64-bit number in decimal text, wrapped to a bigint."""
    wide = unsigned.cast("decimal(20,0)")
    return F.when(wide >= F.lit("9223372036854775808").cast("decimal(20,0)"), (wide - F.lit("18446744073709551616").cast("decimal(20,0)")).cast("long")).otherwise(wide.cast("long"))


def chunk_confidence(source_type: Column, transcript: Column) -> Column:
    base = looked_up(F.lower(source_type), ROOM_CONFIDENCE, 0.2)
    return clamp(F.round(base - F.when(F.length(F.trim(F.coalesce(transcript, F.lit("")))) < 40, 0.1).otherwise(0.0), 3), 0.05, 0.95)


def camera_confidence(transcript: Column, visual: Column) -> Column:
    """Of a clip: its visual confidence, if any, weighed by whether something was said."""
    length = F.length(F.trim(F.coalesce(transcript, F.lit(""))))
    seen = F.when(length > 0, clamp(F.round(0.45 + 0.45 * visual, 3), 0.25, 0.98)).otherwise(clamp(F.round(0.35 + 0.55 * visual, 3), 0.2, 0.95))
    return F.when(visual.isNotNull(), seen).when(length >= 40, 0.62).when(length > 0, 0.42).otherwise(0.2)


def app_on_screen(text: Column) -> Column:
    """The application that the first 2000 characters of a screen's text show, or null."""
    low = F.lower(F.substring(text, 1, 2000))
    out = F.lit(None).cast("string")
    for hint, app in reversed(SCREEN_HINTS):
        out = F.when(low.contains(hint), app).otherwise(out)
    return out


def frame_app(app: Column, screen_text: Column, window: Column) -> Column:
    """The reported application unless it is a compositor; then what the screen, or else the window's title, tells."""
    raw = F.lower(F.trim(F.coalesce(app, F.lit(""))))
    real = (raw != "") & ~raw.isin(COMPOSITORS)
    title = F.when((window != "") & (F.lower(window) != "main stage"), window)
    return F.when(real, app).otherwise(F.coalesce(app_on_screen(screen_text), title, F.nullif(app, F.lit("")), F.lit("unknown")))


def clock_confidence(explicit: Column, offset_ms: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(explicit), F.lit("")), F.when(offset_ms.isNotNull(), "medium").otherwise("low"))


def capture_clock_confidence(offset_ms: Column, platform: Column) -> Column:
    return F.when(offset_ms.isNotNull(), "high").when(F.nullif(platform, F.lit("")).isNotNull(), "medium").otherwise("low")


def keeps_speech(source_type: Column, language: Column) -> Column:
    """False for media, and for room sound in a known language other than English."""
    kind, lang = F.lower(F.trim(F.coalesce(source_type, F.lit("")))), F.lower(F.trim(F.coalesce(language, F.lit(""))))
    return ~(kind == "media") & ~((kind == "room") & (lang != "") & ~lang.startswith("en"))
