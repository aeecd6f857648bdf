"""Instants, days and clock offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = "MICROSECOND"


def iso_z(ts: Column) -> Column:
    """UTC text of an instant, with a fraction only where there is one."""
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(plain, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("Z"))


def parse_instant(text: Column) -> Column:
    """ISO-8601 text with Z or an offset; fractions beyond microseconds are cut, bad text is null."""
    cut = F.regexp_replace(F.trim(text), r"(\.\d{6})\d+", "$1")
    return F.try_to_timestamp(F.when(cut != "", cut))


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff(MICRO, a, b) / F.lit(1e6)


def add_micros(ts: Column, micros: Column) -> Column:
    return F.timestamp_add(MICRO, micros.cast("long"), ts)


def without_offset(ts: Column, offset_ms: Column) -> Column:
    """A wall-clock instant less its clock's offset; a null offset leaves it alone."""
    return add_micros(ts, -F.coalesce(offset_ms, F.lit(0)).cast("long") * 1000)


def day_of(ts: Column, offset_hours: float = 0.0, zone: str | None = None) -> Column:
    """The day of an instant in a fixed offset from UTC or, if given, a named zone."""
    local = F.from_utc_timestamp(ts, zone) if zone else add_micros(ts, F.lit(int(offset_hours * 3_600_000_000)))
    return F.date_format(local, "yyyy-MM-dd")


def day_range(day: str, offset_hours: float = 0.0) -> tuple[Column, Column]:
    """First instant of a local day and of the next one."""
    start = add_micros(F.lit(f"{day} 00:00:00").cast("timestamp"), F.lit(int(-offset_hours * 3_600_000_000)))
    return start, add_micros(start, F.lit(86_400_000_000))


def local_instant(text: Column, zone: str) -> Column:
    """Naive text is taken in ``zone``; text with Z or an offset keeps it."""
    has_zone = F.trim(text).rlike(r"([zZ]|[+-]\d{2}:?\d{2})$")
    naive = F.to_utc_timestamp(F.try_to_timestamp(text), zone)
    return F.when(has_zone, parse_instant(text)).otherwise(naive)


def clock_fragment_minutes(value: Column) -> Column:
    """Minutes of ``H``, ``H:MM`` or ``H:MM:SS``, null for anything else."""
    text = F.trim(value.cast("string"))
    hour = F.regexp_extract(text, r"^(\d{1,2})(?::(\d{1,2})(?::\d{1,2}(?:\.\d+)?)?)?$", 1)
    minute = F.regexp_extract(text, r"^(\d{1,2})(?::(\d{1,2})(?::\d{1,2}(?:\.\d+)?)?)?$", 2)
    h, m = hour.try_cast("int"), F.coalesce(F.when(minute != "", minute).try_cast("int"), F.lit(0))
    return F.when((hour != "") & (h < 24) & (m < 60), h * 60 + m)


def block_range(day: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """Instants of a block of clock times on a day; an end not after its start is on the next day."""
    base = day.cast("timestamp")
    a, b = clock_fragment_minutes(start), clock_fragment_minutes(end)
    b = F.when(b <= a, b + 1440).otherwise(b)
    known = a.isNotNull() & b.isNotNull()
    return F.when(known, add_micros(base, a.cast("long") * 60_000_000)), F.when(known, add_micros(base, b.cast("long") * 60_000_000))


def audio_times(at: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """A chunk's instant with the offsets of an utterance in it; a missing end is the start."""
    first = F.coalesce(start, F.lit(0.0))
    return add_micros(at, F.rint(first * 1_000_000)), add_micros(at, F.rint(F.coalesce(end, first) * 1_000_000))
