"""A screen recorder's tables, over JDBC or from an extract.

Timestamps are texts there, with Z or an offset.  A range of instants is first
a range of texts, wide enough for any offset, which reaches the database or the
Parquet filters; what it lets through is compared as instants.  A database is
read in slices of that range, one task each, and OCR text only for the frames
that were chosen.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import text
from timeloom.functions.times import audio_times, parse_instant

#: The day of a text lies no further than this from that of its instant, whatever the offset and the session's zone.
MARGIN = timedelta(days=2)


def day_text(at, margin: timedelta) -> str:
    moment = at if isinstance(at, datetime) else datetime.fromisoformat(str(at))
    return (moment + margin).strftime("%Y-%m-%d")


def text_range(at: str, start=None, end=None) -> list[Column]:
    """Conditions on a column of timestamps as texts that all rows of a range of instants fulfil, and others; texts with blanks in front pass."""
    out = []
    if start is not None:
        out.append((F.col(at) >= day_text(start, -MARGIN)) | (F.col(at) < "!"))
    if end is not None:
        out.append(F.col(at) < day_text(end, MARGIN))
    return out


def time_slices(at: str, start, end, parts: int, quote: str = '"') -> list[str]:
    """SQL conditions that cut a table by a column of timestamps as texts: every row, whatever it holds, fulfils one of them.

    The cuts lie evenly between two instants, so rows outside go to the first
    and the last slice.
    """
    first, last = (datetime.fromisoformat(day_text(x, m)) for x, m in ((start, -MARGIN), (end, MARGIN)))
    step = (last - first) / max(1, parts)
    cuts = list(dict.fromkeys((first + step * i).strftime("%Y-%m-%dT%H:%M") for i in range(1, max(1, parts))))
    name = f"{quote}{at}{quote}"
    if not cuts:
        return ["1 = 1"]
    inner = [f"{name} >= '{a}' AND {name} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [f"{name} < '{cuts[0]}' OR {name} IS NULL", *inner, f"{name} >= '{cuts[-1]}'"]


def read_jdbc(spark: SparkSession, url: str, table: str, slices: list[str] | None = None, **options: str) -> DataFrame:
    """A table of the recorder's database, read only; each of the ``slices`` is a task, and predicates reach the database."""
    if slices:
        return spark.read.jdbc(url, table, predicates=slices, properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def of_frames(ocr_text: DataFrame, frames: DataFrame) -> DataFrame:
    """The rows of some frames; their least and largest id, which reach the driver, reach the database."""
    least, most = frames.agg(F.min("id"), F.max("id")).first()
    if least is None:
        return ocr_text.limit(0)
    return ocr_text.where((F.col("frame_id") >= least) & (F.col("frame_id") <= most))


def ranged(rows: DataFrame, machine: str | None, start, end, at: str = "timestamp") -> DataFrame:
    """What a machine and a range of texts leave of a table as it is stored."""
    for test in [*([F.col("machine_id") == machine] if machine is not None else []), *text_range(at, start, end)]:
        rows = rows.where(test)
    return rows


def chosen(rows: DataFrame, at: str, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Rows of a half-open range of instants, in order; a parameter that isn't set adds no predicate."""
    if start is not None:
        rows = rows.where(F.col(at) >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.where(F.col(at) < F.lit(end).cast("timestamp"))
    rows = rows.orderBy(at, "id")
    return rows.limit(limit) if limit is not None else rows


def frames(frame: DataFrame, ocr_text: DataFrame, machine: str | None = None, start=None, end=None, limit: int | None = None, narrow: bool = False) -> DataFrame:
    """Frames with one OCR text each, the longest.

    OCR text is grouped for chosen frames alone; with ``narrow`` a first pass
    over those finds their range of ids, for tables in a database.
    """
    rows = ranged(frame, machine, start, end).withColumn("at", parse_instant(F.col("timestamp")))
    rows = chosen(rows, "at", start, end, limit)
    if narrow:
        ocr_text = of_frames(ocr_text, rows)
    if machine is not None or start is not None or end is not None or limit is not None:
        ocr_text = ocr_text.join(rows.select(F.col("id").alias("frame_id")), "frame_id", "left_semi")
    best = ocr_text.groupBy("frame_id").agg(F.max_by(F.struct("text", "text_json", "ocr_engine"), F.struct(F.length(F.coalesce("text", F.lit(""))), "text", "text_json", "ocr_engine")).alias("o"))
    best = best.select(F.col("frame_id").alias("id"), text.squeeze(F.col("o.text")).alias("ocr_text"), F.col("o.text_json").alias("ocr_text_json"), F.col("o.ocr_engine").alias("ocr_engine"))
    for c in ("full_text", "accessibility_text"):
        rows = rows.withColumn(c, text.squeeze(F.col(c)))
    rows = rows.withColumn("host", text.browser_host(F.col("browser_url")))
    return rows.join(best, "id", "left").orderBy("at", "id")


def audio(transcriptions: DataFrame, chunks: DataFrame, machine: str | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Utterances with the file of their chunk and the instants they span."""
    files = chunks if machine is None else chunks.where(F.col("machine_id") == machine)
    rows = ranged(transcriptions, None, start, end).join(files.select(F.col("id").alias("audio_chunk_id"), "file_path", "machine_id"), "audio_chunk_id")
    rows = rows.withColumn("at", parse_instant(F.col("timestamp"))).withColumn("transcription", text.squeeze(F.col("transcription")))
    first, last = audio_times(F.col("at"), F.col("start_time"), F.col("end_time"))
    return chosen(rows.withColumn("start_at", first).withColumn("end_at", last), "at", start, end, limit)


def ui_events(rows: DataFrame, machine: str | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    rows = ranged(rows, machine, start, end).withColumn("at", parse_instant(F.col("timestamp"))).withColumn("text_content", text.squeeze(F.col("text_content")))
    return chosen(rows, "at", start, end, limit)
