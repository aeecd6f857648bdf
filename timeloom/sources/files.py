"""Files as evidence: listings with hashes, JSON documents, day folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Media types by suffix.
MIME = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "json": "application/json", "txt": "text/plain", "md": "text/markdown", "wav": "audio/x-wav",
    "mp3": "audio/mpeg", "m4a": "audio/mp4", "ogg": "audio/ogg", "flac": "audio/flac", "mp4": "video/mp4", "mov": "video/quicktime", "csv": "text/csv", "html": "text/html", "pdf": "application/pdf",
}


def mime_type(path: Column) -> Column:
    from timeloom.functions.scoring import looked_up

    return looked_up(F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)), MIME, "application/octet-stream")


def plain_path(path: Column) -> Column:
    """A path without a local scheme."""
    return F.regexp_replace(path, r"^file:/+", "/")


def listing(spark: SparkSession, root: str, pattern: str = "*", content: bool = True) -> DataFrame:
    """path, byte_size, modified and, if wanted, the SHA-256 of every file under a root.

    Without ``content`` no file is opened: the hash column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    out = files.select(plain_path(F.col("path")).alias("path"), F.col("length").alias("byte_size"), F.col("modificationTime").alias("modified"), *([F.sha2("content", 256).alias("sha256")] if content else []))
    return out.withColumn("mime_type", mime_type(F.col("path")))


def texts(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path and whole text of every file that matches."""
    rows = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return rows.select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text"))


def json_documents(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """path and text of the well-formed JSON objects under a root."""
    rows = texts(spark, root, pattern)
    return rows.where(F.try_parse_json("text").isNotNull() & F.ltrim("text").startswith("{"))


def text_or_fail(spark: SparkSession, path: str) -> str:
    """A document by path; raises if it is missing."""
    return spark.read.format("text").option("wholetext", "true").load(path).first()[0]


def day_folders(spark: SparkSession, root: str, user: str) -> DataFrame:
    """user_id, day, biography, sidecar and incomplete of every folder named after a day."""
    names = {"biography.md": "biography", "sidecar.json": "sidecar", "INCOMPLETE.md": "incomplete"}
    rows = texts(spark, root, "{" + ",".join(names) + "}")
    rows = rows.select(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("day"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "text").where("day <> ''")
    kept = [F.max(F.when(F.col("name") == n, F.nullif(F.trim("text"), F.lit("")))).alias(c) for n, c in names.items()]
    return rows.groupBy("day").agg(*kept).select(F.lit(user).alias("user_id"), "day", *names.values())


def staging_root(base: str, source: str, date: str) -> str:
    """Where a source's captures of a day are staged."""
    layouts = {"desktop-linux": date.replace("-", "/"), "laptop-macos": date}
    if source not in layouts:
        raise ValueError(f"unknown source {source!r}")
    return f"{base.rstrip('/')}/{source}/{layouts[source]}"
