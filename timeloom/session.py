"""Session defaults: UTC, adaptive execution, overwrite of touched partitions only."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "timeloom", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only where that is unset and the session is local."""
    global _own_folder
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="timeloom-")
    return _own_folder


def work_folder(spark: SparkSession) -> str:
    """A new folder there."""
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once a session, where the environment doesn't give it to them already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if app in _shipped or os.path.realpath(root) in paths or os.path.realpath(os.getcwd()) == os.path.realpath(root):
        return
    folder = tempfile.mkdtemp(prefix="timeloom-code-")
    shutil.copytree(os.path.join(root, "timeloom"), os.path.join(folder, "code", "timeloom"), ignore=shutil.ignore_patterns("__pycache__"))
    if os.path.exists(top := os.path.join(root, "corpus_pipeline.py")):
        shutil.copy(top, os.path.join(folder, "code"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "timeloom_code"), "zip", os.path.join(folder, "code")))
    _shipped.add(app)
