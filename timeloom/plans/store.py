"""The timeline's tables as versions of Parquet folders under one root.

A write adds a folder ``data/_version=...`` and a manifest, then moves a small
file that names the manifest into place, in one step where the file system can;
until then readers see the table as it was, and a write that dies leaves it so.
Tables by day have a manifest row for every user and day, with the version that
holds it, so that a write touches the days it is about: those that became empty
leave the manifest, and the others are not rewritten.  Old versions stay until
``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.times import day_of
from timeloom.operators import upsert
from timeloom.schema import TABLES, shaped

#: Tables that a user and a day cut into partitions, and the column that gives the day.
BY_DAY = {"event": "start_at", "scene_window": "start_at", "content_span": "start_at", "episode": "started_at", "reference_scene": "start_at"}
PLACE = ["_user", "_day"]


def placed(df: DataFrame, name: str) -> DataFrame:
    """With the names of its partition: a user's, a day's, and those of rows without."""
    user, day = F.col("user_id"), day_of(F.col(BY_DAY[name]))
    return df.withColumns({"_user": F.coalesce(F.concat(F.lit("u-"), user), F.lit("none")), "_day": F.coalesce(day.cast("string"), F.lit("none"))})


class TableStore:
    """Reads snapshots, upserts and replaces.  A table that isn't there yet is empty; one writer a table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, name, *parts]))

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self, name: str) -> list[str]:
        """The lines of the small file: the version that readers see, then, by stream, the last batch that it holds."""
        path = self._path(name, "current")
        if not self._files(path).exists(path):
            return []
        stream = self._files(path).open(path)
        try:
            return bytes(stream.readAllBytes()).decode().splitlines()
        finally:
            stream.close()

    def current(self, name: str) -> str | None:
        """The version that readers see."""
        lines = self._pointer(name)
        return lines[0] if lines else None

    def batches(self, name: str) -> dict[str, int]:
        """The number of the last batch that the current version holds of each stream."""
        return {query: int(epoch) for epoch, query in (line.split(" ", 1) for line in self._pointer(name)[1:])}

    def _switch(self, name: str, version: str, batch: tuple[str, int] | None = None) -> None:
        held = self.batches(name) | (dict([batch]) if batch else {})
        lines = "\n".join([version, *(f"{epoch} {query}" for query, epoch in sorted(held.items()))])
        jvm, new, now = self.spark._jvm, self._path(name, f"next-{version}"), self._path(name, "current")
        stream = self._files(new).create(new, True)
        stream.write(bytearray(lines.encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(now.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(new, now, options)

    def _manifest(self, name: str, version: str) -> DataFrame:
        return self.spark.read.schema("_user string, _day string, _version string").parquet(self._path(name, "manifest", version).toString())

    def read(self, name: str, days: DataFrame | None = None) -> DataFrame:
        """The table, or its rows of ``days`` (_user, _day); only the files of those are read."""
        version = self.current(name)
        if version is None:
            return self.spark.createDataFrame([], TABLES[name].schema)
        ddl = TABLES[name].ddl + ", _version string" + (", _user string, _day string" if name in BY_DAY else "")
        rows = self.spark.read.schema(ddl).option("basePath", self._path(name, "data").toString()).parquet(self._path(name, "data").toString())
        if name not in BY_DAY:
            return shaped(rows.where(F.col("_version") == version), name)
        which = self._manifest(name, version)
        if days is not None:
            which = which.join(days.select(*PLACE).distinct(), PLACE, "left_semi")
        return shaped(rows.join(which, ["_version", *PLACE], "left_semi"), name)

    def write(self, name: str, df: DataFrame, days: DataFrame | None = None, batch: tuple[str, int] | None = None) -> None:
        """Replace the whole table, or the rows of ``days`` (_user, _day), by ``df``, which must have no others then.

        ``batch``, a stream's name and a batch's number, is kept with the version, in the same step.
        """
        version, before, df = uuid.uuid4().hex, self.current(name), shaped(df, name)
        folder = self._path(name, "data", f"_version={version}").toString()
        if name not in BY_DAY:
            df.write.parquet(folder)
        else:
            placed(df, name).repartition(*PLACE).write.partitionBy(*PLACE).parquet(folder)
            written = self.spark.read.schema(TABLES[name].ddl + ", _user string, _day string").parquet(folder)
            rows = written.select(*PLACE).distinct().withColumn("_version", F.lit(version))
            if days is not None and before is not None:
                rows = self._manifest(name, before).join(days.select(*PLACE).distinct(), PLACE, "left_anti").unionByName(rows)
            rows.write.parquet(self._path(name, "manifest", version).toString())
        self._switch(name, version, batch)

    def replace_days(self, name: str, df: DataFrame, days: DataFrame) -> None:
        """The rows of ``days`` (user_id, day) give way to ``df``; days that it lacks become empty."""
        first = F.to_timestamp("day").alias(BY_DAY[name])
        self.write(name, df, placed(days.select("user_id", first), name))

    def days_of(self, name: str, where: Column) -> DataFrame:
        """The (_user, _day) of the rows for which a condition holds."""
        return placed(self.read(name).where(where), name).select(*PLACE).distinct()

    def upsert(self, name: str, df: DataFrame, order: list[str] | None = None, days_stay: bool = False, batch: tuple[str, int] | None = None) -> None:
        """Merge rows in by the table's key; rows that repeat a key are taken in ``order`` (columns of ``df``).

        Of tables by day only the days of the new rows, and of old ones with
        their keys, are read whole and written.  To find the latter the keys of
        the whole table are read (two columns and the key); with ``days_stay``
        the caller says that no row ever moves to another day, and the days of
        the new rows are enough.
        """
        if name not in BY_DAY:
            return self.write(name, upsert.upsert(self.read(name), df, name, order), batch=batch)
        key, rows = list(TABLES[name].key), shaped(df, name)
        touched = placed(rows, name).select(*PLACE)
        if not days_stay:
            touched = placed(self.read(name).join(rows.select(*key).distinct(), key, "left_semi"), name).select(*PLACE).unionByName(touched)
        touched = touched.distinct()
        self.write(name, upsert.upsert(self.read(name, touched), df, name, order), touched, batch)

    def sink(self, name: str, stream: str, order: list[str] | None = None, make: Callable[[DataFrame], DataFrame] | None = None, days_stay: bool = False) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that merges what ``make`` makes of a batch into a table, each batch once.

        A batch that comes again after a crash, between its write and the
        stream's own commit or before, changes nothing: the version that it
        wrote names it.  ``stream`` must be the stream's name for ever, and a
        table has one writer at a time.
        """

        def run(rows: DataFrame, number: int) -> None:
            if number <= self.batches(name).get(stream, -1):
                return
            self.upsert(name, make(rows) if make else rows, order, days_stay, (stream, number))

        return run

    def vacuum(self, name: str) -> None:
        """Delete the versions that the current one doesn't need."""
        version = self.current(name)
        if version is None:
            return
        needed = {version}
        if name in BY_DAY:
            needed |= {r[0] for r in self._manifest(name, version).select("_version").distinct().collect()}
        for folder, keep in (("data", {f"_version={v}" for v in needed}), ("manifest", {version})):
            path = self._path(name, folder)
            files = self._files(path)
            if files.exists(path):
                for status in files.listStatus(path):
                    if status.getPath().getName() not in keep:
                        files.delete(status.getPath(), True)
