"""Stage tables: what one stage hands to the next is stored, not a plan that grows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timeloom.session import work_folder


def stored(df: DataFrame, folder: str, name: str = "table") -> DataFrame:
    """Write ``df`` under a new name in a shared folder and read it back."""
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_all(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    return {name: stored(df, folder, name) for name, df in tables.items()}


def keeper(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """What stores the tables of one run in a new folder of its own."""
    folder = work_folder(spark)
    return lambda df, name: stored(df, folder, name)
