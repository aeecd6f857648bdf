"""Shared plumbing: durable tables, Arrow batch slicing, vectorised text helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.session import ship

#: Characters handled together by the array code; bounds a Python worker's memory.
SLICE_CHARS = 1_000_000

_own_dir: str | None = None


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only where that is unset and the session is local."""
    global _own_dir
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="timeloom-")
    return _own_dir


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    ship(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a table that ``durable`` gave; nothing that is still to be computed may read it."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def text_hash() -> Column:
    return F.coalesce(F.xxhash64("text"), F.lit(0)).cast("long")


#: A row's id, with null apart, and its text's hash, as plain keys.
ROW = ["did", "no_id", "th"]


def keyed(df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return df.withColumns({"did": F.coalesce(F.col(doc_id), F.lit(0)).cast("long"), "no_id": F.col(doc_id).isNull()})


#: Tasks among which the rows of one key are dealt where they meet their one partner.
SALTS = 8


def meet(many: DataFrame, one: DataFrame, keys: list[str], by: str | Column, how: str = "inner") -> DataFrame:
    """Join rows with their one partner, the rows of each key dealt to SALTS tasks by a hash of ``by``."""
    by = F.col(by) if isinstance(by, str) else by
    dealt = many.withColumn("salt", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(SALTS)).cast("int"))
    copies = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [*keys, "salt"], how).drop("salt")


def map_text(
    df: DataFrame,
    keep: list[str],
    make: Callable[[], Callable[[list[str]], dict[str, object]]],
    fields: list[tuple[str, T.DataType]],
    text: str = "text",
) -> DataFrame:
    """Add ``fields`` computed from ``text`` (null: empty), keeping the columns ``keep``.

    ``make`` is called once a task and returns a function from a list of whole
    texts to arrays by field name.  Batches are cut where their texts exceed
    SLICE_CHARS, so memory depends on the longest text alone.
    """
    source = df.select(*keep, text) if text not in keep else df.select(*keep)
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema, score = to_arrow_schema(schema), make()
        for batch in batches:
            for part in slices(batch, batch.column(batch.schema.get_field_index(text))):
                texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                made = score(texts)
                arrays = [part.column(part.schema.get_field_index(c)) for c in keep]
                arrays += [pa.array(made[n], type=out_schema.field(n).type) for n, _ in fields]
                arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, out_schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)
        give_back()

    return source.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: pa.Array, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a part hold about ``most`` bytes, one row at least."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(text), 0))
    start = total = 0
    for i, n in enumerate(size):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(size):
        yield batch.slice(start)


def give_back() -> None:
    """Return freed memory to the system at the end of a task; workers wait for the next stage with little."""
    import contextlib
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Characters of the words, and a few for each entry, that a Python worker keeps with what it found for them.
CACHE_CHARS, ENTRY_CHARS = 2_000_000, 8


class Kept(dict):
    """The value of every word met, computed once while there is room."""

    def __init__(self, value: Callable[[str], object]):
        self.value, self.room = value, CACHE_CHARS

    def __missing__(self, word: str):
        found = self.value(word)
        if self.room > 0:
            self.room -= len(word) + ENTRY_CHARS
            self[word] = found
        return found

    def make_room(self) -> None:
        """Forget all if it is full."""
        if self.room <= 0:
            self.clear()
            self.room = CACHE_CHARS


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def bounded_sample(df: DataFrame, by: str, per_class: int, *key: str) -> DataFrame:
    """About ``per_class`` rows of each value of ``by``, chosen by a hash of ``key``.

    The bound is in expectation: the share kept is per_class / count.  Classes
    with fewer rows are kept whole.  Only the counts by class reach the driver,
    as the classes themselves do with the model; no sort, no window, no join.
    """
    counts = {r[0]: r[1] for r in df.groupBy(by).count().collect() if r[0] is not None}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(per_class / n)).otherwise(share)
    return df.where(unit_hash(*[F.col(k) for k in key]) < share)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, *used: str) -> tuple[DataFrame, list[str], list[Column]]:
    """The rows with every column but ``text`` under a number, beside those in ``used`` under their names.

    Returns the rows, the names to carry along and the columns that turn them
    back, so that no column's name can clash with one that an operator makes.
    """
    names = [c if c == "text" else f"_{i}" for i, c in enumerate(df.columns)]
    carried = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)]
    back = [F.col(n).alias(c) for c, n in zip(df.columns, names)]
    return df.select(*carried, *[u for u in used if u != "text"]), names, back
