"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; in every window of ``window``
successive k-grams the smallest hash is chosen, the rightmost of equals.  Any
passage of at least ``k + window - 1`` code points that two texts share gives
both the same selected hash, whatever surrounds it.  Positions are kept.

Corner cases: a null text is empty and has the empty fingerprint; a text
shorter than k is one gram; fewer grams than a window are one window; a very
long text is hashed in blocks, with memory in proportion to it; repeated rows
get equal fingerprints, and are each other's next; an empty table gives no
rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

K, WINDOW = 12, 20
#: Grams hashed together; a longer text is taken in overlapping blocks.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """The 32-bit hashes of all k-grams, by doubling: a 2m-gram's from two m-grams'."""
    with np.errstate(over="ignore"):
        power, have, h = np.uint64(_BASE), 1, points.astype(np.uint64) + np.uint64(1)
        out, done = None, 0
        scale = {1: power}
        rest = k
        while rest:
            if rest & have:
                if out is None:
                    out, done = h, have
                else:
                    n = len(points) - done - have + 1
                    out, done = out[:n] * scale[have] + h[done : done + n], done + have
            rest &= ~have
            if rest:
                n = len(points) - 2 * have + 1
                h = h[:n] * scale[have] + h[have : have + n]
                scale[2 * have] = scale[have] * scale[have]
                have *= 2
    return (common.mix64(out) >> np.uint64(32)).astype(np.uint64)


def window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions chosen by winnowing, ascending."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    width = min(window, n)
    # Smaller hash first; of equal hashes the larger position is the smaller key.
    key = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    low, have = key, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: n - width + 1], low[width - have :][: n - width + 1])
    low = low[np.r_[True, low[1:] != low[:-1]]]
    return (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) selected from a whole text."""
    points = common.code_points(text)
    if len(points) == 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, len(points))
    grams, found_h, found_p, last = len(points) - k + 1, [], [], -1
    step = max(1, BLOCK - window + 1)
    for at in range(0, max(1, grams - window + 1), step):
        h = gram_hashes(points[at : at + step + window - 1 + k - 1], k)
        p = window_minima(h, window)
        new = p + at > last
        p = p[new]
        found_h.append(h[p].astype(np.uint32))
        found_p.append(p + at)
        last = found_p[-1][-1] if len(p) else last
    return np.concatenate(found_h), np.concatenate(found_p)


def encode(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Hashes and the gaps between positions, as text: what equal texts have in common, and only they."""
    gaps = np.diff(positions, prepend=0).astype("<u2")
    packed = np.empty((len(hashes), 6), np.uint8)
    packed[:, :4] = hashes.astype("<u4").view(np.uint8).reshape(-1, 4)
    packed[:, 4:] = gaps.view(np.uint8).reshape(-1, 2)
    return base64.b64encode(packed.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two sets of hashes; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def fingerprint(df: DataFrame, keep: list[str], text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` and, of each whole text, the selected hashes and their positions."""
    if not 1 <= window < 1 << 16 or k < 1:
        raise ValueError("k must be 1 at least, window between 1 and 65535")

    def make():
        def score(texts):
            found = [winnow(t, k, window) for t in texts]
            return {"hashes": [h.astype(np.int64) for h, _ in found], "positions": [p for _, p in found]}

        return score

    return common.map_text(df, keep, make, [("hashes", T.ArrayType(T.LongType())), ("positions", T.ArrayType(T.LongType()))], text)


def range_edges(rows: DataFrame, columns: list[str], ranges: int) -> list[tuple[int, ...]]:
    """Bounds that cut the rows into about equal ranges; where one value fills several, the next column cuts it."""
    if ranges < 2:
        return []
    top, column = (1 << 63) - 1, F.col(columns[0])
    found = rows.select(column.cast("double").alias("x")).approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    out: list[tuple[int, ...]] = []
    for x, times in sorted(Counter(found).items()):
        value, hot = min(int(x), top), times > 2 and columns[1:]
        if hot:  # the very value; a double is near it only
            value = rows.where(column.cast("double") == F.lit(x)).groupBy(column.alias("v")).count().orderBy(F.col("count").desc(), "v").first()["v"]
        out.append((value,))
        if hot:
            out += [(value, *edge) for edge in range_edges(rows.where(column == F.lit(value)), columns[1:], times + 1)]
    return out


def beside_next(docs: DataFrame) -> DataFrame:
    """All rows, in partitions that are ranges of descending doc_id and sorted so, each followed by the first row of the next range.

    Quantiles of the ids give the ranges, so the texts are exchanged once.
    Equal ids are ordered by a hash of the text, null ids come last; an id of
    very many rows, or none, is cut by that hash, and one row that is repeated
    as often by its place in ``docs``, which must then be the same whenever
    they are read.  Of each range only its first key reaches the driver.
    ``_lent`` marks the copies.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["_null", "_down", "_tie", "_place"]
    rows = docs.select("doc_id", "text").select(
        "*",
        F.col("doc_id").isNull().cast("int").alias("_null"),
        F.coalesce(-1 - F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("_down"),
        F.coalesce(F.xxhash64("text"), F.lit(0).cast("bigint")).alias("_tie"),
        F.xxhash64(F.monotonically_increasing_id()).alias("_place"),
    )
    edges = range_edges(rows, key[1:], partitions)
    if all(len(e) < 3 for e in edges):
        rows = rows.withColumn("_place", F.lit(0).cast("bigint"))
    rows = rows.withColumn("_range", _range(key[1:], edges))
    heads = rows.groupBy("_range").agg(F.min(F.struct(*key)).alias("h")).orderBy("_range").collect()
    before = {heads[i]["_range"]: heads[i - 1]["_range"] for i in range(len(heads))}
    lend = spark.createDataFrame([(*h["h"], before[h["_range"]]) for h in heads], "_null int, _down long, _tie long, _place long, _to int")
    rows = rows.join(F.broadcast(lend), key, "left")
    places = F.array(F.struct(F.lit(False).alias("lent"), F.col("_range").alias("at")), F.struct(F.lit(True).alias("lent"), F.col("_to").alias("at")))
    rows = rows.select("doc_id", "text", *key, F.explode(F.filter(places, lambda x: x["at"].isNotNull())).alias("_x"))
    rows = rows.select("doc_id", "text", *key, F.col("_x.lent").alias("_lent"), F.col("_x.at").alias("_range"))
    return rows.repartitionById(len(edges) + 1, F.col("_range")).sortWithinPartitions("_lent", *key).select("doc_id", "text", "_lent")


def _range(key: list[str], edges: list[tuple[int, ...]]):
    """How many of the ascending edges are at most the key, as a balanced tree of comparisons."""

    def below(edge: tuple[int, ...]):
        test = F.lit(False)
        for column, value in reversed(list(zip(key, edge))):
            test = (F.col(column) < F.lit(value)) | ((F.col(column) == F.lit(value)) & test)
        return test

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(edges[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(edges))


OUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def compare_with_edits(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint beside those of an edited text and of the next document.

    The edited text has the last half (rounded down) of the document's code
    points replaced by as many of the next document's first ones, or all; next
    is by descending doc_id, after the last the first.  One document alone is
    its own next.
    """

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in common.slices(batch, batch.column(1)):
                yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, out, size, held = to_arrow_schema(OUT), [], 0, None
        for doc_id, text, lent in rows(batches):
            text = text or ""
            prints = winnow(text, k, window)
            if held is not None:
                own_id, own, own_prints = held
                half = len(own) // 2
                edited = own[: len(own) - half] + text[:half]
                edited_prints = winnow(edited, k, window)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                near = likeness(own_prints[0], edited_prints[0]), likeness(own_prints[0], prints[0])
                out.append((own_id, len(own), digest, encode(*own_prints), encode(*edited_prints), *near))
                size += len(own)
                if size > common.SLICE_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            held = None if lent else (doc_id, text, prints)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return beside_next(docs).mapInArrow(run, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(common.documents(spark, sf_dir))
