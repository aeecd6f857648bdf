"""N-gram Jaccard self-join with Bayesian pruning of candidates.

Texts are sets of word 5-grams; two are linked if their Jaccard similarity is
0.8 or more.  Texts with equal sets form a class, and only classes are
compared.  Thirty-two bands of five MinHash values find the candidates (a pair
at the threshold is missed with probability 3e-6); the smallest class of a
bucket is its pivot, and the classes that share a bucket with a pivot are its
star.  Stars are compared inside tasks, in tiles of bounded size, so that no
pair ever becomes a row.  A pair compares its MinHash values CHUNK at a time
and is dropped once the posterior probability (uniform prior) of a similarity
of at least the threshold is below TOLERANCE; the rest is verified exactly on
the whole sets.  A pair that meets in several stars counts in the smallest.
Links give each class its number of linked documents, and connected components
by alternating star contraction, on tables in the shared folder.

A star of many classes is cut into tiles, and every class goes to each of
them.  What goes there is not its text but the symmetric difference of its set
with the pivot's, which is short for near copies and says as much: A ^ B is
(A ^ P) ^ (B ^ P), and |A & B| = (|A| + |B| - |A ^ B|) / 2.

Words are runs of letters, digits and underscores, in lower case.  Grams, and
whole sets, are known by 64-bit and 128-bit hashes: results are exact up to a
collision of those.

Corner cases: a text of fewer than five words is one gram of all its words; a
null text, or one without words, has no grams, is linked to nothing and is its
own class; a very long text is a set like any other, read whole; repeated rows
are linked documents like any others; a class has the smallest id of its rows
that isn't null, and a null one only if all are; of ties (equal ids, equal
texts) ``first_of_each`` keeps one row; an empty table gives no rows.  Only
doc_id and text are read, so other columns may have any name; ``join`` returns
its own columns alone and ``first_of_each`` those of its input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

GRAM, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS = 32, 5
CHUNK, TOLERANCE = 16, 1e-6
#: Classes of one tile of a star, at least and at most, between which it is a TILE_SHARE of the star; grams of one tile.
TILE_CLASSES, TILE_MOST, TILE_SHARE, TILE_GRAMS = 200, 1000, 16, 400_000
WORD = re.compile(r"\w+")
_RANDOM = np.random.default_rng(20240917).integers(1, 1 << 63, (2, BANDS * BAND_ROWS), dtype=np.uint64)
_A, _B = _RANDOM[0] * np.uint64(2) + np.uint64(1), _RANDOM[1]


@lru_cache(1)
def worker_hashes() -> common.Kept:
    return common.Kept(xxhash.xxh3_64_intdigest)


def gram_set(text: str, gram: int = GRAM) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word n-grams."""
    words = WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(worker_hashes().__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - gram + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(gram, len(h)), np.uint64)
        for i in range(min(gram, len(h))):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
            out ^= out >> np.uint64(29)
    return np.unique(common.mix64(out))


def min_hashes(grams: np.ndarray) -> np.ndarray:
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(grams), 2048):
            low = np.minimum(low, (grams[at : at + 2048, None] * _A + _B).min(0))
    return low >> np.uint64(32)


def band_keys(low: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype=np.uint64)
        for column in low.reshape(BANDS, BAND_ROWS).T:
            key = common.mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


SIGNED = "doc_id long, th long, n long, k1 long, k2 long, bands array<long>, sig binary"


def signatures(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """Of every row: its id and text hash, the size and key of its set, its band keys and 16 bits of each MinHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SIGNED.split(", ")]
        for batch in batches:
            for part in common.slices(batch, batch.column(2)):
                n, k1, k2, bands, sig = [], [], [], [], []
                for text in part.column(2).to_pylist():
                    grams = gram_set(text or "", gram)
                    n.append(len(grams))
                    if not len(grams):
                        k1.append(None), k2.append(None), bands.append([]), sig.append(b"")
                        continue
                    key = xxhash.xxh3_128_digest(grams.tobytes())
                    k1.append(int.from_bytes(key[:8], "little", signed=True)), k2.append(int.from_bytes(key[8:], "little", signed=True))
                    low = min_hashes(grams)
                    bands.append(band_keys(low)), sig.append(low.astype("<u2").tobytes())
                made = [pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=names)
        common.give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_hash().alias("th"), "text").mapInArrow(run, SIGNED)


def least_matches(hashes: int, threshold: float, tolerance: float) -> int:
    """The fewest matches of so many MinHash values that leave P(similarity >= threshold) at tolerance or above."""
    n, total = hashes + 1, 0.0
    for m in range(hashes + 1):
        total += comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if total >= tolerance:
            return m
    return hashes


def candidate_pairs(sig: np.ndarray, sizes: np.ndarray, side: np.ndarray | None, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j (of different sides, if given) that survive the incremental comparison."""
    total = sig.shape[1]
    stops = list(range(CHUNK, total + 1, CHUNK))
    least = [least_matches(s, threshold, tolerance) for s in stops]
    found_i, found_j = [], []
    place = np.arange(len(sig))
    for at in range(0, len(sig), 128):
        block = slice(at, at + 128)
        same = np.zeros((len(sig[block]), len(sig)), np.int16)
        for c in range(CHUNK):
            same += sig[block, c, None] == sig[:, c]
        keep = (same >= least[0]) & (place[block, None] < place)
        if side is not None:
            keep &= side[block, None] != side
        i, j = (x.astype(np.int32) for x in np.nonzero(keep))
        m, i = same[i, j], i + np.int32(at)
        fits = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
        i, j, m = i[fits], j[fits], m[fits]
        for (a, b), need in zip(pairwise(stops), least[1:]):
            if not len(i):
                break
            m = m + np.concatenate([(sig[i[k : k + 65536], a:b] == sig[j[k : k + 65536], a:b]).sum(1, dtype=np.int16) for k in range(0, len(i), 65536)])
            ok = m >= need
            i, j, m = i[ok], j[ok], m[ok]
        found_i.append(i), found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def common_members(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many members the sets of each pair share, exactly.

    Members of one set alone drop out.  What remains is counted by products of
    0/1 matrices where many pairs meet in few members, by look-ups elsewhere.
    """
    if not len(i):
        return np.zeros(0, np.int64)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, member, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[member] > 1
    owner, member = owner[shared], (np.cumsum(times > 1) - 1)[member[shared]]
    width = int((times > 1).sum())
    start = np.searchsorted(owner, np.arange(len(sets) + 1))
    size = np.diff(start)
    small, large = np.where(size[i] <= size[j], i, j), np.where(size[i] <= size[j], j, i)
    used = np.unique(np.r_[i, j])
    if size[small].sum() * 150e-9 <= len(used) ** 2 * width * 1.2e-10 + 1e-4 * (1 + width / 2048):
        key = owner.astype(np.int64) * (width + 1) + member  # ascending in owner; members of one owner ascend too
        out = np.zeros(len(i), np.int64)
        ends = np.cumsum(size[small])
        at = 0
        while at < len(i):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + 2_000_000, side="right")))
            n = size[small[at:to]]
            pair = np.repeat(np.arange(to - at), n)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ask = large[at:to][pair].astype(np.int64) * (width + 1) + member[start[small[at:to]][pair] + offset]
            hit = np.searchsorted(key, ask)
            hit = key[np.minimum(hit, len(key) - 1)] == ask if len(key) else np.zeros(0, bool)
            out[at:to] = np.bincount(pair[hit], minlength=to - at)
            at = to
        return out
    row = np.full(len(sets), -1)
    row[used] = np.arange(len(used))
    inside = row[owner] >= 0
    owner, member = row[owner[inside]], member[inside]
    order = np.argsort(member, kind="stable")
    owner, member = owner[order], member[order]
    total = np.zeros((len(used), len(used)), np.float32)
    for low in range(0, width, 2048):
        a, b = np.searchsorted(member, [low, low + 2048])
        block = np.zeros((len(used), min(2048, width - low)), np.float32)
        block[owner[a:b], member[a:b] - low] = 1
        total += block @ block.T
    return total[row[i], row[j]].astype(np.int64)


def compare(cids: np.ndarray, rows: np.ndarray, sizes: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], stars: list[np.ndarray], star: int, side: np.ndarray | None, threshold: float, tolerance: float):
    """Of one tile: for each class with a link, the documents linked here and the smallest class it is connected to here.

    ``sizes`` are the sizes of the gram sets, ``sets`` the sets themselves or their differences with one and the same set.
    """
    i, j = candidate_pairs(sig, sizes, side, threshold, tolerance)
    if len(i):
        before = [s[s < star] for s in stars]
        first = common_members(before, i, j) == 0
        i, j = i[first], j[first]
    if len(i):
        own = np.array([len(s) for s in sets])
        apart = own[i] + own[j] - 2 * common_members(sets, i, j)
        both = (sizes[i] + sizes[j] - apart) // 2
        linked = both / (sizes[i] + sizes[j] - both) >= threshold
        i, j = i[linked], j[linked]
    if not len(i):
        return None
    links = np.bincount(np.r_[i, j], weights=rows[np.r_[j, i]], minlength=len(cids)).astype(np.int64)
    label = cids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            break
    some = np.flatnonzero(links)
    return cids[some], links[some], label[some]


def relative(members: DataFrame, gram: int) -> DataFrame:
    """Turn ``text`` into the bytes of its gram set, or of the difference with the set of ``pivot`` where that isn't null."""
    names = [c for c in members.columns if c not in ("text", "pivot")]
    schema = T.StructType([*(members.schema[c] for c in names), T.StructField("grams", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, base = None, None
        for batch in batches:
            for part in common.slices(batch, batch.column(batch.schema.get_field_index("text"))):
                columns = {c: part.column(i) for i, c in enumerate(part.schema.names)}
                out = []
                for now, text, pivot in zip(*(columns[c].to_pylist() for c in ("star", "text", "pivot"))):
                    own = gram_set(text or "", gram)
                    if pivot is not None:
                        if now != star:
                            star, base = now, gram_set(pivot, gram)
                        own = np.setxor1d(own, base, assume_unique=True)
                    out.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([*(columns[c] for c in names), pa.array(out, pa.binary())], names=[*names, "grams"])
        common.give_back()

    return members.mapInArrow(run, schema)


TILE = ["star", "a", "b", "tile", "cid", "rows", "n", "stars", "sig", "grams"]


def star_links(tiles: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Compare every tile; tiles are runs of rows with equal (star, a, b) in sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []

        def batch_of():
            columns = [np.concatenate(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cid", "links", "root"])

        def close(key, cids, rows, sizes, sig, sets, stars, tile):
            if len(cids) < 2:
                return
            side = None if key[1] == key[2] else np.array(tile)
            found = compare(np.array(cids), np.array(rows), np.array(sizes), np.array(sig), sets, stars, key[0], side, threshold, tolerance)
            if found:
                out.append(found)

        key, held = None, None
        for batch in batches:
            for part in common.slices(batch, batch.column(9)):
                for star, a, b, tile, cid, n_rows, n, stars, sig, grams in zip(*(c.to_pylist() for c in part.columns)):
                    if (star, a, b) != key:
                        if key:
                            close(key, *held)
                        key, held = (star, a, b), ([], [], [], [], [], [], [])
                    row = cid, n_rows, n, np.frombuffer(sig, "<u2"), np.frombuffer(grams, np.uint64), np.array(stars, np.int64), tile
                    for column, value in zip(held, row):
                        column.append(value)
                if sum(len(x[0]) for x in out) > 100_000:
                    yield batch_of()
                    out.clear()
        if key:
            close(key, *held)
        if out:
            yield batch_of()
        common.give_back()

    return tiles.select(*TILE).mapInArrow(run, "cid long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node connected to it.

    Large-star and small-star turns: each node hands its larger, then its
    smaller neighbours to its smallest one, until the edges are stars.
    """
    edges = common.durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = common.meet(both, low, ["u"], "v").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = common.meet(large, low, ["u"], "v")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        edges = common.durable(small, "edges")
        # Ids reach 2^63, so their hashes are added as decimals.
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def stars_of(classes: DataFrame) -> DataFrame:
    """(star, cid): the classes that share a bucket with a pivot, the pivot included."""
    banded = classes.select("cid", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("cid").alias("star"), F.max("cid").alias("_last")).where("star < _last").select("band", "star")
    return common.meet(banded, buckets, ["band"], "cid").select("star", "cid").distinct()


def tiled(member: DataFrame, classes: DataFrame, texts: DataFrame, gram: int, parts: int) -> DataFrame:
    """The rows of all tiles, dealt to ``parts`` partitions and sorted there."""
    sized = member.join(classes.select("cid", "n"), "cid")
    per_tile = F.least(F.greatest(F.count("*") / TILE_SHARE, F.lit(TILE_CLASSES)), F.lit(TILE_MOST))
    tiling = sized.groupBy("star").agg(F.ceil(F.greatest(F.count("*") / per_tile, F.sum("n") / TILE_GRAMS)).cast("int").alias("g"))
    large = common.durable(tiling.where("g > 1"), "large-stars")

    own = member.groupBy("cid").agg(F.array_sort(F.collect_set("star")).alias("stars"))
    reps = common.keyed(own.join(classes, "cid"), "rep_id").withColumnRenamed("rep_th", "th")
    reps = reps.join(texts, common.ROW).select("cid", "rows", "n", "stars", "sig", "text")
    narrow = common.meet(member, large, ["star"], "cid", "left")

    small = narrow.where("g IS NULL").select("star", "cid").join(reps, "cid").withColumn("pivot", F.lit(None).cast("string"))
    small = relative(small, gram).withColumns({"a": F.lit(0), "b": F.lit(0), "tile": F.lit(0), "place": F.pmod(F.xxhash64("star"), F.lit(parts))})

    pivots = large.join(reps.select(F.col("cid").alias("star"), F.col("text").alias("pivot")), "star").select("star", "pivot")
    big = common.meet(narrow.where("g IS NOT NULL").join(reps, "cid"), pivots, ["star"], "cid")
    big = relative(big, gram).withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("g")).cast("int"))
    big = big.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    big = big.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})
    # The tiles of one star lie in partitions one after another.
    turn = F.shiftright(F.col("b").cast("long") * (F.col("b") + 1), 1) + F.col("a")
    big = big.withColumn("place", F.pmod(F.pmod(F.xxhash64("star"), F.lit(parts)) + turn, F.lit(parts)))

    rows = small.select(*TILE, F.col("place").cast("int").alias("place")).unionByName(big.select(*TILE, F.col("place").cast("int").alias("place")))
    return rows.repartitionById(parts, "place").sortWithinPartitions("star", "a", "b", "cid")


def linked_rows(docs: DataFrame, gram: int = GRAM, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Of every row: doc_id, th (hash of the text), and, null unless it has a copy or a link, the first row of its class (rep) and n_links."""
    signed = common.durable(signatures(docs, gram), "signatures")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th"))
    classes = signed.where("n > 0").groupBy("k1", "k2").agg(F.count("*").alias("rows"), rep.alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = classes.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "rows", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"), "n", "bands", "sig")
    classes = common.durable(classes, "classes")

    member = common.durable(stars_of(classes), "stars")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = common.keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_hash().alias("th"), "text"))
    # Of all texts only those of representatives that share a bucket, a row that is repeated once.
    wanted = common.keyed(member.select("cid").distinct().join(classes, "cid"), "rep_id").withColumnRenamed("rep_th", "th").select(*common.ROW)
    texts = texts.join(wanted, common.ROW, "left_semi").groupBy(*common.ROW).agg(F.first("text").alias("text"))
    found = common.durable(star_links(tiled(member, classes, texts, gram, parts), threshold, tolerance), "links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    known = classes.select("cid", "k1", "k2", "rows", "rep_id", "rep_th").join(links, "cid", "left").where("rows > 1 OR links IS NOT NULL")
    known = known.join(roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    first = known.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull().alias("no_id"), F.col("rep_id").alias("doc_id"), F.col("rep_th").alias("th"))).alias("rep"))
    known = common.meet(known, first, ["root"], "cid").select("k1", "k2", "rep", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    known = common.durable(known, "classes-linked")

    plain = signed.select("doc_id", "th", "k1", "k2")
    some = common.meet(plain.where("k1 IS NOT NULL"), known, ["k1", "k2"], F.monotonically_increasing_id(), "left").select("doc_id", "th", "rep", "n_links")
    none = plain.where("k1 IS NULL").select("doc_id", "th", F.lit(None).cast(some.schema["rep"].dataType).alias("rep"), F.lit(None).cast("long").alias("n_links"))
    return some.unionByName(none)


def join(docs: DataFrame, gram: int = GRAM, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id (smallest id connected by links) and n_links of every row."""
    rows = linked_rows(docs, gram, threshold, tolerance)
    return rows.select("doc_id", F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def first_of_each(docs: DataFrame, **how) -> DataFrame:
    """The documents with the smallest id of each class, one row each."""
    found = common.durable(common.keyed(linked_rows(docs, **how)), "joined")
    away = F.col("rep").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("th") == F.col("rep.th")))
    columns, names = docs.columns, [common.fresh(docs, f"_{c}") for c in common.ROW]
    own = docs["doc_id"].cast("long")
    rows = docs.withColumns(dict(zip(names, [F.coalesce(own, F.lit(0)), own.isNull(), common.text_hash()])))
    out = found.where(away).select(*(F.col(c).alias(n) for c, n in zip(common.ROW, names))).distinct()
    rows = rows.join(out, names, "left_anti")
    if found.where(~away).groupBy(*common.ROW).count().where("count > 1").limit(1).count():  # rows that are repeated
        rows = rows.dropDuplicates(names)
    return rows.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.documents(spark, sf_dir))
