"""A stored inverted index in segments, and the best documents of a query without reading all of its postings.

Under a folder lie ``postings``, a row for every token of every block of
documents: how many documents of the block have it, the largest frequency, the
least length, and the documents with the places; the rows of a file are sorted by
token, so that a query reads the pages of its tokens alone.  A segment,
one build's documents, is written once and never changed; it counts from when
its row of totals is there, and no longer once it is among the ``removed``.

``top`` first reads the numbers of the blocks, which bound what a document of
the block can score.  The blocks with the highest bounds are scored; of the
others only those follow whose bound reaches the k-th best score so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from timeloom.operators import search
from timeloom.session import ship

#: Documents of a block, and words at which it ends before (a longer document is a block).
BLOCK, BLOCK_WORDS = 2048, 1 << 21
#: Scores are compared to this.
STEP, SLACK = 1e-6, 1e-9


def first_block(docs: pa.RecordBatch, fields: int) -> int:
    """How many of the first documents are a block; 0 if more can join them."""
    held = sum(docs.column(f"f{f}").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for f in range(fields))
    n = int(np.searchsorted(np.cumsum(held), BLOCK_WORDS, side="right"))
    return min(BLOCK, max(1, n)) if n < docs.num_rows or docs.num_rows >= BLOCK else 0


def blocks(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of BLOCK, or of BLOCK_WORDS words at most; the last may have fewer."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pa.concat_batches([rest, batch])
        while rest.num_rows and (n := first_block(rest, fields)):
            yield rest.slice(0, n)
            rest = rest.slice(n)
    if rest is not None and rest.num_rows:
        yield rest


def blocks_of(schema: StructType, fields: int):
    """What turns Arrow batches of documents (doc, segment, the words of each field) into postings, block by block, each in the task that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        out, block = to_arrow_schema(schema), TaskContext.get().partitionId() << 33
        for docs in blocks(batches, fields):
            arrays = postings_of(docs, fields, block)
            yield pa.RecordBatch.from_arrays([arrays[f.name].cast(f.type) for f in out], schema=out)
            block += 1

    return run


def postings_of(docs: pa.RecordBatch, fields: int, block: int) -> dict[str, pa.Array]:
    """The postings of one block, as columns; the row of the empty token says how many documents a segment has there, and their length."""
    n, tokens, doc, field, position = docs.num_rows, [], [], [], []
    length = np.zeros(n, dtype=np.int64)
    for f in range(fields):
        column = docs.column(f"f{f}")
        size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        tokens.append(column.flatten())
        doc.append(np.repeat(np.arange(n), size))
        position.append(np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
        field.append(np.full(size.sum(), f))
        length += size
    doc, field, position = (np.concatenate(x) for x in (doc, field, position))
    words, segments = pa.concat_arrays(tokens).dictionary_encode(), docs.column("segment").dictionary_encode()
    segment, m = segments.indices.to_numpy(), max(1, len(words.dictionary))
    group = segment[doc] * m + words.indices.to_numpy()
    order = np.argsort(group * n + doc, kind="stable")
    group, doc, field, position = group[order], doc[order], field[order], position[order]
    # Where a token's documents begin, and where its rows do.
    posting = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.empty(0, dtype=np.int64)
    tf = np.diff(np.r_[posting, len(doc)])
    of, who = group[posting], doc[posting]
    row = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, dtype=np.int64)
    ends = np.r_[row, len(of)]
    places = np.r_[posting[row], len(doc)]
    held = np.bincount(segment, minlength=len(segments.dictionary))
    total = np.bincount(segment, weights=length, minlength=len(held)).astype(np.int64)
    k, none = len(held), np.zeros(len(held), dtype=np.int64)

    def lists(bounds: np.ndarray, values: pa.Array, last: pa.Array | None = None) -> pa.Array:
        """The values of each row, then ``last``, one a segment, or nothing."""
        tail = np.arange(1, k + 1) if last is not None else none
        return pa.ListArray.from_arrays(pa.array(np.r_[bounds, bounds[-1] + tail], pa.int32()), pa.concat_arrays([values, last]) if last is not None else values)

    some = len(row) > 0
    return {
        "token": pa.concat_arrays([words.dictionary.take(pa.array(of[row] % m)).cast(pa.string()), pa.array([""] * k, pa.string())]),
        "block": pa.array(np.full(len(row) + k, block)),
        "n": pa.array(np.r_[np.diff(ends), held]),
        "max_tf": pa.array(np.r_[np.maximum.reduceat(tf, row) if some else row, none]),
        "min_length": pa.array(np.r_[np.minimum.reduceat(length[who], row) if some else row, none]),
        "doc": lists(ends, docs.column("doc").take(pa.array(who))),
        "length": lists(ends, pa.array(length[who], pa.int64()), pa.array(total, pa.int64())),
        "tf": lists(ends, pa.array(tf, pa.int64())),
        "field": lists(places, pa.array(field, pa.int64())),
        "position": lists(places, pa.array(position, pa.int64())),
        "segment": segments.dictionary.take(pa.array(np.r_[of[row] // m, np.arange(k)])).cast(pa.string()),
    }


def postings_schema(key: str) -> str:
    """A row for each token of each block: its documents, and their places one after another, ``tf`` of each document."""
    return f"token string, block bigint, n bigint, max_tf int, min_length int, doc array<{key}>, length array<int>, tf array<int>, field array<int>, position array<int>, segment string"


def add(folder: str, docs: DataFrame, key: str, fields: list[str], segment: str = "segment") -> None:
    """Add documents; their column ``segment`` (text) says of which build each is.  A segment's documents must come in one call."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    words = docs.select(F.col(key).alias("doc"), F.col(segment).alias("segment"), *[search.words(F.col(f)).alias(f"f{n}") for n, f in enumerate(fields)])
    # Blocks are made where their documents are read, so flat postings are all that is exchanged; a token of all documents is as many rows as there are blocks.
    rows = words.mapInArrow(blocks_of(StructType.fromDDL(postings_schema(kind)), len(fields)), postings_schema(kind))
    rows.repartition("segment", "token", "block").sortWithinPartitions("segment", "token", "block").write.mode("append").partitionBy("segment").parquet(f"{folder}/postings")
    added = docs.sparkSession.read.schema(postings_schema(kind)).parquet(f"{folder}/postings").where("token = ''")
    added = added.join(docs.select(F.col(segment).alias("segment")).distinct(), "segment", "left_semi")
    totals = added.groupBy("segment").agg(F.sum("n").alias("n_docs"), F.sum(F.col("length")[0].cast("long")).alias("length"))
    totals.write.mode("append").parquet(f"{folder}/totals")


def remove(folder: str, segments: DataFrame) -> None:
    """Segments (their names are the first column) that no longer count, such as superseded builds."""
    segments.select(F.col(segments.columns[0]).cast("string").alias("segment")).write.mode("append").parquet(f"{folder}/removed")


@dataclass(frozen=True)
class Stored:
    postings: DataFrame
    totals: DataFrame
    fields: tuple[str, ...]

    def of(self, segments: DataFrame) -> Stored:
        """The same index over some segments only (their names are the first column)."""
        names = segments.select(F.col(segments.columns[0]).cast("string").alias("segment")).distinct()
        return replace(self, postings=self.postings.join(names, "segment", "left_semi"), totals=self.totals.join(names, "segment", "left_semi"))

    def found(self, any_of: Callable[[Column], Column]) -> DataFrame:
        """doc, length and the places of the tokens for which ``any_of`` holds."""
        return placed(self.postings.where(any_of(F.col("token"))))

    def size(self) -> DataFrame:
        return self.totals.agg(F.sum("n_docs").alias("n_docs"), (F.sum("length") / F.sum("n_docs")).alias("avg_length"))


def placed(postings: DataFrame) -> DataFrame:
    """doc, length and all places of some postings."""
    # The flat rows are exchanged, once; with a block's rows together, so are those of each document.
    rows = postings.select("segment", "block", "token", "doc", "length", "tf", "field", "position").repartition("segment", "block")
    ends = F.aggregate("tf", F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    rows = rows.withColumn("ends", ends)

    def of(i: Column) -> Column:
        here = lambda c: F.slice(c, F.get("ends", i) + 1, F.get("tf", i))
        at = F.zip_with(here("field"), here("position"), lambda f, p: F.struct(f.alias("field"), p.alias("position"), F.col("token").alias("token")))
        return F.struct(F.get("doc", i).alias("doc"), F.get("length", i).alias("length"), at.alias("p"))

    rows = rows.select("segment", "block", F.explode(F.transform("doc", lambda _, i: of(i))).alias("d")).select("segment", "block", "d.*")
    return rows.groupBy("segment", "block", "doc", "length").agg(F.flatten(F.collect_list("p")).cast(search.PLACED).alias("places")).drop("segment", "block")


def opened(spark: SparkSession, folder: str, fields: list[str], key: str = "bigint") -> Stored:
    """The index under a folder as it is now; ``key`` is the type of the documents' keys."""
    totals = spark.read.schema("segment string, n_docs bigint, length bigint").parquet(f"{folder}/totals")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/removed")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        totals = totals.join(spark.read.schema("segment string").parquet(path.toString()), "segment", "left_anti")
    return Stored(spark.read.schema(postings_schema(key)).parquet(f"{folder}/postings"), totals, tuple(fields)).of(totals)


def bounded(ix: Stored, asked: list[search.Match], tree, n_docs: int, avg_length: float, counts: dict[str, int]) -> tuple[DataFrame, Column]:
    """The blocks that can hold a match, with the most that a document there can score; and the rarities, as a sum over columns tf0, tf1 ..."""
    rows = ix.postings.where(search.any_word_of(asked)(F.col("token"))).select("segment", "block", "token", "max_tf", "min_length")
    columns = []
    for i, leaf in enumerate(asked):
        here = F.col("token") == leaf.parts[0]
        columns += [F.max(F.when(here, F.col("max_tf"))).alias(f"_tf{i}"), F.min(F.when(here, F.col("min_length"))).alias(f"_length{i}")]
    blocks = rows.groupBy("segment", "block").agg(*columns)
    # A word that must not be there may still be absent from some document of the block.
    there = {leaf: F.coalesce(F.col(f"_tf{i}"), F.lit(0)) for i, leaf in enumerate(asked)}
    bound = F.lit(0.0)
    for i, leaf in enumerate(asked):
        if leaf in search.leaves(tree):
            idf = search.rarity(F.lit(n_docs), F.lit(counts.get(leaf.parts[0], 0)))
            bound = bound + F.coalesce(idf * search.saturated(F.col(f"_tf{i}"), F.col(f"_length{i}"), F.lit(avg_length)), F.lit(0.0))
    return blocks.where(may_hold(tree, there)).select("segment", "block", bound.alias("bound")), bound


def may_hold(tree, there: dict[search.Leaf, Column]) -> Column:
    """Whether a query can hold somewhere in a block, from which words are there at all."""
    if isinstance(tree, search.Leaf):
        return there[tree] > 0
    a = may_hold(tree[1], there)
    return a if tree[0] == "not" else a & may_hold(tree[2], there) if tree[0] == "and" else a | may_hold(tree[2], there)


def top(ix: Stored, query: str, k: int) -> DataFrame:
    """(doc, score) of the ``k`` best documents; scores are compared to a millionth, ties go to the smaller key.

    Words, AND, OR and NOT are answered by bounds of blocks; queries with
    phrases, prefixes, NEAR or fields, whose rarity only the places tell, are
    scored whole.  A number for each word of the query and the k-th best score
    reach the driver.
    """
    tree = search.parse(query, ix.fields)
    asked = list(dict.fromkeys(search.every_leaf(tree)))
    order = [F.floor(F.col("score") / STEP + 0.5).desc(), F.col("doc")]
    if not all(isinstance(leaf, search.Match) and len(leaf.parts) == 1 and not leaf.prefix and leaf.fields is None for leaf in asked):
        return search.bm25(ix, query).orderBy(*order).limit(k)
    mine = ix.postings.where(search.any_word_of(asked)(F.col("token")))
    counts = dict(map(tuple, mine.groupBy("token").agg(F.sum("n")).collect()))
    size = ix.size().first()
    if not counts or not size["n_docs"]:
        return search.bm25(ix, query).limit(0)
    blocks, _ = bounded(ix, asked, tree, size["n_docs"], size["avg_length"], counts)

    def scored(some: DataFrame) -> DataFrame:
        rows, tf = search.frequencies(placed(mine.join(some.select("segment", "block"), ["segment", "block"], "left_semi")), asked)
        score = F.lit(0.0)
        for leaf in dict.fromkeys(search.leaves(tree)):
            score = score + search.rarity(F.lit(size["n_docs"]), F.lit(counts.get(leaf.parts[0], 0))) * search.saturated(tf[leaf], F.col("length"), F.lit(size["avg_length"]))
        return rows.where(search.holds(tree, tf)).select("doc", score.alias("score"))

    first = blocks.orderBy(F.col("bound").desc(), "segment", "block").limit(k)
    kth = scored(first).orderBy(*order).limit(k).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    least = kth["least"] - STEP - SLACK if kth["n"] == k else float("-inf")
    return scored(blocks.where(F.col("bound") >= least)).orderBy(*order).limit(k)
