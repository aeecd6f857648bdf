"""Exact top-k by inner product, term at a time.

The rows hold sparse integer vectors; a term is a dimension.  Rows are stored
in blocks, a block as postings: for every term the rows that have it and their
weights.  Every block of queries meets every block of candidates in one job:
each term's postings of the queries are scattered, weighted by those of the
candidates, into dense arrays of scores; partition selection keeps the best of
each query, a task merges what it keeps over its blocks, and a window merges
the tasks' lists.  No row passes the driver, and a task holds one block of each
side, the scores of QUERY_GROUP queries, and HELD bytes of the best of queries:
of the blocks of queries that it has left behind their ids alone.

Spark pairs the blocks by a broadcast of one side only where that is below its
own limit of size, and by partitions of both otherwise.

Corner cases: vectors null, or with a null or non-finite component, take no
part; vectors of unequal length meet on the dimensions they share, and a very
long one is as many postings as it has components that aren't 0; a repeated row
is another candidate (only the query's own row is left out); of equal scores
the smaller id comes first; scores are 64-bit integers and wrap around beyond;
a null id is a candidate, last among ties, and never a query; a query without
candidates, like an empty table, gives no rows.  Only the id and the vector are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.llm import common

#: Rows, and components, of one block; queries scored together; bytes of the best of queries that a task holds.
BLOCK, BLOCK_TERMS, QUERY_GROUP, HELD = 2048, 1 << 21, 64, 64 << 20
PART = "query_uid long, query_id long, uid long, vec_id long, score long"
ARRAYS = ["uids", "ids", "known", "terms", "start", "rows", "weights"]


def integer_vectors(df: DataFrame, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """uid, vec_id and the components floor(scale * x) of the rows that take part."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = df.where(F.col(vector).isNotNull()).where(~bad)
    return rows.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("v"),
    )


@dataclass
class Postings:
    """Rows by term: ``rows[start[i]:start[i + 1]]`` have ``terms[i]``, in ascending order."""

    uids: np.ndarray
    ids: np.ndarray
    known: np.ndarray  # whether the row has an id
    terms: np.ndarray
    start: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, uids: np.ndarray, ids: np.ndarray, known: np.ndarray, vectors: list[np.ndarray]) -> Postings:
        row = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
        term = np.concatenate([np.arange(len(v)) for v in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate(vectors) if vectors else np.zeros(0, np.int64)
        row, term, weight = row[weight != 0], term[weight != 0], weight[weight != 0]
        order = np.argsort(term, kind="stable")
        terms, start = np.unique(term[order], return_index=True)
        return cls(uids, ids, known, terms, np.r_[start, len(term)], row[order], weight[order])

    def store(self) -> tuple[bytes, ...]:
        return tuple(getattr(self, n).astype(np.int64).tobytes() for n in ARRAYS)

    @classmethod
    def load(cls, stored: list[bytes]) -> Postings:
        return cls(*(np.frombuffer(x, np.int64) for x in stored))

    def groups(self, size: int) -> Iterator[tuple[int, Postings]]:
        """The same rows in groups of ``size``, each with the place of its first."""
        for at in range(0, len(self.uids), size):
            inside = (self.rows >= at) & (self.rows < at + size)
            term = np.repeat(np.arange(len(self.terms)), np.diff(self.start))[inside]
            some, start = np.unique(term, return_index=True)
            part = slice(at, at + size)
            yield at, Postings(self.uids[part], self.ids[part], self.known[part], self.terms[some], np.r_[start, len(term)], self.rows[inside] - at, self.weights[inside])


def blocks(vectors: DataFrame) -> DataFrame:
    """The rows as blocks of postings, one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            uids, ids, v = zip(*held)
            made = Postings.of(np.array(uids), np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]), list(v))
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made.store()], names=ARRAYS)

        for batch in batches:
            offsets, flat = np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).values)
            for i, (uid, vec_id) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                v = flat[offsets[i] : offsets[i + 1]]
                if held and (len(held) == BLOCK or size + len(v) > BLOCK_TERMS):
                    yield block()
                    held, size = [], 0
                held.append((uid, vec_id, v))
                size += len(v)
        if held:
            yield block()

    return vectors.select("uid", "vec_id", "v").mapInArrow(run, ", ".join(f"{n} binary" for n in ARRAYS))


def scatter_scores(queries: Postings, candidates: Postings) -> np.ndarray:
    """Scores of every query with every candidate, accumulated one term at a time."""
    n, m = len(queries.uids), len(candidates.uids)
    most = [int(np.abs(x.weights).max(initial=0)) for x in (queries, candidates)]
    narrow = most[0] * most[1] * min(len(queries.terms), len(candidates.terms)) < 1 << 31
    kind = np.int32 if narrow else np.int64
    scores, buffer = np.zeros((n, m), kind), np.empty((n, m), kind)
    q_weights, c_weights = queries.weights.astype(kind), candidates.weights.astype(kind)
    _, qs, cs = np.intersect1d(queries.terms, candidates.terms, assume_unique=True, return_indices=True)
    for q, c in zip(qs.tolist(), cs.tolist()):
        a, b = slice(queries.start[q], queries.start[q + 1]), slice(candidates.start[c], candidates.start[c + 1])
        asks, rows = queries.rows[a], candidates.rows[b]
        if 2 * len(rows) >= m:  # a term that most rows have: zeros cost less than places
            offered = np.zeros(m, kind)
            offered[rows] = c_weights[b]
            if 2 * len(asks) >= n:
                asked = np.zeros(n, kind)
                asked[asks] = q_weights[a]
                np.multiply(asked[:, None], offered, out=buffer)
                scores += buffer
            else:
                scores[asks] += q_weights[a, None] * offered
        else:
            scores[np.ix_(asks, rows)] += q_weights[a, None] * c_weights[b]
    return scores


#: What is kept of candidates: the query's place, score, id, whether there is one, and uid.
Found = tuple[np.ndarray, ...]


def first_k(found: Found, k: int) -> Found:
    """The k best of each query; of equal scores the smaller id, then the smaller uid."""
    query, score, vec_id, known, uid = found
    order = np.lexsort((uid, vec_id, known == 0, np.invert(score), query))  # ~score falls as score grows, without overflow
    query = query[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    order = order[place < k]
    return tuple(x[order] for x in found)


def select(scores: np.ndarray, queries: Postings, candidates: Postings, k: int) -> Found:
    """By partition, the k best candidates of each query, its own row left out."""
    m = scores.shape[1]
    if m > k + 1:
        limit = np.partition(scores, m - k - 1, axis=1)[:, m - k - 1]
        query, place = np.nonzero(scores >= limit[:, None])
    else:
        query, place = (x.ravel() for x in np.indices(scores.shape))
    other = queries.uids[query] != candidates.uids[place]
    query, place = query[other], place[other]
    return first_k((query, scores[query, place].astype(np.int64), candidates.ids[place], candidates.known[place], candidates.uids[place]), k)


def weight(kept: tuple[np.ndarray, np.ndarray, Found]) -> int:
    """The bytes of what a task keeps of one block of queries."""
    return sum(x.nbytes for x in (*kept[:2], *kept[2]))


def best_of_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of every query over the candidate blocks that a task pairs it with; more rows than that where it holds too many queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, Found]] = {}
        candidates, stored, size = None, None, 0

        def give() -> Iterator[pa.RecordBatch]:
            for uids, query_ids, (query, score, vec_id, known, uid) in held.values():
                ids = pa.array(vec_id, mask=known == 0)
                columns = [pa.array(uids[query]), pa.array(query_ids[query]), pa.array(uid), ids, pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_uid", "query_id", "uid", "vec_id", "score"])
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in batch.columns]
                asked, offered = row[: len(ARRAYS)], row[len(ARRAYS) :]
                if offered != stored:
                    candidates, stored = Postings.load(offered), offered
                queries = Postings.load(asked)
                found = []
                for at, group in queries.groups(QUERY_GROUP):
                    query, *rest = select(scatter_scores(group, candidates), group, candidates, k)
                    found.append((query + at, *rest))
                if (key := int(queries.uids[0])) in held:
                    found.append(held[key][-1])
                    size -= weight(held[key])
                # Copies, so that the block they were read from can go.
                held[key] = queries.uids.copy(), queries.ids.copy(), first_k(tuple(map(np.concatenate, zip(*found))), k)
                size += weight(held[key])
                if size > HELD:
                    yield from give()
                    size = 0
        yield from give()
        common.give_back()

    return pairs.mapInArrow(run, PART)


def top_k(df: DataFrame, is_query, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row for which ``is_query``, a condition on vec_id, holds."""
    vectors = common.durable(integer_vectors(df, scale, vec_id, vector), "vectors")
    asked = common.durable(blocks(vectors.where(is_query).where("vec_id IS NOT NULL")), "query-blocks")
    offered = common.durable(blocks(vectors), "candidate-blocks")
    pairs = asked.select(*(F.col(n).alias(f"q_{n}") for n in ARRAYS)).crossJoin(offered)
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("uid")]
    ranked = best_of_pairs(pairs, k).withColumn("rank", F.row_number().over(Window.partitionBy("query_uid").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS uid,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))), TRUE)
), terms AS (
  SELECT uid, vec_id, unnest(v) AS w, generate_subscripts(v, 1) AS term FROM v
), s AS (
  SELECT q.uid AS query_uid, q.vec_id AS query_id, c.uid, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.term = c.term AND q.uid <> c.uid
  WHERE q.vec_id % 50 = 0
  GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_uid ORDER BY score DESC, vec_id NULLS LAST, uid) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
