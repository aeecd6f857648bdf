"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score grows with the evidence
of its words above a base rate, p = (sigmoid(base + sum of weights) -
sigmoid(base)) / (1 - sigmoid(base)), 0 at least, so that a sentence without
evidence scores exactly 0; a document's is the noisy-or of its sentences',
1 - prod(1 - p).  Weights are learnt from document labels alone, through a
label model with a rate of clean documents marked toxic and of toxic ones not
marked.  Sentences with a score of LOCATE or more are the offending ones.

The features of a word are itself and its beginnings, so that other forms of a
word learnt from are known too.

The sample is about PER_CLASS labelled documents of each class, none held out.

Corner cases: a null or empty text scores 0; a very long text is read whole,
sentence by sentence, with memory in proportion to it; several labels of one
document count as toxic if one does, null labels are left out; with one class
alone, or no labels, every document scores 0; repeated rows get equal results
and teach once; a score of exactly THRESHOLD counts as toxic; an empty table
gives no rows.  ``score`` reads text alone and carries the columns it is told
to; one called score or sentences is for the caller to rename
(``common.set_aside``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

PER_CLASS = 3000
THRESHOLD, LOCATE = 0.7, 0.5
#: A word is a feature if it is in so many documents of the sample and so many standard errors more frequent in one class.
MIN_DOCS, MIN_Z = 3, 4.0
BASE = -4.0
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")


#: Lengths of the beginnings of words that are features.
BEGINNINGS = range(4, 9)


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)

    def evidence(self) -> common.Kept:
        """The weight of every word met, the sum of its features' weights."""
        weights = self.weights
        return common.Kept(lambda word: sum(weights.get(f, 0.0) for f in features(word)) if weights else 0.0)


def chance(z):
    """A sentence's score from base plus evidence."""
    floor = 1 / (1 + np.exp(-BASE))
    return np.maximum(0, (1 / (1 + np.exp(-np.clip(z, -30, 30))) - floor) / (1 - floor))


def score_text(evidence: Evidence, text: str) -> tuple[float, list[tuple[int, int, float]]]:
    """The document's score and its offending sentences (start, end, score)."""
    low = text.lower() if len(text.lower()) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if max(map(evidence.__getitem__, WORD.findall(low)), default=0.0) <= 0:
        return 0.0, []
    clean, found = 1.0, []
    for m in SENTENCE.finditer(low):
        found_here = sum(map(evidence.__getitem__, set(WORD.findall(m[0]))))
        if found_here > 0:
            p = float(chance(BASE + found_here))
            clean *= 1 - p
            if p >= LOCATE:
                found.append((m.start(), m.end(), p))
    return 1 - clean, found


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("_label"))
    known = known.where(~common.held_out(F.col("doc_id")))
    sample = common.bounded_sample(known, "_label", per_class, "doc_id")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id").select("text", "_label")
    # Copies of one document would make its chance words telling.
    texts = common.durable(texts.groupBy("text").agg(F.max("_label").alias("_label")), "toxic-sample")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tally.update((f, y) for f in {f for w in set(WORD.findall(text.lower())) for f in features(w)})
        keys = list(tally)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array([tally[x] for x in keys], pa.int64())], names=["w", "y", "n"])

    size = {y: n for y, n in texts.groupBy("_label").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        return Model()
    by_word = texts.mapInArrow(words, "w string, y int, n long").groupBy("w").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    rate = (F.col("a") + F.col("b") + 1) / F.lit(float(n0 + n1 + 2))
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(rate * (1 - rate) * (1 / n0 + 1 / n1))
    telling = by_word.withColumn("z", z).where((F.col("a") + F.col("b") >= MIN_DOCS) & (F.abs("z") >= MIN_Z))
    # As many as the bounded sample has; the order makes reruns agree.
    chosen = sorted((r["w"], r["a"], r["b"]) for r in telling.select("w", "a", "b").collect())
    if not chosen:
        return Model()
    index = {w: i for i, (w, _, _) in enumerate(chosen)}
    a, b = (np.array([f[i] for f in chosen], float) for i in (1, 2))
    # A word brings several features, so each starts with a part of its evidence.
    start = 0.5 * np.log((a + 0.5) / (n1 + 1) * (n0 + 1) / (b + 0.5))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                low = text.lower()
                sentences = ([index[f] for w in set(WORD.findall(s)) for f in features(w) if f in index] for s in SENTENCE.findall(low))
                out.append([s for s in sentences if s])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.list_(pa.int32()))), batch.column(1)], names=["bag", "y"])

    found = texts.mapInArrow(bags, "bag array<array<int>>, y int").collect()
    weights = fit([r["bag"] for r in found], np.array([r["y"] for r in found], float), start)
    return Model({w: float(x) for (w, _, _), x in zip(chosen, weights) if x})


def fit(bags: list[list[list[int]]], y: np.ndarray, start: np.ndarray, steps: int = 300, ridge: float = 0.01) -> np.ndarray:
    """Weights that maximise the likelihood of the labels under noisy-or and label noise."""
    sentences = [s for bag in bags for s in bag]
    doc = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
    words = np.array([i for s in sentences for i in s], np.int64)
    sentence = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    leak, miss = 0.05, 0.05
    floor = 1 / (1 + np.exp(-BASE))
    for t in range(1, steps + 1):
        z = BASE + np.bincount(sentence, weights=w[words], minlength=len(sentences))
        p = np.minimum(chance(z), 1 - 1e-6)
        clean = np.exp(np.bincount(doc, weights=np.log1p(-p), minlength=len(bags)))
        bag = 1 - clean
        if t % 25 == 0:  # the noise is what the labels are on documents the model is sure of
            low, high = y[bag < 0.05], y[bag > 0.95]
            leak = float(np.clip((low.sum() + 1) / (len(low) + 20), 1e-3, 0.4))
            miss = float(np.clip((len(high) - high.sum() + 1) / (len(high) + 20), 1e-3, 0.4))
        chance_y = np.clip(leak + (1 - leak - miss) * bag, 1e-9, 1 - 1e-9)
        to_bag = (y / chance_y - (1 - y) / (1 - chance_y)) * (1 - leak - miss)
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = np.where(s > floor, s * (1 - s) / (1 - floor), 0.0)
        to_z = to_bag[doc] * (clean[doc] / (1 - p)) * slope
        g = np.bincount(words, weights=to_z[sentence], minlength=len(w)) / len(bags) * 100 - ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return w


def score(docs: DataFrame, model: Model, *keep: str, sentences: bool = False) -> DataFrame:
    """The columns ``keep``, the score of each whole text and, if asked for, its offending sentences."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("score", T.DoubleType())]
    if sentences:
        fields.append(("sentences", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))))

    def make():
        evidence = shared.value.evidence()

        def run(texts):
            found = [score_text(evidence, t) for t in texts]
            return {"score": [s for s, _ in found], "sentences": [[{"start": a, "end": b, "score": p} for a, b, p in x] for _, x in found] if sentences else None}

        return run

    return common.map_text(docs, list(keep), make, fields)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    rows = score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "doc_id")
    return rows.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
