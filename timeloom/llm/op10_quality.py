"""Quality by co-training two views.

One classifier sees a document's text: the shapes of its words, how they
repeat, and hashed words.  The other sees its record and nothing of the text:
source, language, their pair, and the length that the record states.  Both
start from the labelled sample; in every round each hands the unlabelled
documents of which it is surest to the other.  Each view is then calibrated on
a fold of labelled documents that no training used, to log-odds of at most what
a fold of that size can tell; a second calibration on both gives the views
their weights, and their weighted sum is the score of every document.

The labelled sample is about PER_CLASS documents of each class, the unlabelled
pool about POOL documents, both chosen by hash.

Corner cases: a null or empty text has all text features at 0 and is scored by
what remains; a null source, language or length is a value of its own, and so
is a column of the record that the table lacks; a very long text or word is
read whole; several labels of one document count as bad if one is, null labels
are left out; with one class alone, or no labels, every document scores 1;
documents of which a view is equally sure are handed over in the order of the
sample; a score of exactly KEEP is kept; repeated rows get equal results; an
empty table gives no rows.  Columns to carry that are called like one that
``score`` makes are for the caller to rename (``common.set_aside``).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

PER_CLASS, POOL = 2500, 4000
ROUNDS, SURE, HANDED = 3, 0.95, 500
#: Steps of a training from the start, and of one that goes on from the round before.
FIRST_STEPS, STEPS = 200, 60
KEEP = 0.5
#: Hashed shapes, hashed words and plain numbers of the text view; hashed values of the record's.
SHAPES, WORDS, PLAIN = 512, 4096, 8
VALUES = 1024
TEXT_SIZE, RECORD_SIZE = SHAPES + WORDS + PLAIN + 1, VALUES + 1
#: The record of a document.
RECORD = ["source", "lang", "n_chars"]
_RUNS = re.compile(r"(.)\1+", re.S)


def token_features(token: str) -> tuple[int, int]:
    """Shape feature and word feature."""
    shape = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "L" if c.isalpha() else c for c in token)
    shape = _RUNS.sub(r"\1", shape)
    return zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPES, SHAPES + zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % WORDS


def text_features(tokens: common.Kept, text: str) -> dict[int, float]:
    words = text.split()
    out: dict[int, float] = {TEXT_SIZE - 1: 1.0}
    n = len(words)
    if not n:
        return out
    times = Counter(words)
    shapes: dict[int, int] = {}
    hashed: dict[int, int] = {}
    for word, k in times.items():
        s, w = tokens[word]
        shapes[s] = shapes.get(s, 0) + k
        hashed[w] = hashed.get(w, 0) + k
    for s, k in shapes.items():
        out[s] = (k / n) ** 0.5
    for w, k in hashed.items():
        out[w] = 0.3 * k / n
    base = SHAPES + WORDS
    letters = sum(map(len, words))
    out |= {
        base: len(times) / n,
        base + 1: max(times.values()) / n,
        base + 2: sum(map(str.__eq__, words, words[1:])) / n,
        base + 3: letters / n / 10,
        base + 4: (1 - len(times) / n) * min(1.0, 100 / n),
        base + 5: 1 / n,
    }
    return out


def record_features(source: str | None, lang: str | None, n_chars: int | None) -> dict[int, float]:
    length = None if n_chars is None else int(2 * np.log2(max(n_chars, 0) + 1))  # half a power of two
    names = f"source {source}", f"lang {lang}", f"both {source} {lang}", f"length {length}"
    return {RECORD_SIZE - 1: 1.0} | {zlib.crc32(x.encode("utf-8", "surrogatepass")) % VALUES: 1.0 for x in names}


@dataclass
class Rows:
    """Sparse rows."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, rows: list[dict[int, float]]) -> Rows:
        size = [len(r) for r in rows]
        return cls(np.cumsum([0, *size]), np.array([c for r in rows for c in r], np.int32), np.array([v for r in rows for v in r.values()], np.float32))

    def some(self, which: np.ndarray) -> Rows:
        size = np.diff(self.start)
        inside = np.repeat(which, size)
        return Rows(np.r_[0, np.cumsum(size[which])], self.column[inside], self.value[inside])

    def times(self, w: np.ndarray) -> np.ndarray:
        if len(self.start) == 1:
            return np.zeros(0)
        return np.add.reduceat(self.value * w[self.column], self.start[:-1])

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, weights=self.value * np.repeat(r, np.diff(self.start)), minlength=size)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: Rows, y: np.ndarray, weight: np.ndarray, size: int, start: np.ndarray | None = None, ridge: float = 1e-4, steps: int = 200, flat: float = 1e-5) -> np.ndarray:
    """Logistic regression from ``start`` on; rows with weight 0 take no part, and it ends where the gradient is flat."""
    rows, y, weight = rows.some(weight > 0), y[weight > 0], weight[weight > 0]
    w, m, v = np.zeros(size) if start is None else start, np.zeros(size), np.zeros(size)
    total = max(weight.sum(), 1.0)
    for t in range(1, steps + 1):
        g = rows.back(weight * (y - sigmoid(rows.times(w))), size) / total - ridge * w
        if np.abs(g).max() < flat:
            break
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-negative slopes and an offset, by Newton's method, that turn columns of raw scores into log-odds."""
    x = np.column_stack([z, np.ones(len(z))])
    prior = np.array([1.0] * (x.shape[1] - 1) + [0.0])
    a = prior.copy()
    for _ in range(100):
        p = sigmoid(x @ a)
        g = x.T @ (weight * (y - p)) - 0.5 * (a - prior)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(a))
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a = a + step
        a[:-1] = np.maximum(a[:-1], 0.0)
        if np.abs(step).max() < 1e-8:
            break
    return a


@dataclass
class Model:
    text: np.ndarray
    record: np.ndarray
    of_text: np.ndarray
    of_record: np.ndarray
    of_both: np.ndarray
    most: float

    def odds(self, view: np.ndarray, z):
        return np.clip(view[0] * z + view[1], -self.most, self.most)

    def score(self, tokens: common.Kept, text: str, *record) -> tuple[float, float, float]:
        """Of the document together, of its text, of its record."""
        l1 = self.odds(self.of_text, sum(self.text[c] * v for c, v in text_features(tokens, text).items()))
        l2 = self.odds(self.of_record, sum(self.record[c] * v for c, v in record_features(*record).items()))
        both = self.of_both[0] * l1 + self.of_both[1] * l2 + self.of_both[2]
        return float(sigmoid(both)), float(sigmoid(l1)), float(sigmoid(l2))


def cotrain(text: Rows, record: Rows, y: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS, sure: float = SURE, handed: int = HANDED) -> Model:
    """y: 1 good, 0 bad, -1 unlabelled; labelled rows with fold 0 only calibrate."""
    labelled, spare = (y >= 0) & (fold != 0), (y >= 0) & (fold == 0)
    share = y[labelled].mean()
    views = {"text": (text, TEXT_SIZE), "record": (record, RECORD_SIZE)}
    taught = {v: np.full(len(y), -1) for v in views}
    weights = {}
    for turn in range(rounds + 1):
        p = {}
        for v, (rows, size) in views.items():
            target = np.where(labelled, y, taught[v])
            known = labelled | (taught[v] >= 0)
            even = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) * np.where(labelled, 1.0, 0.5)
            weights[v] = train(rows, target, np.where(known, even, 0.0), size, weights.get(v), steps=STEPS if turn else FIRST_STEPS)
            p[v] = sigmoid(rows.times(weights[v]))
        if turn == rounds:
            break
        for v, other in (("text", "record"), ("record", "text")):
            pool = y < 0
            for value, sureness in ((1, p[v]), (0, 1 - p[v])):
                best = np.flatnonzero(pool & (sureness >= sure) & (taught[other] < 0))
                best = best[np.argsort(-sureness[best], kind="stable")[:handed]]
                taught[other][best] = value
    if not spare.any() or len(set(y[spare])) < 2:
        spare = labelled
    even = np.where(y[spare] == 1, 0.5 / y[spare].mean(), 0.5 / (1 - y[spare].mean()))
    z = {v: rows.times(weights[v])[spare] for v, (rows, _) in views.items()}
    cal = {v: calibrate(z[v][:, None], y[spare], even) for v in views}
    model = Model(weights["text"], weights["record"], cal["text"], cal["record"], np.zeros(3), float(np.log(spare.sum() + 1)))
    views_odds = np.column_stack([model.odds(cal[v], z[v]) for v in ("text", "record")])
    model.of_both = calibrate(views_odds, y[spare], even)
    return model


def record_of(docs: DataFrame) -> list[Column]:
    """The record's columns; null where the table lacks one."""
    types = {"n_chars": "long"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(types.get(c, "string")).alias(c) for c in RECORD]


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, pool: int = POOL) -> Model | None:
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min(label) > 0).cast("int").alias("_label"))
    sample = common.bounded_sample(known, "_label", per_class, "doc_id")
    rows = docs.select("doc_id", "text", *record_of(docs))
    n = max(1, rows.count())
    rows = rows.join(F.broadcast(sample), "doc_id", "left")
    rows = rows.where(F.col("_label").isNotNull() | (common.unit_hash(F.col("doc_id"), F.lit("pool")) * n < F.lit(float(pool))))
    rows = rows.select("text", *RECORD, F.coalesce("_label", F.lit(-1)).alias("y"), F.floor(common.unit_hash(F.col("doc_id"), F.lit("fold")) * 4).cast("int").alias("fold"))
    schema = "tc array<int>, tv array<float>, rc array<int>, rv array<float>, y int, fold int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = common.Kept(token_features)
        for batch in batches:
            for part in common.slices(batch, batch.column(0)):
                text, *record = (part.column(i).to_pylist() for i in range(4))
                t = [text_features(tokens, x or "") for x in text]
                r = [record_features(*x) for x in zip(*record)]
                made = [pa.array([list(x) for x in t], pa.list_(pa.int32())), pa.array([list(x.values()) for x in t], pa.list_(pa.float32()))]
                made += [pa.array([list(x) for x in r], pa.list_(pa.int32())), pa.array([list(x.values()) for x in r], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays([*made, part.column(4), part.column(5)], names=["tc", "tv", "rc", "rv", "y", "fold"])

    table = rows.mapInArrow(run, schema).toArrow()
    y, fold = table["y"].to_numpy(), table["fold"].to_numpy()
    if len(set(y[y >= 0])) < 2 or len(set(y[(y >= 0) & (fold != 0)])) < 2:
        return None

    def rows_of(c: str, v: str) -> Rows:
        columns, values = table[c].combine_chunks(), table[v].combine_chunks()
        return Rows(np.asarray(columns.offsets), np.asarray(columns.values), np.asarray(values.values))

    return cotrain(rows_of("tc", "tv"), rows_of("rc", "rv"), y, fold)


def score(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep`` with score, text_score and record_score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = ["score", "text_score", "record_score"]
    source = docs.select(*keep, F.col("text").alias("_text"), *(x.alias(f"_{n}") for n, x in zip(RECORD, record_of(docs))))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in made])
    at = range(len(keep), len(keep) + 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema, m, tokens = to_arrow_schema(schema), shared.value, common.Kept(token_features)
        for batch in batches:
            for part in common.slices(batch, batch.column(at[0])):
                found = [m.score(tokens, t or "", *x) if m else (1.0, 1.0, 1.0) for t, *x in zip(*(part.column(i).to_pylist() for i in at))]
                arrays = [part.column(i).cast(out_schema.field(i).type) for i in range(len(keep))]
                arrays += [pa.array([f[i] for f in found], pa.float64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)
        common.give_back()

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    rows = score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "doc_id")
    return rows.select("doc_id", "score", "text_score", "record_score", (F.col("score") >= KEEP).cast("int").alias("keep"))
