"""Language identification of whole, possibly mixed texts.

Letters make words; a word's script, from ranges of code points, narrows the
candidate languages to those that were seen to use it; the word's letter
trigrams score each candidate; Viterbi with a penalty for every switch labels
the words, and runs of equal labels are the spans.  A document's language is
the one that labels most of its letters, and its score the share of those
letters times the posterior of the language over the whole text.

The model is counts of hashed trigrams by language, learnt from about
PER_LANGUAGE documents of each language, which are not held out.

Corner cases: a null text, and one without letters (marks alone are none), is
``und`` with score 0; words in a script that no learnt language uses leave the
choice to the rest; a very long text is labelled whole, with memory in
proportion to it; if nothing could be learnt every text is ``und``; ties go to
the language whose name sorts first; repeated rows get equal results; an empty
table gives no rows.  ``identify`` reads text alone and carries the columns it
is told to; one called like a column it makes is for the caller to rename
(``common.set_aside``).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

PER_LANGUAGE = 3000
#: Hashed trigrams; cost of a switch in nats; words labelled in one pass of the vectorised Viterbi.
BUCKETS, SWITCH, PASS_WORDS = 1 << 16, 8.0, 256
#: A script is a language's if it has this share of the letters learnt for it.
SCRIPT_SHARE = 0.01
UND = "und"

# Blocks of Unicode by script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


@cache
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its lower-case form (0 outside words), whether it is a letter, its script."""
    low = np.zeros(sys.maxunicode + 1, np.uint32)
    letter = np.zeros(sys.maxunicode + 1, bool)
    script = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(c := chr(i))[0]
        if kind in "LM":
            letter[i] = kind == "L"
            low[i] = ord(x) if len(x := c.lower()) == 1 else i
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return low, letter, script


@dataclass
class Words:
    """The words of some texts: hashed trigrams, where each word's begin, length, script, text number, place in the text; and the letters of each text."""

    grams: np.ndarray
    at: np.ndarray
    length: np.ndarray
    script: np.ndarray
    text: np.ndarray
    offset: np.ndarray
    letters: np.ndarray


def words_of(texts: list[str]) -> Words:
    """Words of the joined texts and the hashed trigram around each of their letters."""
    low, letter, scripts = characters()
    points = common.code_points("\n" + "\n".join(texts) + "\n")
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    c = low[points]
    inside = c > 0
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    first, last = edge[::2] + 1, edge[1::2] + 1
    h = (c[:-2] * np.uint32(0x9E3779B1) + c[1:-1]) * np.uint32(0x85EBCA6B) + c[2:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)
    grams = (h >> np.uint32(16))[inside[1:-1]]
    length = last - first
    text = np.searchsorted(starts, first, side="right") - 1
    letters = np.diff(np.r_[0, np.cumsum(letter[points])][starts])
    return Words(grams, np.cumsum(length) - length, length, scripts[points[first]], text, first - starts[text], letters)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # language, trigram
    uses: np.ndarray  # script, language

    def scores(self, w: Words) -> np.ndarray:
        """word, language: log probability of the word's trigrams; -inf where the script rules a language out."""
        out = np.empty((len(w.at), len(self.languages)), np.float32)
        for i in range(len(self.languages)):
            out[:, i] = np.add.reduceat(self.log_p[i][w.grams], w.at)
        uses = self.uses[w.script]
        none = ~uses.any(1)
        out[none] = 0
        out[~uses & ~none[:, None]] = -1e6
        return out


def best_path(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The label of every word by Viterbi, text by text.

    Texts are cut into passes of equal length.  Every pass is solved for each
    label that could stand before it, all passes together; then the passes of
    a text are chained and labels traced back.
    """
    n, k = scores.shape
    begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[begin, n])
    passes = -(-count // PASS_WORDS)
    pass_text = np.repeat(np.arange(len(begin)), passes)
    pass_no = np.arange(len(pass_text)) - np.repeat(np.cumsum(passes) - passes, passes)
    pass_at = begin[pass_text] + pass_no * PASS_WORDS
    size = np.minimum(PASS_WORDS, count[pass_text] - pass_no * PASS_WORDS)
    steps = int(size.max())
    cost = np.where(np.eye(k, dtype=bool), 0.0, -switch).astype(np.float32)
    reach = np.broadcast_to(cost, (len(size), k, k)).copy()
    stay = np.ones((steps, len(size), k, k), bool)
    origin = np.zeros((steps, len(size), k), np.int32)
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(steps), side="left")
    reach, at = reach[order], pass_at[order]
    for t in range(steps):
        live = slice(0, alive[t])
        now = reach[live]
        if t:
            origin[t, live] = now.argmax(2)
            over = now.max(2, keepdims=True) - np.float32(switch)
            stay[t, live] = now >= over
            now = np.maximum(now, over)
        reach[live] = now + scores[at[live] + t][:, None, :]
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    start, end = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
    before: list[np.ndarray] = []
    for p in range(len(size)):
        gain = reach[where[p]].astype(np.float64)
        value = gain if pass_no[p] == 0 else total[:, None] + gain
        before.append(value.argmax(0))
        total = value.max(0)
        if p + 1 == len(size) or pass_no[p + 1] == 0:
            label, q = int(total.argmax()), p
            while True:
                end[q], start[q] = label, before[q][label]
                label = int(start[q])
                if pass_no[q] == 0:
                    break
                q -= 1
    start, label = start[order], end[order]
    labels = np.empty(n, np.int64)
    for t in range(steps - 1, -1, -1):
        live = np.arange(alive[t])
        labels[at[live] + t] = label[live]
        if t:
            moved = ~stay[t, live, start[live], label[live]]
            label[live] = np.where(moved, origin[t, live, start[live]], label[live])
    return labels


def identify_texts(model: Model, texts: list[str], spans: bool = False) -> dict[str, list]:
    """lang_pred and score of each text, and its spans (start, end, language) if asked for."""
    out = {"lang_pred": [UND] * len(texts), "score": [0.0] * len(texts), "spans": [[] for _ in texts]}
    w = words_of(texts)
    k = len(model.languages)
    if not k or not len(w.at):
        return out
    scores = model.scores(w)
    labels = best_path(scores, w.text)
    letters = np.bincount(w.text * k + labels, weights=w.length, minlength=len(texts) * k).reshape(-1, k)
    whole = np.stack([np.bincount(w.text, weights=scores[:, i], minlength=len(texts)) for i in range(k)], 1)
    chosen = letters.argmax(1)
    rows = np.arange(len(texts))
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        posterior = 1 / np.exp(np.minimum(whole - whole[rows, chosen][:, None], 700)).sum(1)
        share = letters[rows, chosen] / letters.sum(1)
    for i in np.flatnonzero((w.letters > 0) & (letters.sum(1) > 0)):  # marks alone are no text
        out["lang_pred"][i] = model.languages[chosen[i]]
        # Inside mixed texts the whole's posterior says little; the share alone counts there.
        out["score"][i] = float(share[i] * (posterior[i] if share[i] == 1 else 1.0))
    if spans:
        cut = np.flatnonzero(np.r_[True, (w.text[1:] != w.text[:-1]) | (labels[1:] != labels[:-1])])
        for a, b in zip(cut, np.r_[cut[1:], len(labels)] - 1):
            out["spans"][w.text[a]].append((int(w.offset[a]), int(w.offset[b] + w.length[b]), model.languages[labels[a]]))
    return out


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Trigram statistics by language from a bounded sample of the documents that aren't held out."""
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~common.held_out(F.col("doc_id")))
    sample = common.bounded_sample(known, "lang", per_language, "doc_id", "text").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in common.slices(batch, batch.column(1)):
                texts = part.column(1).to_pylist()
                names = part.column(0).to_pylist()
                for name in set(names):
                    w = words_of([t for t, x in zip(texts, names) if x == name])
                    tally = counts.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                    tally[:BUCKETS] += np.bincount(w.grams, minlength=BUCKETS)
                    tally[BUCKETS:] += np.bincount(w.script, weights=w.length, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        for name, tally in counts.items():
            cell = np.flatnonzero(tally)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cell), pa.string()), pa.array(cell), pa.array(tally[cell])], names=["lang", "cell", "n"])

    cells = sample.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for name, cell, n in cells.collect():
        found.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_NAMES)))[cell] = n
    languages = sorted(name for name, tally in found.items() if tally[:BUCKETS].any())
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    tally = np.stack([found[x] for x in languages])
    grams = tally[:, :BUCKETS]
    prior = (grams.sum(0) + 0.1) / (grams.sum() + 0.1 * BUCKETS)  # of all languages together
    smooth = 50.0
    log_p = np.log((grams + smooth * prior) / (grams.sum(1, keepdims=True) + smooth))
    use = tally[:, BUCKETS:]
    uses = use >= SCRIPT_SHARE * use.sum(1, keepdims=True)
    return Model(languages, log_p.astype(np.float32), (uses & (use > 0)).T)


def identify(docs: DataFrame, model: Model, *keep: str, spans: bool = False) -> DataFrame:
    """The columns ``keep`` with lang_pred, score and, if asked for, the labelled spans of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType())]
    if spans:
        fields.append(("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))))

    def make():
        def score(texts):
            out = identify_texts(shared.value, texts, spans)
            if spans:
                out["spans"] = [[{"start": a, "end": b, "lang": x} for a, b, x in s] for s in out["spans"]]
            return out

        return score

    return common.map_text(docs, list(keep), make, fields)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    rows = identify(docs, learn(docs), "doc_id")
    return rows.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
