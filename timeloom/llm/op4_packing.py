"""Packing documents into training windows, best fit decreasing.

A document's token ids are cut into full windows and a rest; full windows are
sequences by themselves, the rests are packed from long to short, each into the
open window with the least room that still holds it.  A segment tree over the
remaining capacities finds that window.  Each task packs its own share of the
table of pieces, which holds lengths and checksums only, TOGETHER pieces at a
time, so nothing is shuffled and memory is bounded.

Ids come from the tokenizer itself.  Texts of common Latin characters are split
as the tokenizer splits them, by arrays of character classes, and each distinct
word is encoded once and then found by a 64-bit hash; any other text, and one
of more than LONG_TEXT characters, goes through the tokenizer whole.  Both give
the same ids, up to a collision of the hashes of two words that a worker meets.

Corner cases: a null or empty text has only the end id; a length that is a
multiple of the window leaves no rest; a very long text is many full windows,
with memory in proportion to it; of equal lengths the first comes first;
repeated rows are packed as often as they come; an empty table gives no rows.
Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from timeloom.llm import common

WINDOW, END_ID = 4096, 2
#: Pieces packed together, which bounds a task's memory; what is lost is about one open window in so many pieces.
TOGETHER = 500_000
#: Words that a Python worker can keep, and their ids at most; both are let go together when the ids are full.
SLOTS, POOL_IDS = 1 << 21, 3_000_000
#: Characters split together.
SLICE = 500_000
#: Longer texts, and words, aren't split here.
LONG_TEXT, LONG_WORD = 4_000_000, 64

# The word tokenizer's classes among lower-case characters up to
# U+017F, and its contractions.  Words are runs of letters, single digits, runs
# of other signs; a sign run that is one apostrophe takes a contraction's letters.
LETTER = "a-zªµºß-öø-ſ"
NUMBER = "0-9²³¹¼-¾"
SPACE = " \t\n\r"
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
LAST = 0x17F
_B = 0x9E3779B97F4A7C15


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point up to LAST: its lower-case form, and its class; 0 space, 1 letter, 2 number, 3 sign, 9 unusual.

    A text without unusual characters is unchanged by the tokenizer's Unicode
    normal form, and has its lower case character by character.
    """
    low, kind = np.zeros(LAST + 2, np.uint32), np.full(LAST + 2, 9, np.uint8)
    for i in range(LAST + 1):
        c = chr(i)
        usual = c in SPACE or " " <= c <= "~" or i >= 0xA1
        if usual and len(c.lower()) == 1 and ord(c.lower()) <= LAST:
            low[i] = ord(c.lower())
            small = c.lower()
            kind[i] = 0 if c in SPACE else 1 if re.match(f"[{LETTER}]", small) else 2 if re.match(f"[{NUMBER}]", small) else 3
    return low, kind


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _B, np.uint64)), np.cumprod(np.full(n, pow(_B, -1, 1 << 64), np.uint64))


def split(points: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-case code points begin and end."""
    edge = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    first = np.r_[True, edge] & (kind > 0)
    last = np.r_[edge, True] & (kind > 0)
    mark = np.flatnonzero(first[:-1] & last[:-1] & (points[:-1] == ord("'")) & (kind[1:] == 1))
    at = lambda i: np.where(i < len(points), points[np.minimum(i, len(points) - 1)], 0)
    for tail in CONTRACTIONS:
        hit = np.logical_and.reduce([at(mark + 1 + k) == ord(c) for k, c in enumerate(tail)])
        here, mark = mark[hit], mark[~hit]
        last[here], first[here + 1] = False, False
        last[here + len(tail)] = True
        after = here + len(tail) + 1
        after = after[after < len(points)]
        first[after[kind[after] == 1]] = True
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from sums of prefixes."""
    power, inverse = powers(1 << max(19, len(points).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((points.astype(np.uint64) + np.uint64(7)) * power[: len(points)])]
        h = (sums[last] - sums[first]) * inverse[first]
        return np.maximum(common.mix64(h + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), np.uint64(1))


class Words:
    """Ids of texts, each distinct word encoded once and kept in a direct-mapped table."""

    #: What the tokenizer makes of a word before it looks for pieces.
    form = staticmethod(str.lower)

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.definition = definition
        # The same model for words that are normal and split already.
        self.by_word = Tokenizer.from_str(definition)
        self.by_word.normalizer = normalizers.Sequence([])
        self.by_word.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.by_word.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    @cached_property
    def tokenizer(self):
        """For texts that aren't split here; few workers meet any."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.definition)

    def forget(self) -> None:
        self.hash, self.start, self.size = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.empty(1 << 20, "<u4"), 0

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each has; the last id of a word is one that ends words."""
        ids = np.array(self.by_word.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words):
            return ids, np.diff(stops, prepend=0)
        each = [np.array(self.by_word.encode(w, add_special_tokens=False).ids, "<u4") for w in words]
        return np.concatenate(each), np.array([len(x) for x in each])

    def add(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; where they start."""
        at = self.used
        while at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def look_up(self, text: str, points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of each word are, and how many."""
        h = word_hashes(points, first, last)
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        short = last - first <= LONG_WORD
        known = (self.hash[slot] == h) & short
        start, size = self.start[slot], self.size[slot]
        miss = np.flatnonzero(~known & short)
        if len(miss):
            new, one, which = np.unique(h[miss], return_index=True, return_inverse=True)
            words = [self.form(text[a:b]) for a, b in zip(first[miss[one]].tolist(), last[miss[one]].tolist())]
            ids, n = self.encode_words(words)
            at = self.add(ids) + np.cumsum(n) - n
            place = slot[miss[one]]
            self.hash[place], self.start[place], self.size[place] = new, at, n
            start[miss], size[miss] = at[which], n[which]
        for i in np.flatnonzero(~short):
            ids, _ = self.encode_words([self.form(text[first[i] : last[i]])])
            start[i], size[i] = self.add(ids), len(ids)
        return start, size

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text."""
        if self.used > POOL_IDS:
            self.forget()
        low, kinds = characters()
        joined = "\n".join(t if len(t) <= LONG_TEXT else "" for t in texts) + "\n"
        begin = np.cumsum([0] + [1 + (len(t) if len(t) <= LONG_TEXT else 0) for t in texts])
        raw = np.minimum(common.code_points(joined), LAST + 1)
        kind = kinds[raw]
        odd = np.flatnonzero((kind == 9) | ((raw == ord("<")) & (np.r_[raw[1:], 0] == ord("|"))))
        whole = {*np.unique(np.searchsorted(begin, odd, side="right") - 1).tolist(), *(i for i, t in enumerate(texts) if len(t) > LONG_TEXT)}
        for i in whole:
            kind[begin[i] : begin[i + 1]] = 0
        points = low[raw]
        first, last = split(points, kind)
        start, size = self.look_up(joined, points, first, last)
        ends = np.cumsum(size, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.pool[np.repeat(start - (ends - size), size) + np.arange(total)]
        cuts = np.r_[0, ends][np.searchsorted(first, begin)]
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4") if i in whole else flat[cuts[i] : cuts[i + 1]] for i, t in enumerate(texts)]


PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
PACKED = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


@lru_cache(1)
def worker_words(definition: str) -> Words:
    return Words(definition)


def cut(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int | None = END_ID) -> DataFrame:
    """The pieces of every document: full windows and one rest.  ``tokenizer`` is the path of its file on the driver."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(definition.value)
        end = np.array([] if end_id is None else [end_id], "<u4")
        for batch in batches:
            for part in common.slices(batch, batch.column(1), SLICE):
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), words.encode(texts)):
                    ids = np.concatenate([ids, end])
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                columns = zip(*rows) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECES.names)
        common.give_back()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Rooms:
    """Open windows by remaining capacity, under a segment tree of how many there are."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, which: int) -> None:
        self.open[room].append(which)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The open window with the least room of at least ``size``, and that room."""
        count, i = self.count, size + self.leaves
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i *= 2
                if not count[i]:
                    i += 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return self.open[room].pop(), room


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, taken from long to short."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms, used = Rooms(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        found = rooms.take(size)
        if found is None:
            found, used = (used, window), used + 1
        which, room = found
        sequence[i], offset[i] = which, window - room
        if room > size:
            rooms.add(room - size, which)
    return sequence, offset


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Give every piece its sequence and offset.

    ``pieces`` must be a stored table, so that a task that runs again sees the
    same share.  A task packs TOGETHER pieces at a time.  A sequence's id is
    the share's number times 2^40 and a count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, held, rows = TaskContext.get().partitionId() << 40, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used
            table = pa.Table.from_batches(held, schema=pa.schema([(n, pa.int64()) for n in PIECES.names]))
            sequence, offset = best_fit(table["length"].to_numpy(), window)
            table = table.append_column("sequence_id", pa.array(sequence + used)).append_column("offset", pa.array(offset))
            used += int(sequence.max(initial=-1)) + 1
            yield from table.to_batches(max_chunksize=100_000)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, TOGETHER - rows)
                held.append(part)
                rows, batch = rows + part.num_rows, batch.slice(part.num_rows)
                if rows == TOGETHER:
                    yield from packed()
                    held, rows = [], 0
        if held:
            yield from packed()
        common.give_back()

    return pieces.mapInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int | None = END_ID) -> DataFrame:
    return pack(common.durable(cut(docs, tokenizer, window, end_id), "pieces"), window)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
