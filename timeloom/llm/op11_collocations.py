"""Phrases whose words keep company, mined from vertical positional inverted lists.

Texts are lower-cased in A-Z and cut into pieces at punctuation and line ends,
and pieces into words.  A block is some documents of one language that a task
reads together: a row of words, with a gap between pieces.  For every word, and
later for every phrase, a block has the ascending list of the positions where
it occurs; the length of the list is the frequency there, and the sum over
blocks the exact frequency.

A phrase of k + 1 words occurs where one of k words does and another begins one
position later, which ends in the adjacent word.  So a block merges the lists
of its frequent phrases with themselves, one position on, and gets the lists of
the longer ones.  It sends their lengths alone to be added up; what is
frequent over all blocks comes back under a number, and only those lists are
kept.  A phrase is known by the numbers of its two parts, never by a hash.

The keys are dealt into shares by a hash, as many as hold about TOGETHER counts
each.  A block sends one message to each share: its keys there in their order,
as compressed steps, with their counts.  A share adds them up and answers every
block with the places and the numbers of what is frequent.  Numbers begin with
the most frequent phrase of each share, so that they stay small.

No text and no position leaves its block but to meet what is frequent there; a
word of any frequency is one count a block, so no key is hot.  A level sends at
most one count for every word of the texts.  Nothing is broadcast by hand, and
but for one sum a level nothing reaches the driver.  Tables between the levels
are written to the shared folder, and lists removed when the next ones are there.

Scores: a candidate of frequency a, cut after its first k words into parts of
frequencies l and r, scores floor(2000000 a / (l + r)); the lowest cut counts,
of equals the first.  A candidate is dropped if a longer one around it has 80 %
of its frequency; as a longer one is never more frequent than what it holds,
those of one word more say that.

Corner cases: a null text is empty and a null language is ``und``; an empty
text, or one of punctuation alone, has no words; a very long text is a block of
its own, with memory in proportion to it; repeated rows count as often as they
come; equal scores are ordered by frequency, then by the bytes of the phrase;
a table without frequent phrases, or an empty one, gives no rows.  Only text
and lang are read, so other columns may have any name.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.llm import common

LEAST, LONGEST, TOP, COVER = 30, 4, 2000, 80
UND = "und"
#: Words, gaps included, and different words that a task takes into its blocks together.
BLOCK_WORDS, BLOCK_DISTINCT = 4_000_000, 1_000_000
#: Counts of blocks that are added up together: those of one share of the keys.  SHARES shares work side by side if they get FEW each.
TOGETHER, FEW = 1_000_000, 50_000
#: Shares in which the phrases of a language are ranked before the best are ranked together.
SHARES = 64

# What ends a piece; blanks and tabs part words.
STOPS = b".,;:!?\n\x0b\x0c\r"
#: Stands for the end of a piece; no byte of a text in UTF-8.
GAP = b"\xff"
FOLD = bytes.maketrans(string.ascii_uppercase.encode() + STOPS + b"\t", string.ascii_lowercase.encode() + GAP * len(STOPS) + b" ")

WORDS = "block long, lang string, total long, names array<string>, sizes array<int>, positions binary"
LISTS = "block long, total long, ids array<long>, sizes array<int>, positions binary"
MESSAGES = "share int, block long, lang string, n int, names binary, numbers binary"
#: Answers have a block, phrases an id; of words also language and word, of longer ones their parts.
ANSWERS = "block long, n int, numbers binary, id long, f long, lang string, word string, left long, right long"


def inverted(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From whose each position is: the owners, the sizes of their lists and the lists, one behind the other."""
    order = np.argsort(owner, kind="stable")
    owners, sizes = np.unique(owner, return_counts=True)
    return owners, sizes.astype(np.int32), order.astype(np.int32)


def squeezed(positions: np.ndarray) -> bytes:
    """Lists of positions as compressed bytes: steps from one to the next, low bytes first, then the next ones, and so on."""
    steps = np.diff(positions.astype(np.int32), prepend=np.int32(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, sizes: np.ndarray) -> np.ndarray:
    n = int(sizes.sum())
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).ravel(), dtype=np.int32)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as compressed bytes: the low bytes of a column first, then the next ones, and so on."""
    planes = [np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8).T for c in columns]
    return pa.compress(np.concatenate(planes).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 8 * n * columns, "zstd", asbytes=True), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=0)


def table_of(schema: str, **columns: object) -> pa.Table:
    """A table of ``schema``, null where no column is given."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    n = len(next(iter(columns.values())))
    return pa.table({name: pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields})


def word_lists(docs: DataFrame) -> DataFrame:
    """The blocks: by block its language, its words in their order and the list of positions of each."""
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(UND)).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, numbers = TaskContext.get().partitionId() << 32, count()
        known: dict[str, defaultdict] = {}
        held: dict[str, list[np.ndarray]] = {}
        total = 0

        def give() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                names = pa.array(list(known[lang])[1:], pa.binary())
                order = pc.sort_indices(names).to_numpy()
                place = np.zeros(len(names) + 1, np.int32)
                place[order + 1] = np.arange(1, len(names) + 1)
                _, sizes, positions = inverted(place[np.concatenate(parts)])
                gaps = int(sizes[0])
                if len(names):
                    row = [[task + next(numbers)], [lang], [int(sizes[1:].sum())], [names.take(pa.array(order)).cast(pa.string())], [sizes[1:]], [squeezed(positions[gaps:])]]
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["block", "lang", "total", "names", "sizes", "positions"])
            known.clear()
            held.clear()

        for batch in batches:
            for part in common.slices(batch, batch.column(1)):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    if lang not in known:
                        known[lang] = defaultdict(count(1).__next__, {GAP: 0})
                        held[lang] = []
                    words = (text.translate(FOLD).replace(GAP, b" \xff ") + b" \xff").split()
                    held[lang].append(np.fromiter(map(known[lang].__getitem__, words), np.int32, len(words)))
                    total += len(words)
                if total >= BLOCK_WORDS or sum(map(len, known.values())) >= BLOCK_DISTINCT:
                    yield from give()
                    total = 0
        yield from give()
        common.give_back()

    return rows.mapInArrow(run, WORDS)


def longer(sizes: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge a block's lists with themselves, one position on: left and right list of each pair that occurs, its size, its list."""
    none = np.zeros(0, np.int32)
    if not len(positions):
        return none, none, none, none
    whose = np.repeat(np.arange(len(sizes)), sizes)
    # The lists as one, by position: each position begins one phrase of this length at most.
    at = np.full(int(positions.max()) + 2, -1, np.int64)
    at[positions] = whose
    follows = at[positions + 1]
    both = follows >= 0
    places, code = positions[both], whose[both] * len(sizes) + follows[both]
    codes, length, order = inverted(code)
    return codes // len(sizes), codes % len(sizes), length, places[order]


def one_row(block: int, ids: np.ndarray, sizes: np.ndarray, positions: np.ndarray) -> pa.RecordBatch:
    row = [[block], [len(positions)], [ids], [sizes], [squeezed(positions)]]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["block", "total", "ids", "sizes", "positions"])


def lists_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The sizes and positions of a block's lists."""
    sizes = batch.column("sizes")[i].values.to_numpy(zero_copy_only=False)
    return sizes, unsqueezed(batch.column("positions")[i].as_py(), sizes)


def kept_lists(sizes: np.ndarray, positions: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and positions of the lists in ``slots``, in their order."""
    start = np.cumsum(sizes, dtype=np.int64) - sizes
    size = sizes[slots]
    return size, positions[np.repeat(start[slots] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def shares_for(rows: DataFrame) -> int:
    """Into how many shares the keys are dealt, from a row with the number of their counts."""
    counts = rows.first()[0] or 0
    return max(counts // TOGETHER, min(counts // FEW, SHARES)) + 1


def dealt(share: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each share that occurs and the slots dealt to it, ascending."""
    order = np.argsort(share, kind="stable")
    found, start = np.unique(share[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, start[1:]))


def words_of(blocks: DataFrame, shares: int) -> DataFrame:
    """How often each word occurs in each block: messages of blocks to the shares of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, lang = batch.column("block")[i].as_py(), batch.column("lang")[i].as_py()
                names = batch.column("names")[i].values.cast(pa.binary()).to_pylist()
                n = batch.column("sizes")[i].values.to_numpy(zero_copy_only=False)
                out = defaultdict(list)
                for share, slots in dealt(np.fromiter(map(crc32, names), np.int64, len(names)) % shares):
                    there = b" ".join([names[x] for x in slots.tolist()])
                    row = (share, block, lang, len(slots), len(there).to_bytes(8, "little") + pa.compress(there, "zstd", asbytes=True), packed(steps(slots), n[slots]))
                    for name, x in zip(("share", "block", "lang", "n", "names", "numbers"), row):
                        out[name].append(x)
                yield from table_of(MESSAGES, **out).to_batches()
        common.give_back()

    return blocks.select("block", "lang", "names", "sizes").mapInArrow(run, MESSAGES)


def pairs_of(lists: DataFrame, shares: int) -> DataFrame:
    """How often each pair of neighbouring phrases occurs in each block: messages of blocks to the shares of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, ids = batch.column("block")[i].as_py(), batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                left, right, n, _ = longer(*lists_of(batch, i))
                if not len(n):
                    continue
                left, right = ids[left], ids[right]
                out = defaultdict(list)
                for share, slots in dealt((common.mix64(common.mix64(left) + right.astype(np.uint64)) % np.uint64(shares)).astype(np.int64)):
                    row = (share, block, len(slots), packed(steps(slots), steps(left[slots]), right[slots], n[slots]))
                    for name, x in zip(("share", "block", "n", "numbers"), row):
                        out[name].append(x)
                yield from table_of(MESSAGES, **out).to_batches()
        common.give_back()

    return lists.select("block", "ids", "sizes", "positions").mapInArrow(run, MESSAGES)


def same_words(langs: list[str], names: list[bytes]) -> tuple[np.ndarray, list[str], list[str]]:
    """From the languages and packed words of messages: which word each row has, and the languages and words met."""
    group, met_langs, met = [], [], []
    for lang in dict.fromkeys(langs):
        there = [x for own, x in zip(langs, names) if own == lang]
        texts = [pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True).split(b" ") for x in there]
        coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
        group.append(coded.indices.to_numpy() + len(met))
        words = coded.dictionary.cast(pa.string()).to_pylist()
        met += words
        met_langs += [lang] * len(words)
    return np.concatenate(group), met_langs, met


def same_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pair each row has, and the two sides of the pairs met."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(order), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, left[new], right[new]


def frequent(messages: DataFrame, shares: int, least: int, name: str) -> DataFrame:
    """What is frequent over all blocks: answers to the blocks, with slots and ids, and the phrases, with ids and frequencies."""

    def run(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        share = key[0].as_py()
        sent = sent.sort_by("lang")
        blocks, langs, sizes, names = (sent.column(c).to_pylist() for c in ("block", "lang", "n", "names"))
        words = names[0] is not None
        parts = [unpacked(x, n, 2 if words else 4) for x, n in zip(sent.column("numbers").to_pylist(), sizes)]
        slots = [np.cumsum(p[0]) for p in parts]
        if words:
            group, *keys = same_words(langs, names)
        else:
            group, *keys = same_pairs(np.concatenate([np.cumsum(p[1]) for p in parts]), np.concatenate([p[2] for p in parts]))
        # Sums of whole numbers below 2^53 are exact.
        f = np.bincount(group, weights=np.concatenate([p[-1] for p in parts])).astype(np.int64)
        kept = np.flatnonzero(f >= least)
        kept = kept[np.argsort(-f[kept], kind="stable")]
        ids = np.full(len(f), -1)
        ids[kept] = np.arange(len(kept)) * shares + share
        out = defaultdict(list)
        for block, slot, new in zip(blocks, slots, np.split(ids[group], np.cumsum(sizes)[:-1])):
            there = new >= 0
            if there.any():
                for column, x in zip(("block", "n", "numbers"), (block, int(there.sum()), packed(steps(slot[there]), new[there]))):
                    out[column].append(x)
        found = {"lang": [keys[0][x] for x in kept], "word": [keys[1][x] for x in kept]} if words else {"left": keys[0][kept], "right": keys[1][kept]}
        tables = [table_of(ANSWERS, id=ids[kept], f=f[kept], **found)] + ([table_of(ANSWERS, **out)] if out else [])
        common.give_back()
        return pa.concat_tables(tables)

    return common.durable(messages.groupBy("share").applyInArrow(run, ANSWERS), name)


def phrases_in(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("id").isNotNull())


def keep(lists: DataFrame, answers: DataFrame, grow: bool) -> DataFrame:
    """The lists of what is frequent: of the words themselves, or of the pairs that the block's lists make (``grow``)."""
    found = answers.where(F.col("block").isNotNull()).groupBy("block").agg(F.collect_list(F.struct("n", "numbers")).alias("found"))
    rows = lists.select("block", "sizes", "positions").join(found, "block").select("block", "sizes", "positions", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, (sizes, positions) = batch.column("block")[i].as_py(), lists_of(batch, i)
                parts = [unpacked(x["numbers"], x["n"], 2) for x in batch.column("found")[i].as_py()]
                slots, new = (np.concatenate(x) for x in zip(*[(np.cumsum(slot), new) for slot, new in parts]))
                order = np.argsort(new)
                if grow:
                    _, _, sizes, positions = longer(sizes, positions)
                yield one_row(block, new[order], *kept_lists(sizes, positions, slots[order]))
        common.give_back()

    return rows.mapInArrow(run, LISTS)


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1, 2 ... ``longest`` words, and the words of each language.

    Columns of the phrases: id, lang, phrase, its last word, f, the ids of its
    first and its last words but one (left, right), and the frequencies of its
    first 1, 2 ... words and of its last 1, 2 ... words.
    """
    words = common.durable(word_lists(docs), "blocks")
    totals = common.durable(words.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    shares = shares_for(words.agg(F.sum(F.size("sizes"))))
    kept = frequent(words_of(words, shares), shares, least, "words-kept")
    none, no_id = F.array().cast("array<long>"), F.lit(None).cast("long")
    phrases = [common.durable(phrases_in(kept).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", no_id.alias("left"), no_id.alias("right"), none.alias("firsts"), none.alias("lasts")), "scored-1")]
    lists = words
    for size in range(2, longest + 1):
        shorter = common.durable(keep(lists, kept, size > 2), f"lists-{size - 1}")
        common.discard(lists)
        common.discard(kept)
        lists = shorter
        # A pair begins where its left phrase does, so there are no more counts than positions.
        shares = shares_for(lists.agg(F.sum("total")))
        kept = frequent(pairs_of(lists, shares), shares, least, f"phrases-{size}")
        before = phrases[-1]
        first = before.select(F.col("id").alias("left"), "lang", "phrase", F.col("firsts").alias("_firsts"), F.col("f").alias("_first"))
        last = before.select(F.col("id").alias("right"), "last", F.col("lasts").alias("_lasts"), F.col("f").alias("_last"))
        joined = phrases_in(kept).select("id", "f", "left", "right").join(first, "left").join(last, "right")
        found = joined.select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f", "left", "right",
            F.concat("_firsts", F.array("_first")).alias("firsts"), F.concat("_lasts", F.array("_last")).alias("lasts"),
        )
        phrases.append(common.durable(found, f"scored-{size}"))
    common.discard(lists)
    common.discard(kept)
    return phrases, totals


def lowest_cut() -> Column:
    """The score of a phrase by its weakest cut, with the frequencies of both parts; exact, by decimals."""
    cut = """named_struct(
      'score', CAST(2000000 AS DECIMAL(7, 0)) * CAST(f AS DECIMAL(19, 0)) div (CAST(firsts[k - 1] AS DECIMAL(19, 0)) + CAST(lasts[size(lasts) - k] AS DECIMAL(19, 0))),
      'k', k, 'l', firsts[k - 1], 'r', lasts[size(lasts) - k])"""
    return F.expr(f"array_min(transform(sequence(1, size(firsts)), k -> {cut}))")


def not_covered(phrases: DataFrame, around: DataFrame, cover: int) -> DataFrame:
    """Without the phrases that one of a word more, frequent enough, holds."""
    held = around.select(F.explode(F.array("left", "right")).alias("id"), F.col("f").alias("around")).groupBy("id").agg(F.max("around").alias("around"))
    enough = F.col("around").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * cover
    return phrases.join(held, "id", "left").where(F.col("around").isNull() | ~enough).drop("around")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    levels, totals = mine(docs, least, longest)
    left = [not_covered(p, around, cover) for p, around in zip(levels[1:], levels[2:])] + levels[-1:] if longest > 1 else []
    found = left[0].select("lang", "phrase", "f", lowest_cut().alias("c"))
    for more in left[1:]:
        found = found.unionByName(more.select("lang", "phrase", "f", lowest_cut().alias("c")))
    rows = found.select("lang", "phrase", F.col("f").alias("a"), F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").cast("long").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    rows = rows.withColumn("_share", share).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("_place") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.documents(spark, sf_dir))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (VALUES (1), (2), (3), (4)) t(m)
  WHERE i + m - 1 <= len(ws)
), f AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, l.f AS l, r.f AS r, c.k, (CAST(2000000 AS HUGEINT) * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1 :], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f, m, m2, array_to_string(ws[i : i + m2 - 1], ' ') AS phrase
  FROM (SELECT lang, f, m, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS i FROM f WHERE m > 2), (VALUES (2), (3)) t(m2)
  WHERE m2 < m AND i + m2 - 1 <= m
), covered AS (
  SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_phrases s ON s.lang = b.lang AND s.phrase = b.phrase WHERE 100 * s.f >= 80 * b.a
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b ANTI JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
