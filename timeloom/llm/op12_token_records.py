"""Token ids as length-delimited binary records, with an index of offsets.

A file is a row of frames, one a document::

    length of the payload     8 bytes, little-endian
    checksum of those         4 bytes
    payload
    checksum of the payload   4 bytes

A checksum is the CRC-32C, rotated right by 15 bits plus 0xA282EAD8 (masked, so
that checksums of data that hold checksums stay good); any reader of this
widespread framing reads the files.  The payload is the document's id (8
bytes), a byte that says how many bytes an id of a token takes (2 while the
vocabulary allows, else 4; 128 more where the document has no id), and the
ids, little-endian.

Documents are cut in ranges of ascending id, null ids last; a task writes one
range, a file for about FILE_BYTES.  Files carry a name of their own for every
attempt, and only those that the index names count, so a task that runs again,
or twice at a time, leaves at worst a file that nobody reads.  The index is a
Parquet table beside the files: by document its file, offset, size, number of
ids and the ids of all documents before it.  Reading follows the index, so
that rows of it in any order, or a choice of them, read just those frames;
``scan`` reads a file without it.  A frame whose length or checksum is wrong
stops the job.

Ids come from the tokenizer itself: texts are split as it splits them, by
arrays of character classes, and each distinct word is encoded once; texts with
unassigned characters or special tokens, and very long ones, go through the
tokenizer whole.  Both give the same ids, up to a collision of the 64-bit
hashes of two words that a worker meets.

Files are written and read by pyarrow's file systems (local paths, s3, gs,
abfs, hdfs), which the folder's address chooses.

Corner cases: a null or empty text has only the end id, or, without one, a
record of no ids; rows with one id are ordered by a hash of their text, and
repeated rows are records each; null ids are kept as such; a very long text is
one record, with memory in proportion to it; an empty table gives an empty
index.  Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common, op4_packing

END_ID = 2
#: A file takes no more documents beyond this size; bytes of neighbouring frames that are read together.
FILE_BYTES, READ_BYTES = 256 << 20, 1 << 20
#: Bytes of a frame beside its payload, and of a payload beside its ids.
FRAME, HEAD = 16, 9
NO_ID = 128

# The polynomial of CRC-32C (reflected) and what masks it; white space.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Bytes of a lane; the lanes of all records are taken side by side.
LANE = 64


def advance(crc: np.ndarray, step: np.ndarray) -> np.ndarray:
    """What becomes of each checksum over as many zeros as ``step`` stands for."""
    return step[0][crc & 255] ^ step[1][(crc >> 8) & 255] ^ step[2][(crc >> 16) & 255] ^ step[3][crc >> 24]


@cache
def step(zeros: int) -> np.ndarray:
    """The tables of ``advance`` for 4, 8, 16 ... zero bytes."""
    crc = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    if zeros > 4:
        return advance(advance(crc, step(zeros // 2)), step(zeros // 2))
    for _ in range(8 * zeros):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1)
    return crc


def masked_crc(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The masked CRC-32C of the parts of ``data`` (bytes, 4 at least a part), all lanes of all parts at once."""
    lanes = -(-size // LANE)
    end = np.cumsum(lanes) * LANE
    padded = np.zeros(int(lanes.sum()) * LANE, np.uint8)
    place = np.arange(int(size.sum())) + np.repeat(end - np.cumsum(size), size)
    padded[place] = data[np.arange(len(place)) + np.repeat(start - (np.cumsum(size) - size), size)]
    # A register of ones before the first byte is the same as the first four bytes turned over; zeros in front then say nothing.
    padded[(end - size)[:, None] + np.arange(4)] ^= 0xFF
    words = padded.view("<u4").reshape(-1, LANE // 4)
    crc = np.zeros(len(words), np.uint32)
    for i in range(LANE // 4):
        crc = advance(crc ^ words[:, i], step(4))
    behind = np.repeat(np.cumsum(lanes), lanes) - 1 - np.arange(len(crc))
    for bit in range(int(lanes.max(initial=1)).bit_length()):
        some = (behind >> bit) & 1 == 1
        crc[some] = advance(crc[some], step(LANE << bit))
    crc = ~np.bitwise_xor.reduceat(crc, np.cumsum(lanes) - lanes) if len(size) else crc
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK)


def laid(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Put each of the numbers ``values``, by its bytes, at its place in ``out``."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    out[at[:, None] + np.arange(flat.shape[1])] = flat


def taken(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(data[at[:, None] + np.arange(np.dtype(kind).itemsize)]).view(kind).ravel()


def frames(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The frames of some documents as bytes, and the size of each."""
    size = np.array([len(x) for x in ids], np.int64) * width + HEAD
    start = np.cumsum(size + FRAME) - size - FRAME
    out = np.zeros(int((size + FRAME).sum()), np.uint8)
    laid(out, start, size.astype("<u8"))
    laid(out, start + 12, np.array([i or 0 for i in doc_ids], "<i8"))
    out[start + 20] = [width | (NO_ID if i is None else 0) for i in doc_ids]
    flat = np.concatenate(ids).astype(f"<u{width}").view(np.uint8) if len(ids) else np.zeros(0, np.uint8)
    each = size - HEAD
    out[np.arange(len(flat)) + np.repeat(start + 21 - (np.cumsum(each) - each), each)] = flat
    laid(out, start + 8, masked_crc(out, start, np.full(len(size), 8)).astype("<u4"))
    laid(out, start + 12 + size, masked_crc(out, start + 12, size).astype("<u4"))
    return out, size + FRAME


def unframed(data: np.ndarray, start: np.ndarray, whole: np.ndarray) -> tuple[list[int | None], list[np.ndarray]]:
    """The documents' ids and token ids of frames that begin at ``start`` and are ``whole`` bytes long."""
    size = whole - FRAME
    good = (size >= HEAD) & (start + whole <= len(data))
    if good.all():
        good = (taken(data, start, "<u8") == size) & (taken(data, start + 8, "<u4") == masked_crc(data, start, np.full(len(size), 8)))
        good &= taken(data, start + 12 + size, "<u4") == masked_crc(data, start + 12, size)
    if not good.all():
        raise ValueError(f"a damaged record, {int(start[np.argmin(good)])} bytes behind the first one read")
    flags = data[start + 20]
    doc_ids = [None if f & NO_ID else i for i, f in zip(taken(data, start + 12, "<i8").tolist(), flags.tolist())]
    parts = zip((start + 21).tolist(), (start + 12 + size).tolist(), (flags & ~np.uint8(NO_ID)).tolist())
    return doc_ids, [data[a:b].view(f"<u{w}").astype("<u4") for a, b, w in parts]


@cache
def classes() -> np.ndarray:
    """By code point: 0 space, 1 letter, 2 number, 3 sign, 9 not assigned (tokenizers differ on these)."""
    first = {"L": 1, "N": 2}
    kind = np.array([9 if (c := unicodedata.category(chr(i))) == "Cn" else first.get(c[0], 3) for i in range(0x110000)], np.uint8)
    kind[SPACES] = 0
    return kind


def split(points: np.ndarray, kind: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the words of texts begin that follow each other; each text begins at one of ``begin``.

    A word is a contraction, or a run of letters, of numbers or of signs with
    the one blank before it, or white space; of white space before other
    characters the last one is apart, and a blank goes to what follows.
    """
    fresh = np.zeros(len(points) + 1, bool)
    fresh[begin] = True
    starts = np.r_[True, kind[1:] != kind[:-1]] | fresh[:-1]
    last_space = (kind == 0) & np.r_[starts[1:], True] & ~fresh[1:]  # before other characters of the same text
    starts |= last_space
    blank = np.flatnonzero(last_space & (points == 0x20))
    starts[blank + 1] = False
    ends = np.r_[starts[1:], True]
    mark = np.flatnonzero(starts[:-1] & ends[:-1] & (points[:-1] == ord("'")) & (kind[1:] == 1) & ~fresh[1:-1])
    at = lambda i: np.where(i < len(points), points[np.minimum(i, len(points) - 1)], 0)
    which = np.cumsum(fresh)
    for tail in op4_packing.CONTRACTIONS:
        hit = np.logical_and.reduce([at(mark + 1 + k) == ord(c) for k, c in enumerate(tail)])
        hit &= which[mark] == which[np.minimum(mark + len(tail), len(points))]
        here, mark = mark[hit], mark[~hit]
        starts[here + 1] = False
        after = here + len(tail) + 1
        starts[after[after < len(points)]] = True
    return np.flatnonzero(starts)


class Words(op4_packing.Words):
    """Ids of texts of a byte-level tokenizer without normal form, each distinct word encoded once."""

    form = staticmethod(str)

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.definition = definition
        self.by_word = Tokenizer.from_str(definition)
        vocabulary = self.by_word.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.special = [t.content for t in self.by_word.get_added_tokens_decoder().values()]
        self.width = 2 if len(self.begins) <= 1 << 16 else 4
        self.forget()

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words and how many each has; those with a blank in front go through in one text."""
        spaced = np.array([len(w) > 1 and w[0] == " " and not w[1].isspace() for w in words], bool)
        joined = np.array(self.by_word.encode_batch_fast(["".join(itertools.compress(words, spaced))], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self.begins[joined])
        if len(starts) != spaced.sum() or (len(starts) and starts[0]):
            spaced[:], joined, starts = False, joined[:0], starts[:0]
        others = [np.array(x.ids, "<u4") for x in self.by_word.encode_batch_fast(list(itertools.compress(words, ~spaced)), add_special_tokens=False)]
        size, begin = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        flat = np.concatenate([joined, *others])
        size[spaced], begin[spaced] = np.diff(np.r_[starts, len(joined)]), starts
        size[~spaced] = [len(x) for x in others]
        begin[~spaced] = len(joined) + np.cumsum(size[~spaced]) - size[~spaced]
        return flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(flat))], size

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text."""
        if self.used > op4_packing.POOL_IDS:
            self.forget()
        whole = {i for i, t in enumerate(texts) if len(t) > op4_packing.LONG_TEXT or any(s in t for s in self.special)}
        short = ["" if i in whole else t for i, t in enumerate(texts)]
        joined = "".join(short)
        begin = np.cumsum([0, *map(len, short)])
        points = common.code_points(joined)
        kind = classes()[points]
        odd = np.unique(np.searchsorted(begin, np.flatnonzero(kind == 9), side="right") - 1).tolist()
        whole.update(odd)
        first = split(points, kind, begin) if len(points) else np.zeros(0, np.int64)
        start, size = self.look_up(joined, points, first, np.r_[first[1:], len(points)].astype(np.int64)[: len(first)])
        ends = np.cumsum(size, dtype=np.int64)
        flat = self.pool[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        cuts = np.r_[0, ends][np.searchsorted(first, begin)]
        return [np.array(self.by_word.encode(t, add_special_tokens=False).ids, "<u4") if i in whole else flat[cuts[i] : cuts[i + 1]] for i, t in enumerate(texts)]


@lru_cache(1)
def worker_words(definition: str) -> Words:
    return Words(definition)


def opened(path: str):
    """The file system of an address and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


WRITTEN = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("file", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in ("offset", "size", "doc_id", "n_tokens", "before")),
    ]
)


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text in ranges of ascending id, each sorted; a hot id is cut by its texts, and repeated rows by their place."""
    key = ["_null", "doc_id", "_tie"]
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"],
        docs["doc_id"].isNull().alias("_null"),
        F.coalesce(F.xxhash64(docs["text"]), F.lit(0).cast("long")).alias("_tie"),
        F.monotonically_increasing_id().alias("_place"),
    )
    return rows.repartitionByRange(*key, "_place").sortWithinPartitions(*key).select("doc_id", "text")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = END_ID) -> DataFrame:
    """Encode every document into files under ``folder`` and give the index, which is stored there too.

    ``tokenizer`` is the path of its file on the driver; ``folder`` must be new.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, shard, words = to_arrow_schema(WRITTEN), TaskContext.get().partitionId(), worker_words(definition.value)
        system, place = opened(folder)
        end = np.array([] if end_id is None else [end_id], "<u4")
        sink, name, offset, before = None, "", 0, 0
        try:
            for batch in batches:
                for part in common.slices(batch, batch.column(1), op4_packing.SLICE):
                    if sink is None or offset >= FILE_BYTES:
                        if sink is not None:
                            sink.close()
                        system.create_dir(place, recursive=True)
                        name, offset = f"ids-{shard:06d}-{uuid.uuid4().hex}.rec", 0
                        sink = system.open_output_stream(f"{place}/{name}")
                    doc_ids = part.column(0).to_pylist()
                    ids = [np.concatenate([x, end]) for x in words.encode([t or "" for t in part.column(1).to_pylist()])]
                    data, size = frames(doc_ids, ids, words.width)
                    sink.write(pa.py_buffer(data))
                    count = np.array([len(x) for x in ids], np.int64)
                    columns = [np.full(len(size), shard), [name] * len(size), offset + np.cumsum(size) - size, size, doc_ids, count, before + np.cumsum(count) - count]
                    offset, before = offset + int(size.sum()), before + int(count.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        finally:
            if sink is not None:
                sink.close()
        common.give_back()

    written = common.durable(in_order(docs).mapInArrow(run, WRITTEN), "records-written")
    # One row a task reaches the driver.
    totals = sorted(map(tuple, written.groupBy("shard").agg(F.sum("n_tokens")).collect()))
    first = spark.createDataFrame([(s, b) for (s, _), b in zip(totals, itertools.accumulate((n for _, n in totals), initial=0))], "shard int, first long")
    index = written.join(first, "shard").select("file", "offset", "size", "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens")
    index.sortWithinPartitions("start").write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """file, offset, size, doc_id, start, n_tokens of the records under ``folder``."""
    return spark.read.parquet(f"{folder}/index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (bytes, 4 little-endian ones an id), read from the files by rows of the index.

    Rows that follow each other in a file are read together, as far as READ_BYTES.
    """

    def runs(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for row in rows:
            if held and (row[0] != held[-1][0] or row[1] != held[-1][1] + held[-1][2] or row[1] - held[0][1] > READ_BYTES):
                yield held
                held = []
            held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = opened(folder)
        name, source = None, None
        for held in runs(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            if held[0][0] != name:
                name, source = held[0][0], system.open_input_file(f"{place}/{held[0][0]}")
            at, size = np.array([r[1] for r in held]), np.array([r[2] for r in held])
            data = np.frombuffer(source.read_at(int(at[-1] + size[-1] - at[0]), int(at[0])), np.uint8)
            doc_ids, ids = unframed(data, at - at[0], size)
            columns = [pa.array(doc_ids, pa.int64()), pa.array([r[3] for r in held], pa.int64()), pa.array([len(x) for x in ids], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
        common.give_back()

    return index.select("file", "offset", "size", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def scan(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of one file without its index, one frame after another."""
    system, place = opened(path)
    with system.open_input_stream(place) as source:
        while head := source.read(12):
            size = int.from_bytes(head[:8], "little")
            data = np.frombuffer(head + source.read(size + 4), np.uint8)
            (doc_id,), (ids,) = unframed(data, np.zeros(1, np.int64), np.array([size + FRAME]))
            yield doc_id, ids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{common.shared_dir(spark)}/records-{uuid.uuid4().hex}"
    index = write(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read(index, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
