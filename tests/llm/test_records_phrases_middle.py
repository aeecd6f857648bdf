"""Collocations, token records and fill-in-the-middle against brute force, and their corner cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from timeloom.llm import common, op11_collocations, op12_token_records, op13_fill_in_middle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, output string, form string, _tie string, left string, f string"
tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, columns whose names operators might use."""
    rng = random.Random(9)
    some = ["new york", "New York city", "of the", "in the", "São Paulo", "x\x0by", "a.b,c", "éte", "日本 語", "\x1c", "<P>", "don't", "  ", "\t", "\n\n", "🙂", "Ⅷ"]
    out = []
    for i in range(80):
        text = " ".join(rng.choice(some) if rng.random() < 0.6 else rng.choice("abcd") for _ in range(rng.randint(1, 120)))
        out.append((i, text, rng.choice(["en", "pt", None]), rng.choice(["a", None]), len(text), *["x"] * 6))
    out += [(100, None, None, None, None, *[None] * 6), (None, "a null id of the", "en", "a", 9, *[None] * 6), (101, "", "en", "c", 0, *["q"] * 6), (102, " \n ", "en", "c", 3, *["q"] * 6)]
    out += [(103, " ".join(rng.choices(["alpha", "beta", "gamma", "delta\n"], k=30_000)), "en", "d", 0, *["q"] * 6)]
    out += [out[3], out[3], (3, "another text of this id", "en", "a", 1, *["q"] * 6), (None, None, "und", "a", 1, *["q"] * 6), (-7, "New York, new york: NEW YORK", "en", "a", 1, *["q"] * 6)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# collocations


def phrases_by_hand(rows, least, longest, top, cover):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if c >= least}
        scored = []
        for p, a in frequent.items():
            around = [c for q, c in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if len(p) > 1 and not any(100 * c >= cover * a for c in around):
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        scored.sort(key=lambda s: (-s[0], -s[1], s[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], score) for i, (score, a, p, left, right) in enumerate(scored[:top])]
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "top", "cover"), [(30, 4, 2000, 80), (3, 4, 50, 80), (2, 2, 5, 50), (2, 5, 2000, 100)])
def test_collocations_by_hand(docs, rows, least, longest, top, cover):
    got = sorted(map(tuple, op11_collocations.collocations(docs, least, longest, top, cover).collect()))
    assert got == phrases_by_hand(rows, least, longest, top, cover)
    assert got


def test_collocations_over_many_small_blocks(docs, rows, monkeypatch, spark):
    """Blocks of any size give equal lists; the limits here are those of the driver, so the function runs here."""
    monkeypatch.setattr(op11_collocations, "BLOCK_WORDS", 50)
    got = sorted(map(tuple, op11_collocations.collocations(docs.repartition(17), 4).collect()))
    assert got == phrases_by_hand(rows, 4, 4, 2000, 80)


@pytest.mark.parametrize("together", [40, 10_000])
def test_collocations_over_many_shares(docs, rows, monkeypatch, together):
    """Keys dealt into any number of shares give equal frequencies."""
    monkeypatch.setattr(op11_collocations, "TOGETHER", together)
    got = sorted(map(tuple, op11_collocations.collocations(docs.repartition(5), 3).collect()))
    assert got == phrases_by_hand(rows, 3, 4, 2000, 80)


def shuffled(spark):
    """Bytes that the stages of this session have written for exchanges."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_collocations_exchange_few_bytes_a_word(spark):
    """Counts leave their blocks packed: all levels together, lists included, exchange less than two bytes a word."""
    random = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in random.zipf(1.2, 2000) % 20_000) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").coalesce(2).localCheckpoint()
    before = shuffled(spark)
    got = op11_collocations.collocations(docs).collect()
    assert got
    assert (shuffled(spark) - before) / (200 * 2000) < 2


def test_longer_merges_positions():
    owner = np.array([0, 1, 0, 1, 0, 0])  # words a b a b a a
    _, sizes, positions = op11_collocations.inverted(owner)
    left, right, n, places = op11_collocations.longer(sizes, positions)
    assert list(zip(left, right, n)) == [(0, 0, 1), (0, 1, 2), (1, 0, 2)]
    assert places.tolist() == [4, 0, 2, 1, 3]


def test_scores_beyond_64_bits(spark):
    big = 6_000_000_000_000_000_000
    row = spark.sql(f"SELECT {big}L AS f, array({big}L) AS firsts, array({big + 1}L) AS lasts").select(op11_collocations.lowest_cut().alias("c")).first()["c"]
    assert row["score"] == 2000000 * big // (2 * big + 1)


def test_no_phrases(empty, spark):
    assert op11_collocations.collocations(empty).count() == 0
    assert op11_collocations.collocations(spark.createDataFrame([(1, "just a few words.", "en")], "doc_id long, text string, lang string")).count() == 0


# token records


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))


def records_by_hand(rows, tokenizer, end):
    out, at = [], 0
    tied = sorted(((r[0] is None, r[0] or 0), tokenizer.encode(r[1] or "", add_special_tokens=False).ids + end) for r in rows)
    by_id = defaultdict(list)
    for (null, doc_id), ids in tied:
        by_id[None if null else doc_id].append(ids)
        out.append((None if null else doc_id, len(ids)))
        at += len(ids)
    return by_id, out, at


@pytest.fixture(scope="module")
def written(docs, spark):
    folder = f"{common.shared_dir(spark)}/records-test"
    if not folder.startswith("file:"):
        folder = f"file://{folder}"
    return folder, op12_token_records.write(docs, tokenizers.path("byte_bpe_50k.json"), folder)


def test_records_round_trip(docs, rows, tokenizer, written):
    folder, index = written
    by_id, _, total = records_by_hand(rows, tokenizer, [2])
    got = op12_token_records.read(index, folder).orderBy("start").collect()
    at = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        by_id[r["doc_id"]].remove(ids)
        at += len(ids)
    assert at == total and not any(by_id.values())
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is None, i or 0))


def test_records_in_any_order_and_in_part(spark, written):
    folder, index = written
    rows = index.collect()
    random.Random(1).shuffle(rows)
    want = {r["start"]: r["ids"] for r in op12_token_records.read(index, folder).collect()}
    some = rows[:20]
    got = op12_token_records.read(spark.createDataFrame(some, index.schema).coalesce(1), folder).collect()
    assert [r["start"] for r in got] == [r["start"] for r in some]
    assert all(r["ids"] == want[r["start"]] for r in got)


def test_files_without_their_index(written):
    folder, index = written
    want = defaultdict(list)
    for r in index.orderBy("file", "offset").collect():
        want[r["file"]].append((r["doc_id"], r["n_tokens"]))
    for name, docs in want.items():
        assert [(i, len(ids)) for i, ids in op12_token_records.scan(f"{folder}/{name}")] == docs


def test_damage_is_seen():
    data, size = op12_token_records.frames([1, None, 3], [np.array([1, 2], "<u4"), np.array([], "<u4"), np.array([70_000], "<u4")], 4)
    start = np.cumsum(size) - size
    doc_ids, ids = op12_token_records.unframed(data, start, size)
    assert doc_ids == [1, None, 3] and [x.tolist() for x in ids] == [[1, 2], [], [70_000]]
    for i in range(len(data)):
        bad = data.copy()
        bad[i] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            op12_token_records.unframed(bad, start, size)
    with pytest.raises(ValueError, match="damaged"):
        op12_token_records.unframed(data[:-1], start, size)


def test_checksums_by_hand():
    def slow(data):
        crc = 0xFFFFFFFF
        for byte in data:
            crc ^= byte
            for _ in range(8):
                crc = (crc >> 1) ^ 0x82F63B78 if crc & 1 else crc >> 1
        crc ^= 0xFFFFFFFF
        return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF

    rng = random.Random(3)
    parts = [b"123456789", *(rng.randbytes(rng.choice([4, 8, 63, 64, 65, 128, 1000])) for _ in range(60))]
    size = np.array([len(p) for p in parts])
    got = op12_token_records.masked_crc(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [slow(p) for p in parts]
    assert slow(b"123456789") == (((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_split_texts_have_the_tokenizers_ids(tokenizer):
    words = op12_token_records.Words(tokenizer.to_str())
    rng = random.Random(4)
    parts = ["a", "bc", "S", "'", "'s", "'ll", "'re", " ", "  ", "\n", "\t", "\xa0", "1", "22", "!", "?!", "é", "—", "🙂", "日本", "͸", "<|endoftext|>", "<|", "don't", "\x1c", "\x85", "Ⅷ", "x" * 70, "\r\n", "́"]
    for _ in range(800):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(5)]
        assert [x.tolist() for x in words.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_rolled_files_and_no_end(docs, rows, spark, tokenizer, monkeypatch):
    monkeypatch.setattr(op12_token_records, "FILE_BYTES", 1)
    monkeypatch.setattr(op12_token_records.op4_packing, "SLICE", 400)
    folder = f"file://{common.shared_dir(spark).removeprefix('file://')}/records-rolled"
    index = op12_token_records.write(docs, tokenizers.path("byte_bpe_50k.json"), folder, end_id=None)
    _, sizes, total = records_by_hand(rows, tokenizer, [])
    got = op12_token_records.read(index, folder).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(n for _, n in sizes) and sum(r["n_tokens"] for r in got) == total


def test_records_of_nothing(empty, spark):
    folder = f"file://{common.shared_dir(spark).removeprefix('file://')}/records-empty"
    index = op12_token_records.write(empty, tokenizers.path("byte_bpe_50k.json"), folder)
    assert index.count() == 0 and op12_token_records.read(index, folder).count() == 0


# fill in the middle


def middle_by_hand(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "rate", "spm"), [(42, 50, 80), (7, 100, 50), (1, 0, 0)])
def test_middle_by_hand(docs, rows, seed, rate, spm):
    key = lambda r: (r[0] is None, r[0] or 0, r[-1] or "")
    made = op13_fill_in_middle.fill_in_middle(docs, seed, rate, spm)
    assert sorted(map(tuple, made.collect()), key=key) == sorted((middle_by_hand(r[0], r[1], seed, rate, spm) for r in rows), key=key)
    back = op13_fill_in_middle.restore(made).select("doc_id", "restored").collect()
    assert sorted(map(tuple, back), key=key) == sorted(((r[0], r[1] or "") for r in rows), key=key)


def test_parts_that_almost_hold_a_mark(spark):
    texts = ["< P> <S <M a <P", "<<P <S< b <", "> P> <", "<P", " <M <M <"]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    back = op13_fill_in_middle.restore(op13_fill_in_middle.fill_in_middle(docs, rate=100)).collect()
    assert sorted((r["doc_id"], r["restored"]) for r in back) == sorted(map(tuple, docs.collect()))
    assert {r["form"] for r in back} == {"psm", "spm"}


def test_marks_that_would_mislead(docs):
    for marks in (("", "b", "c"), ("<P>", "<P>>", "<M>"), ("aba", "c", "d")):
        with pytest.raises(ValueError, match="marks"):
            op13_fill_in_middle.fill_in_middle(docs, marks=marks)


def test_middle_of_nothing(empty):
    assert op13_fill_in_middle.restore(op13_fill_in_middle.fill_in_middle(empty)).count() == 0


def test_digests_of_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op13_fill_in_middle.query(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        want = middle_by_hand(r["doc_id"], r["text"])
        got = rows[r["doc_id"]]
        assert got["output_sha256"] == hashlib.sha256(want[-1].encode()).hexdigest()
        assert got["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_records_query(spark, tokenizer):
    folder, at = "/root/testdata/sf0.001", 0
    rows = {r["doc_id"]: tuple(r) for r in op12_token_records.query(spark, folder).collect()}
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").collect()):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        assert rows[r["doc_id"]] == (r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# what earlier operators hold


def test_topk_keeps_ids_alone_of_the_blocks_it_leaves(monkeypatch):
    """At 768 dimensions a task keeps a hundredth of the blocks of queries that it has seen."""
    from timeloom.llm import op5_topk

    rng = np.random.default_rng(1)
    blocks = [op5_topk.Postings.of(np.arange(i * 256, (i + 1) * 256), np.arange(256), np.ones(256, bool), list(rng.integers(-9, 9, (256, 768)))) for i in range(4)]
    weights = []
    real = op5_topk.weight
    monkeypatch.setattr(op5_topk, "weight", lambda kept: weights.append(real(kept)) or real(kept))
    whole = sum(len(x) for x in blocks[0].store())
    queries, ids = blocks[0].uids.copy(), blocks[0].ids.copy()
    scores = op5_topk.scatter_scores(blocks[0], blocks[1])
    kept = queries, ids, op5_topk.select(scores, blocks[0], blocks[1], 5)
    assert op5_topk.weight(kept) < whole / 20 and queries.base is None


def test_topk_with_room_for_few_queries(spark, monkeypatch):
    from pyspark.sql import functions as F

    from timeloom.llm import op5_topk

    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = sorted(map(tuple, op5_topk.top_k(df, F.col("vec_id") % 3 == 0).collect()))
    monkeypatch.setattr(op5_topk, "HELD", 1)
    monkeypatch.setattr(op5_topk, "BLOCK", 16)
    assert sorted(map(tuple, op5_topk.top_k(df, F.col("vec_id") % 3 == 0).collect())) == want


def test_repeated_rows_of_two_sources_meet_both_targets(spark):
    """Rows that agree in id and text but not in source get the same numbers over any partitions."""
    from timeloom.llm import op3_mixing

    rows = [(1, "the same words here", s) for s in ("a", "b", None) for _ in range(70)] + [(i, "w " * (i % 9), "b") for i in range(2, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = []
    for parts in (1, 4, 9):
        mixed = op3_mixing.resample(common.durable(docs.repartition(parts), "mixed-in"))
        results.append(sorted((str(r["source"]), r["doc_id"]) for r in mixed.collect()))
    assert results[0] == results[1] == results[2]
    met = op3_mixing.mix(docs).groupBy("source_size", "target").sum("taken").collect()
    assert len(met) == 3 and all(abs(r["sum(taken)"] - r["target"]) <= 5 for r in met)
