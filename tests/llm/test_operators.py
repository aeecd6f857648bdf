"""The llm operators against brute force on small inputs, and their corner cases."""

import base64
import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from timeloom.llm import (
    common,
    op1_licenses,
    op2_fingerprints,
    op3_mixing,
    op4_packing,
    op5_topk,
    op6_language,
    op7_token_counts,
    op8_toxicity,
    op9_jaccard_join,
    op10_quality,
    pipeline,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _label string, _th string, size string, u string"
tokenizers = pytest.importorskip("public_tokenizers")


def words(rng, n, stem=""):
    return " ".join(stem + "".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns whose names operators might use."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        text = words(rng, rng.randint(1, 200)) + ".\n" + words(rng, 30)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text), "x", "y", "z", "s", "u"))
    rows += [(100, None, None, None, None, None, None, None, None, None), (None, "a null id", "en", "a", 9, *[None] * 5)]
    rows += [(101, "", "en", "c", 0, *["q"] * 5), (102, " \n ", "en", "c", 3, *["q"] * 5), (103, words(rng, 30_000), "en", "d", 0, *["q"] * 5)]
    rows += [rows[3], rows[3], rows[60], (200, rows[5][1], "en", "a", 1, *["q"] * 5)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(60)] + [(None, 1, 1), (3, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")


def counted(df, *by):
    return sorted((tuple(r) for r in df.select(*by).collect()), key=str)


# fingerprints


def selected_by_hand(hashes, window):
    out = []
    for s in range(max(1, len(hashes) - window + 1) if len(hashes) else 0):
        span = range(s, min(s + window, len(hashes)))
        p = min(span, key=lambda i: (hashes[i], -i))
        if not out or out[-1] != p:
            out.append(p)
    return out


@pytest.mark.parametrize("k,window,block", [(12, 20, 1 << 20), (3, 4, 16), (1, 1, 8), (7, 2, 50)])
def test_winnowing_selects_rightmost_minima(monkeypatch, k, window, block):
    monkeypatch.setattr(op2_fingerprints, "BLOCK", block)
    rng = random.Random(1)
    for n in (0, 1, 5, 40, 300):
        text = "".join(rng.choices("abé🙂", k=n))
        points = common.code_points(text)
        hashes = op2_fingerprints.gram_hashes(points, min(k, n)) if n else []
        assert list(op2_fingerprints.winnow(text, k, window)[1]) == selected_by_hand([int(h) for h in hashes], window)


def test_winnowing_match_guarantee():
    rng = random.Random(2)
    shared = "".join(rng.choices("abcdefghij", k=31))
    a, b = ("".join(rng.choices("klmnop", k=200)) + shared + "".join(rng.choices("qrstu", k=100)) for _ in range(2))
    assert set(op2_fingerprints.winnow(a)[0]) & set(op2_fingerprints.winnow(b)[0])


def test_fingerprints_of_edits(spark, docs, empty):
    rows = op2_fingerprints.compare_with_edits(docs).collect()
    assert len(rows) == docs.count()
    source = sorted(docs.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h")).collect(), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    texts = [r["text"] or "" for r in source]
    want = []
    for i, r in enumerate(source):
        own, nxt = texts[i], texts[(i + 1) % len(texts)]
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        want.append((r["doc_id"], len(own), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(want, key=str) == sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str)
    by_text = {}
    for r in source:
        prints = {x["fingerprint"] for x in rows if x["doc_id"] == r["doc_id"]}
        assert by_text.setdefault(r["text"] or "", prints) == prints
    assert op2_fingerprints.compare_with_edits(empty).count() == 0
    assert op2_fingerprints.fingerprint(docs, ["doc_id"]).count() == docs.count()


def fingerprint_by_hand(text, k=12, window=20):
    """From the definition: hashes, positions, the printed form."""
    base, mask, points = 0x9E3779B97F4A7C15, (1 << 64) - 1, [ord(c) + 1 for c in text]
    k = min(k, len(points))

    def mixed(x):
        x ^= x >> 32
        for _ in range(2):
            x = x * 0xD6E8FEB86659FD93 & mask
            x ^= x >> 32
        return x >> 32

    hashes = [mixed(sum(p * pow(base, k - 1 - i, 1 << 64) for i, p in enumerate(points[at : at + k])) & mask) for at in range(len(points) - k + 1)] if k else []
    places = selected_by_hand(hashes, window)
    gaps = [b - a for a, b in zip([0, *places], places)]
    packed = b"".join(hashes[p].to_bytes(4, "little") + g.to_bytes(2, "little") for p, g in zip(places, gaps))
    return {hashes[p] for p in places}, base64.b64encode(packed).decode()


def test_fingerprints_and_likenesses_from_their_definition(spark, monkeypatch):
    monkeypatch.setattr(op2_fingerprints, "BLOCK", 64)  # long texts in several blocks
    rng = random.Random(21)
    texts = {i: "".join(rng.choices("abcdé🙂 ", k=n)) for i, n in enumerate([0, 3, 11, 12, 31, 40, 150, 400, 90])}
    texts[9] = texts[7][100:300]
    rows = {r["doc_id"]: r for r in op2_fingerprints.compare_with_edits(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}

    def alike(a, b):
        return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))

    for i, own in texts.items():
        following = texts[(i - 1) % len(texts)]
        edited = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
        (a, a_text), (b, b_text), (c, _) = map(fingerprint_by_hand, (own, edited, following))
        assert (rows[i]["fingerprint"], rows[i]["edited_fingerprint"]) == (a_text, b_text)
        assert rows[i]["near_edited"] == pytest.approx(alike(a, b)) and rows[i]["near_next"] == pytest.approx(alike(a, c))


def test_ids_of_very_many_rows_are_cut(spark):
    rng = random.Random(22)
    rows = [(7, words(rng, 3)) for _ in range(300)] + [(None, "same")] * 300 + [(i, words(rng, 2)) for i in range(100, 400)]
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    df = common.durable(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "hot")
    beside = op2_fingerprints.beside_next(df)
    sizes = [r["count"] for r in beside.groupBy(F.spark_partition_id()).count().collect()]
    got = op2_fingerprints.compare_with_edits(df).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert max(sizes) < 200 and len(got) == 900
    order = sorted(df.withColumn("h", F.xxhash64("text")).collect(), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for r, after in zip(order, [*order[1:], order[0]]):
        half = len(r[1]) // 2
        want.append((r[0], hashlib.sha256((r[1][: len(r[1]) - half] + after[1][:half]).encode()).hexdigest()))
    assert sorted(want, key=str) == sorted(((r["doc_id"], r["edited_sha256"]) for r in got), key=str)


# mixing


def test_targets_share_everything_below_the_cap():
    got = op3_mixing.targets([10, 1000, 5, 0])
    assert sum(got) == pytest.approx(1015) and all(t <= 3 * s + 1e-9 for t, s in zip(got, [10, 1000, 5, 0]))
    assert got[0] == 30 and got[2] == 15 and got[3] == 0
    assert op3_mixing.targets([100, 100, 100]) == pytest.approx([50, 100, 150])


def shared_out(sizes):
    """Targets by pouring: weights 1, 2, 3, repeating, no source above three times its size."""
    weight = [1 + i % 3 for i in range(len(sizes))]
    low, high = 0.0, 3.0 * max(sum(sizes), 1)
    for _ in range(200):  # the level at which min(3 * size, weight * level) adds up to all sizes
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * s, w * level) for s, w in zip(sizes, weight)) < sum(sizes) else (low, level)
    return [min(3 * s, w * high) for s, w in zip(sizes, weight)]


def missed(docs):
    """Of each source: its target, the words taken, its smallest and largest size; by a count in Python."""
    sizes, of = {}, {}
    for r in docs.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        sizes.setdefault(r["source"], []).append(n)
        of.setdefault((r["doc_id"], n), set()).add(r["source"])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, shared_out([sum(sizes[s]) for s in order])))
    taken = dict.fromkeys(order, 0)
    rows = op3_mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        (source,) = of[r["doc_id"], r["size"]]
        assert r["target"] == pytest.approx(target[source], rel=1e-9) and r["source_size"] == sum(sizes[source])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source] += r["taken"]
    return {s: (target[s], taken[s], min(x for x in sizes[s] if x or not any(sizes[s])), max(sizes[s])) for s in order}


def test_mixing_meets_targets_and_reruns_agree(docs, empty):
    first, second = (counted(op3_mixing.mix(docs), "doc_id", "size", "source_size", "target", "taken") for _ in range(2))
    assert first == second and len(first) == docs.count()
    for target, taken, least, most in missed(docs).values():
        assert abs(taken - target) <= most if least == most else abs(taken - target) <= max(least, 1)
    assert op3_mixing.mix(empty).count() == 0


def test_mixing_takes_some_of_the_rows_that_repeat(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(1, words(rng, 5), "a")] * 200 + [(2, words(rng, 7), "b")] * 150 + [(i, words(rng, 6), "b") for i in range(3, 40)] + [(i, words(rng, 9), "c") for i in range(40, 240)]
    rows += [(None, words(rng, 4), None)] * 90
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for limit in (op3_mixing.BROADCAST_ROWS, 0):  # by broadcast and by exchange
        monkeypatch.setattr(op3_mixing, "BROADCAST_ROWS", limit)
        for target, taken, _, most in missed(df).values():
            assert abs(taken - target) <= most
    first, second = (counted(op3_mixing.mix(df.repartition(n)), "doc_id", "size", "taken") for n in (3, 4))
    assert first == second
    stored = common.durable(df, "rows")
    again = op3_mixing.resample(stored).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in again} == {s: t for s, (_, t, _, _) in missed(df).items()}


def test_resampling_takes_the_copies_of_the_mix(docs, empty):
    copies = {}
    for r in op3_mixing.mix(docs).where("doc_id < 60 AND doc_id <> 3").collect():
        copies[r["doc_id"]] = r["copies"]
    got = {r[0]: r[1] for r in op3_mixing.resample(docs).where("doc_id < 60 AND doc_id <> 3").groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}
    assert op3_mixing.resample(docs).columns == docs.columns and op3_mixing.resample(empty).count() == 0


def test_cut_hashes_finds_the_rank_in_large_groups(spark, monkeypatch):
    monkeypatch.setattr(op3_mixing, "SORT_TOGETHER", 10)
    rows = spark.range(1000).select(F.lit("s").alias("source"), F.lit(7).cast("long").alias("size"), common.unit_hash(F.col("id")).alias("u"))
    groups = spark.createDataFrame([("s", 7, 1000, 345)], "source string, size long, n long, extra long")
    cut = op3_mixing.cut_hashes(rows, groups).first()["cut"]
    assert rows.where(F.col("u") <= cut).count() == 345


# packing


def test_best_fit_matches_a_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(1, 65, rng.integers(0, 120))
        sequence, offset = op4_packing.best_fit(lengths, 64)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in room if r >= lengths[i]]
            r = min(fits, default=64)
            if fits:
                room.remove(r)
            want[i] = 64 - r
            room.append(r - lengths[i])
        assert all(offset[i] == want[i] for i in want) and len(set(sequence)) == len(room)


ODD = ["it's  DON'T  we'll 'S ''s '9 a'd", "naïve ÀÉÎ œuvre ß ẞ Ⅷ ²³ ½ x", "<|endoftext|> hi <|x", "Σας ΑΣ 中文 привет", "\x1c\x1d a\x85b c", "é café", "", "a\tb\r\nc", "🙂 ok", "×÷ª µ º", "İstanbul Ǆ ŉ"]


def test_ids_of_split_texts_are_the_tokenizers(monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    plain = Tokenizer.from_file(path)
    rng = random.Random(11)
    texts = [*ODD, "Ⱥ Ⱦ ǅ", "x" * 200 + " " + "y1" * 90, "'", "''", "'r 're're 'vex l'l'll", "'s", "a's", "a'", "'tis 'Twas", "\n\n"]
    texts += ["".join(rng.choices("abstrevmld'' .,!9²ÀßŸſ\n<|", k=rng.randint(0, 80))) for _ in range(3000)]
    for slots in (1 << 22, 64):  # a small table evicts all the time
        monkeypatch.setattr(op4_packing, "SLOTS", slots)
        monkeypatch.setattr(op4_packing, "POOL_IDS", 5000)
        words = op4_packing.Words(definition)
        for at in range(0, len(texts), 500):
            part = texts[at : at + 500]
            assert [x.tolist() for x in words.encode(part)] == [plain.encode(t, add_special_tokens=False).ids for t in part]
    assert words.encode([]) == []


def test_packing_covers_every_id_once(spark, docs, empty):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    own = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(own)
    rows = op4_packing.pack_documents(every, path, 256).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in every.collect()]
    want = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want += [(doc_id, at, len(ids[at : at + 256]), zlib.crc32(np.array(ids[at : at + 256], "<u4").tobytes()), len(ids)) for at in range(0, len(ids), 256)]
    assert sorted(want, key=str) == sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows), key=str)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    assert op4_packing.pack_documents(empty, path).count() == 0


# top-k


@pytest.mark.parametrize("block,group,held,threshold", [(2048, 64, 200_000, "10MB"), (16, 3, 4, "-1")])
def test_top_k_against_all_pairs(spark, monkeypatch, block, group, held, threshold):
    """By a broadcast of the queries' blocks and by pairs of partitions."""
    for name, value in (("BLOCK", block), ("QUERY_GROUP", group), ("HELD", held)):
        monkeypatch.setattr(op5_topk, name, value)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(9)
    rows = [(i, [rng.randint(-3, 3) / 4 if rng.random() < 0.4 else 0.0 for _ in range(rng.choice([6, 8]))]) for i in range(120)]
    rows += [(50, rows[50][1]), (300, None), (301, [1.0, None]), (302, [float("nan"), 1.0]), (303, [float("inf")]), (304, []), (None, [1.0] * 8)]
    clashing = [(*r, 1, 2, "c", [0.5]) for r in rows]
    df = spark.createDataFrame(clashing, "vec_id long, embedding array<float>, uid long, v long, score string, query_id array<float>")
    got = op5_topk.top_k(df, F.col("vec_id") % 25 == 0, 4).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, (i, v) in enumerate(good):
        if i is None or i % 25:
            continue
        others = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, p) for p, (j, w) in enumerate(good) if p != q)
        want += [(i, r + 1, None if null else j, -s) for r, (s, null, j, _) in enumerate(others[:4])]
    assert sorted(want, key=str) == sorted(map(tuple, got), key=str)
    assert op5_topk.top_k(df.limit(0), F.col("vec_id") % 25 == 0).count() == 0


def test_a_very_long_vector_costs_what_it_holds(spark):
    """One row of 200,000 components among 2,000 of 4: as a padded matrix this would be 3 GB."""
    rng = np.random.default_rng(2)
    small = rng.integers(-2, 3, (2000, 4))
    long = np.r_[small[0], rng.integers(0, 2, 199_996)]
    rows = [(i, v.tolist()) for i, v in enumerate(small)] + [(2000, long.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<int>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in op5_topk.top_k(df, F.col("vec_id") % 1000 == 0, 3, scale=1).collect()}
    assert len(got) == 9
    for q, v in ((0, small[0]), (1000, small[1000]), (2000, long[:4])):
        order = sorted((-int(v @ w[:4]), i) for i, w in enumerate([*small, long]) if i != q)
        assert [got[q, r + 1] for r in range(3)] == [(i, -s) for s, i in order[:3]]


# languages


def test_viterbi_is_the_best_path(monkeypatch):
    rng = np.random.default_rng(4)
    for width in (1, 3, 256):
        monkeypatch.setattr(op6_language, "PASS_WORDS", width)
        scores = rng.normal(0, 6, (40, 3)).astype(np.float32)
        text = np.sort(rng.integers(0, 12, 40))
        labels = op6_language.best_path(scores, text)
        for t in set(text):
            own, got = scores[text == t][:7], None
            if (text == t).sum() > 7:
                continue
            value = lambda path: sum(own[i, p] for i, p in enumerate(path)) - 8 * sum(a != b for a, b in zip(path, path[1:]))
            got = list(labels[text == t])
            assert value(got) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=len(own))), abs=1e-3)


def test_languages_spans_and_corner_cases(spark, docs, empty):
    rng = random.Random(6)
    north, south = (lambda n: " ".join("".join(rng.choices("bdkrst", k=4)) for _ in range(n))), (lambda n: " ".join("".join(rng.choices("aeiolm", k=4)) for _ in range(n)))
    known = spark.createDataFrame([(i, f(40), name) for i in range(40) for f, name in ((north, "n"), (south, "s"))] + [(1, None, "n"), (2, "x", None)], "doc_id long, text string, lang string")
    model = op6_language.learn(known)
    assert model.languages == ["n", "s"]
    a, b = north(10), south(10)
    out = op6_language.identify_texts(model, [a + " " + b, "", "12 !", "привет", b], spans=True)
    assert out["spans"][0] == [(0, len(a), "n"), (len(a) + 1, len(a) + 1 + len(b), "s")]
    assert out["lang_pred"][1:3] == ["und", "und"] and out["lang_pred"][3] in ("n", "s") and out["lang_pred"][4] == "s"
    assert all(0 <= s <= 1 for s in out["score"])
    marks = [chr(0x301) * 70, chr(0x301) * 10, "1 " + chr(0x301) * 200 + " 2", chr(0x301) * 70 + " b"]
    assert op6_language.identify_texts(model, marks)["lang_pred"][:3] == ["und"] * 3 and op6_language.identify_texts(model, marks)["lang_pred"][3] != "und"
    rows = op6_language.identify(docs, model, "doc_id", spans=True)
    assert rows.count() == docs.count() and op6_language.identify(empty, op6_language.learn(empty), "doc_id").count() == 0
    assert {r[0] for r in op6_language.identify(docs, op6_language.learn(empty), "doc_id").select("lang_pred").collect()} == {"und"}


def test_held_out_follows_crc32(spark):
    rows = spark.range(50).select("id", common.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


# token counts


def greedy(word, pieces):
    """Longest piece first, from left to right, or one unknown token."""
    text, at, n = "▁" + word, 0, 0
    while at < len(text):
        fits = [e for e in range(len(text), at, -1) if text[at:e] in pieces and "▁" not in text[at + (at == 0) : e]]
        if not fits:
            return 1
        at, n = fits[0], n + 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(8)
    for _ in range(400):
        pieces = {"".join([rng.choice("abc▁"), *rng.choices("abc", k=rng.randint(0, 4))]) for _ in range(rng.randint(0, 25))}
        automaton = op7_token_counts.Automaton(pieces)
        for _ in range(10):
            word = "".join(rng.choices("abcd▁", weights=[9, 9, 9, 1, 1], k=rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, pieces)


def test_token_counts_of_documents(docs, empty):
    pieces = op7_token_counts.sentence_pieces(tokenizers.path("piece_bpe_32k.model"))
    automaton = op7_token_counts.Automaton(pieces)
    rows = op7_token_counts.count_tokens(docs, pieces, "doc_id", "text").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_words"], r["n_tokens"]) == (len((r["text"] or "").split()), sum(map(automaton.count, (r["text"] or "").split())))
    assert op7_token_counts.count_tokens(empty, pieces, "doc_id").count() == 0
    assert op7_token_counts.word_pieces(["un", "##able"]) == ("▁un", "able")


# toxicity


def test_toxicity_finds_the_sentences(spark, docs, labels, empty):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        text = ". ".join(words(rng, 8) for _ in range(6)) + (". you zzbadone fool" if toxic else "")
        rows.append((i, text))
        marks.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = op8_toxicity.learn(df, spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = op8_toxicity.score(df, model, "doc_id", sentences=True).collect()
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in got)
    assert all("zzbadone" in rows[r["doc_id"]][1][s["start"] : s["end"]] for r in got for s in r["sentences"])
    assert all(0 <= r["score"] <= 1 for r in op8_toxicity.score(docs, op8_toxicity.learn(docs, labels), "doc_id").collect())
    assert op8_toxicity.learn(empty, labels).weights == {} and op8_toxicity.score(empty, model, "doc_id").count() == 0


def test_toxic_scores_from_their_definition(spark):
    """Noisy-or over sentences of a logistic score above a base rate, word by word."""
    weights = {"bad": 5.0, "badl*": 1.5, "awful": 3.0, "nice": -4.0}
    texts = ["Bad things. Nice bad things! awful", "badly done\nbadly BAD bad", "all nice", "", None, "bad " * 5000 + ". awful", "x. y? z"]

    def by_hand(text):
        floor, clean = 1 / (1 + math.exp(4)), 1.0
        for sentence in re.split(r"[.!?\n]", (text or "").lower()):
            z = 0.0
            for word in set(re.findall(r"\w+", sentence)):
                z += weights.get(word, 0) + sum(weights.get(word[:n] + "*", 0) for n in range(4, 9) if n < len(word))
            clean *= 1 - max(0, (1 / (1 + math.exp(4 - z)) - floor) / (1 - floor))
        return 1 - clean

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in op8_toxicity.score(df, op8_toxicity.Model(weights), "doc_id").collect()}
    assert got == pytest.approx({i: by_hand(t) for i, t in enumerate(texts)}, abs=1e-9)


def test_toxic_fit_finds_the_word_that_labels_follow():
    rng = np.random.default_rng(5)
    bags, y = [], []
    for i in range(300):
        toxic = i % 3 == 0
        bags.append([[int(rng.integers(1, 4))], *([[0]] if toxic or rng.random() < 0.02 else [])])
        y.append(float(toxic))
    w = op8_toxicity.fit(bags, np.array(y), np.full(4, 0.5), steps=600)
    assert w[0] - max(w[1:]) > 3


def test_toxic_rows_that_repeat_teach_once(spark):
    rng = random.Random(14)
    rows = [(i, words(rng, 12) + (" zzvile" if i % 5 == 0 else "")) for i in range(400)]
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    once, often = (spark.createDataFrame(x, "doc_id long, text string") for x in (rows, rows * 3))
    assert op8_toxicity.learn(once, marks).weights == pytest.approx(op8_toxicity.learn(often, marks).weights)


# licences


def test_licence_predictions_from_their_definition():
    """A softmax over summed n-gram weights at a temperature, then the comparison with templates."""
    rng = random.Random(2)
    model = op1_licenses.train([words(rng, 20) for _ in range(200)])
    texts = [t for ts in op1_licenses.TEMPLATES.values() for t in ts] + op1_licenses.OTHERS + ["", "license", "all rights reserved seats were sold out by then"]
    for text in texts:
        tokens = re.findall(r"[^\W_]+", text.lower())
        pairs = set(zip(tokens, tokens[1:]))
        z = list(model.offset)
        for gram in {*tokens, *pairs}:
            if gram in model.weights:
                z = [a + b for a, b in zip(z, model.weights[gram])]
        p = [math.exp(x / model.temperature) for x in z]
        best = max(range(len(p)), key=lambda i: p[i])
        family = op1_licenses.FAMILIES[best] if p[best] / sum(p) >= op1_licenses.PROBABLE else "unknown"
        assert model.predict(tokens) == (family, pytest.approx(p[best] / sum(p)))
        found = op1_licenses.judge(model, text)
        if family == "unknown":
            assert found is None
            continue
        like = 0.0
        for t in op1_licenses.TEMPLATES[family]:
            other = re.findall(r"[^\W_]+", t.lower())
            theirs = set(zip(other, other[1:]))
            if len(theirs) > op1_licenses.SHORT:
                like = max(like, len(pairs & theirs) / max(1, min(len(pairs), len(theirs))))
            else:
                for sentence in re.split(r"[.;!?](?:\s+|$)", text.lower()):
                    mine = re.findall(r"[^\W_]+", sentence)
                    own = set(zip(mine, mine[1:])) or set(mine)
                    like = max(like, len(own & theirs) / max(1, len(own), len(theirs)))
        assert found == ((family, pytest.approx(p[best] / sum(p)), pytest.approx(like)) if like >= op1_licenses.LIKENESS else None)


def test_wrapped_licences_are_found_in_texts():
    rng = random.Random(3)
    model = op1_licenses.train([words(rng, 20) for _ in range(200)])
    for family in ("apache-2.0", "mit", "bsd", "isc", "gpl"):
        notice = max(op1_licenses.TEMPLATES[family], key=len)
        wrapped = textwrap.fill(notice, 50)
        text = words(rng, 10) + "\n" + words(rng, 10) + "\n\n" + wrapped + "\n\n" + words(rng, 2500)
        found = op1_licenses.scan_text(model, text)
        assert {m[2] for m in found} == {family}
        at = text.index(wrapped)
        assert sum(m[1] - m[0] for m in found) > 0.7 * len(wrapped) and all(at <= m[0] < m[1] <= at + len(wrapped) for m in found)


def test_licence_paragraphs(spark, docs, empty):
    rng = random.Random(2)
    model = op1_licenses.train([words(rng, 20) for _ in range(200)])
    for family, texts in op1_licenses.TEMPLATES.items():
        for text in texts:
            found = op1_licenses.scan_text(model, "some words\n" + text + "\nmore")
            assert [(m[0], m[1], m[2]) for m in found] == [(11, 11 + len(text), family)]
    assert not any(op1_licenses.scan_text(model, t) for t in op1_licenses.OTHERS)
    rows = op1_licenses.scan(docs, op1_licenses.learn(docs), "doc_id")
    assert rows.count() == docs.count() and rows.where(F.size("matches") > 0).count() == 0
    assert op1_licenses.scan(empty, op1_licenses.learn(empty), "doc_id").count() == 0


# near duplicates


def test_every_link_of_the_documents(spark):
    """All pairs of the smallest tables' documents, by plain sets."""
    folder = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    links, roots = near_by_hand([t for _, t in docs])
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in op9_jaccard_join.query(spark, folder).collect()}
    assert got == {i: (docs[root][0], n) for (i, _), n, root in zip(docs, links, roots)} and sum(links)


def five_words(text):
    """The plain sets of five words; a shorter text is one of all its words."""
    found = re.findall(r"\w+", (text or "").lower())
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def near_by_hand(texts):
    sets = list(map(five_words, texts))
    links, root = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            links[i] += 1
            links[j] += 1
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return links, [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("tile", [1500, 7])
def test_join_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(op9_jaccard_join, "TILE_CLASSES", tile)
    monkeypatch.setattr(op9_jaccard_join, "TILE_SHARE", 1000)
    rng = random.Random(7)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(60)] + [None, "", "one two", "one two", "one two three"]
    base = words(rng, 120).split()
    for _ in range(40):  # near copies, all of one text
        copy = list(base)
        copy[rng.randrange(120)] = "edited" + str(rng.random())
        texts.append(" ".join(copy))
    shared = words(rng, 40)
    texts += [shared + " " + words(rng, rng.choice([5, 60])) for _ in range(20)]
    texts += [texts[70]] * 5
    for _ in range(6):  # a chain
        chain = texts[-1].split()
        chain[rng.randrange(len(chain))] = "c" + str(rng.random())
        texts.append(" ".join(chain))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links, root = near_by_hand(texts)
    got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in op9_jaccard_join.join(df).collect()}
    assert got == {i: (links[i], root[i]) for i in range(len(texts))}
    kept = sorted(r["doc_id"] for r in op9_jaccard_join.first_of_each(df).collect())
    assert kept == sorted(set(root))


def test_common_members_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 200))) for _ in range(60)]
    i, j = map(np.array, zip(*itertools.combinations(range(60), 2)))
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert list(op9_jaccard_join.common_members(sets, i, j)) == want
    assert list(op9_jaccard_join.common_members(sets, i[:3], j[:3])) == want[:3]


def test_join_corner_cases(docs, empty):
    rows = op9_jaccard_join.join(docs)
    assert rows.count() == docs.count() and op9_jaccard_join.join(empty).count() == 0
    assert {r["n_links"] for r in rows.where("doc_id = 3").collect()} == {2}
    assert rows.where("doc_id = 200").first()["class_id"] == 5
    kept = op9_jaccard_join.first_of_each(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 1 and kept.where("doc_id = 200").count() == 0
    assert op9_jaccard_join.first_of_each(empty).count() == 0


def test_rows_without_ids_share_the_class_of_their_copies(spark):
    rng = random.Random(12)
    one, two, three = (words(rng, 40) for _ in range(3))
    near = two.split()
    near[20] = "other"
    near = " ".join(near)  # 31 of 41 grams are shared: no link
    close = two + " more"  # 36 of 37 are
    rows = [(None, one), (5, one), (7, one), (None, two), (None, two), (None, close), (None, near), (9, None), (9, None), (None, None), (4, three), (4, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = counted(op9_jaccard_join.join(df), "doc_id", "class_id", "n_links")
    want = [(None, 4, 3), (5, 4, 3), (7, 4, 3), (4, 4, 3), (4, 4, 0), (None, None, 2), (None, None, 2), (None, None, 2), (None, None, 0), (None, None, 0), (9, 9, 0), (9, 9, 0)]
    assert got == sorted(want, key=str)
    kept = counted(op9_jaccard_join.first_of_each(df), "doc_id", "text")
    first_of_two = [x for x in kept if x[1] in (two, close)]
    assert len(first_of_two) == 1
    assert sorted([x for x in kept if x not in first_of_two], key=str) == sorted([(4, one), (4, three), (None, near), (9, None), (None, None)], key=str)


def test_components_of_large_ids_and_many_edges(spark):
    """Sums of so many ids would pass 2^63."""
    n, base = 1_000_000, 1 << 58
    edges = spark.range(n).select((F.lit(base) + F.col("id")).alias("u"), (F.lit(base) + F.floor(F.col("id") / 1000) * 1000).alias("v"))
    got = op9_jaccard_join.components(edges)
    assert got.count() == n - 1000
    assert got.where(F.col("root") != F.lit(base) + F.floor((F.col("node") - base) / 1000) * 1000).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in op9_jaccard_join.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 120)}


# quality


def test_quality_on_held_out_documents(spark, docs, labels, empty):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(800):
        good = i % 3 > 0
        text = ". ".join(words(rng, 10).capitalize() for _ in range(5)) + "." if good else " | ".join(words(rng, 40).upper().split()) + "!!"
        rows.append((i, text, "en", "a"))
        if i < 500:
            marks.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = op10_quality.learn(df, spark.createDataFrame(marks, "doc_id long, quality int"))
    got = op10_quality.score(df, model, "doc_id").where("doc_id >= 500").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in got]) > 0.97
    assert op10_quality.score(docs, op10_quality.learn(docs, labels), "doc_id").count() == docs.count()
    assert op10_quality.learn(empty, labels) is None and op10_quality.score(empty, None, "doc_id").count() == 0


def test_quality_scores_from_their_definition(spark):
    """Two logistic views, each calibrated and bounded, weighed by a third calibration."""
    rng = np.random.default_rng(6)
    model = op10_quality.Model(rng.normal(0, 1, op10_quality.TEXT_SIZE), rng.normal(0, 1, op10_quality.RECORD_SIZE), np.array([0.7, 0.1]), np.array([1.2, -0.3]), np.array([0.8, 0.5, 0.05]), 2.5)
    rows = [(1, "Some Words here. some WORDS", "a", "en", 27), (2, None, None, None, None), (3, "x " * 3000 + "y" * 5000, "b", None, 11000), (4, "", "a", "de", 0)]

    def by_hand(text, source, lang, n_chars):
        tokens, w, r = (text or "").split(), model.text, model.record
        n, z = len(tokens), model.text[-1]
        if n:
            shapes, hashed = {}, {}
            for t in tokens:
                shape = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "L" if c.isalpha() else c for c in t)
                a = zlib.crc32("".join(c for c, _ in itertools.groupby(shape)).encode()) % 512
                b = 512 + zlib.crc32(t.lower().encode()) % 4096
                shapes[a], hashed[b] = shapes.get(a, 0) + 1, hashed.get(b, 0) + 1
            z += sum(w[a] * (k / n) ** 0.5 for a, k in shapes.items()) + sum(w[b] * 0.3 * k / n for b, k in hashed.items())
            some = len(set(tokens)) / n
            plain = [some, max(map(tokens.count, set(tokens))) / n, sum(a == b for a, b in zip(tokens, tokens[1:])) / n, sum(map(len, tokens)) / n / 10, (1 - some) * min(1, 100 / n), 1 / n]
            z += sum(w[512 + 4096 + i] * x for i, x in enumerate(plain))
        length = None if n_chars is None else int(2 * math.log2(n_chars + 1))
        places = {zlib.crc32(x.encode()) % 1024 for x in (f"source {source}", f"lang {lang}", f"both {source} {lang}", f"length {length}")}
        l1, l2 = max(-2.5, min(2.5, 0.7 * z + 0.1)), max(-2.5, min(2.5, 1.2 * (r[-1] + sum(r[i] for i in places)) - 0.3))
        return [1 / (1 + math.exp(-x)) for x in (0.8 * l1 + 0.5 * l2 + 0.05, l1, l2)]

    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    for r in op10_quality.score(df, model, "doc_id").collect():
        want = by_hand(*next(x[1:] for x in rows if x[0] == r["doc_id"]))
        assert [r["score"], r["text_score"], r["record_score"]] == pytest.approx(want, abs=1e-5)


# the pipeline


def test_stages_against_plain_ones(spark, tmp_path):
    """Every stage on what the stage before kept: its decisions recomputed in Python from the operators' own scores and definitions."""
    from tokenizers import Tokenizer

    rng = random.Random(31)
    north, south = (lambda n: " ".join("".join(rng.choices("bdkrst", k=4)) for _ in range(n))), (lambda n: " ".join("".join(rng.choices("aeiolm", k=4)) for _ in range(n)))
    rows = [(i, (north if i % 2 else south)(40) + ".", "ns"[(i + 1) % 2], f"s{i % 3}", 200) for i in range(120)]
    rows += [(200 + i, rows[i][1], rows[i][2], "s1", 200) for i in range(20)]  # copies
    rows += [(300 + i, rows[i][1] + " " + south(1), rows[i][2], "s2", 200) for i in range(20)]  # near copies
    rows += [(400 + i, "!! " * 30 + "12 34 | | $$ " * 5, "n", "s0", 100) for i in range(60)]  # junk
    rows += [(500, None, None, None, None), (None, north(30), "n", "s0", 150)]
    marks = [(i, 1, 0) for i in range(60)] + [(400 + i, 0, 0) for i in range(40)]
    docs = common.durable(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "docs")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {}
    for name, stage in pipeline.STAGES:
        kept[name] = common.durable(stage(spark, docs, str(tmp_path)), name)
        before, docs = docs, kept[name]
        ids = lambda df: sorted((r[0] for r in df.select("doc_id").collect()), key=str)
        if name == "quality":
            model = op10_quality.learn(before, spark.read.parquet(str(tmp_path / "labels.parquet")))
            tokens = common.Kept(op10_quality.token_features)
            assert ids(docs) == sorted((i for i, text, lang, source, n in rows if model.score(tokens, text or "", source, lang, n)[0] >= 0.5), key=str)
            assert not {400 + i for i in range(60)} & set(ids(docs)) and set(range(120)) <= set(ids(docs))
        if name == "language":
            model = op6_language.learn(before)
            found = [(r["doc_id"], op6_language.identify_texts(model, [r["text"] or ""])) for r in before.collect()]
            assert ids(docs) == sorted((i for i, x in found if x["lang_pred"][0] != "und" and x["score"][0] >= 0.5), key=str)
            assert set(range(120)) <= set(ids(docs)) and 500 not in ids(docs)
        if name == "near_duplicates":
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            texts.sort(key=lambda x: (x[0] is None, x[0] or 0))
            _, root = near_by_hand([t for _, t in texts])
            assert ids(docs) == sorted((texts[i][0] for i in set(root)), key=str)
        if name == "mixing":
            want = {r["doc_id"]: r["copies"] for r in op3_mixing.mix(before).collect()}
            assert {r[0]: r[1] for r in docs.groupBy("doc_id").count().collect()} == {i: n for i, n in want.items() if n}
            for target, taken, _, most in missed(before).values():
                assert abs(taken - target) <= most
        if name == "packing":
            tokenizer = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
            want = [(r["doc_id"], 0, len(x), len(x)) for r in before.collect() for x in [[*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]]]
            assert counted(docs, "doc_id", "start", "length", "doc_tokens") == sorted(want, key=str)
            assert all(r[1] <= 4096 for r in docs.groupBy("sequence_id").agg(F.sum("length")).collect())


def test_stages_on_corner_cases(spark, docs, empty, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for start in (docs, empty):
        rows = start
        for name, stage in pipeline.STAGES:
            rows = common.durable(stage(spark, rows, str(tmp_path)), name)
            if stage is not pipeline.STAGES[-1][1]:
                assert rows.columns == start.columns
        assert rows.columns[:3] == ["doc_id", "start", "length"]


def test_run_applies_the_stages(spark, tmp_path):
    rng = random.Random(1)
    rows = [Row(doc_id=i, text=". ".join(words(rng, 12) for _ in range(8)), lang="en", source=f"s{i % 3}", n_chars=1) for i in range(90)]
    rows += [Row(doc_id=100 + i, text=rows[i].text, lang="en", source="s0", n_chars=1) for i in range(10)]
    spark.createDataFrame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = {r["doc_id"] for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert found and found <= set(range(90))
