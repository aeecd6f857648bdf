"""The query language, stored indexes and snippets against plain recomputation."""

import random
import re

import pytest
from pyspark.sql import functions as F

from timeloom.operators import inverted, retrieval, search

FIELDS = ["title", "text"]
WORDS = ["apple", "applet", "pie", "the", "Thé", "b", "tart"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(i, "Äpfel b" if i % 7 else None, " ".join(rng.choices(WORDS, weights=[2, 1, 2, 9, 3, 1, 0.1], k=rng.randint(0, 40))), f"s{i % 4}") for i in range(300)]
    return [*out, (900, None, None, "s1"), (901, "", " . ", "s3"), (902, "tart", "pie " * 50, "s0")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, title string, text string, segment string")


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("ix"))
    inverted.add(folder, docs.where("segment < 's2'").repartition(3), "id", FIELDS)
    inverted.add(folder, docs.where("segment >= 's2'").repartition(2), "id", FIELDS)
    return folder


def plain(text):
    return re.findall(r"[a-z]+", (text or "").lower().replace("é", "e").replace("ä", "a"))


def has(words, *wanted):
    return any(all(a == b if isinstance(b, str) else b(a) for a, b in zip(words[i : i + len(wanted)], wanted)) for i in range(len(words) - len(wanted) + 1))


def near(words, gap, *phrases):
    """By hand: every choice of one place for each phrase."""
    places = [[i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p] for p in phrases]
    return any(all(any(last - gap - len(p) <= y <= last for y in ys) for p, ys in zip(phrases, places)) for last in {x for ys in places for x in ys})


ASKED = {
    "apple": lambda t, w: "apple" in t + w,
    '"apple pie"': lambda t, w: has(w, "apple", "pie"),
    '"the app"*': lambda t, w: has(w, "the", lambda x: x.startswith("app")),
    "app* NOT (pie OR applet)": lambda t, w: has(w, lambda x: x.startswith("app")) and "pie" not in w and "applet" not in w,
    "pie applet": lambda t, w: "pie" in w and "applet" in w,
    "title : b": lambda t, w: "b" in t,
    "text:b AND title : apf*": lambda t, w: "b" in w and "apfel" in t,
    "- title : b": lambda t, w: "b" in w,
    "{title text} : tart": lambda t, w: "tart" in t + w,
    "title : (b OR pie) NOT text : b": lambda t, w: ("b" in t or "pie" in t) and "b" not in w,
    "NEAR(apple pie)": lambda t, w: near(w, 10, ["apple"], ["pie"]),
    'NEAR("apple the" pie applet, 2)': lambda t, w: near(w, 2, ["apple", "the"], ["pie"], ["applet"]),
    "NEAR(tart b, 0)": lambda t, w: near(w, 0, ["tart"], ["b"]),
    "title : NEAR(b apfel, 0)": lambda t, w: near(t, 0, ["b"], ["apfel"]),
    "title : NEAR(b pie, 0)": lambda t, w: False,
}


@pytest.mark.parametrize("ask", list(ASKED))
def test_what_is_found(spark, docs, rows, stored, ask):
    want = {r[0] for r in rows if ASKED[ask](plain(r[1]), plain(r[2]))}
    a, b = ({r["doc"]: round(r["score"], 9) for r in search.bm25(ix, ask).collect()} for ix in (inverted.opened(spark, stored, FIELDS), search.index(docs, "id", FIELDS)))
    assert a == b and set(a) == want


def test_syntax(spark):
    for bad in ("", "AND", '"open', "a)", "(a", "NOT x", "a-b", "NEAR()", "NEAR(a, b)", "other : a", "title :", "{title : a", "a + b"):
        with pytest.raises(search.QuerySyntaxError):
            search.parse(bad)
    assert search.parse("near") == search.Match(("near",)) and search.parse("NEAR") == search.Match(("near",))
    assert search.parse("NEAR(a b*, 3)") == search.Near((search.Match(("a",)), search.Match(("b",), True)), 3)


@pytest.mark.parametrize("ask", ["pie", "tart OR pie", "(apple OR tart) AND b", "the NOT pie", "apple pie", "nothing", "nothing OR tart", '"apple pie" OR tart', "app*"])
@pytest.mark.parametrize("k", [1, 5, 400])
def test_best_by_bounds_equal_best_of_all(spark, stored, ask, k):
    ix = inverted.opened(spark, stored, FIELDS)
    every = sorted(((-int(r["score"] / 1e-6 + 0.5), r["doc"]) for r in search.bm25(ix, ask).collect()))[:k]
    got = [(-int(r["score"] / 1e-6 + 0.5), r["doc"]) for r in inverted.top(ix, ask, k).collect()]
    assert got == every


def test_bounds_leave_blocks_unread(spark, tmp_path):
    """Where a few blocks hold the good documents the others' postings aren't scored."""
    docs = spark.range(40 * inverted.BLOCK).coalesce(1).select("id", F.lit("").alias("title"), F.when(F.col("id") % 997 == 5, "rare rare rare word").otherwise(F.concat(F.lit("word rare "), F.repeat(F.lit("x "), 50))).alias("text"), F.lit("s").alias("segment"))
    docs = docs.where("id < 1000 OR text NOT LIKE 'rare%'")
    inverted.add(str(tmp_path), docs, "id", FIELDS)
    ix = inverted.opened(spark, str(tmp_path), FIELDS)
    tree = search.parse("rare OR word", ix.fields)
    asked, size = search.every_leaf(tree), ix.size().first()
    counts = dict(map(tuple, ix.postings.where("token IN ('rare', 'word')").groupBy("token").agg(F.sum("n")).collect()))
    blocks, _ = inverted.bounded(ix, asked, tree, size["n_docs"], size["avg_length"], counts)
    assert blocks.count() == 40
    best = inverted.top(ix, "rare OR word", 2).collect()
    assert [r["doc"] for r in best[:1]] == [5]
    assert blocks.where(F.col("bound") >= best[0]["score"] - 1e-6).count() <= 4


def test_the_token_reaches_the_scan(spark, stored):
    ix = inverted.opened(spark, stored, FIELDS)
    plan = search.bm25(ix, "pie")._jdf.queryExecution().toString()
    assert "EqualTo(token,pie)" in plan or "In(token, [pie])" in plan
    assert "StringStartsWith(token,ap)" in search.bm25(ix, "ap*")._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan


def test_segments_come_and_go(spark, docs, rows, tmp_path):
    folder = str(tmp_path)
    inverted.add(folder, docs.where("segment = 's0'"), "id", FIELDS)
    found = lambda ix: {r["doc"] for r in search.bm25(ix, "apple").collect()}
    of = lambda *names: {r[0] for r in rows if r[3] in names and "apple" in plain(r[2])}
    assert found(inverted.opened(spark, folder, FIELDS)) == of("s0")
    inverted.add(folder, docs.where("segment IN ('s1', 's2')"), "id", FIELDS)
    both = inverted.opened(spark, folder, FIELDS)
    assert found(both) == of("s0", "s1", "s2") and found(both.of(spark.createDataFrame([("s1",)], "b string"))) == of("s1")
    inverted.remove(folder, spark.createDataFrame([("s1",)], "b string"))
    now = inverted.opened(spark, folder, FIELDS)
    fresh = search.index(docs.where("segment IN ('s0', 's2')"), "id", FIELDS)
    assert now.size().first() == fresh.size().first()
    assert {r["doc"]: round(r["score"], 9) for r in search.bm25(now, "apple pie").collect()} == {r["doc"]: round(r["score"], 9) for r in search.bm25(fresh, "apple pie").collect()}


def snippet_by_hand(text, terms, size):
    parts = re.split(r"\s+", text.strip(" "))
    who = [next((i for i, (t, prefix) in enumerate(terms) if (w.startswith(t) if prefix else w == t)), None) for w in (re.sub(r"^[^a-z0-9]+|[^a-z0-9]+$", "", p.lower()) for p in parts)]
    best = max(((len({x for x in who[i : i + size] if x is not None}), sum(x is not None for x in who[i : i + size]), -i) for i in range(len(parts)) if who[i] is not None), default=None)
    start = 0
    if best:
        first = -best[2]
        last = max(i for i in range(first, min(first + size, len(parts))) if who[i] is not None)
        start = max(0, min(first - (size - 1 - (last - first)) // 2, len(parts) - size))
    shown = " ".join(f"[{p}]" if w is not None else p for p, w in list(zip(parts, who))[start : start + size])
    return ("..." if start else "") + shown + ("..." if start + size < len(parts) else "")


def test_the_best_window_is_shown(spark):
    rng = random.Random(6)
    terms = [("pie", False), ("app", True)]
    texts = [" ".join(rng.choices(["Pie,", "apple", "APPLET.", "x", "y", "pies", "z-z"], weights=[1, 1, 1, 20, 20, 3, 2], k=rng.randint(1, 120))) for _ in range(80)]
    texts += ["pie " + "x " * 40 + "pie apple", "none at all", "pie", ""]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", search.snippet(F.col("t"), terms).alias("s")).collect()
    assert {r["i"]: r["s"] for r in got} == {i: snippet_by_hand(t, terms, 16) for i, t in enumerate(texts)}
    far = next(r["s"] for r in got if r["i"] == 80)
    assert far.endswith("[pie] [apple]") and far.startswith("...")


def test_search_with_a_stored_index(spark, tmp_path):
    chunks = spark.createDataFrame(
        [("a", "b1", "t", "pie apple", "x"), ("b", "b1", "t", "pie", "y"), ("c", "b2", "t", "pie apple", "x")], "id string, build_id string, title string, text string, chunk_type string"
    ).select("*", F.lit("u").alias("user_id"), F.lit("2026-01-01").alias("day"), F.lit(1.0).alias("salience"), F.lit(1.0).alias("confidence"), F.lit(1).alias("sort_key"))
    builds = spark.createDataFrame([("b1", "u", "active", "2026-01-01"), ("b2", "u", "superseded", "2026-01-02")], "id string, user_id string, status string, generated_at string")
    tags = spark.createDataFrame([("a", "k", "v")], "chunk_id string, tag_type string, tag_value string")
    refs = spark.createDataFrame([], "chunk_id string, ref_kind string, ref_id string, role string, weight double")
    inverted.add(str(tmp_path), chunks, "id", FIELDS, "build_id")
    ix = inverted.opened(spark, str(tmp_path), FIELDS, "string")
    store = retrieval.Store({"memory_build": builds, "memory_chunk": chunks, "chunk_tag": tags, "chunk_ref": refs})
    for ask, want in (("pie", ["b", "a"]), ("text : apple", ["a"]), ("title : pie", []), ("apple", ["a"])):
        a, b = (retrieval.search_memory(store, "u", ask, ix=x) for x in (ix, None))
        assert a[0] == b[0] == "fts" and [r["id"] for r in a[1].collect()] == [r["id"] for r in b[1].collect()]
        assert sorted(r["id"] for r in a[1].collect()) == sorted(want)
    assert retrieval.search_memory(store, "u", "pie", ix=ix, chunk_types=["x"])[1].count() == 1
    assert retrieval.search_memory(store, "u", "nowhere : pie", ix=ix)[0] == "like"
