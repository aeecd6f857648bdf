"""Top-k similarity joins against all pairs, and how few pairs they try."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeloom import queries
from timeloom.operators import overlap, similarity


def vector(words):
    return {w: words.count(w) for w in words}


def cosine(a, b):
    dot = sum(n * b.get(w, 0) for w, n in a.items())
    return dot / (math.sqrt(float(sum(n * n for n in a.values()))) * math.sqrt(float(sum(n * n for n in b.values())))) if dot else 0.0


def best_by_hand(left, right, k):
    out = set()
    for i, a in left.items():
        scored = sorted((-math.floor(cosine(a, b) / 1e-6 + 0.5), j) for j, b in right.items() if cosine(a, b) > 0)
        out |= {(i, j, rank + 1) for rank, (_, j) in enumerate(scored[:k])}
    return out


def counts(spark, side, key):
    return spark.createDataFrame([(i, w, n) for i, v in side.items() for w, n in v.items()], f"{key} long, token string, tf long")


def corpora(rng, n, vocabulary, size, common=()):
    """Texts of words drawn by a power law, each with the common ones."""
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return {i: vector(rng.choices(vocabulary, weights, k=rng.randint(1, size)) + list(common)) for i in range(n)}


@pytest.mark.parametrize(("k", "vocabulary", "common"), [(1, 40, ()), (3, 300, ("all",)), (5, 1000, ("all", "most"))])
def test_top_k_equals_all_pairs(spark, k, vocabulary, common):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(vocabulary)]
    left, right = corpora(rng, 40, words, 12, common), corpora(rng, 150, words, 12, common)
    left[99], right[99] = vector(["nowhere"]), vector(["alone"])
    left[98], right[98], right[97] = vector(["all"]), vector(["all"]), vector(["all"])
    got = similarity.top_k(counts(spark, left, "l"), counts(spark, right, "r"), "l", "r", k)
    assert {(r["l"], r["r"], r["rank"]) for r in got.collect()} == best_by_hand(left, right, k)


def test_fewer_than_k_and_ties(spark):
    left, right = {1: vector(["a", "b"]), 2: vector(["z"])}, {5: vector(["a"]), 4: vector(["a"]), 6: vector(["b", "b"]), 7: vector(["z", "y"])}
    got = similarity.top_k(counts(spark, left, "l"), counts(spark, right, "r"), "l", "r", 5)
    assert sorted((r["l"], r["rank"], r["r"]) for r in got.collect()) == [(1, 1, 4), (1, 2, 5), (1, 3, 6), (2, 1, 7)]
    nothing = counts(spark, {}, "l")
    assert similarity.top_k(nothing, counts(spark, right, "r"), "l", "r", 5).count() == 0


def test_a_word_of_all_texts_makes_no_square(spark):
    """One word in every text and a good partner for each: the rows after the join on words stay below 50 a text."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    texts = [rng.choices(words, k=20) for _ in range(600)]
    left = {i: vector([*t, "all"]) for i, t in enumerate(texts)}
    right = {i * 10 + j: vector([*t[: 20 - j], *rng.choices(words, k=j), "all"]) for i, t in enumerate(texts) for j in range(3)}
    a, b = similarity.postings(counts(spark, left, "l"), counts(spark, right, "r"), "l", "r")
    first = similarity.exact(similarity.seeds(a, b, "l", "r"), a, b, "l", "r")
    assert first.count() < 50 * 600
    rows = similarity.met(a.join(similarity.bounds(first, "l", 2), "l"), b, F.col("_least"))
    assert rows.count() < 50 * 600 < 600 * 1800 / 20
    assert rows.where("token = 'all'").count() == 0
    got = similarity.top_k(counts(spark, left, "l"), counts(spark, right, "r"), "l", "r", 2)
    some = {i: left[i] for i in range(0, 600, 60)}
    assert {(r["l"], r["r"], r["rank"]) for r in got.where("l % 60 = 0").collect()} == best_by_hand(some, right, 2)


T0 = datetime(2026, 1, 1)


def report_by_hand(left, right, gap_minutes, k):
    out = []
    for i, at, text in left:
        for j, bt, other in right:
            words, gap = cosine(vector(text.split()), vector(other.split())), abs((at - bt).total_seconds())
            score = math.floor((words * 0.65 + max(0.0, 1 - gap / 60 / gap_minutes) * 0.35) / 1e-4 + 0.5)
            if score > 0:
                out.append((-score, math.floor(gap / 60 / 1e-2 + 0.5), at, i, j))
    return [x[3:] for x in sorted(out)[:k]]


@pytest.mark.parametrize("kind", ["alike", "unlike", "at once", "few", "far apart"])
def test_report_equals_all_pairs(spark, kind):
    rng = random.Random(len(kind))
    words = [f"word{i}" for i in range({"alike": 8, "unlike": 5000}.get(kind, 200))]
    span = {"at once": 0, "far apart": 40_000_000}.get(kind, 40_000)

    def rows(side, n):
        return [(f"{side}{i:02d}", T0 + timedelta(seconds=rng.randint(0, span)), " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(n)]

    left, right = rows("l", 3 if kind == "few" else 60), rows("r", 2 if kind == "few" else 60)
    frame = lambda x: spark.createDataFrame(x, "id string, start_at timestamp, text string")
    got = overlap.report(frame(left), frame(right), 90.0, 12).collect()
    assert [(r["left_id"], r["right_id"]) for r in got] == report_by_hand(left, right, 90.0, 12)


def test_report_of_empty_sides(spark):
    empty = spark.createDataFrame([], "id string, start_at timestamp, text string")
    some = spark.createDataFrame([("a", T0, "words here"), ("b", None, None)], empty.schema)
    assert overlap.report(empty, some).count() == 0 and overlap.report(some, empty).count() == 0
    assert overlap.report(some, some).count() == 1


@pytest.mark.parametrize("k", [1, 4])
def test_top_k_of_few_equals_all_pairs(spark, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(200)]
    left, right = corpora(rng, 12, words, 12, ("all",)), corpora(rng, 150, words, 12, ("all",))
    left[99], right[99], right[98] = vector(["nowhere"]), vector(["alone"]), vector(["all"])
    got = similarity.top_k_of_few(counts(spark, left, "l"), counts(spark, right, "r").repartition("r"), "l", "r", k)
    assert {(r["l"], r["r"], r["rank"]) for r in got.collect()} == best_by_hand(left, right, k)


def test_pairs_with_a_small_table_stay_where_the_documents_are(spark):
    """Texts are exchanged once; neither their words nor the pairs are, but the best of each partition."""
    plan = queries.tf_cosine_topk(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([x for x in exchanges if "doc_id" in x]) == 1
    assert not [x for x in exchanges if "token" in x]
