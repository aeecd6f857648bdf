"""The postings of a block, and what building an index exchanges."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from timeloom.operators import inverted


def test_postings_of_a_block_equal_a_plain_walk():
    rng = random.Random(5)
    docs = [(i * 10, f"s{i % 3}", [[rng.choice("abcdé") for _ in range(rng.randrange(6))] for _ in range(2)]) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc": [d[0] for d in docs], "segment": [d[1] for d in docs], "f0": pa.array([d[2][0] for d in docs], pa.list_(pa.string())), "f1": pa.array([d[2][1] for d in docs], pa.list_(pa.string()))})
    made = inverted.postings_of(batch.slice(3, 30), 2, 7)
    got = {}
    for r in (dict(zip(made, row)) for row in zip(*[a.to_pylist() for a in made.values()])):
        assert r["block"] == 7 and r["n"] == (len(r["doc"]) or r["n"])
        places, out = list(zip(r["field"], r["position"])), []
        for doc, length, tf in zip(r["doc"], r["length"], r["tf"]):
            out.append((doc, length, places[:tf]))
            places = places[tf:]
        got[r["segment"], r["token"]] = out if r["token"] else (r["n"], r["length"])
    want = {}
    for doc, segment, fields in docs[3:33]:
        n, length = want.get((segment, ""), (0, [0]))
        size = sum(map(len, fields))
        want[segment, ""] = (n + 1, [length[0] + size])
        for token in {t for f in fields for t in f}:
            want.setdefault((segment, token), []).append((doc, size, [(f, p) for f in range(2) for p, t in enumerate(fields[f]) if t == token]))
    assert got == want


def test_an_index_exchanges_a_row_a_token_and_block(spark, tmp_path):
    docs = spark.range(3 * inverted.BLOCK).coalesce(1).select("id", F.repeat(F.lit("one two "), 40).alias("text"), F.lit("s").alias("segment"))
    stages, doubles = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def exchanged() -> dict:
        rows = stages.stageList(None, False, False, doubles, None)
        return {rows.apply(i).stageId(): rows.apply(i).shuffleWriteRecords() for i in range(rows.size())}

    before = exchanged()
    inverted.add(str(tmp_path), docs, "id", ["text"])
    after = exchanged()
    assert sum(n for k, n in after.items() if k not in before) < 100
    assert inverted.opened(spark, str(tmp_path), ["text"]).size().first().asDict() == {"n_docs": 3 * inverted.BLOCK, "avg_length": 80.0}
