"""Full-text search ranks keys: texts and snippets are of the best chunks alone; blocks end at a number of words, too."""

import pyarrow as pa
from pyspark.sql import functions as F

from timeloom.operators import inverted, search


def test_snippets_of_the_best_alone(spark):
    chunks = spark.range(300).select(F.concat(F.lit("c"), "id").alias("id"), F.lit("t").alias("title"), F.concat(F.lit("apple pie "), F.col("id").cast("string")).alias("text"), F.lit("d").alias("day"))
    tags = spark.range(300).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.lit("n").alias("tag_type"), (F.col("id") % 2).cast("string").alias("tag_value"))
    kept = []

    def keep(df, name):
        kept.append((name, df.columns, df.count()))
        return spark.createDataFrame(df.collect(), df.schema)

    how, rows = search.search(chunks, tags, "apple", 3, keep=keep, tags=["n:1"])
    assert how == "fts" and kept == [("best", ["id", "score"], 3)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 0 and "best" not in plan
    got = rows.collect()
    plain = search.search(chunks, tags, "apple", 3, tags=["n:1"])[1].collect()
    assert got == plain and [r["id"] for r in got] == ["c1", "c101", "c103"] and got[0]["snippet"] == "[apple] pie 1"


def test_blocks_end_at_words(monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 4)
    monkeypatch.setattr(inverted, "BLOCK_WORDS", 10)
    sizes = [3, 3, 3, 3, 30, 1, None, 1, 1, 1, 9, 2]
    words = pa.array([None if n is None else ["w"] * n for n in sizes], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), words], names=["doc", "f0"])
    for cut in (2, 5, 12):
        parts = [batch.slice(i, cut) for i in range(0, len(sizes), cut)]
        assert [b.column("doc").to_pylist() for b in inverted.blocks(iter(parts), 1)] == [[0, 1, 2], [3], [4], [5, 6, 7, 8], [9, 10], [11]]
