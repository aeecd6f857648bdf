"""Streams into the table store: each batch once, whenever the writer or the stream dies."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.plans.store import TableStore

T0 = datetime(2026, 1, 1)


def spans(spark, *rows):
    df = spark.createDataFrame([(i, u, T0 + timedelta(hours=h), t, n) for i, u, h, t, n in rows], "id string, user_id string, start_at timestamp, text string, line int")
    return df.withColumn("created_at", F.col("start_at"))


def held(store, name, *columns):
    return sorted(map(tuple, store.read(name).select(*columns).collect()), key=str)


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    sink = store.sink("content_span", "from recorder", ["line"])
    sink(spans(spark, ("a", "u", 0, "first", 1), ("b", "u", 30, "x", 2), ("a", "u", 0, "second", 3)), 0)
    assert held(store, "content_span", "id", "text") == [("a", "second"), ("b", "x")] and store.batches("content_span") == {"from recorder": 0}
    sink(spans(spark, ("a", "u", 0, "third", 1), ("c", "v", 1, "y", 2)), 1)
    version, rows = store.current("content_span"), held(store, "content_span", "id", "text")
    # The stream died after the write and before its commit; meanwhile something else changed a row.
    store.upsert("content_span", spans(spark, ("a", "u", 0, "by hand", 1)))
    sink(spans(spark, ("a", "u", 0, "third", 1), ("c", "v", 1, "y", 2)), 1)
    sink(spans(spark, ("a", "u", 0, "first", 1)), 0)
    assert rows == [("a", "third"), ("b", "x"), ("c", "y")] and version != store.current("content_span")
    assert held(store, "content_span", "id", "text") == [("a", "by hand"), ("b", "x"), ("c", "y")]
    assert store.batches("content_span") == {"from recorder": 1}
    other = store.sink("content_span", "another stream")
    other(spans(spark, ("d", "u", 0, "z", 1)), 0)
    assert store.batches("content_span") == {"from recorder": 1, "another stream": 0}


def test_a_write_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    """Between the data and the switch: readers see the table as it was, and the batch, sent again, is merged once."""
    store = TableStore(spark, str(tmp_path))
    sink = store.sink("event", "s")
    event = lambda i, text: spark.createDataFrame([(i, "u", T0, text)], "id string, user_id string, start_at timestamp, payload_json string")
    sink(event("a", "1"), 0)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "_switch", die)
        with pytest.raises(RuntimeError):
            sink(event("b", "2"), 1)
    assert held(store, "event", "id") == [("a",)] and store.batches("event") == {"s": 0}
    sink(event("b", "2"), 1)
    store.vacuum("event")
    assert held(store, "event", "id", "payload_json") == [("a", "1"), ("b", "2")] and store.batches("event") == {"s": 1}


def test_a_stream_that_is_stopped_and_started(spark, tmp_path):
    """The stream's own commit of its last batch is taken away, so that it sends that batch again."""
    store, folder = TableStore(spark, str(tmp_path / "store")), str(tmp_path / "in")
    calls = []

    def run():
        sink = store.sink("event_artifact", "links", ["line"])

        def counted(rows, number):
            calls.append(number)
            sink(rows, number)

        stream = spark.readStream.schema("event_id string, artifact_id string, role string, line int").parquet(folder)
        stream.writeStream.foreachBatch(counted).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    for n in range(2):
        spark.createDataFrame([("e", "a", f"role{n}", 1), ("e", f"a{n}", "x", 2), ("e", f"a{n}", "y", 3)], "event_id string, artifact_id string, role string, line int").write.mode("append").parquet(folder)
        run()
    want = [("a", "role1"), ("a0", "y"), ("a1", "y")]
    assert held(store, "event_artifact", "artifact_id", "role") == want
    version = store.current("event_artifact")
    for name in ("1", ".1.crc"):
        path = tmp_path / "state" / "commits" / name
        if path.exists():
            path.unlink()
    run()
    assert calls == [0, 1, 1] and store.current("event_artifact") == version
    assert held(store, "event_artifact", "artifact_id", "role") == want


def test_the_table_has_no_rows_of_its_own_order(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.upsert("content_span", spans(spark, ("a", "u", 0, "t", 1)), ["line"], days_stay=True)
    assert store.read("content_span").columns == schema.TABLES["content_span"].schema.names
