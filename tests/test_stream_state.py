"""A key's waiting rows are few values of its state, not one a row."""

from pyspark.sql import types as T

from timeloom.streaming import folds


class Cell:
    def __init__(self):
        self.values, self.sent = [], 0

    def exists(self):
        return bool(self.values)

    def put(self, values):
        self.values, self.sent = list(values), self.sent + len(values)

    def update(self, value):
        self.values = [value]

    def get(self):
        return iter(self.values)

    def clear(self):
        self.values = []


class One(Cell):
    def get(self):
        return self.values[0]


class Handle:
    def __init__(self):
        self.list, self.value, self.timers = Cell(), One(), []

    def getListState(self, name, schema):
        return self.list

    def getValueState(self, name, schema):
        return self.value

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


class Passed:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_waiting_rows_are_packed(spark):
    import pandas as pd

    n, handle, walk = 2 * folds.PACKED + 5, Handle(), folds.Scenes(10.0, 1e6)
    names = T.StructType.fromDDL(f"id string, turn long, at long, due long, {walk.facts}").names
    made = folds.processor(walk, names, T.StructType.fromDDL(walk.state))()
    made.init(handle)
    at = [i * 1_000_000 + (50_000_000 if i >= n // 2 else 0) for i in range(n)]
    rows = pd.DataFrame({"id": [str(i) for i in range(n)], "turn": range(n), "at": at, "due": [a + folds.BEHIND for a in at], "end": at, "app": ["ä"] * n, "category": [None] * n}).sample(frac=1, random_state=1)
    assert list(made.handleInputRows(("u",), iter([rows[: n // 3], rows[n // 3 :]]), Passed(0))) == []
    assert handle.list.sent == 3 and len(handle.timers) == 1
    (out,) = made.handleExpiredTimer(("u",), Passed(10**9), None)
    assert list(out.columns) == ["k0", "id", "at", "number", "kind", "role"] and set(out["k0"]) == {"u"}
    assert out["id"].tolist() == [str(i) for i in range(n)] and out["number"].tolist() == [1] * (n // 2) + [2] * (n - n // 2)
    assert not handle.list.exists() and handle.timers == []
