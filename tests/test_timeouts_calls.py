"""How often timeouts call the state store: by batch and not by row."""

from collections import Counter

from pyspark.sql import Row

from terrace.streaming.timeouts import Silence


class Store:
    """A state store of one key that counts calls."""

    def __init__(self):
        self.calls, self.timers, self.values, self.value = Counter(), set(), [], None

    def getListState(self, *_):
        return ListState(self)

    def getValueState(self, *_):
        return ValueState(self)

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)


class ListState:
    def __init__(self, store):
        self.store = store

    def get(self):
        self.store.calls["get"] += 1
        return iter(list(self.store.values))

    def appendValue(self, x):
        self.store.calls["append"] += 1
        self.store.values.append(x)

    def put(self, xs):
        self.store.values = list(xs)

    def clear(self):
        self.store.values = []


class ValueState:
    def __init__(self, store):
        self.store = store

    def exists(self):
        return self.store.value is not None

    def get(self):
        return self.store.value

    def update(self, x):
        self.store.value = x


class Watermark:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def test_calls_go_with_batches(spark):
    store, silence = Store(), Silence(60, 300)
    silence.init(store)
    rows = [Row(at=i * 1_000_000, event=i if i % 7 else None) for i in range(1000)] + [Row(at=5_000_000, event=None)] * 2
    assert not list(silence.handleInputRows(("k",), iter(rows), None))
    assert store.calls["append"] == 1 and len(store.timers) == 1
    got, now = [], 500_000
    while due := [t for t in sorted(store.timers) if t < now]:
        for t in due:
            store.timers.discard(t)
            got += silence.handleExpiredTimer(("k",), Watermark(now), None)
        now = 2_000_000
    assert [tuple(x) for x in got] == [("k", 999, "soft_timeout"), ("k", 999, "hard_timeout")]
    assert store.calls["get"] <= 6 and store.calls["timer"] <= 6
