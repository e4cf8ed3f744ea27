"""The event log with keyed state: own clocks, late rows, bounded state, restarts."""

from datetime import datetime, timedelta

import pytest

from lakeweave.session import work_dir
from lakeweave.streaming import event_log, keyed_state

SCHEMA = "content_id string, source_name string, natural_key string, title string, score double, created_at timestamp, loaded_at timestamp"


def row(source, day, n=0):
    at = None if day is None else datetime(2024, 1, 1) + timedelta(days=day)
    return (f"{source}-{day}-{n}", source, "k", "t", 1.0, None, at)


class Feed:
    def __init__(self, spark):
        self.spark, self.folder = spark, work_dir(spark, "test-keyed")
        self.stream = None

    def load(self, rows, horizon_days=7, slots=2):
        df = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{self.folder}/raw")
        self.stream = self.stream or event_log.read_raw_stream(self.spark, f"{self.folder}/raw", df.schema, max_files=1)
        events = event_log.incr_content_events_stream(self.stream)
        query = keyed_state.start_keyed_log(events, f"{self.folder}/log", f"{self.folder}/checkpoint", slots, horizon_days * 86_400)
        query.awaitTermination()
        self.state_rows = (query.lastProgress or {"stateOperators": [{}]})["stateOperators"][0].get("numRowsTotal")
        self.events = events

    def stored(self):
        read = keyed_state.KeyedEventLog(self.spark, f"{self.folder}/log").read(self.events.schema)
        return sorted(r.content_id for r in read.collect())


def test_sources_a_month_apart_and_rows_beyond_the_horizon(spark):
    """Each load is a run of its own: the state survives the restart between them."""
    feed = Feed(spark)
    feed.load([row("news", 60), row("news", 60), row(None, 3)])
    feed.load([row("reddit", 2), row("news", 60)])  # two months behind, but by its own clock new; a known id
    feed.load([row("news", 5), row("news", 5), row("news", None), row("reddit", 2)])  # far behind its own clock, twice; no time at all
    feed.load([row("news", 5), row("news", None), row("news", 61), row(None, 3)])  # late ones again: found in the log
    assert feed.stored() == sorted(r[0] for r in (row("news", 60), row(None, 3), row("reddit", 2), row("news", 5), row("news", None), row("news", 61)))


def test_state_is_bounded_by_the_horizon(spark):
    feed = Feed(spark)
    for week in range(3):
        feed.load([row("news", 10 * week + i / 200, i) for i in range(200)], slots=1)
        assert feed.state_rows <= 200 + 2  # the last days, the clock and the mark of the sweep
    assert len(feed.stored()) == 600


def test_a_repeated_batch_adds_nothing_and_slots_are_fixed(spark):
    feed = Feed(spark)
    feed.load([row("news", d) for d in range(3)])
    log = keyed_state.KeyedEventLog(spark, f"{feed.folder}/log")
    batch = log.read(feed.events.schema).selectExpr("*", "false AS late")
    rows = batch.collect()
    log.write_batch(spark.createDataFrame(rows, batch.schema), 0)
    assert len(feed.stored()) == 3
    with pytest.raises(ValueError, match="slots"):
        keyed_state.start_keyed_log(feed.events, f"{feed.folder}/log", f"{feed.folder}/checkpoint", slots=3)


def test_the_store_is_asked_by_hour_not_by_row():
    """A call goes to another process; a batch makes one of a kind for each hour, however many rows it has."""
    import pandas as pd

    class Store:
        def __init__(self):
            self.held, self.calls = {}, 0

        def call(self, value=None):
            self.calls += 1
            return value

        def exists(self):
            return self.call("value" in self.held)

        def get(self):
            return self.call(self.held["value"])

        def update(self, value):
            self.held["value"] = self.call(value)

        def containsKey(self, key):
            return self.call(key in self.held)

        def getValue(self, key):
            return self.call(self.held[key])

        def updateValue(self, key, value):
            self.held[key] = self.call(value)

        def keys(self):
            return self.call(iter(list(self.held)))

        def iterator(self):
            return self.call(iter(list(self.held.items())))

        def removeKey(self, key):
            self.call(self.held.pop(key))

    class Handle:
        def __init__(self):
            self.stores = []

        def getMapState(self, *_):
            self.stores.append(Store())
            return self.stores[-1]

        getValueState = getMapState

    handle, state = Handle(), keyed_state.SeenEvents(86_400)
    state.init(handle)

    def batch(n):
        at = [1_700_000_000_000_000 + i % 4 * 3_600_000_000 for i in range(n)]
        rows = pd.DataFrame({"event_id": [f"e{i}" for i in range(n)], "at": at, "slot": 0})
        return pd.concat(state.handleInputRows(("s", 0), iter([rows[: n // 2], rows[n // 2 :], rows[:5]]), None))

    assert len(batch(2000)) == 2000 and len(batch(2100)) == 100
    assert sum(s.calls for s in handle.stores) < 60
