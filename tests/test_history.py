import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeweave.catalog import fixtures as fx
from lakeweave.operators import history
from lakeweave.plans import intermediate
from lakeweave.plans.build import stage_all
from lakeweave.session import materialized, work_dir
from lakeweave.streaming import event_log

from conftest import SF_DIR

START = datetime(2024, 1, 1)


def expected_versions(rows, changed_only=False):
    """Brute force: (key, value, from, to) of every load."""
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted({(at, v) for k, v, at in rows if k == key})
        if changed_only:
            mine = [m for i, m in enumerate(mine) if i == 0 or m[1] != mine[i - 1][1]]
        for i, (at, v) in enumerate(mine):
            out.append((key, v, at, mine[i + 1][0] if i + 1 < len(mine) else None))
    return sorted(out, key=str)


def random_loads(seed, n=400):
    """Loads where one key holds a third of the rows; hours vary from crowded to empty."""
    rng = random.Random(seed)
    seen, rows = set(), []
    while len(rows) < n:
        key = "hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}"
        at = START + timedelta(minutes=rng.choice([1, 7, 600]) * rng.randrange(300))
        if (key, at) not in seen:
            seen.add((key, at))
            rows.append((key, rng.randrange(3), at))
    return rows


def versions(df):
    return sorted(((r.id, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()), key=str)


def test_scd2_from_history_equals_brute_force(frame):
    for seed in (1, 2):
        rows = random_loads(seed)
        df = frame(rows + rows[:50], "id string, v int, loaded_at timestamp")
        assert versions(history.scd2_from_history(df, "id")) == expected_versions(rows)
        changed = history.scd2_from_history(df, "id", check_cols=["v"])
        assert versions(changed) == expected_versions(rows, changed_only=True)


def test_scd2_apply_replay_equals_history(frame):
    rng = random.Random(5)
    schema = "id string, v int, loaded_at timestamp"
    loads = []
    for day in range(4):
        keys = rng.sample(range(30), 18)
        loads.append([(f"k{k}", rng.randrange(3), START + timedelta(days=day)) for k in keys])
    snapshot = history.scd2_from_history(frame(loads[0], schema), "id")
    for load in loads[1:]:
        snapshot = history.scd2_apply(materialized(snapshot), frame(load, schema), "id")
    everything = history.scd2_from_history(frame([r for load in loads for r in load], schema), "id")
    assert sorted(map(tuple, snapshot.select(*everything.columns).collect()), key=str) == sorted(map(tuple, everything.collect()), key=str)


def test_scd2_apply_ignores_old_and_repeated_loads(frame):
    schema = "id string, v int, loaded_at timestamp"
    base = history.scd2_from_history(frame([("a", 1, START)], schema), "id")
    same = history.scd2_apply(base, frame([("a", 2, START), (None, 3, START)], schema), "id")
    older = history.scd2_apply(base, frame([("a", 2, START - timedelta(days=1))], schema), "id")
    assert versions(same) == versions(older) == [("a", 1, START, None)]


def test_repeated_keys_in_a_load_count_once(frame):
    schema = "id string, v int, loaded_at timestamp"
    base = history.scd2_from_history(frame([("a", 1, START)], schema), "id")
    day = timedelta(days=1)
    got = history.scd2_apply(base, frame([("a", 2, START + day), ("a", 3, START + 2 * day), ("a", 3, START + 2 * day)], schema), "id")
    assert versions(got) == [("a", 1, START, START + 2 * day), ("a", 3, START + 2 * day, None)]


def test_stored_history_equals_one_build(spark, frame):
    """Loads one by one, the last one repeated; a load rewrites no closed version."""
    rng = random.Random(11)
    schema = "id string, v int, loaded_at timestamp"
    table = history.HistoryTable(spark, work_dir(spark, "test-history"), "id")
    assert table.read() is None
    rows = []
    for day in range(4):
        load = [(f"k{k}", rng.randrange(3), START + timedelta(days=day)) for k in rng.sample(range(20), 12)]
        rows += load
        table.apply(frame(load, schema), f"2024-01-0{day + 1}")
    assert versions(table.read()) == expected_versions(rows)
    assert versions(table.apply(frame(load, schema), "2024-01-04")) == expected_versions(rows)
    assert versions(table.read(before="2024-01-03")) == expected_versions([r for r in rows if r[2] < START + timedelta(days=2)])
    assert table.loads() == [f"2024-01-0{d}" for d in range(1, 5)]


def test_as_of(frame):
    schema = "id string, v int, loaded_at timestamp"
    rows = [("a", 1, START), ("a", 2, START + timedelta(days=2)), ("b", 1, START + timedelta(days=1))]
    snapshot = history.scd2_from_history(frame(rows, schema), "id")

    def at(days):
        when = F.lit(START + timedelta(days=days)).cast("timestamp")
        return sorted((r.id, r.v) for r in history.scd2_as_of(snapshot, when).collect())

    assert at(-1) == [] and at(0) == [("a", 1)] and at(1) == [("a", 1), ("b", 1)] and at(2) == [("a", 2), ("b", 1)]


def test_history_scans_its_input_once(spark):
    """Both branches of the stitched window read the same shuffle."""
    loads = fx.steam_load(spark, SF_DIR, 0).select("app_id", "price", "loaded_at")
    loads = loads.unionByName(fx.steam_load(spark, SF_DIR, 1).select("app_id", "price", "loaded_at"))
    result = history.scd2_from_history(loads, "app_id")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan


def _unified(spark):
    return intermediate.int_content_unified(stage_all(fx.raw_sources(spark, SF_DIR), fx.AS_OF))


def test_event_log_replay_rerun_and_refresh(spark):
    unified = _unified(spark).cache()
    total = unified.count()
    cuts = [datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 1, 27), datetime(2024, 3, 1)]
    log = history.EventLog(spark, work_dir(spark, "test-events") + "/log")
    for cut in cuts:
        log.run(unified.where(F.col("loaded_at") <= cut))
    replayed = log.run(unified)
    assert replayed.count() == total
    assert replayed.select("event_id").distinct().count() == total
    full = {r.event_id for r in history.content_events(unified).select("event_id").collect()}
    assert {r.event_id for r in replayed.select("event_id").collect()} == full
    fixed = replayed.where("source_name = 'steam'").withColumn("title", F.lit("fixed")).limit(20)
    corrected = log.upsert(materialized(fixed))
    assert corrected.count() == total and corrected.where("title = 'fixed'").count() == 20
    assert log.run(unified.where(F.col("loaded_at") <= cuts[0]), full_refresh=True).count() < total
    unified.unpersist()


def test_empty_target_loads_everything(spark):
    unified = _unified(spark)
    empty = history.content_events(unified).limit(0)
    assert history.content_events_increment(unified, empty).count() == unified.count()


def test_upsert_and_column_sync(frame):
    target = frame([(1, "a"), (2, "b")], "id int, v string")
    incoming = frame([(2, "B", 1), (3, "C", 1)], "id int, v string, extra int")
    got = sorted(map(tuple, history.upsert_by_key(target, incoming, "id").collect()))
    assert got == [(1, "a", None), (2, "B", 1), (3, "C", 1)]
    synced = history.sync_columns(target, [("v", "string"), ("new", "double")])
    assert synced.dtypes == [("v", "string"), ("new", "double")]


def test_stream_equals_batch(spark):
    """Files of the same events twice: the log holds each event once."""
    folder = work_dir(spark, "test-stream")
    staged, streams = {}, {}
    for name, df in fx.raw_sources(spark, SF_DIR).items():
        path = f"{folder}/raw/{name}"
        df.write.parquet(path)
        df.write.mode("append").parquet(path)
        staged[name] = df
        streams[name] = event_log.read_raw_stream(spark, path, df.schema)
    events = event_log.incr_content_events_stream(intermediate.int_content_unified(stage_all(streams, fx.AS_OF)))
    event_log.start_event_log(events, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    batch = history.content_events(intermediate.int_content_unified(stage_all(staged, fx.AS_OF)))
    stored = history.EventLog(spark, f"{folder}/log").read().select(*batch.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))


def test_stream_keeps_late_rows_of_a_slow_source(spark):
    """A row of 31 January in one batch, one of 2 January in the next: both are stored, and a replayed batch adds nothing."""
    folder = work_dir(spark, "test-late")
    schema = "content_id string, source_name string, natural_key string, title string, score double, created_at timestamp, loaded_at timestamp"
    stream = None
    for batch, (source, day) in enumerate([("news", 31), ("reddit", 2), ("news", 31)]):
        row = (f"{source}-{day}", source, "k", "t", 1.0, None, datetime(2024, 1, day))
        df = spark.createDataFrame([row], schema)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        stream = stream or event_log.read_raw_stream(spark, f"{folder}/raw", df.schema, max_files=1)
        event_log.start_event_log(event_log.incr_content_events_stream(stream), f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
        assert history.EventLog(spark, f"{folder}/log").read().count() == min(batch + 1, 2)


def test_log_follows_the_model_columns(spark):
    unified = _unified(spark)
    log = history.EventLog(spark, work_dir(spark, "test-columns") + "/log")
    usual = history.EVENT_COLUMNS
    log.run(unified.where(F.col("loaded_at") <= datetime(2024, 1, 20)))
    wider = log.run(unified.withColumn("flair", F.lit("new")), columns=[*usual, "flair"])
    assert {r.flair for r in wider.select("flair").distinct().collect()} == {None, "new"}
    narrow = log.run(unified, columns=[c for c in usual if c != "title"])
    assert "title" not in narrow.columns and "flair" not in narrow.columns and narrow.count() == unified.count()


def test_failed_full_refresh_leaves_the_log(spark):
    unified = _unified(spark)
    log = history.EventLog(spark, work_dir(spark, "test-refresh") + "/log")
    total = log.run(unified).count()
    broken = unified.withColumn("title", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        log.run(broken, full_refresh=True)
    assert log.read().count() == total


def test_history_refuses_loads_out_of_order_and_grows_by_changes(spark, frame):
    schema = "id string, v int, loaded_at timestamp"
    path = work_dir(spark, "test-order")
    table = history.HistoryTable(spark, path, "id")
    everyone = [(f"k{i}", 0, START) for i in range(200)]
    table.apply(frame(everyone, schema), "l1")
    for day in (2, 3, 4):
        table.apply(frame([("k1", day, START + timedelta(days=day))], schema), f"l{day}")
    before = versions(table.read())
    for late in ("l15", "l2"):
        with pytest.raises(ValueError, match="in order"):
            table.apply(frame([("k1", 9, START + timedelta(days=1))], schema), late)
    assert versions(table.read()) == before and len(before) == 203
    # The open set of 200 keys is stored once; a load of one key adds its bucket and no more than the load before it is kept.
    bucket = [r for r in table._versions(table._commits(), None, None).collect() if r.dbt_is_current]
    stored = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/open").count()
    assert len(bucket) == 200 and stored < 200 + 2 * 20


def test_new_loads_open_no_closed_file_and_closed_folders_are_merged(spark, frame, monkeypatch):
    monkeypatch.setattr(history, "CLOSED_FOLDERS", 3)
    schema = "id string, v int, loaded_at timestamp"
    path = work_dir(spark, "test-lean")
    table = history.HistoryTable(spark, path, "id")
    table.apply(frame([("a", 0, START), ("b", 0, START)], schema), "l00")
    for day in range(1, 10):
        with monkeypatch.context() as watched:
            read = []
            parts = history.HistoryTable._parts
            watched.setattr(history.HistoryTable, "_parts", lambda self, paths, commits: read.extend(paths) or parts(self, paths, commits))
            watched.setattr(history.HistoryTable, "_merge_closed", lambda self, commits: None) if day != 6 else None
            watched.setattr(history.HistoryTable, "read", lambda self: None)
            table.apply(frame([("a", day, START + timedelta(days=day))], schema), f"l{day:02d}")
        assert day == 6 or not [p for p in read if "/closed/" in p]
    folders = table._closed_folders(table._commits())
    assert folders[0].startswith("upto-l05") and len(folders) == 1 + 4
    got = sorted((r.id, r.v, r.dbt_is_current) for r in table.read().collect())
    assert got == [("a", v, v == 9) for v in range(10)] + [("b", 0, True)]
    assert sorted((r.id, r.v) for r in table.read(before="l03").where("dbt_is_current").collect()) == [("a", 2), ("b", 0)]
    # Repeating the newest load replaces it, what it closed is open again.
    again = table.apply(frame([("b", 5, START + timedelta(days=9))], schema), "l09")
    assert sorted((r.id, r.v) for r in again.where("dbt_is_current").collect()) == [("a", 8), ("b", 5)]


def test_a_writer_that_stops_between_two_days_leaves_no_mixed_log(spark, monkeypatch):
    schema = "event_id string, v int, event_date date"
    rows = [(f"e{k}", 0, (START + timedelta(days=k % 3)).date()) for k in range(9)] + [("none", 0, None)]
    log = history.EventLog(spark, work_dir(spark, "test-upsert") + "/log")
    log.upsert(spark.createDataFrame(rows, schema))
    fixed = spark.createDataFrame([(i, 1, d) for i, _, d in rows if i in ("e0", "e1", "none")], schema)

    def values():
        return {r.event_id: r.v for r in log.read().collect()}

    with monkeypatch.context() as broken:
        broken.setattr(history, "write_once", lambda *a: 1 / 0)  # stops before the days are announced
        with pytest.raises(ZeroDivisionError):
            log.upsert(fixed)
    assert set(values().values()) == {0} and len(values()) == 10
    with monkeypatch.context() as broken:

        def half(self, events, mode, partitions="static", path=None):
            one_day = events.where(F.col("event_date") == rows[0][2])
            one_day.write.mode("overwrite").partitionBy("event_date").option("partitionOverwriteMode", "dynamic").parquet(self.path)
            raise OSError("lost")

        broken.setattr(history.EventLog, "_write", half)  # stops with one of three days in place
        with pytest.raises(OSError, match="lost"):
            log.upsert(fixed)
    expected = {i: int(i in ("e0", "e1", "none")) for i, _, _ in rows}
    assert values() == expected  # announced: the correction counts as a whole
    log.finish()
    assert values() == expected and log._announced() is None
    stored = spark.read.schema(schema).parquet(log.path)
    assert {r.event_id: r.v for r in stored.collect()} == expected
