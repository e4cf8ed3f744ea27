"""The growing directory of silver buckets against a dictionary."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeweave.operators import lake as lake_ops
from lakeweave.operators.lake import Lake, Silver, lake_pipeline
from lakeweave.session import work_dir

NOW = datetime(2024, 5, 1, tzinfo=UTC)
SCHEMA = "id string, v int, loaded_at timestamp"


@pytest.fixture
def lake(spark):
    return Lake(spark, work_dir(spark, "test-silver"))


def load(lake, rows, k, bucket_rows, schema=SCHEMA):
    lake.write("raw", "s", lake.spark.createDataFrame(rows, schema), NOW + timedelta(hours=k), f"l{k}")
    status = lake_pipeline(lake, {"s": "id"}, NOW + timedelta(hours=k), bucket_rows=bucket_rows).first()
    assert status.error is None
    return status


def newest(known, rows):
    """How many rows of a load are current after it; ``known`` holds key → row, compared by time, then value."""
    won = {}
    for row in rows:
        best = won.get(row[0]) or known.get(row[0])
        if best is None or (row[2], row[1]) >= (best[2], best[1]):
            won[row[0]] = row
    known.update(won)
    return len(won)


def check_directory(silver, known):
    """Depths and bits cover every hash exactly once, counts are right, and every bucket has the keys that lead to it."""
    state = silver.directory()
    deepest = max(d for d, _ in state.buckets)
    covered = [b + (i << d) for d, b in state.buckets for i in range(1 << (deepest - d))]
    assert sorted(covered) == list(range(1 << deepest))
    assert sum(b.live for b in state.buckets.values()) == len(known)
    assert all(b.live <= silver.bucket_rows and len(b.folders) <= lake_ops.MERGE_FOLDERS for b in state.buckets.values())
    return state


def test_random_loads_equal_a_dictionary(lake):
    """Growing keys, corrections, late rows and ties over 12 loads: many splits and merges, one whole commit on the way."""
    rng, known, old = random.Random(7), {}, lake_ops.FULL_EVERY
    lake_ops.FULL_EVERY = 5
    try:
        silver, seen = Silver(lake, "s", 40), set()
        for k in range(12):
            keys = [f"k{rng.randrange(60 * (k + 1))}" for _ in range(rng.choice([3, 30, 120]))]
            rows = [(key, rng.randrange(5), datetime(2024, 1, rng.randint(1, 9))) for key in keys]
            current = newest(known, rows)
            assert load(lake, rows, k, 40).current == current
            got = {r.id: tuple(r) for r in silver.snapshot("id").collect()}
            assert got == known
            seen |= {b.depth for b in check_directory(silver, known).buckets.values()}
        assert len(seen) > 2
    finally:
        lake_ops.FULL_EVERY = old


def test_a_small_load_adds_only_its_rows(lake):
    rows = [(f"k{i}", 1, datetime(2024, 1, 1)) for i in range(4000)]
    load(lake, rows, 0, 500)
    silver = Silver(lake, "s", 500)
    before = silver.directory()
    assert len(before.buckets) == 16
    assert load(lake, [("k5", 2, datetime(2024, 1, 2)), ("k6", 0, datetime(2023, 1, 1)), ("new", 1, datetime(2024, 1, 1))], 1, 500).current == 2
    after = silver.directory()
    changed = [k for k in after.buckets if after.buckets[k] != before.buckets[k]]
    assert 1 <= len(changed) <= 2 and sum(after.buckets[k].added for k in changed) == 2
    assert lake.read("silver", "s").count() == 4002
    assert silver.snapshot("id").count() == 4001


def test_a_full_bucket_splits_and_leaves_the_others(lake):
    load(lake, [(f"k{i}", 1, datetime(2024, 1, 1)) for i in range(3000)], 0, 1000)
    silver = Silver(lake, "s", 1000)
    before = silver.directory()
    target = max(before.buckets.values(), key=lambda b: b.live)
    pool = lake.spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("id"))
    same = [r.id for r in pool.where(lake_ops._last_bits("id", F.lit(target.depth)) == target.bits).limit(740).collect()]
    load(lake, [(key, 1, datetime(2024, 1, 1)) for key in same], 1, 1000)
    after = silver.directory()
    assert (target.depth, target.bits) not in after.buckets
    children = [b for b in after.buckets.values() if b.depth > target.depth and b.bits % (1 << target.depth) == target.bits]
    assert sum(b.live for b in children) == target.live + 740 and {b.depth for b in children} == {target.depth + 1}
    assert all(before.buckets[k] == after.buckets[k] for k in before.buckets if k != (target.depth, target.bits))
    assert silver.snapshot("id").count() == 3740


def test_a_large_load_splits_in_its_own_commit(lake):
    load(lake, [(f"k{i}", 1, datetime(2024, 1, 1)) for i in range(60)], 0, 100)
    load(lake, [(f"k{i}", 2, datetime(2024, 1, 2)) for i in range(500)], 1, 100)
    silver = Silver(lake, "s", 100)
    state = silver.directory()
    assert state.seq == 2 and len(state.buckets) > 4 and all(b.live <= 100 for b in state.buckets.values())
    load(lake, [("k3", 3, datetime(2024, 1, 3))], 2, 100)
    assert {r.v: r["count"] for r in silver.snapshot("id").groupBy("v").count().collect()} == {2: 499, 3: 1}


def test_a_run_that_dies_before_its_commit_changes_nothing(lake, monkeypatch):
    load(lake, [(f"k{i}", 1, datetime(2024, 1, 1)) for i in range(100)], 0, 30)
    more = [(f"k{i}", 2, datetime(2024, 1, 2)) for i in range(50, 150)]
    with monkeypatch.context() as broken:
        broken.setattr(Silver, "_commit", lambda *a: 1 / 0)
        lake.write("raw", "s", lake.spark.createDataFrame(more, SCHEMA), NOW + timedelta(hours=1), "l1")
        assert lake_pipeline(lake, {"s": "id"}, NOW, bucket_rows=30).first().status == "failed"
    silver = Silver(lake, "s", 30)
    assert silver.snapshot("id").where("v = 2").count() == 0
    assert lake_pipeline(lake, {"s": "id"}, NOW, bucket_rows=30).first().current == 100
    assert sorted((r.id, r.v) for r in silver.snapshot("id").collect()) == sorted((f"k{i}", 2 if i >= 50 else 1) for i in range(150))


def test_two_runs_cannot_commit_under_one_number(lake):
    load(lake, [("a", 1, datetime(2024, 1, 1))], 0, 10)
    silver = Silver(lake, "s", 10)
    state = silver.directory()
    silver._commit(state, [], [], [], None)
    with pytest.raises(FileExistsError):
        silver._commit(state, [], [], [], None)


def test_new_and_missing_columns(lake):
    load(lake, [("a", 1, datetime(2024, 1, 1)), ("b", 1, datetime(2024, 1, 1))], 0, 10)
    load(lake, [("b", 2, datetime(2024, 1, 2), "x")], 1, 10, SCHEMA + ", extra string")
    load(lake, [("c", datetime(2024, 1, 3))], 2, 10, "id string, loaded_at timestamp")
    rows = {r.id: (r.v, r.extra) for r in Silver(lake, "s", 10).snapshot("id").collect()}
    assert rows == {"a": (1, None), "b": (2, "x"), "c": (None, None)}


def test_an_unfinished_raw_version_is_not_taken(lake, spark):
    load(lake, [("a", 1, datetime(2024, 1, 1))], 0, 10)
    spark.createDataFrame([("z",)], "value string").write.text(f"{lake.path('raw', 's')}/ingest_date=2024-05-02/version=open/_temporary")
    assert lake_pipeline(lake, {"s": "id"}, NOW).first().status == "skipped"


def test_load_without_usable_rows_and_empty_load(lake):
    assert load(lake, [(None, 1, datetime(2024, 1, 1))], 0, 10).rejected == 1
    assert Silver(lake, "s").snapshot("id") is None
    assert load(lake, [], 1, 10).current == 0
    assert load(lake, [("a", 1, datetime(2024, 1, 1))], 2, 10).current == 1
    assert Silver(lake, "s").snapshot("id").count() == 1


def test_an_empty_version_beside_others(lake, spark):
    for k, rows in enumerate([[("a", 1, datetime(2024, 1, 1))], [], [("b", 1, datetime(2024, 1, 1))]]):
        lake.write("raw", "s", spark.createDataFrame(rows, SCHEMA), NOW + timedelta(hours=k), f"l{k}")
    status = lake_pipeline(lake, {"s": "id"}, NOW).first()
    assert (status.versions, status.rows, status.current) == (3, 2, 2)
    assert lake_pipeline(lake, {"s": "id"}, NOW).first().status == "skipped"


def test_reads_open_no_footer_for_columns(lake, spark):
    lake.write("raw", "s", spark.createDataFrame([("a", 1)], "id string, v int"), NOW, "l0")
    lake.write("raw", "s", spark.createDataFrame([("b", "x")], "id string, extra string"), NOW, "l1")
    lake.write("raw", "s", spark.createDataFrame([("c", 1)], "id string, v int"), NOW, "l2")
    assert lake.columns("raw", "s").names == ["id", "v", "extra"]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("columns", "read")
    read = lake.read("raw", "s")
    spark.sparkContext.setJobGroup("other", "x")
    assert not jobs.getJobIdsForGroup("columns")  # merging footers would be a job
    assert sorted(map(tuple, read.collect()), key=repr) == [("a", 1, None), ("b", None, "x"), ("c", 1, None)]
    lake.write("raw", "s", spark.createDataFrame([("d", "text")], "id string, v string"), NOW, "l3")
    with pytest.raises(ValueError, match="'v'"):
        lake.read("raw", "s")
