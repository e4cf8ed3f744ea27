"""Metrics kept by changes against the full build."""

import math
import random
from datetime import date, datetime, timedelta

import pytest

from lakeweave.plans import marts
from lakeweave.plans.metrics_state import MetricsState
from lakeweave.session import work_dir

SCHEMA = "content_id string, source_name string, score double, created_at timestamp, loaded_at timestamp"
DAY0 = datetime(2024, 3, 1)


@pytest.fixture
def state(spark):
    return MetricsState(spark, work_dir(spark, "metrics"))


def row(rng, k):
    created = None if rng.random() < 0.05 else DAY0 + timedelta(days=rng.randrange(6), hours=rng.randrange(24))
    score = rng.choice([None, 0.25, 0.5, 5.0, 7.25, -2.0, 1e6])
    return (f"c{k}", rng.choice(["news", "imdb", None]), score, created, DAY0 + timedelta(days=10, minutes=rng.randrange(50)))


def outcome(df):
    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()), key=repr)


def check(spark, state, rows):
    content = spark.createDataFrame(rows, SCHEMA)
    assert outcome(state.metrics()) == outcome(marts.fct_engagement_metrics(content))
    return content


def test_random_changes_equal_the_full_build(spark, state):
    rng = random.Random(3)
    rows = [row(rng, k) for k in range(80)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    check(spark, state, rows)
    for step in range(5):
        went = rng.sample(rows, rng.randrange(12))
        corrected = [(r[0], r[1], rng.choice([r[2], 2.5, None]), r[3], r[4]) for r in went if rng.random() < 0.7]
        came = corrected + [row(rng, 1000 * (step + 1) + k) for k in range(rng.randrange(6))]
        rows = [r for r in rows if r not in went] + came
        content = spark.createDataFrame(rows, SCHEMA)
        days = state.apply(spark.createDataFrame(came, SCHEMA), spark.createDataFrame(went, SCHEMA), content)
        assert days == {r[3].date() for r in came + went if r[3]}
        check(spark, state, rows)


def test_a_correction_of_one_day_reads_and_writes_that_day(spark, state):
    rows = [(f"c{k}", "news", float(k % 7), DAY0 + timedelta(days=k % 5), DAY0) for k in range(50)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    before = state._newest()["days"]
    fixed = ("c3", "news", 100.0, rows[3][3], DAY0)
    # The content fails if a row is read: nothing has to be aggregated anew when the corrected value is the new extreme and newer.
    content = spark.createDataFrame(rows, SCHEMA).selectExpr("content_id", "source_name", "score", "IF(assert_true(score > 1000) IS NULL, created_at, NULL) AS created_at", "loaded_at")
    newer = (*fixed[:4], DAY0 + timedelta(days=1))
    days = state.apply(spark.createDataFrame([newer], SCHEMA), spark.createDataFrame([], SCHEMA), content)
    after = state._newest()["days"]
    assert days == {date(2024, 3, 4)} and {d for d in after if after[d] != before[d]} == {"2024-03-04"}
    check(spark, state, [*rows, newer])
    state.expire()
    check(spark, state, [*rows, newer])


def test_lost_extremes_are_aggregated_anew(spark, state):
    rows = [("a", "news", 9.0, DAY0, DAY0), ("b", "news", 3.0, DAY0, DAY0), ("c", "news", -1.0, DAY0, DAY0), ("d", "imdb", 9.0, DAY0, DAY0), ("e", None, 1.0, DAY0, DAY0), ("f", None, 2.0, DAY0, DAY0)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    for gone in ("a", "c", "f", "d"):
        went = [r for r in rows if r[0] == gone]
        rows = [r for r in rows if r[0] != gone]
        state.apply(spark.createDataFrame([], SCHEMA), spark.createDataFrame(went, SCHEMA), spark.createDataFrame(rows, SCHEMA))
        check(spark, state, rows)


def test_sums_do_not_drift(spark, state):
    rows = [(f"c{k}", "news", 0.1, DAY0, DAY0) for k in range(31)] + [("big", "news", 1e15, DAY0, DAY0), ("top", "news", 2e15, DAY0, DAY0)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    state.apply(spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows[31:32], SCHEMA), spark.createDataFrame([r for r in rows if r[0] != "big"], SCHEMA))
    assert str(state.partials().first().total) == "2000000000000003.100000000000"


def test_days_that_empty_and_odd_values(spark, state):
    rows = [("a", "news", float("nan"), DAY0, DAY0), ("b", "news", 1.0, DAY0, None), ("c", "news", float("inf"), DAY0 + timedelta(days=1), DAY0), ("d", "x", None, DAY0 + timedelta(days=2), DAY0)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    check(spark, state, rows)
    for gone in ("a", "c", "d", "b"):
        went, rows = [r for r in rows if r[0] == gone], [r for r in rows if r[0] != gone]
        content = spark.createDataFrame(rows, SCHEMA)
        state.apply(spark.createDataFrame([], SCHEMA), spark.createDataFrame(went, SCHEMA), content)
        check(spark, state, rows)
    assert state._newest()["days"] == {} and state.metrics().count() == 0


def test_a_run_that_dies_leaves_the_days_as_they_were(spark, state, monkeypatch):
    rows = [("a", "news", 1.0, DAY0, DAY0)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    with monkeypatch.context() as broken:
        broken.setattr("lakeweave.plans.metrics_state.write_once", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.rebuild(spark.createDataFrame([], SCHEMA))
    check(spark, state, rows)


def test_many_days_are_written_by_many_tasks(spark, state, monkeypatch):
    from lakeweave.plans import metrics_state
    from lakeweave.session import matching_paths

    monkeypatch.setattr(metrics_state, "DAYS_PER_TASK", 2, raising=False)
    rows = [(f"c{k}", "news", 1.0 * k, DAY0 + timedelta(days=k % 40), DAY0) for k in range(200)]
    state.rebuild(spark.createDataFrame(rows, SCHEMA))
    names = [p.rsplit("/", 1)[1] for p in matching_paths(spark, f"{state.path}/days=*/activity_date=*/part-*")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 5
    check(spark, state, rows)


def test_the_columns_read_are_enough(spark, state):
    from lakeweave.plans import metrics_state

    rng = random.Random(4)
    rows = [row(rng, k) for k in range(60)]
    content = spark.createDataFrame(rows, SCHEMA).select(*metrics_state.READ_COLUMNS)
    state.rebuild(content)
    state.apply(content.limit(0), content.where("source_name = 'news'").limit(3), content)
    state.rebuild(content)
    check(spark, state, rows)
