"""Stored test states against the tests over all rows at once."""

import random
from datetime import datetime, timedelta

import pytest

from lakeweave.operators import quality
from lakeweave.operators.quality import TableTests
from lakeweave.operators.quality_state import QualityState
from lakeweave.session import work_dir

AS_OF = datetime(2024, 5, 1)
DECLARED = {
    "items": TableTests(("id", "name"), ("id", "name"), {"kind": ["a", "b"]}, ("at",), ("score",), {"owner": ("people", "pid")}),
    "people": TableTests(("pid",), ("pid",)),
    "fct_content": TableTests(("content_id",), ("content_id",)),
    "dim_sources": TableTests(("source_name",)),
    "incr_content_events": TableTests((), ("event_id",)),
}
SCHEMAS = {
    "items": "id string, name string, kind string, at timestamp, score double, owner int", "people": "pid int", "fct_content": "content_id string, source_name string",
    "dim_sources": "source_name string", "incr_content_events": "event_id string",
}


def version(rng, n):
    pick = rng.choice
    return {
        "items": [
            (pick([None, f"i{rng.randrange(40)}"]), pick(["x", "y", None, f"n{rng.random()}"]), pick(["a", "b", "c", None]), AS_OF + timedelta(hours=pick([-5, 0, 3, 30])), pick([-1.0, 0.0, 1.0, None]), pick([None, 1, 2, 50, 70]))
            for _ in range(n)
        ],
        "people": [(pick([None, 1, 2, 3, rng.randrange(40)]),) for _ in range(n // 4)],
        "fct_content": [(f"c{rng.randrange(50)}", pick([None, "news", "imdb", "blog"])) for _ in range(n)],
        "dim_sources": [(pick(["news", "imdb", None]),) for _ in range(n // 10)],
        "incr_content_events": [(pick([None, f"e{rng.randrange(60)}"]),) for _ in range(n)],
    }


def frames(spark, rows):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}


def outcome(df):
    return sorted(map(tuple, df.collect()))


def test_states_add_up_to_the_tests_of_all_rows(spark):
    rng, state, rows = random.Random(5), QualityState(spark, work_dir(spark, "state"), DECLARED), {n: [] for n in DECLARED}
    for k, n in enumerate([30, 0, 45]):
        new = version(rng, n)
        assert state.add(f"v{k}", frames(spark, new), AS_OF)
        rows = {name: rows[name] + new[name] for name in rows}
        want = outcome(quality.run_tests(frames(spark, rows), AS_OF, DECLARED))
        assert outcome(state.results(AS_OF)) == want and any(r[3] for r in want)
    later = AS_OF + timedelta(hours=12)
    assert outcome(state.results(later)) == outcome(quality.run_tests(frames(spark, rows), later, DECLARED))
    state.compact()
    assert outcome(state.results(AS_OF)) == want and state.versions() == ["v0", "v1", "v2"]
    assert not state.add("v1", {}, AS_OF)  # held, although its folder is gone


def test_a_held_version_is_not_read_again(spark):
    state = QualityState(spark, work_dir(spark, "state"), {"people": DECLARED["people"]})
    assert outcome(state.results(AS_OF)) == [("people", "not_null", "pid", 0), ("people", "unique", "pid", 0)]
    state.add("v0", {"people": spark.createDataFrame([(1,), (2,)], "pid int")}, AS_OF)
    gone = spark.createDataFrame([(0,)], "pid int").selectExpr("assert_true(pid > 0) is null as pid")  # fails if it is read
    assert not state.add("v0", {"people": gone}, AS_OF)
    with pytest.raises(Exception, match="assert|true"):
        state.add("v1", {"people": gone}, AS_OF)
    assert state.versions() == ["v0"]
    state.add("v1", {"people": spark.createDataFrame([(2,)], "pid int")}, AS_OF)
    assert ("people", "unique", "pid", 1) in outcome(state.results(AS_OF))


def test_other_declarations_have_their_own_state(spark):
    path = work_dir(spark, "state")
    QualityState(spark, path, {"people": TableTests(("pid",))}).add("v0", {"people": spark.createDataFrame([(1,), (1,)], "pid int")}, AS_OF)
    assert QualityState(spark, path, {"people": TableTests((), ("pid",))}).versions() == []


def test_a_compacted_state_is_not_shuffled_by_value(spark, capsys):
    from datetime import datetime

    from lakeweave.operators.quality import TableTests
    from lakeweave.operators.quality_state import QualityState
    from lakeweave.session import work_dir

    at = datetime(2024, 1, 1)
    state = QualityState(spark, work_dir(spark, "compacted"), {"t": TableTests(("id",), ("id",))})
    for k in range(2):
        state.add(f"v{k}", {"t": spark.range(5 * k, 5 * k + 6).selectExpr("id")}, at)
    before = sorted(map(tuple, state.results(at).collect()))
    state.compact()
    found = state.results(at)
    assert sorted(map(tuple, found.collect())) == before and ("t", "unique", "id", 1) in before
    capsys.readouterr()
    state.results(at).explain()
    assert "hashpartitioning(test_no" in (plan := capsys.readouterr().out) and ", h1#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
