import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeweave.catalog import fixtures as fx
from lakeweave.operators import quality as q
from lakeweave.operators.lake import Lake
from lakeweave.operators.warehouse import Warehouse
from lakeweave.plans import analyses, intermediate, marts, reports, staging
from lakeweave.plans.build import build_models
from lakeweave.plans.pipeline import run_pipeline
from lakeweave.session import work_dir
from lakeweave.sources import adapters, seeds

from conftest import SF_DIR

AS_OF = datetime(2024, 2, 1)
DAY = datetime(2024, 1, 3)

CONTENT = (
    "content_id string, source_name string, natural_key string, title string, author string, score double, "
    "created_at timestamp, url string, body string, loaded_at timestamp"
)


def item(i, source="reddit", score=1.0, created=DAY, author="a", loaded=AS_OF):
    return (f"c{i}", source, str(i), "t", author, score, created, "u", "b", loaded)


def test_seeds(spark):
    assert [tuple(r) for r in seeds.content_categories(spark).collect()] == seeds.CONTENT_CATEGORIES
    assert [tuple(r) for r in seeds.source_metadata(spark).collect()] == seeds.SOURCE_METADATA
    assert dict(seeds.source_metadata(spark).dtypes)["crawl_frequency_hours"] == "int"


def test_dimensions(spark):
    dims = marts.dim_sources(seeds.source_metadata(spark), seeds.content_categories(spark), AS_OF).collect()
    assert len({d.source_key for d in dims}) == 4 and all(d.category and d.dbt_updated_at == AS_OF for d in dims)
    more = seeds.content_categories(spark).union(spark.sql("select 'blog', 'x', 'y', true"))
    types = {r.source_name: r.content_type for r in marts.dim_content_types(more).collect()}
    assert types == {"reddit": "Post", "steam": "Game", "imdb": "Title", "news": "Article", "blog": "Unknown"}


def test_staging_drops_null_keys_and_fills_load_time(frame):
    raw = frame(
        [(None, "x", None), ("t3_1", " Hi! ", None), ("t3_2", "y", DAY)], "id string, title string, loaded_at timestamp"
    )
    for name in ("author", "subreddit", "score", "num_comments", "url", "text"):
        raw = raw.withColumn(name, F.lit(" 5 "))
    raw = raw.withColumn("created_utc", F.lit(1704067200).cast("bigint"))
    rows = staging.stg_reddit_posts(raw, AS_OF).orderBy("id").collect()
    assert [(r.id, r.title, r.loaded_at) for r in rows] == [("t3_1", "hi", AS_OF), ("t3_2", "y", DAY)]
    assert rows[0].created_at == datetime(2024, 1, 1) and rows[0].author == "5" and rows[0].score == 5


def test_news_publication_must_be_a_timestamp(frame):
    raw = frame([("u", "t", "a", "s", "1", "soon", "b", None)], "url string, title string, author string, source string, score string, published_at string, body string, loaded_at timestamp")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_news_articles(raw, AS_OF).collect()


def test_enrichment_tiers(frame, spark):
    posts = frame([(i, s, 10) for i, s in enumerate([10000, 1000, 100, 99, None, 0])], "id int, score int, num_comments int")
    got = intermediate.int_reddit_posts_enriched(posts, seeds.content_categories(spark)).orderBy("id").collect()
    assert [r.engagement_tier for r in got] == ["viral", "high", "medium", "low", "low", "low"]
    assert [r.is_popular for r in got] == [True, True, False, False, None, False]
    assert got[2].comment_to_score_pct == -90.0 and got[4].comment_to_score_pct is None and got[5].comment_to_score_pct is None
    assert got[0].category == "Social Media"
    games = frame([(i, p) for i, p in enumerate([None, 0.0, -1.0, 9.99, 10.0, 29.99, 30.0])], "id int, price double")
    tiers = intermediate.int_steam_games_enriched(games, seeds.content_categories(spark).limit(0)).orderBy("id").collect()
    assert [r.price_tier for r in tiers] == ["free", "free", "budget", "budget", "mid", "mid", "premium"]
    assert [r.is_free for r in tiers] == [True, True, False, False, False, False, False] and tiers[0].category is None


def test_union_prunes_the_other_sources(spark):
    unified = intermediate.int_content_unified(
        {n: staging.STAGING[n](df, AS_OF) for n, df in fx.raw_sources(spark, SF_DIR).items()}
    )
    plan = unified.where("source_name = 'steam'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "part.parquet" in plan


def test_year_ranges_keep_the_row(frame, spark):
    raw = frame([("tt1", "2020-2023"), ("tt2", "1999")], "id string, year string")
    for name in ("title", "rating", "votes", "genres", "type", "url"):
        raw = raw.withColumn(name, F.lit("1"))
    raw = raw.withColumn("loaded_at", F.lit(AS_OF))
    got = intermediate.unified_source(staging.stg_imdb_titles(raw, AS_OF), "imdb").orderBy("natural_key").collect()
    assert [r.created_at for r in got] == [None, datetime(1999, 1, 1)]


def test_dimension_join_is_a_size_checked_broadcast(spark):
    """No hint, one broadcast hash join over the whole union, no shuffle."""
    fact = build_models(spark, fx.raw_sources(spark, SF_DIR), AS_OF)["fct_content"]
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "strategy=broadcast" not in fact._jdf.queryExecution().optimizedPlan().toString()


def test_fact_drops_unknown_sources(frame, spark):
    unified = frame([item(1), item(2, "blog")], CONTENT)
    dims = marts.dim_sources(seeds.source_metadata(spark), seeds.content_categories(spark))
    assert [r.content_id for r in marts.fct_content(unified, dims).collect()] == ["c1"]


def test_null_scores_count_in_the_daily_mean(frame):
    content = frame([item(1, score=4.0), item(2, score=None), item(3, "news", 2.0), item(4, "news", 3.0), item(5, created=None)], CONTENT)
    day = reports.rpt_daily_ingestion_summary(marts.fct_engagement_metrics(content)).collect()
    assert len(day) == 1
    assert (day[0].total_content, day[0].reddit_count, day[0].news_count, day[0].steam_count) == (4, 2, 2, 0)
    assert day[0].avg_score_all == 2.25 and day[0].dominant_source == "reddit"


def test_top_content_nulls_last_and_ties_by_id(frame):
    content = frame([item(i, score=s) for i, s in enumerate([None, 5.0, 7.0, 5.0])], CONTENT)
    got = reports.rpt_top_content_by_source(content, 3).orderBy("rank_within_source").collect()
    assert [(r.content_id, r.rank_within_source) for r in got] == [("c2", 1), ("c1", 2), ("c3", 3)]


def test_freshness_status(frame):
    ages = {"reddit": 6, "steam": 24, "news": 24.1}
    content = frame([item(1, s, loaded=AS_OF - timedelta(hours=h)) for s, h in ages.items()], CONTENT)
    got = {r.source_name: (r.hours_since_last_load, r.records_last_24h, r.freshness_status) for r in reports.rpt_content_freshness(content, AS_OF).collect()}
    assert got == {"reddit": (6.0, 1, "fresh"), "steam": (24.0, 1, "stale"), "news": (24.1, 0, "critical")}


def test_percentiles_match_sorted_values(frame):
    rng = random.Random(3)
    values = {"reddit": [float(rng.choice([0, 1, 2, 10**rng.randrange(6), -rng.randrange(50)])) for _ in range(500)],
              "steam": [round(rng.random() * 60, 2) for _ in range(101)], "news": [7.0]}
    content = frame([item(i, s, v) for s, vs in values.items() for i, v in enumerate(vs)] + [item(9, "imdb", None)], CONTENT)

    def exact(vs, p):
        vs, at = sorted(vs), p * (len(vs) - 1)
        low = int(at)
        high = min(low + 1, len(vs) - 1)
        return vs[low] + (vs[high] - vs[low]) * (at - low)

    got = {r.source_name: r for r in analyses.score_percentiles(content).collect()}
    assert set(got) == set(values)
    for source, vs in values.items():
        for name, p in analyses.PERCENTILES.items():
            assert got[source][name] == pytest.approx(exact(vs, p), abs=1e-6)
    share = {r.source_name: r for r in analyses.content_distribution(content).collect()}
    assert share["imdb"].content_count == 1 and share["imdb"].median_score is None and share["imdb"].avg_score is None
    assert share["steam"].median_score == pytest.approx(exact(values["steam"], 0.5), abs=0.006)
    approx = {r.source_name: r.p50 for r in analyses.score_percentiles_approx(content).collect()}
    assert approx["news"] == 7.0


def test_weekly_growth_and_velocity(frame):
    content = frame(
        [item(1, score=10.0, created=datetime(2024, 1, 1)), item(2, score=20.0, created=datetime(2024, 1, 7)),
         item(3, score=30.0, created=datetime(2024, 1, 8)), item(4, "news", None, datetime(2024, 1, 8))], CONTENT)
    weeks = {(r.source_name, r.week_start): r for r in analyses.weekly_growth(content).collect()}
    second = weeks["reddit", datetime(2024, 1, 8)]
    assert second.prev_week_score == 15.0 and second.score_growth_pct == 100.0 and second.volume_growth_pct == -50.0
    assert weeks["news", datetime(2024, 1, 8)].score_growth_pct is None
    days = {(r.source_name, str(r.day)): r for r in analyses.daily_velocity(content).collect()}
    assert days["reddit", "2024-01-07"].score_delta == 10.0 and days["reddit", "2024-01-01"].score_delta is None


def test_top_authors_need_three_items(frame):
    content = frame([item(i, score=float(i), author="x" if i < 3 else "y") for i in range(5)] + [item(7, author=None)], CONTENT)
    got = analyses.top_authors(content).collect()
    assert [(r.author, r.item_count, r.avg_score, r.best_score) for r in got] == [("x", 3, 1.0, 2.0)]


def test_declared_tests_number():
    kinds = [t for t in q.DECLARED_TESTS.values()]
    assert sum(len(t.unique) for t in kinds) == 21 and sum(len(t.not_null) for t in kinds) == 49
    assert sum(len(t.accepted) for t in kinds) == 3 and sum(len(t.references) for t in kinds) == 1
    assert sum(len(t.positive) for t in kinds) == 1 and sum(len(t.not_future) for t in kinds) == 2


def test_data_tests_find_failures(frame):
    df = frame([("a", 1), ("a", -1), (None, 0), ("b", 5), (None, 5)], "k string, v int")
    assert [tuple(r) for r in q.test_unique(df, "k").collect()] == [("a", 2)]
    assert q.test_not_null(df, "k").count() == 2
    assert [tuple(r) for r in q.test_accepted_values(df, "k", ["a"]).collect()] == [("b", 1)]
    assert [r.v for r in q.test_positive_score(df, "v").collect()] == [-1]
    parent = frame([("a",), ("a",)], "key string")
    assert [r.k for r in q.test_relationships(df, "k", parent, "key").collect()] == ["b"]
    dates = frame([(AS_OF + timedelta(minutes=59),), (AS_OF + timedelta(minutes=61),)], "at timestamp")
    assert q.test_not_future_date(dates, "at", AS_OF).count() == 1
    results = q.run_tests({"t": df}, AS_OF, {"t": q.TableTests(("k",), ("k", "v"), {"k": ["a"]}, positive=("v",))})
    got = {(r.test, r.column_name): r.failures for r in results.collect()}
    assert got == {("unique", "k"): 1, ("not_null", "k"): 2, ("not_null", "v"): 0, ("accepted_values", "k"): 1, ("positive_score", "v"): 1}
    assert tuple(q.dq_summary(results).first()) == (1, 4, 5)


def test_all_tests_share_one_pass(spark):
    """One scan per relation and two shuffles for any number of tests."""
    df = fx.table(spark, SF_DIR, "orders")
    tests = q.TableTests(("o_orderkey", "o_custkey"), tuple(df.columns), {"o_orderstatus": ["F"]}, positive=("o_totalprice",))
    results = q.run_tests({"orders": df}, AS_OF, {"orders": tests})
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert results.count() == 10


def test_source_freshness_limits(frame):
    hours = {"reddit": 12, "steam": 49, "imdb": 145, "news": None}
    raw = {
        n: frame([(None if h is None else AS_OF - timedelta(hours=h),)], "loaded_at timestamp") for n, h in hours.items()
    }
    got = {r.source_name: r.status for r in q.source_freshness(raw, AS_OF).collect()}
    assert got == {"reddit": "pass", "steam": "warn", "imdb": "error", "news": "error"}


def test_record_rules(frame):
    titles = frame([("tt1", "a", 9.0, 1), ("tt2", "b", 11.0, 1), ("tt3", "c", -1.0, -2), (None, "d", 10.0, 0), ("tt5", "e", None, 0)],
                   "id string, title string, rating double, votes int")
    valid, rejected = q.validate_records(titles, q.RECORD_RULES["imdb_title"])
    assert sorted(r.title for r in valid.collect()) == ["a", "e"]
    assert {r.title: r.violations for r in rejected.collect()} == {
        "b": ["range:rating"], "c": ["range:rating", "range:votes"], "d": ["missing:id"]}
    ratings = frame([("tt1", 0), ("tt1", 1), ("tt1", 10), ("tt1", 11)], "title_id string, rating int")
    assert sorted(r.rating for r in q.validate_records(ratings, q.RECORD_RULES["imdb_rating"])[0].collect()) == [1, 10]


def test_adapters_and_sentinels(frame):
    games = frame([("1", "n", "$29.99", "r", ["a", "b"], "d", "Jan 1", AS_OF), ("", "n", "Free", "r", [], "d", "", AS_OF)],
                  "app_id string, name string, price string, rating string, genres array<string>, developer string, release_date string, loaded_at timestamp")
    raw = adapters.steam_raw(games)
    good, bad = adapters.split_sentinel_keys(raw, adapters.SOURCES["steam"])
    assert [(r.app_id, r.price, r.genres) for r in good.collect()] == [("1", "29.99", "a, b")]
    assert [r.price for r in bad.collect()] == ["0.0"]
    assert staging.stg_steam_games(raw, AS_OF).where("app_id = '1'").first().price == 29.99


def test_models_on_one_source(spark):
    models = build_models(spark, {"steam": fx.steam_games(spark, SF_DIR)}, AS_OF)
    assert models["fct_content"].select("source_name").distinct().collect()[0][0] == "steam"
    assert "int_reddit_posts_enriched" not in models


def test_pipeline_twice_leaves_the_marts_unchanged(spark):
    lake = Lake(spark, work_dir(spark, "test-pipe"))
    warehouse = Warehouse(spark, work_dir(spark, "test-pipe-wh"), "pipe_test")
    at = datetime(2024, 2, 1, tzinfo=UTC)
    for name in ("reddit", "steam", "news"):
        lake.write("raw", name, fx.RAW[name](spark, SF_DIR), at)
    first = run_pipeline(spark, lake, warehouse, at)
    assert first.status == "SUCCESS", first.tests.where("failures > 0").collect()
    assert {r.source: r.status for r in first.steps.collect()} == {"reddit": "promoted", "steam": "promoted", "imdb": "skipped", "news": "promoted"}

    def state():
        tables = ["fct_content", "fct_engagement_metrics", "rpt_daily_ingestion_summary", "rpt_top_content_by_source"]
        audit = {"dbt_created_at"}
        return {
            t: sorted(map(str, warehouse.table(t).select(*[c for c in warehouse.table(t).columns if c not in audit]).collect()))
            for t in tables
        }

    before, events = state(), first.models["incr_content_events"].count()
    second = run_pipeline(spark, lake, warehouse, at + timedelta(hours=1))
    assert second.status == "SUCCESS" and state() == before
    assert second.models["incr_content_events"].count() == events
    assert warehouse.table("pipeline_runs").count() == 2
    lake.write("raw", "imdb", fx.imdb_titles(spark, SF_DIR).withColumn("title", F.lit(None).cast("string")), at, "bad")
    third = run_pipeline(spark, lake, warehouse, at + timedelta(hours=2))
    assert third.status == "FAILED" and third.tests.where("failures > 0").count() > 0


def test_values_of_any_length_are_counted_by_hash(frame):
    df = frame([("a" * 5000,), ("a" * 5000,), ("a" * 4999 + "b",), (None,)], "k string")
    tests = q.TableTests(("k",), ("k",))
    entries = q.table_entries(q.TestPlan(), "t", df, tests, {}, AS_OF)
    assert {kind for e in entries for _, kind in e.dtypes} <= {"int", "bigint"}
    results = q.run_tests({"t": df}, AS_OF, {"t": tests})
    assert sorted((r.test, r.failures) for r in results.collect()) == [("not_null", 1), ("unique", 1)]
