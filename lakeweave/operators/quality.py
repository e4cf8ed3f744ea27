"""Declarative data tests: each one alone returns its failing rows; together they share one pass per relation."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.casts import safe_double
from lakeweave.schemas import SOURCE_NAMES, SOURCES


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their frequency."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n_records"))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def test_positive_score(df: DataFrame, column: str) -> DataFrame:
    """Negative values; zero passes."""
    return df.where(F.col(column) < 0)


def test_not_future_date(df: DataFrame, column: str, as_of: datetime) -> DataFrame:
    """Timestamps more than an hour ahead of ``as_of``."""
    return df.where(F.col(column) > F.lit(as_of).cast("timestamp") + F.expr("interval 1 hour"))


def test_orphans(content: DataFrame, sources: DataFrame) -> DataFrame:
    """Facts of a source the dimension does not know."""
    return content.join(sources.select("source_name"), "source_name", "left_anti").select("content_id", "source_name")


def test_event_unique(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_id").agg(F.count("*").alias("occurrence_count")).where(F.col("occurrence_count") > 1)
    )


@dataclass(frozen=True)
class TableTests:
    """The tests declared on one relation."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, list] = field(default_factory=dict)
    not_future: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def size(self) -> int:
        parts = (self.unique, self.not_null, self.accepted, self.not_future, self.positive, self.references)
        return sum(len(p) for p in parts)


# The declared tests per relation.
DECLARED_TESTS: dict[str, TableTests] = {
    "reddit_posts": TableTests(("id",), ("id", "title", "subreddit", "created_utc")),
    "steam_games": TableTests(("app_id",), ("app_id", "name")),
    "imdb_titles": TableTests(("id",), ("id", "title")),
    "news_articles": TableTests(("url",), ("url", "title", "published_at")),
    "stg_reddit_posts": TableTests(("id",), ("id", "title", "subreddit", "created_at"), not_future=("created_at",)),
    "stg_steam_games": TableTests(("app_id",), ("app_id", "name")),
    "stg_imdb_titles": TableTests(("id",), ("id", "title")),
    "stg_news_articles": TableTests(("url",), ("url", "title", "published_at"), not_future=("published_at",)),
    "int_reddit_posts_enriched": TableTests(("id",), ("id", "title")),
    "int_steam_games_enriched": TableTests(("app_id",), ("app_id",)),
    "int_content_unified": TableTests(
        ("content_id",), ("content_id", "source_name"), accepted={"source_name": SOURCE_NAMES}
    ),
    "dim_sources": TableTests(
        ("source_key", "source_name"), ("source_key", "source_name", "display_name"),
        accepted={"source_name": SOURCE_NAMES},
    ),
    "dim_content_types": TableTests(
        ("content_type_key", "source_name"), ("content_type_key", "source_name", "content_type")
    ),
    "fct_content": TableTests(
        ("content_key", "content_id"), ("content_key", "content_id", "source_key", "source_name"),
        references={"source_key": ("dim_sources", "source_key")},
    ),
    "fct_engagement_metrics": TableTests(("metric_key",), ("metric_key", "source_name", "activity_date")),
    "rpt_top_content_by_source": TableTests(
        (), ("content_id", "source_name", "rank_within_source"), positive=("rank_within_source",)
    ),
    "rpt_content_freshness": TableTests(("source_name",), ("source_name",)),
    "rpt_daily_ingestion_summary": TableTests(("activity_date",), ("activity_date",)),
    "incr_content_events": TableTests(
        ("event_id",), ("event_id", "content_id", "source_name", "loaded_at"), accepted={"source_name": SOURCE_NAMES}
    ),
}


def _checks(tests: TableTests, as_of: datetime) -> list[tuple[str, str, Column, Column]]:
    """(test, column, condition under which a row is an entry, value the entry is counted by).

    A row test makes an entry of a failing row; a uniqueness test makes one of every value.
    """
    limit = F.lit(as_of).cast("timestamp") + F.expr("interval 1 hour")
    no_value = F.lit(None).cast("string")
    checks = [("unique", c, F.col(c).isNotNull(), F.col(c).cast("string")) for c in tests.unique]
    checks += [("not_null", c, F.col(c).isNull(), no_value) for c in tests.not_null]
    checks += [("accepted_values", c, ~F.col(c).isin(v), no_value) for c, v in tests.accepted.items()]
    checks += [("not_future_date", c, F.col(c) > limit, no_value) for c in tests.not_future]
    checks += [("positive_score", c, F.col(c) < 0, no_value) for c in tests.positive]
    return checks


@dataclass
class TestPlan:
    """Numbers the tests of a run, so that entries carry one integer instead of three names, and a value as a 128-bit hash: no texts are
    compared or shuffled, whatever their length."""

    rows: list[tuple[int, str, str, str]] = field(default_factory=list)

    def entry(self, relation: str, test: str, column: str, value: Column) -> Column:
        self.rows.append((len(self.rows), relation, test, column))
        return F.struct(F.lit(self.rows[-1][0]).alias("test_no"), F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("second"), value).alias("h2"))


def table_entries(
    plan: TestPlan, name: str, df: DataFrame, tests: TableTests, relations: dict[str, DataFrame], as_of: datetime
) -> list[DataFrame]:
    """Entries (test_no, h1, h2) of all tests on one relation, from a single pass over it.

    Only references need a second pass, an anti join against the parent's keys.
    """
    found = [F.when(condition, plan.entry(name, test, c, value)) for test, c, condition, value in _checks(tests, as_of)]
    entries = [df.select(F.explode(F.array(*found)).alias("e")).where(F.col("e").isNotNull()).select("e.*")]
    for column, (parent, parent_column) in tests.references.items():
        missing = test_relationships(df, column, relations[parent], parent_column)
        entry = plan.entry(name, "relationships", column, F.lit(None).cast("string"))
        entries.append(missing.select(entry.alias("e")).select("e.*"))
    return entries


def run_tests(relations: dict[str, DataFrame], as_of: datetime, declared: dict[str, TableTests] | None = None) -> DataFrame:
    """Failures (relation, test, column_name, failures) of every declared test on the given relations,
    plus the two singular tests where they apply.

    All relations share two aggregations: entries per value, whose partial counts collapse failing rows
    and repeated values before the shuffle, then failures per test. A value seen once is no failure.
    """
    plan, entries = TestPlan(), []
    for name, tests in (DECLARED_TESTS if declared is None else declared).items():
        if name in relations and tests.size:
            entries += table_entries(plan, name, relations[name], tests, relations, as_of)
    if {"fct_content", "dim_sources"} <= set(relations):
        orphans = test_orphans(relations["fct_content"], relations["dim_sources"])
        entry = plan.entry("fct_content", "no_orphans", "source_name", F.lit(None).cast("string"))
        entries.append(orphans.select(entry.alias("e")).select("e.*"))
    if "incr_content_events" in relations:
        entry = plan.entry("incr_content_events", "event_unique", "event_id", F.col("event_id"))
        entries.append(relations["incr_content_events"].select(entry.alias("e")).select("e.*"))

    repeated = [no for no, _, test, _ in plan.rows if test in ("unique", "event_unique")]
    by_value = reduce(DataFrame.unionByName, entries).groupBy("test_no", "h1", "h2").agg(F.count("*").alias("n"))
    failing = F.when(F.col("test_no").isin(repeated), (F.col("n") > 1).cast("bigint")).otherwise(F.col("n"))
    failures = by_value.groupBy("test_no").agg(F.sum(failing).alias("failures"))
    listed = ", ".join(f"({no}, '{relation}', '{test}', '{column}')" for no, relation, test, column in plan.rows)
    declared_tests = by_value.sparkSession.sql(
        f"SELECT * FROM VALUES {listed} AS declared(test_no, relation, test, column_name)"
    )
    return declared_tests.join(failures, "test_no", "left").select(
        "relation", "test", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )


def dq_summary(results: DataFrame) -> DataFrame:
    """Passed, failed and total tests."""
    return results.agg(
        F.count_if(F.col("failures") == 0).alias("passed"),
        F.count_if(F.col("failures") > 0).alias("failed"),
        F.count("*").alias("total"),
    )


def source_freshness(raw: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """Age of the newest load per source against its warn and error limits."""
    now = F.lit(as_of).cast("timestamp")

    def one(name: str, df: DataFrame) -> DataFrame:
        limits = SOURCES[name]
        hours = (F.unix_micros(now) - F.unix_micros(F.col("max_loaded_at"))) / F.lit(3.6e9)
        status = (
            F.when(hours > limits.error_hours, "error").when(hours > limits.warn_hours, "warn").otherwise("pass")
        )
        newest = df.agg(F.max(F.col("loaded_at").cast("timestamp")).alias("max_loaded_at"))
        return newest.select(
            F.lit(name).alias("source_name"),
            "max_loaded_at",
            F.when(F.col("max_loaded_at").isNull(), "error").otherwise(status).alias("status"),
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in raw.items()])


# --- record validation -------------------------------------------------------------------------


@dataclass(frozen=True)
class RecordRules:
    """Required fields, value ranges (low, high; None is open) and number types of one record type."""

    required: tuple[str, ...]
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)


# Record rules per extracted type.
RECORD_RULES: dict[str, RecordRules] = {
    "reddit_post": RecordRules(("id", "title", "author", "subreddit", "url"), {}, {"score": "bigint", "num_comments": "bigint"}),
    "reddit_comment": RecordRules(("id", "post_id", "author", "body"), {}, {"score": "bigint", "depth": "bigint"}),
    "reddit_subreddit": RecordRules(("name",), {"subscribers": (0, None)}, {"subscribers": "bigint"}),
    "steam_game": RecordRules(("app_id", "name"), {"review_count": (0, None)}, {"review_count": "bigint"}),
    "steam_review": RecordRules(("app_id", "author", "rating"), {"helpful_votes": (0, None)}, {"helpful_votes": "bigint"}),
    "imdb_title": RecordRules(
        ("id", "title"), {"rating": (0, 10), "votes": (0, None), "runtime_minutes": (0, None)},
        {"rating": "double", "votes": "bigint", "runtime_minutes": "bigint"},
    ),
    "imdb_rating": RecordRules(("title_id", "rating"), {"rating": (1, 10), "votes": (0, None)}, {"rating": "bigint", "votes": "bigint"}),
    "news_article": RecordRules(("title", "url")),
}


def with_violations(df: DataFrame, rules: RecordRules) -> DataFrame:
    """Add ``violations``, the names of the broken rules in a fixed order (empty for a valid record).

    Numbers may come as text; text that is no number of the rule's type breaks it, and no range is checked then.
    """
    texts = {c for c, kind in df.dtypes if kind == "string"}

    def number(c: str) -> Column:
        if c not in texts or c not in rules.types:
            return F.col(c)
        return safe_double(F.trim(c)) if rules.types[c] == "double" else F.trim(c).try_cast(rules.types[c])

    checks = [F.when(F.col(c).isNull(), f"missing:{c}") for c in rules.required]
    checks += [F.when(F.col(c).isNotNull() & number(c).isNull(), f"type:{c}") for c in rules.types if c in texts]
    for c, (low, high) in rules.ranges.items():
        if c not in df.columns:
            continue
        outside = [cond for cond in (low is not None and number(c) < low, high is not None and number(c) > high) if cond is not False]
        checks.append(F.when(reduce(Column.__or__, outside), f"range:{c}"))
    return df.withColumn("violations", F.array_compact(F.array(*checks)))


def validate_records(df: DataFrame, rules: RecordRules) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected records with their violations)."""
    checked = with_violations(df, rules)
    ok = F.size("violations") == 0
    return checked.where(ok).drop("violations"), checked.where(~ok)
