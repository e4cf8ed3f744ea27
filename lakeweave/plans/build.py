"""The model graph: raw tables in, every staging, intermediate, mart and report relation out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakeweave.operators.history import content_events
from lakeweave.plans import intermediate, marts, reports
from lakeweave.plans.staging import STAGING
from lakeweave.schemas import SOURCES
from lakeweave.sources.seeds import content_categories, source_metadata

# Relations stored as tables by a pipeline run, in dependency order. The others stay lazy.
STORED = [
    "dim_sources", "dim_content_types", "fct_content", "fct_engagement_metrics",
    "rpt_top_content_by_source", "rpt_content_freshness", "rpt_daily_ingestion_summary",
]


def stage_all(raw: dict[str, DataFrame], as_of: datetime) -> dict[str, DataFrame]:
    """Staged frames by source name, for the sources present."""
    return {name: STAGING[name](df, as_of) for name, df in raw.items()}


def build_content(spark: SparkSession, raw: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """The content fact straight from the raw tables."""
    unified = intermediate.int_content_unified(stage_all(raw, as_of))
    return marts.fct_content(unified, marts.dim_sources(source_metadata(spark), content_categories(spark)))


def build_models(spark: SparkSession, raw: dict[str, DataFrame], as_of: datetime, store=None) -> dict[str, DataFrame]:
    """Every relation by name. ``store(name, df)`` persists a relation and returns what its consumers
    read; without it everything stays one lazy plan."""
    keep = store or (lambda name, df: df)
    staged = stage_all(raw, as_of)
    categories, metadata = content_categories(spark), source_metadata(spark)
    m: dict[str, DataFrame] = {SOURCES[n].raw_table: df for n, df in raw.items()}
    for name, df in staged.items():
        m[f"stg_{SOURCES[name].raw_table}"] = df
    if "reddit" in staged:
        m["int_reddit_posts_enriched"] = intermediate.int_reddit_posts_enriched(staged["reddit"], categories)
    if "steam" in staged:
        m["int_steam_games_enriched"] = intermediate.int_steam_games_enriched(staged["steam"], categories)
    m["int_content_unified"] = unified = keep("int_content_unified", intermediate.int_content_unified(staged))
    m["dim_sources"] = keep("dim_sources", marts.dim_sources(metadata, categories, as_of))
    m["dim_content_types"] = keep("dim_content_types", marts.dim_content_types(categories, as_of))
    m["fct_content"] = keep("fct_content", marts.fct_content(unified, m["dim_sources"], as_of))
    metrics = marts.fct_engagement_metrics(m["fct_content"], as_of)
    m["fct_engagement_metrics"] = keep("fct_engagement_metrics", metrics)
    for name, df in {
        "rpt_top_content_by_source": reports.rpt_top_content_by_source(m["fct_content"]),
        "rpt_content_freshness": reports.rpt_content_freshness(m["fct_content"], as_of),
        "rpt_daily_ingestion_summary": reports.rpt_daily_ingestion_summary(m["fct_engagement_metrics"]),
    }.items():
        m[name] = keep(name, df)
    m["incr_content_events"] = content_events(unified)
    return m
