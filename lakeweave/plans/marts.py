"""Dimensions and facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.keys import surrogate_key
from lakeweave.functions.numbers import round_half_up, stable_sum

# Content type per source.
CONTENT_TYPES = {"reddit": "Post", "steam": "Game", "imdb": "Title", "news": "Article"}


def _audit(df: DataFrame, as_of: datetime | None, *names: str) -> DataFrame:
    """Add the audit timestamps when the caller persists the model."""
    if as_of is None:
        return df
    return df.withColumns({name: F.lit(as_of).cast("timestamp") for name in names})


def dim_sources(metadata: DataFrame, categories: DataFrame, as_of: datetime | None = None) -> DataFrame:
    joined = metadata.join(categories.select("source_name", "category", "subcategory"), "source_name", "left").select(
        surrogate_key(F.col("source_name")).alias("source_key"),
        "source_name", "display_name", "base_url", "crawl_frequency_hours", "is_active", "category", "subcategory",
    )
    return _audit(joined, as_of, "dbt_created_at", "dbt_updated_at")


def dim_content_types(categories: DataFrame, as_of: datetime | None = None) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    typed = categories.select(
        surrogate_key(F.col("source_name")).alias("content_type_key"),
        "source_name",
        F.coalesce(F.try_element_at(labels, F.col("source_name")), F.lit("Unknown")).alias("content_type"),
        "category", "subcategory", "is_active",
    )
    return _audit(typed, as_of, "dbt_created_at")


def fct_content(unified: DataFrame, sources: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per content item of a known source.

    The dimension has one row per source; its size is known to the optimizer, which broadcasts it unasked.
    """
    fact = unified.join(sources.select("source_key", "source_name"), "source_name").select(
        surrogate_key(F.col("content_id")).alias("content_key"),
        "content_id", "source_key", "source_name", "natural_key", "title", "author", "score",
        "created_at", "url", "body", "loaded_at",
    )
    return _audit(fact, as_of, "dbt_created_at")


def fct_engagement_metrics(content: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Daily metrics per source. Partial aggregation leaves one row per task, source and day to shuffle."""
    score = F.col("score")
    daily = (
        content.where(F.col("created_at").isNotNull())
        .groupBy("source_name", F.to_date("created_at").alias("activity_date"))
        .agg(
            F.count("*").alias("content_count"),
            round_half_up(F.avg(score), 2).alias("avg_score"),
            F.max(score).alias("max_score"),
            F.min(score).alias("min_score"),
            stable_sum(score).alias("total_score"),
            F.max("loaded_at").alias("last_loaded_at"),
        )
    )
    keyed = daily.select(surrogate_key(F.col("source_name"), F.col("activity_date")).alias("metric_key"), "*")
    return _audit(keyed, as_of, "dbt_created_at")
