"""Reports built on the facts. Callers sort at the edge; stored reports need no order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeweave.functions.numbers import round_half_up
from lakeweave.schemas import SOURCE_NAMES


def rpt_top_content_by_source(content: DataFrame, k: int = 10) -> DataFrame:
    """The k best-scored items per source, NULL scores last, ties by content id.

    Catalyst turns the rank filter into a per-task top-k before the shuffle, so even a
    source with most of the rows sends only k rows per task.
    """
    order = Window.partitionBy("source_name").orderBy(F.desc_nulls_last("score"), F.asc("content_id"))
    return (
        content.select("content_id", "source_name", "natural_key", "title", "author", "score", "created_at", "url")
        .withColumn("rank_within_source", F.row_number().over(order))
        .where(F.col("rank_within_source") <= k)
    )


def hours_between(start, end):
    """Hours with microsecond resolution."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def rpt_content_freshness(content: DataFrame, as_of: datetime) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    hours = hours_between(F.col("latest_loaded_at"), now)
    status = (
        F.when(F.col("latest_loaded_at").isNull(), "no_data")
        .when(hours <= 6, "fresh")
        .when(hours <= 24, "stale")
        .otherwise("critical")
    )
    return (
        content.groupBy("source_name")
        .agg(
            F.max("loaded_at").alias("latest_loaded_at"),
            F.count("*").alias("total_records"),
            F.count_if(F.col("loaded_at") >= now - F.expr("interval 24 hours")).alias("records_last_24h"),
        )
        .select(
            "source_name", "latest_loaded_at",
            round_half_up(hours, 1).alias("hours_since_last_load"),
            "total_records", "records_last_24h",
            status.alias("freshness_status"),
        )
    )


def rpt_daily_ingestion_summary(metrics: DataFrame) -> DataFrame:
    """One row per day with counts per source and the day's dominant source, in one aggregation.

    ``max_by`` replaces a correlated lookup per day; equal counts go to the later name.
    """
    n = F.col("content_count")
    per_source = [
        F.sum(F.when(F.col("source_name") == name, n).otherwise(0)).alias(f"{name}_count") for name in SOURCE_NAMES
    ]
    mean = F.sum("total_score") / F.nullif(F.sum(n), F.lit(0)).cast("double")
    return metrics.groupBy("activity_date").agg(
        F.sum(n).alias("total_content"),
        *per_source,
        round_half_up(mean, 2).alias("avg_score_all"),
        F.max_by("source_name", F.struct(n, F.col("source_name"))).alias("dominant_source"),
    )
