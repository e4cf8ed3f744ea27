"""Staging models: one cleaned, typed projection per raw table. Narrow, no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.casts import safe_date, safe_double, safe_int
from lakeweave.functions.text import clean_html, normalize_text, trim_text


def stamped(as_of: datetime | Column) -> Column:
    """``loaded_at``, or ``as_of`` where it is missing."""
    return F.coalesce(F.col("loaded_at").cast("timestamp"), F.lit(as_of).cast("timestamp")).alias("loaded_at")


def stg_reddit_posts(raw: DataFrame, as_of: datetime) -> DataFrame:
    return raw.where(F.col("id").isNotNull()).select(
        "id",
        normalize_text(F.col("title")).alias("title"),
        trim_text(F.col("author")).alias("author"),
        trim_text(F.col("subreddit")).alias("subreddit"),
        safe_int(F.col("score")).alias("score"),
        safe_int(F.col("num_comments")).alias("num_comments"),
        trim_text(F.col("url")).alias("url"),
        F.col("created_utc").cast("timestamp").alias("created_at"),
        clean_html(F.col("text")).alias("body"),
        stamped(as_of),
    )


def stg_steam_games(raw: DataFrame, as_of: datetime) -> DataFrame:
    return raw.where(F.col("app_id").isNotNull()).select(
        F.col("app_id").cast("string").alias("app_id"),
        normalize_text(F.col("name")).alias("name"),
        safe_double(F.col("price")).alias("price"),
        trim_text(F.col("rating")).alias("rating"),
        trim_text(F.col("genres")).alias("genres"),
        trim_text(F.col("developer")).alias("developer"),
        safe_date(F.col("release_date")).alias("release_date"),
        stamped(as_of),
    )


def stg_imdb_titles(raw: DataFrame, as_of: datetime) -> DataFrame:
    return raw.where(F.col("id").isNotNull()).select(
        trim_text(F.col("id")).alias("id"),
        normalize_text(F.col("title")).alias("title"),
        safe_int(F.col("year")).alias("year"),
        safe_double(F.col("rating")).alias("rating"),
        safe_int(F.col("votes")).alias("votes"),
        trim_text(F.col("genres")).alias("genres"),
        trim_text(F.col("type")).alias("type"),
        trim_text(F.col("url")).alias("url"),
        stamped(as_of),
    )


def stg_news_articles(raw: DataFrame, as_of: datetime) -> DataFrame:
    return raw.where(F.col("url").isNotNull()).select(
        trim_text(F.col("url")).alias("url"),
        normalize_text(F.col("title")).alias("title"),
        trim_text(F.col("author")).alias("author"),
        trim_text(F.col("source")).alias("source"),
        safe_int(F.col("score")).alias("score"),
        F.col("published_at").cast("timestamp").alias("published_at"),
        clean_html(F.col("body")).alias("body"),
        stamped(as_of),
    )


STAGING = {
    "reddit": stg_reddit_posts,
    "steam": stg_steam_games,
    "imdb": stg_imdb_titles,
    "news": stg_news_articles,
}
