"""From extracted records to the raw tables that staging reads.

Extractors emit display values (price text, genre lists, article content); the raw
contract wants plain columns. Rows with a missing or placeholder key go to the rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.casts import parse_price
from lakeweave.schemas import SOURCES, SourceContract


def reddit_raw(records: DataFrame) -> DataFrame:
    return records.select(
        "id", "title", "author", "subreddit",
        F.col("score").cast("string").alias("score"),
        F.col("num_comments").cast("string").alias("num_comments"),
        "url", "created_utc", "text", "loaded_at",
    )


def steam_raw(records: DataFrame) -> DataFrame:
    return records.select(
        "app_id", "name",
        parse_price(F.col("price")).cast("string").alias("price"),
        "rating",
        F.array_join("genres", ", ").alias("genres"),
        "developer", "release_date", "loaded_at",
    )


def imdb_raw(records: DataFrame) -> DataFrame:
    return records.select(
        "id", "title", "year",
        F.col("rating").cast("string").alias("rating"),
        F.col("votes").cast("string").alias("votes"),
        F.array_join("genres", ", ").alias("genres"),
        F.lit(None).cast("string").alias("type"),
        F.lit(None).cast("string").alias("url"),
        "loaded_at",
    )


def news_raw(records: DataFrame) -> DataFrame:
    return records.select(
        "url", "title", "author", "source",
        F.lit(None).cast("string").alias("score"),
        "published_at", F.col("content").alias("body"), "loaded_at",
    )


def split_sentinel_keys(df: DataFrame, contract: SourceContract) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable key, rows whose key is NULL or a placeholder)."""
    bad = F.col(contract.key).isNull() | F.col(contract.key).isin(*contract.sentinel_keys)
    return df.where(~bad), df.where(bad)


RAW_ADAPTERS = {"reddit": reddit_raw, "steam": steam_raw, "imdb": imdb_raw, "news": news_raw}
assert set(RAW_ADAPTERS) == set(SOURCES)
