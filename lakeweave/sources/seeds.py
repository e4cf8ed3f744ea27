"""The two small reference dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# source_name, category, subcategory, is_active.
CONTENT_CATEGORIES = [
    ("reddit", "Social Media", "Discussion", True),
    ("steam", "Gaming", "Reviews", True),
    ("imdb", "Entertainment", "Movies", True),
    ("news", "News", "Articles", True),
]

# source_name, display_name, base_url, crawl_frequency_hours, is_active.
SOURCE_METADATA = [
    ("reddit", "Reddit", "https://www.reddit.com", 6, True),
    ("steam", "Steam", "https://store.steampowered.com", 24, True),
    ("imdb", "IMDb", "https://www.imdb.com", 48, True),
    ("news", "News Aggregator", "https://news.ycombinator.com", 1, True),
]


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal relation: its size is known to the optimizer, and filters on it fold at planning time."""

    def literal(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value).lower()

    listed = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS seed({columns})")


def content_categories(spark: SparkSession) -> DataFrame:
    return _values(spark, CONTENT_CATEGORIES, "source_name, category, subcategory, is_active")


def source_metadata(spark: SparkSession) -> DataFrame:
    return _values(
        spark, SOURCE_METADATA, "source_name, display_name, base_url, crawl_frequency_hours, is_active"
    )
