"""Intermediate models: enrichment and the union of all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.keys import surrogate_key
from lakeweave.functions.numbers import growth


def with_category(df: DataFrame, categories: DataFrame, source: str) -> DataFrame:
    """Attach the category of one source to every row, NULL when the source has none.

    One source has one category row, so two scalar subqueries replace a join without keys.
    """
    one = categories.where(F.col("source_name") == source)
    return df.withColumns({name: one.select(name).scalar() for name in ("category", "subcategory")})


def int_reddit_posts_enriched(staged: DataFrame, categories: DataFrame) -> DataFrame:
    score = F.col("score")
    tier = (
        F.when(score >= 10000, "viral").when(score >= 1000, "high").when(score >= 100, "medium").otherwise("low")
    )
    enriched = staged.withColumns(
        {
            "engagement_tier": tier,
            "is_popular": score >= 1000,
            "comment_to_score_pct": growth(F.col("num_comments"), score),
        }
    )
    return with_category(enriched, categories, "reddit")


def int_steam_games_enriched(staged: DataFrame, categories: DataFrame) -> DataFrame:
    price = F.col("price")
    free = price.isNull() | (price == 0)
    tier = F.when(free, "free").when(price < 10, "budget").when(price < 30, "mid").otherwise("premium")
    return with_category(staged.withColumns({"price_tier": tier, "is_free": free}), categories, "steam")


# Each source's projection to the unified columns: natural key, title, author, score, created_at, url, body.
def _unified_columns(source: str) -> dict[str, Column | None]:
    c = F.col
    return {
        "reddit": dict(key=c("id"), title=c("title"), author=c("author"), score=c("score"),
                       created=c("created_at"), url=c("url"), body=c("body")),
        "steam": dict(key=c("app_id"), title=c("name"), author=c("developer"), score=c("price"),
                      created=c("release_date"), url=None, body=c("genres")),
        "imdb": dict(key=c("id"), title=c("title"), author=None, score=c("rating"),
                     created=F.make_date(c("year"), F.lit(1), F.lit(1)), url=c("url"), body=c("genres")),
        "news": dict(key=c("url"), title=c("title"), author=c("author"), score=c("score"),
                     created=c("published_at"), url=c("url"), body=c("body")),
    }[source]


def unified_source(staged: DataFrame, source: str) -> DataFrame:
    """One source in the unified schema. The score is upvotes, price or rating, as the source has it."""
    cols = _unified_columns(source)

    def text(name: str) -> Column:
        value = cols[name]
        return (F.lit(None) if value is None else value).cast("string").alias(name)

    return staged.select(
        surrogate_key(F.lit(source), cols["key"]).alias("content_id"),
        F.lit(source).alias("source_name"),
        cols["key"].cast("string").alias("natural_key"),
        text("title"),
        text("author"),
        cols["score"].cast("double").alias("score"),
        cols["created"].cast("timestamp").alias("created_at"),
        text("url"),
        text("body"),
        "loaded_at",
    )


def int_content_unified(staged: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the given sources. A filter on ``source_name`` prunes the other branches."""
    return reduce(DataFrame.unionByName, [unified_source(df, name) for name, df in staged.items()])


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Row concatenation with the union of the columns; missing ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
