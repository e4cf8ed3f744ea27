"""From fetched pages to the raw layer: extract, validate, clean, land."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.text import strip_strings
from lakeweave.operators import extract
from lakeweave.operators.lake import Lake
from lakeweave.operators.monitor import crawl_summary
from lakeweave.operators.quality import RECORD_RULES, validate_records
from lakeweave.schemas import SOURCES
from lakeweave.session import materialized
from lakeweave.sources.adapters import RAW_ADAPTERS, split_sentinel_keys


@dataclass(frozen=True)
class Extractor:
    extract: Callable[[DataFrame], DataFrame]
    rules: str
    record_url: str | None = None


EXTRACTORS = {
    "reddit": Extractor(extract.extract_reddit_posts, "reddit_post", "post_url"),
    "steam": Extractor(extract.extract_steam_games, "steam_game"),
    "imdb": Extractor(extract.extract_imdb_titles, "imdb_title"),
    "news": Extractor(extract.extract_news_articles, "news_article", "article_url"),
}
PAGE_COLUMNS = ["page_id", "item_no", "error", "page_url", "url_source"]


def land_pages(lake: Lake, source: str, pages: DataFrame, at: datetime, version: str | None = None) -> DataFrame:
    """Extract a source's records from ``pages`` (page_id, url, html) into the raw layer.

    Records that break a rule or have no usable key go to ``<source>_rejects``. Pages are parsed once:
    the extraction is checkpointed and feeds records, rejects and the returned summary row.
    """
    spec = EXTRACTORS[source]
    extracted = spec.extract(pages).withColumnRenamed("url", "page_url")
    if spec.record_url:
        extracted = extracted.withColumnRenamed(spec.record_url, "url")
    extracted = materialized(extracted.withColumn("loaded_at", F.lit(at).cast("timestamp")))

    records = extracted.where(F.col("error").isNull())
    valid, broken = validate_records(records, RECORD_RULES[spec.rules])
    cleaned = strip_strings(valid.drop(*PAGE_COLUMNS))
    raw, keyless = split_sentinel_keys(RAW_ADAPTERS[source](cleaned), SOURCES[source])
    lake.write("raw", source, raw, at, version)
    rejects = broken.select(F.to_json(F.struct(*broken.drop("violations").columns)).alias("record"), "violations")
    no_key = keyless.select(F.to_json(F.struct(*keyless.columns)).alias("record"), F.array(F.lit("placeholder key")).alias("violations"))
    lake.write("raw", f"{source}_rejects", rejects.unionByName(no_key), at, version)

    per_page = extracted.groupBy("page_id").agg(
        F.count_if(F.col("error").isNull()).alias("n_records"), F.nullif(F.count("error"), F.lit(0)).alias("error")
    )
    fetched = pages.select("page_id").join(per_page, "page_id", "left")
    when = F.lit(at).cast("timestamp")
    return crawl_summary(
        fetched.select(F.lit(source).alias("profile"), "n_records", "error", when.alias("started_at"), when.alias("ended_at"))
    )
