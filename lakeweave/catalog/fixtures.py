"""Raw sources, pages, logs and monitoring inputs derived from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 2, 1)
SPLIT = datetime(2024, 1, 20)
PAGES_PER_TASK = 20_000


# Declared schemas save a footer-reading job per table and query.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _str(expr: str) -> str:
    return f"cast({expr} as string)"


def reddit_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('t3_', cast(event_id as string)) as id",
        "concat('  Post #', cast(event_id as string), ': ', event_type, '!  ') as title",
        "concat(' user_', cast(user_id as string), ' ') as author",
        "event_type as subreddit",
        "case when event_id % 97 = 0 then 'n/a' else cast(cast(floor(value * 40) as int) as string) end as score",
        "cast(user_id % 50 as string) as num_comments",
        "concat('https://r.example/', event_type, '/', cast(event_id as string)) as url",
        "cast(ts as timestamp) as created_utc",
        "concat('<p>', props, '</p>') as text",
        "cast(ts as timestamp) + interval 6 hour as loaded_at",
    )


def steam_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as app_id",
        "concat(p_name, ' (', p_brand, ')') as name",
        "case when p_partkey % 11 = 0 then 'Free to Play' when p_partkey % 11 = 1 then '0' "
        "else concat(cast((p_partkey * 7) % 60 as string), '.99') end as price",
        "case when p_size > 25 then ' Very Positive ' else 'Mixed' end as rating",
        "p_type as genres",
        "p_brand as developer",
        "case when p_partkey % 13 = 0 then 'Jul 9, 2013' "
        "else concat('2024-01-', lpad(cast(p_partkey % 28 + 1 as string), 2, '0')) end as release_date",
        "timestamp '2024-01-20 00:00:00' + p_size * interval 1 hour as loaded_at",
    )


def imdb_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('tt', lpad(cast(o_orderkey as string), 7, '0')) as id",
        "concat('Title ', cast(o_orderkey as string), ' - ', o_orderpriority) as title",
        "case when o_orderkey % 101 = 0 then '2020-2023' else cast(extract(year from o_orderdate) as string) end as year",
        "concat(cast(cast(floor((o_orderkey % 100) / 10.0) as int) as string), '.', cast(o_orderkey % 10 as string)) as rating",
        "cast(o_custkey as string) as votes",
        "o_orderpriority as genres",
        "case when o_orderstatus = 'F' then 'movie' else 'tvSeries' end as type",
        "concat('https://i.example/title/tt', lpad(cast(o_orderkey as string), 7, '0')) as url",
        "timestamp '2024-01-25 00:00:00' + (o_orderkey % 72) * interval 1 hour as loaded_at",
    )


def news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr(
        "url",
        "regexp_extract(html, '<title>([^<]*)</title>', 1) as title",
        "concat('by ', cast(page_id % 17 as string)) as author",
        "regexp_extract(url, '^https?://([^/]+)', 1) as source",
        "cast(length(html) % 500 as string) as score",
        "timestamp '2024-01-01 00:00:00' + page_id * interval 1 hour as published_at",
        "html as body",
        "timestamp '2024-01-31 00:00:00' + (page_id % 20) * interval 1 hour as loaded_at",
    )


RAW = {"reddit": reddit_posts, "steam": steam_games, "imdb": imdb_titles, "news": news_articles}


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in RAW.items()}


# --- history: three loads of the store, two of the posts ----------------------------------------

STEAM_LOADS = [datetime(2024, 1, 20), datetime(2024, 1, 25), datetime(2024, 1, 30)]


def steam_load(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Load ``k`` of the store: prices move for two thirds of the games."""
    return (
        table(spark, sf_dir, "part")
        .selectExpr(
            "cast(p_partkey as string) as app_id",
            "concat(p_name, ' (', p_brand, ')') as name",
            f"concat(cast((p_partkey * 7 + {k} * (p_partkey % 3)) % 60 as string), '.99') as price",
            "case when p_size > 25 then ' Very Positive ' else 'Mixed' end as rating",
            "p_type as genres",
            "p_brand as developer",
            "cast(null as string) as release_date",
        )
        .withColumn("loaded_at", F.lit(STEAM_LOADS[k]).cast("timestamp"))
    )


def reddit_load(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Load ``k`` of the posts: scores grow with the event value, one day apart."""
    posts = reddit_posts(spark, sf_dir)
    grown = F.expr(f"cast(try_cast(score as int) + {k} * (cast(num_comments as int) % 4) as string)")
    return posts.withColumn("score", grown).withColumn(
        "loaded_at", F.col("loaded_at") + F.expr(f"interval {k} day")
    )


# --- pages with known records ------------------------------------------------------------------


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The test tables are one file with one row group; spread the narrow rows before pages are built from them.

    A task gets so many rows at most, however large the table is. The count comes from the footers.
    """
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // PAGES_PER_TASK)))


def _html(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def reddit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per event with its post and a reply post; every fifth uses the other markup."""
    e = _spread(spark, table(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    c = F.col
    opening = F.when(c("event_id") % 5 == 0, F.lit('<div data-type="link"')).otherwise(F.lit('<div class="thing link odd"'))

    def post(suffix: str, score: Column, comments: Column) -> Column:
        return _html(
            opening, ' data-fullname="t3_', c("event_id"), suffix, '" data-subreddit="', c("event_type"),
            '" data-author="user_', c("user_id"), '" data-score="', score,
            '"><p class="title"><a class="title may-blank" href="/r/', c("event_type"), "/", c("event_id"), suffix,
            '">\n Post &amp; <b>talk</b> ', c("event_id"), '</a></p><a class="comments" href="#">', comments,
            ' comments</a><time datetime="', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), '+00:00">now</time></div>',
        )

    score = F.floor(c("value") * 40).cast("int")
    html = _html(
        "<html><body><div id=siteTable>",
        post("a", F.format_number(score, 0), c("user_id")),
        post("b", F.lit("&bull;"), F.lit("no")),
        "</div></body></html>",
    )
    return e.select(
        c("event_id").alias("page_id"), _html("https://old.r.example/r/", c("event_type"), "?p=", c("event_id")).alias("url"),
        html.alias("html"),
    )


def steam_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part: a store page for even keys, a search result row for odd ones."""
    c = F.col
    price = F.when(c("p_partkey") % 11 == 0, F.lit("Free to Play")).otherwise(F.concat(F.lit("$"), (c("p_partkey") * 7 % 60).cast("string"), F.lit(".99")))
    app = _html(
        '<html><body><div class="apphub_AppName" id="appHubAppName"> ', c("p_name"), ' </div><div class="game_description_snippet">Made by <i>',
        c("p_brand"), '</i></div><div class="game_purchase_price price"> ', price, ' </div><div class="date">Jan ',
        c("p_size"), ', 2024</div><div id="developers_list"><a href="/d">', c("p_brand"),
        '</a></div><div class="details_block"><a>', c("p_type"), '</a><a>A</a><a>B</a><a>C</a><a>D</a><a>E</a></div>',
        '<span class="game_review_summary">', F.when(c("p_size") > 25, "Very Positive").otherwise("Mixed"), "</span></body></html>",
    )
    row = _html(
        '<div id="search_resultsRows"><a class="search_result_row" href="https://store.example/app/', c("p_partkey"),
        '/x/"><span class="title">', c("p_name"), '</span><div class="search_released"> Jan ', c("p_size"),
        ', 2024 </div><div class="search_price"><div class="discount_final_price">', price,
        '</div></div><span class="search_review_summary" data-tooltip-html="Mixed&lt;br&gt;', c("p_size"), '% of reviews"></span></a></div>',
    )
    even = c("p_partkey") % 2 == 0
    return _spread(spark, table(spark, sf_dir, "part")).select(
        c("p_partkey").alias("page_id"),
        _html("https://store.example/app/", c("p_partkey"), "/").alias("url"),
        F.when(even, app).otherwise(row).alias("html"),
    )


def imdb_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order: classic table, modern chart item or title page, by key."""
    c = F.col
    tid = F.concat(F.lit("tt"), F.lpad(c("o_orderkey").cast("string"), 7, "0"))
    rating = F.concat((c("o_orderkey") % 10).cast("string"), F.lit("."), (c("o_custkey") % 10).cast("string"))
    year = F.year("o_orderdate")
    classic = _html(
        '<table><tr><td class="titleColumn">1. <a href="/title/', tid, '/?ref=x">Title ', c("o_orderkey"),
        '</a> <span class="secondaryInfo">(', year, ')</span><td class="ratingColumn imdbRating"><strong title="', rating,
        " based on ", F.format_number(c("o_custkey") * 1000, 0), ' user ratings">', rating, "</strong></table>",
    )
    chart = _html(
        '<ul><li class="ipc-metadata-list-summary-item"><a href="/title/', tid, '/">Title ', c("o_orderkey"),
        '</a><span class="cli-title-metadata-item">', year, '</span><span class="ipc-rating-star--rating">', rating, "</span></ul>",
    )
    single = _html(
        '<h1 data-testid="hero-title-block__title">Title ', c("o_orderkey"),
        '</h1><div data-testid="hero-title-block__metadata"><a>', year,
        '</a></div><div data-testid="hero-rating-bar__aggregate-rating__score"><span>', rating,
        '</span>/10</div><p data-testid="plot">Plot of ', c("o_orderpriority"), '</p><div data-testid="genres"><a>',
        c("o_orderstatus"), "</a><a>Drama</a></div>",
    )
    kind = c("o_orderkey") % 3
    return _spread(spark, table(spark, sf_dir, "orders")).select(
        c("o_orderkey").alias("page_id"),
        F.concat(F.lit("https://i.example/title/"), tid, F.lit("/")).alias("url"),
        F.when(kind == 0, classic).when(kind == 1, chart).otherwise(single).alias("html"),
    )


# --- JSON responses, logs, runs, datasets, rules ------------------------------------------------


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API response per event, in one of eight shapes, around the records k, k+1 and a non-object."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    one = F.concat(F.lit('{"k":'), F.col("k").cast("string"), F.lit("}"))
    two = F.concat(F.lit('{"k":'), (F.col("k") + 1).cast("string"), F.lit("}"))
    pair = F.concat(one, F.lit(", 7, "), two)
    uid = F.col("user_id").cast("string")
    shapes = [
        F.concat(F.lit("["), pair, F.lit("]")),
        F.concat(F.lit('{"data": {"total": 2, "posts": {"edges": [{"node": '), one, F.lit('}, 5, {"node": '), two,
                 F.lit('}], "pageInfo": {"hasNextPage": true, "endCursor": "e'), uid, F.lit('"}}}}')),
        F.concat(F.lit('{"data": {"search": {"items": [], "results": ['), pair, F.lit("]}}}")),
        F.concat(F.lit('{"results": ['), pair, F.lit('], "next_cursor": "n'), uid, F.lit('"}')),
        F.concat(F.lit('{"items": ['), pair, F.lit('], "cursor": 12, "after": "a'), uid, F.lit('"}')),
        F.concat(F.lit('{"k": '), F.col("k").cast("string"), F.lit(', "nextCursor": ""}')),
        F.concat(F.lit('{"data": ['), pair, F.lit('], "items": []}')),
        F.lit('"text"'),
    ]
    shape = F.col("event_id") % len(shapes)
    response = F.lit(None).cast("string")
    for i, text in reversed(list(enumerate(shapes))):
        response = F.when(shape == i, text).otherwise(response)
    return e.select("event_id", response.alias("response"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event: wrapped, plain, or (every 50th) damaged."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    record = F.struct(
        F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("repr")).alias("time"),
        F.struct(level.alias("name")).alias("level"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.struct(F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("pipeline_id")).alias("extra"),
    )
    wrapped = F.to_json(F.struct(record.alias("record")))
    plain = F.to_json(record)
    line = (
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 2 == 0, plain)
        .otherwise(wrapped)
    )
    return e.select(F.col("event_id").alias("line_no"), line.alias("value"))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as run_id",
        "event_type as source",
        "case when event_type = 'error' then 'FAILED' else 'SUCCESS' end as status",
        "cast(ts as timestamp) as started_at",
        "user_id + 1 as rows_processed",
        "user_id + 1 - user_id % 3 as rows_saved",
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "source", "n_chars as row_count", "timestamp '2024-02-01 00:00:00' - (doc_id % 48) * interval 1 hour as updated_at"
    )


def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the hosts seen in the pages, for hosts with a name of even length: two prefixes and a catch-all for one agent."""
    hosts = (
        table(spark, sf_dir, "pages")
        .select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
        .distinct()
        .where(F.length("host") % 2 == 0)
    )
    rules = F.array(
        *[
            F.struct(F.lit(a).alias("agent"), F.lit(n).alias("rule_no"), F.lit(p).alias("path_prefix"), F.lit(ok).alias("allow"))
            for a, n, p, ok in [("*", 1, "/en/", True), ("*", 2, "/fr", False), ("*", 3, "/e", False), ("badbot", 1, "/", False)]
        ]
    )
    return hosts.select("host", F.explode(rules).alias("r")).select("host", "r.*")
