"""The queries again as SQL over the driver tables, composed from named relations."""

from __future__ import annotations

from lakeweave.functions.keys import NULL_TOKEN
from lakeweave.operators.quality import DECLARED_TESTS
from lakeweave.schemas import SOURCES
from lakeweave.sources.seeds import CONTENT_CATEGORIES, SOURCE_METADATA

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
SPLIT = "TIMESTAMP '2024-01-20 00:00:00'"


def key(*exprs: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({e} AS VARCHAR), '{NULL_TOKEN}')" for e in exprs) + ")"


def norm(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[^a-zA-Z0-9 ]', '', 'g')))"


def untag(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', '', 'g')"


def growth(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} = 0 OR {prev} IS NULL THEN NULL ELSE round(CAST({cur} - {prev} AS DOUBLE) * 100.0 / {prev}, 2) END"


def values(rows: list[tuple], columns: str) -> str:
    def lit(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v).upper()

    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") v({columns})"


LOADED = f"coalesce(loaded_at, {AS_OF}) AS loaded_at"

# Relations in dependency order; a query names the last ones it needs.
RELATIONS: dict[str, str] = {
    "reddit_posts": """
        SELECT concat('t3_', event_id) AS id, concat('  Post #', event_id, ': ', event_type, '!  ') AS title,
               concat(' user_', user_id, ' ') AS author, event_type AS subreddit,
               CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value * 40) AS INTEGER) AS VARCHAR) END AS score,
               CAST(user_id % 50 AS VARCHAR) AS num_comments,
               concat('https://r.example/', event_type, '/', event_id) AS url, CAST(ts AS TIMESTAMP) AS created_utc,
               concat('<p>', props, '</p>') AS text, CAST(ts AS TIMESTAMP) + INTERVAL 6 HOUR AS loaded_at
        FROM events""",
    "steam_games": """
        SELECT CAST(p_partkey AS VARCHAR) AS app_id, concat(p_name, ' (', p_brand, ')') AS name,
               CASE WHEN p_partkey % 11 = 0 THEN 'Free to Play' WHEN p_partkey % 11 = 1 THEN '0'
                    ELSE concat((p_partkey * 7) % 60, '.99') END AS price,
               CASE WHEN p_size > 25 THEN ' Very Positive ' ELSE 'Mixed' END AS rating, p_type AS genres, p_brand AS developer,
               CASE WHEN p_partkey % 13 = 0 THEN 'Jul 9, 2013'
                    ELSE concat('2024-01-', lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0')) END AS release_date,
               TIMESTAMP '2024-01-20 00:00:00' + p_size * INTERVAL 1 HOUR AS loaded_at
        FROM part""",
    "imdb_titles": """
        SELECT concat('tt', lpad(CAST(o_orderkey AS VARCHAR), 7, '0')) AS id,
               concat('Title ', o_orderkey, ' - ', o_orderpriority) AS title,
               CASE WHEN o_orderkey % 101 = 0 THEN '2020-2023' ELSE CAST(extract(year FROM o_orderdate) AS VARCHAR) END AS "year",
               concat(CAST(floor((o_orderkey % 100) / 10.0) AS INTEGER), '.', o_orderkey % 10) AS rating,
               CAST(o_custkey AS VARCHAR) AS votes, o_orderpriority AS genres,
               CASE WHEN o_orderstatus = 'F' THEN 'movie' ELSE 'tvSeries' END AS "type",
               concat('https://i.example/title/tt', lpad(CAST(o_orderkey AS VARCHAR), 7, '0')) AS url,
               TIMESTAMP '2024-01-25 00:00:00' + (o_orderkey % 72) * INTERVAL 1 HOUR AS loaded_at
        FROM orders""",
    "news_articles": """
        SELECT url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, concat('by ', page_id % 17) AS author,
               regexp_extract(url, '^https?://([^/]+)', 1) AS source, CAST(length(html) % 500 AS VARCHAR) AS score,
               TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 HOUR AS published_at, html AS body,
               TIMESTAMP '2024-01-31 00:00:00' + (page_id % 20) * INTERVAL 1 HOUR AS loaded_at
        FROM pages""",
    "content_categories": values(CONTENT_CATEGORIES, "source_name, category, subcategory, is_active"),
    "source_metadata": values(SOURCE_METADATA, "source_name, display_name, base_url, crawl_frequency_hours, is_active"),
    "stg_reddit_posts": f"""
        SELECT id, {norm('title')} AS title, trim(author) AS author, trim(subreddit) AS subreddit,
               TRY_CAST(score AS INTEGER) AS score, TRY_CAST(num_comments AS INTEGER) AS num_comments, trim(url) AS url,
               CAST(created_utc AS TIMESTAMP) AS created_at, {untag('text')} AS body, {LOADED}
        FROM reddit_posts WHERE id IS NOT NULL""",
    "stg_steam_games": f"""
        SELECT TRY_CAST(app_id AS VARCHAR) AS app_id, {norm('name')} AS name, TRY_CAST(price AS DOUBLE) AS price,
               trim(rating) AS rating, trim(genres) AS genres, trim(developer) AS developer,
               TRY_CAST(release_date AS DATE) AS release_date, {LOADED}
        FROM steam_games WHERE app_id IS NOT NULL""",
    "stg_imdb_titles": f"""
        SELECT trim(id) AS id, {norm('title')} AS title, TRY_CAST("year" AS INTEGER) AS "year",
               TRY_CAST(rating AS DOUBLE) AS rating, TRY_CAST(votes AS INTEGER) AS votes, trim(genres) AS genres,
               trim("type") AS "type", trim(url) AS url, {LOADED}
        FROM imdb_titles WHERE id IS NOT NULL""",
    "stg_news_articles": f"""
        SELECT trim(url) AS url, {norm('title')} AS title, trim(author) AS author, trim(source) AS source,
               TRY_CAST(score AS INTEGER) AS score, CAST(published_at AS TIMESTAMP) AS published_at,
               {untag('body')} AS body, {LOADED}
        FROM news_articles WHERE url IS NOT NULL""",
    "int_reddit_posts_enriched": f"""
        SELECT r.*, CASE WHEN r.score >= 10000 THEN 'viral' WHEN r.score >= 1000 THEN 'high' WHEN r.score >= 100 THEN 'medium'
                         ELSE 'low' END AS engagement_tier,
               r.score >= 1000 AS is_popular, {growth('r.num_comments', 'r.score')} AS comment_to_score_pct,
               c.category, c.subcategory
        FROM stg_reddit_posts r LEFT JOIN content_categories c ON c.source_name = 'reddit'""",
    "int_steam_games_enriched": """
        SELECT s.*, CASE WHEN s.price IS NULL OR s.price = 0 THEN 'free' WHEN s.price < 10 THEN 'budget'
                         WHEN s.price < 30 THEN 'mid' ELSE 'premium' END AS price_tier,
               (s.price IS NULL OR s.price = 0) AS is_free, c.category, c.subcategory
        FROM stg_steam_games s LEFT JOIN content_categories c ON c.source_name = 'steam'""",
    "int_content_unified": f"""
        SELECT {key("'reddit'", 'id')} AS content_id, 'reddit' AS source_name, id AS natural_key, title, author,
               CAST(score AS DOUBLE) AS score, created_at, url, body, loaded_at FROM stg_reddit_posts
        UNION ALL
        SELECT {key("'steam'", 'app_id')}, 'steam', app_id, name, developer, CAST(price AS DOUBLE),
               CAST(release_date AS TIMESTAMP), CAST(NULL AS VARCHAR), genres, loaded_at FROM stg_steam_games
        UNION ALL
        SELECT {key("'imdb'", 'id')}, 'imdb', id, title, CAST(NULL AS VARCHAR), CAST(rating AS DOUBLE),
               TRY_CAST(concat("year", '-01-01') AS TIMESTAMP), url, genres, loaded_at FROM stg_imdb_titles
        UNION ALL
        SELECT {key("'news'", 'url')}, 'news', url, title, author, CAST(score AS DOUBLE), published_at, url, body, loaded_at
        FROM stg_news_articles""",
    "dim_sources": f"""
        SELECT {key('m.source_name')} AS source_key, m.source_name, m.display_name, m.base_url, m.crawl_frequency_hours,
               m.is_active, c.category, c.subcategory
        FROM source_metadata m LEFT JOIN content_categories c ON m.source_name = c.source_name""",
    "dim_content_types": f"""
        SELECT {key('source_name')} AS content_type_key, source_name,
               CASE source_name WHEN 'reddit' THEN 'Post' WHEN 'steam' THEN 'Game' WHEN 'imdb' THEN 'Title'
                    WHEN 'news' THEN 'Article' ELSE 'Unknown' END AS content_type, category, subcategory, is_active
        FROM content_categories""",
    "fct_content": f"""
        SELECT {key('u.content_id')} AS content_key, u.content_id, s.source_key, u.source_name, u.natural_key, u.title,
               u.author, u.score, u.created_at, u.url, u.body, u.loaded_at
        FROM int_content_unified u JOIN dim_sources s ON u.source_name = s.source_name""",
    "fct_engagement_metrics": f"""
        SELECT {key('source_name', 'activity_date')} AS metric_key, * FROM (
            SELECT source_name, CAST(created_at AS DATE) AS activity_date, count(*) AS content_count,
                   round(avg(score), 2) AS avg_score, max(score) AS max_score, min(score) AS min_score,
                   round(sum(score), 6) AS total_score, max(loaded_at) AS last_loaded_at
            FROM fct_content WHERE created_at IS NOT NULL GROUP BY 1, 2)""",
    "rpt_top_content_by_source": """
        SELECT content_id, source_name, natural_key, title, author, score, created_at, url,
               CAST(row_number() OVER (PARTITION BY source_name ORDER BY score DESC NULLS LAST, content_id) AS INTEGER) AS rank_within_source
        FROM fct_content QUALIFY rank_within_source <= 10""",
    "rpt_content_freshness": f"""
        SELECT source_name, latest_loaded_at, round(h, 1) AS hours_since_last_load, total_records, records_last_24h,
               CASE WHEN latest_loaded_at IS NULL THEN 'no_data' WHEN h <= 6 THEN 'fresh' WHEN h <= 24 THEN 'stale'
                    ELSE 'critical' END AS freshness_status
        FROM (SELECT source_name, max(loaded_at) AS latest_loaded_at, count(*) AS total_records,
                     count(CASE WHEN loaded_at >= {AS_OF} - INTERVAL 24 HOUR THEN 1 END) AS records_last_24h,
                     extract(epoch FROM ({AS_OF} - max(loaded_at))) / CAST(3600 AS DOUBLE) AS h
              FROM fct_content GROUP BY source_name)""",
    "rpt_daily_ingestion_summary": """
        SELECT activity_date, CAST(sum(content_count) AS BIGINT) AS total_content,
               CAST(sum(CASE WHEN source_name = 'reddit' THEN content_count ELSE 0 END) AS BIGINT) AS reddit_count,
               CAST(sum(CASE WHEN source_name = 'steam' THEN content_count ELSE 0 END) AS BIGINT) AS steam_count,
               CAST(sum(CASE WHEN source_name = 'imdb' THEN content_count ELSE 0 END) AS BIGINT) AS imdb_count,
               CAST(sum(CASE WHEN source_name = 'news' THEN content_count ELSE 0 END) AS BIGINT) AS news_count,
               round(sum(total_score) / CAST(nullif(sum(content_count), 0) AS DOUBLE), 2) AS avg_score_all,
               arg_max(source_name, (content_count, source_name)) AS dominant_source
        FROM fct_engagement_metrics GROUP BY activity_date""",
    "content_events": f"""
        SELECT {key('content_id', 'loaded_at')} AS event_id, content_id, source_name, natural_key, title, score, created_at,
               loaded_at, CAST(loaded_at AS DATE) AS event_date FROM int_content_unified""",
    "incr_content_events": "SELECT * FROM content_events",
    "steam_loads": """
        SELECT CAST(p_partkey AS VARCHAR) AS app_id, concat(p_name, ' (', p_brand, ')') AS name,
               concat((p_partkey * 7 + k * (p_partkey % 3)) % 60, '.99') AS price,
               CASE WHEN p_size > 25 THEN ' Very Positive ' ELSE 'Mixed' END AS rating, p_type AS genres, p_brand AS developer,
               CAST(NULL AS VARCHAR) AS release_date, TIMESTAMP '2024-01-20 00:00:00' + k * INTERVAL 5 DAY AS loaded_at, k
        FROM part, (VALUES (0), (1), (2)) loads(k)""",
    "steam_history": f"""
        SELECT app_id, {norm('name')} AS name, TRY_CAST(price AS DOUBLE) AS price, trim(rating) AS rating,
               trim(developer) AS developer, trim(genres) AS genres, loaded_at FROM steam_loads""",
    "reddit_history": """
        SELECT p.id, p.title, p.author, p.subreddit, p.score + k * (p.num_comments % 4) AS score, p.num_comments, p.url,
               p.created_at, p.loaded_at + k * INTERVAL 1 DAY AS loaded_at
        FROM stg_reddit_posts p, (VALUES (0), (1)) loads(k)""",
}


def scd(source: str, key_column: str) -> str:
    """Validity ranges of every load."""
    return f"""
        SELECT {key(key_column, 'loaded_at')} AS dbt_scd_id, *, loaded_at AS dbt_updated_at, loaded_at AS dbt_valid_from,
               valid_to AS dbt_valid_to, valid_to IS NULL AS dbt_is_current
        FROM (SELECT *, lead(loaded_at) OVER (PARTITION BY {key_column} ORDER BY loaded_at) AS valid_to FROM {source})"""


RELATIONS["steam_scd"] = f"SELECT * EXCLUDE (valid_to) FROM ({scd('steam_history', 'app_id')})"
RELATIONS["reddit_scd"] = f"SELECT * EXCLUDE (valid_to) FROM ({scd('reddit_history', 'id')})"
RELATIONS["steam_changes"] = """
    SELECT * EXCLUDE (before) FROM (SELECT *, lag(price) OVER (PARTITION BY app_id ORDER BY loaded_at) AS before FROM steam_history)
    WHERE price IS DISTINCT FROM before"""
RELATIONS["runs"] = """
    SELECT event_id AS run_id, event_type AS source, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           CAST(ts AS TIMESTAMP) AS started_at, user_id + 1 AS rows_processed, user_id + 1 - user_id % 3 AS rows_saved FROM events"""
RELATIONS["datasets"] = f"""
    SELECT source, n_chars AS row_count, {AS_OF} - (doc_id % 48) * INTERVAL 1 HOUR AS updated_at FROM documents"""
RELATIONS["logs"] = """
    SELECT strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
           CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS "level", concat('event ', event_id) AS message,
           concat('p', user_id % 7) AS pipeline_id FROM events WHERE event_id % 50 <> 0"""


def with_relations(*names: str) -> str:
    """A WITH clause of the named relations and everything they depend on."""
    import re

    needed: set[str] = set()

    def add(name: str) -> None:
        if name in needed:
            return
        needed.add(name)
        for other in RELATIONS:
            if other != name and re.search(rf"\b{other}\b", RELATIONS[name]):
                add(other)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({RELATIONS[n]})" for n in RELATIONS if n in needed) + " "


def relation(name: str, columns: str = "*", tail: str = "") -> str:
    return f"{with_relations(name)} SELECT {columns} FROM {name} {tail}"


def _declared_tests() -> str:
    """Every declared test, counted by its own statement."""
    names = [n for n in DECLARED_TESTS]
    parts = []

    def add(rel: str, test: str, column: str, failing: str) -> None:
        parts.append(
            f"SELECT '{rel}' AS relation, '{test}' AS test, '{column}' AS column_name, (SELECT count(*) FROM ({failing})) AS failures"
        )

    for rel, t in DECLARED_TESTS.items():
        for c in t.not_null:
            add(rel, "not_null", c, f"SELECT 1 FROM {rel} WHERE {c} IS NULL")
        for c, accepted in t.accepted.items():
            listed = ", ".join(f"'{v}'" for v in accepted)
            add(rel, "accepted_values", c, f"SELECT 1 FROM {rel} WHERE {c} NOT IN ({listed})")
        for c in t.not_future:
            add(rel, "not_future_date", c, f"SELECT 1 FROM {rel} WHERE {c} > {AS_OF} + INTERVAL 1 HOUR")
        for c in t.positive:
            add(rel, "positive_score", c, f"SELECT 1 FROM {rel} WHERE {c} < 0")
        for c in t.unique:
            add(rel, "unique", c, f"SELECT {c} FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1")
        for c, (parent, pc) in t.references.items():
            add(rel, "relationships", c, f"SELECT 1 FROM {rel} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {parent})")
    add("fct_content", "no_orphans", "source_name",
        "SELECT 1 FROM fct_content f LEFT JOIN dim_sources d ON f.source_name = d.source_name WHERE d.source_name IS NULL")
    add("incr_content_events", "event_unique", "event_id",
        "SELECT event_id FROM incr_content_events GROUP BY event_id HAVING count(*) > 1")
    return with_relations(*names) + " UNION ALL ".join(parts)



URL_PARTS = """WITH parts AS (SELECT page_id, url, regexp_replace(url, '#.*$', '') AS base, regexp_extract(url, '(#.*)$', 1) AS fragment FROM pages)"""


def plain(c: str) -> str:
    """Text of a markup fragment: tags out, outer blanks off, the entities used in the pages decoded.

    These entities also count without their semicolon, as in a title cut in the middle of one.
    """
    stripped = f"regexp_replace(regexp_replace({c}, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g')"
    for entity, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        stripped = f"regexp_replace({stripped}, '&{entity};?', '{char}', 'g')"
    return stripped


def quoted(c: str) -> str:
    return f"CAST(to_json({c}) AS VARCHAR)"


# The pages in pieces: article heading and paragraphs, menu entries, advertisement, footer.
PIECES = f"""WITH pieces AS (
    SELECT page_id, url, article, {plain("regexp_extract(article, '(?s)<h1>(.*?)</h1>', 1)")} AS heading,
           list_transform(string_split(article, '<p>')[2:], lambda x: {plain('x')}) AS paragraphs,
           list_transform(string_split(article, '<p>')[2:], lambda x: starts_with(x, '<b>')) AS bold,
           list_transform(regexp_extract_all(nav, '(?s)<a [^>]*>(.*?)</a>', 1), lambda x: {plain('x')}) AS menu,
           list_transform(regexp_extract_all(nav, '<a href="([^"]*)"', 1), lambda x: {plain('x')}) AS links,
           {plain("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS ad,
           {plain("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS footer
    FROM (SELECT *, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS article,
                 regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages))"""

CONTENT = with_relations("fct_content")
UNIFIED = with_relations("int_content_unified")

ORACLE: dict[str, str] = {
    # lake, files, warehouse
    "lake_write": f"{with_relations('reddit_posts')} SELECT *, DATE '2024-01-20' AS ingest_date, 'posts' AS version FROM reddit_posts",
    "lake_read": f"""{with_relations('reddit_posts')}
        SELECT id, score, loaded_at, CASE WHEN loaded_at > {SPLIT} THEN subreddit END AS subreddit FROM reddit_posts""",
    "lake_read_as_of_date": relation("reddit_posts", tail=f"WHERE loaded_at > {SPLIT}"),
    "lake_versions": """SELECT DATE '2024-01-20' + 5 * k AS ingest_date, concat('load', k) AS version
        FROM (VALUES (0), (1), (2)) loads(k) WHERE (SELECT count(*) FROM part) > 0""",
    "lake_datasets": """SELECT 'raw' AS layer, 'steam' AS source, CAST(TIMESTAMP '2024-01-20' + k * INTERVAL 5 DAY AS DATE) AS ingest_date,
        concat('load', k) AS name, (SELECT count(*) FROM part) AS row_count FROM (VALUES (0), (1), (2)) loads(k)""",
    "lake_entries": "SELECT 'raw' AS layer, 'steam' AS source, CAST(3 * count(*) AS BIGINT) AS row_count, true AS sound FROM part",
    "dataset_preview": "SELECT least(count(*), 100) AS shown, least(count(*), 100) AS known FROM part",
    "lake_promote": relation("steam_loads", "* EXCLUDE (k)"),
    "lake_pipeline": relation("steam_loads", "* EXCLUDE (k)", "WHERE k = 2"),
    "silver_directory": """
        SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN o_totalprice > 400000 THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "dataset_catalog": """
        SELECT 'raw' AS layer, 'steam' AS source, concat('load', k) AS name, (SELECT count(*) FROM part) AS row_count,
               CAST(NULL AS BIGINT) AS remote_size FROM (VALUES (0), (1), (2)) loads(k)
        UNION ALL
        SELECT 'raw', 's3', concat('load', doc_id), NULL, n_chars FROM documents
        WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0 AND doc_id > 2""",
    "table_preview_page": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100",
    "parquet_load": "SELECT * FROM customer",
    "parquet_load_dir": relation("steam_loads", "app_id, price, loaded_at"),
    "csv_to_parquet": "SELECT * FROM customer",
    "csv_dir_to_parquet": "SELECT * FROM customer",
    "ingest_file_rows": "SELECT * FROM orders",
    "ingest_dataframe": "SELECT 'imdb' AS source, 'raw' AS layer, 1 AS files_ingested, count(*) AS rows_total, true AS success FROM orders",
    "ingest_file": "SELECT 'lineitem' AS source, 'raw' AS layer, 1 AS files_ingested, count(*) AS rows_total, true AS success FROM lineitem",
    "ingest_directory": "SELECT 'all' AS source, 'raw' AS layer, 14 AS files_ingested, "
    + " + ".join(
        f"(SELECT count(*) FROM {t})"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    )
    + " AS rows_total, true AS success",
    "count_rows": "SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders) AS row_count",
    "save_records": relation("steam_games"),
    "warehouse_append": relation("steam_games", "app_id, name, loaded_at, CAST(2 AS BIGINT) AS copies"),
    "warehouse_overwrite": relation("steam_games", tail="WHERE rating <> 'Mixed'"),
    "warehouse_incremental": f"""{with_relations('reddit_posts')}, first_load AS (SELECT * FROM reddit_posts WHERE loaded_at <= {SPLIT})
        SELECT id, score, loaded_at FROM first_load UNION ALL
        SELECT id, score, loaded_at FROM reddit_posts WHERE loaded_at > (SELECT max(loaded_at) FROM first_load)""",
    "load_result": f"""{with_relations('reddit_posts')}
        SELECT 'reddit_posts' AS table_name, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_skipped, 'incremental' AS mode, true AS success
        FROM reddit_posts WHERE loaded_at <= {SPLIT} UNION ALL
        SELECT 'reddit_posts', count(*) FILTER (loaded_at > {SPLIT}), count(*) FILTER (loaded_at <= {SPLIT}), 'incremental', true
        FROM reddit_posts""",
    "load_parquet": f"SELECT *, {AS_OF} AS loaded_at FROM customer",
    "stamp_loaded_at": relation("reddit_posts", f"id, CASE WHEN id < 't3_5' THEN loaded_at ELSE {AS_OF} END AS loaded_at"),
    "register_view": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "run_sql": "SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS max_price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "catalog_info": """
        SELECT 'customer' AS table_name, o AS ordinal, c AS column_name, (SELECT count(*) FROM customer) AS row_count
        FROM (VALUES (0, 'c_custkey'), (1, 'c_name'), (2, 'c_nationkey'), (3, 'c_acctbal'), (4, 'c_mktsegment'), (5, 'loaded_at')) v(o, c)
        UNION ALL
        SELECT 'nation', o, c, (SELECT count(*) FROM nation)
        FROM (VALUES (0, 'n_nationkey'), (1, 'n_name'), (2, 'n_regionkey'), (3, 'loaded_at')) v(o, c)""",
    "log_source": relation("logs"),
    # models
    **{
        name: relation(name)
        for name in (
            "stg_reddit_posts", "stg_steam_games", "stg_imdb_titles", "stg_news_articles", "int_reddit_posts_enriched",
            "int_steam_games_enriched", "int_content_unified", "fct_content", "fct_engagement_metrics",
            "rpt_top_content_by_source", "rpt_content_freshness", "rpt_daily_ingestion_summary",
        )
    },
    "fct_engagement_metrics_from_state": relation("fct_engagement_metrics"),
    "rpt_daily_ingestion_summary_from_state": relation("rpt_daily_ingestion_summary"),
    "union_frames": f"""{with_relations('reddit_posts', 'imdb_titles')}
        SELECT id, title, author, CAST(NULL AS VARCHAR) AS "year" FROM reddit_posts UNION ALL
        SELECT id, title, NULL, "year" FROM imdb_titles""",
    **{
        name: f"""{with_relations(name, 'int_content_unified')}
            SELECT d.*, n.content_count FROM {name} d LEFT JOIN
            (SELECT source_name, count(*) AS content_count FROM int_content_unified GROUP BY 1) n ON d.source_name = n.source_name"""
        for name in ("dim_sources", "dim_content_types")
    },
    "an_content_distribution": f"""{CONTENT}
        SELECT source_name, count(*) AS content_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS pct_of_total,
               round(avg(score), 2) AS avg_score, round(median(score), 2) AS median_score, max(score) AS max_score, min(score) AS min_score
        FROM fct_content GROUP BY source_name""",
    "an_score_percentiles": f"{CONTENT} SELECT source_name, "
    + ", ".join(f"round(percentile_cont({p}) WITHIN GROUP (ORDER BY score), 6) AS {n}" for n, p in
                {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}.items())
    + " FROM fct_content WHERE score IS NOT NULL GROUP BY source_name",
    "score_percentiles_sketch": f"{CONTENT} SELECT source_name, count(*) AS scored, true AS within_error FROM fct_content WHERE score IS NOT NULL GROUP BY source_name",
    "an_monthly_volume": f"""{CONTENT}
        SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS "month", source_name, count(*) AS items_published,
               round(avg(score), 2) AS avg_score FROM fct_content WHERE created_at IS NOT NULL GROUP BY 1, 2""",
    "an_weekly_growth": f"""{CONTENT}, weekly AS (
            SELECT source_name, CAST(date_trunc('week', created_at) AS TIMESTAMP) AS week_start, round(avg(score), 2) AS avg_score,
                   count(*) AS item_count FROM fct_content WHERE created_at IS NOT NULL GROUP BY 1, 2),
        lagged AS (SELECT *, lag(avg_score) OVER w AS prev_week_score, lag(item_count) OVER w AS prev_week_count FROM weekly
                   WINDOW w AS (PARTITION BY source_name ORDER BY week_start))
        SELECT source_name, week_start, avg_score, item_count, prev_week_score,
               {growth('avg_score', 'prev_week_score')} AS score_growth_pct, {growth('item_count', 'prev_week_count')} AS volume_growth_pct
        FROM lagged""",
    "an_top_authors": f"""{CONTENT}
        SELECT source_name, author, count(*) AS item_count, round(avg(score), 2) AS avg_score, max(score) AS best_score
        FROM fct_content WHERE author IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3
        ORDER BY avg_score DESC NULLS LAST, source_name, author LIMIT 20""",
    "an_daily_velocity": f"""{CONTENT}, daily AS (
            SELECT CAST(created_at AS DATE) AS "day", source_name, count(*) AS items, round(sum(score), 6) AS total_score
            FROM fct_content WHERE created_at IS NOT NULL GROUP BY 1, 2)
        SELECT *, lag(total_score) OVER w AS prev_day_total_score, round(total_score - lag(total_score) OVER w, 6) AS score_delta
        FROM daily WINDOW w AS (PARTITION BY source_name ORDER BY "day")""",
    "pipeline_run": with_relations("incr_content_events", *DECLARED_TESTS)
    + " UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS row_count FROM {n}" for n in DECLARED_TESTS),
    # incremental log and history
    "incr_content_events": relation(
        "content_events",
        tail=f"WHERE loaded_at > (SELECT max(loaded_at) FROM content_events WHERE loaded_at <= {SPLIT})",
    ),
    "incr_content_events_replay": relation("content_events"),
    "incr_event_upsert": relation(
        "content_events", "* EXCLUDE (title), CASE WHEN source_name = 'steam' THEN upper(title) ELSE title END AS title"
    ),
    "incr_full_refresh": relation("content_events", tail=f"WHERE loaded_at <= {SPLIT}"),
    "incr_content_events_stream": relation("content_events"),
    "incr_upsert_by_key": f"""{with_relations('steam_loads')}
        SELECT app_id, price, loaded_at FROM steam_loads
        WHERE (k = 1 AND CAST(app_id AS BIGINT) % 3 = 0)
           OR (k = 0 AND CAST(app_id AS BIGINT) % 2 = 0 AND CAST(app_id AS BIGINT) % 3 <> 0)""",
    "incr_schema_sync": relation("reddit_posts", "id, score, CAST(NULL AS VARCHAR) AS flair"),
    "scd_steam_game_prices": relation("steam_scd"),
    "scd2_apply": relation("steam_scd"),
    "scd2_stored": relation("steam_scd"),
    "scd_steam_price_changes": f"{with_relations('steam_changes')} SELECT * EXCLUDE (valid_to) FROM ({scd('steam_changes', 'app_id')})",
    "scd_reddit_post_scores": relation("reddit_scd"),
    "scd2_as_of": relation(
        "steam_scd", "app_id, price, dbt_valid_from, dbt_valid_to",
        "WHERE dbt_valid_from <= TIMESTAMP '2024-01-27' AND (dbt_valid_to IS NULL OR TIMESTAMP '2024-01-27' < dbt_valid_to)",
    ),
    # scalar functions
    "normalize_text": f"SELECT doc_id, {norm('text')} AS value FROM documents",
    "clean_html": f"SELECT page_id, {untag('html')} AS value FROM pages",
    "trim_strings": "SELECT p_partkey, trim(concat(chr(160), ' ', chr(12288), p_name, '  ')) AS value FROM part",
    "safe_cast": """
        WITH d AS (SELECT o_orderkey, o_totalprice, concat(' ', CAST(round(o_totalprice / 100, 1) AS VARCHAR),
                CASE o_orderkey % 7 WHEN 0 THEN 'd' WHEN 1 THEN 'e1' WHEN 2 THEN 'f' WHEN 3 THEN 'x' ELSE ' ' END) AS s,
              concat(strftime(o_orderdate, '%Y/%-m/%-d'), CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END) AS day_text FROM orders)
        SELECT o_orderkey, TRY_CAST(s AS INTEGER) AS as_int, TRY_CAST(s AS DOUBLE) AS as_double, TRY_CAST(o_totalprice AS INTEGER) AS price_int,
               TRY_CAST(day_text AS DATE) AS as_date,
               coalesce(TRY_CAST(s AS DOUBLE), -1.0) AS as_default
        FROM d""",
    "round_half_up": """SELECT l_orderkey, l_linenumber, round(x, 0) AS places_0, round(x, 2) AS places_2, round(x, 3) AS places_3 FROM (
        SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END
            * (l_extendedprice + 0.005::DOUBLE) * pow(10.0::DOUBLE, l_linenumber::DOUBLE * 2) AS x FROM lineitem)""",
    "calculate_growth": f"SELECT l_orderkey, l_linenumber, {growth('l_linenumber', '(l_orderkey % 5)')} AS growth_pct FROM lineitem",
    "surrogate_key": f"""
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS s FROM orders)
        SELECT o_orderkey, {key('o_orderkey', 's')} AS "key", md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(s, '_null_'))) AS fallback_key FROM o""",
    "strip_strings": r"SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM conversations",
    "slugify": r"""
        WITH d AS (SELECT doc_id, source, trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
                   regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^a-z0-9_]', '_', 'g') AS proposed FROM documents)
        SELECT doc_id, slug, concat(source, '_dataset') AS dataset_name,
               CASE WHEN trim(proposed[1:40], '_') <> '' THEN trim(proposed[1:40], '_') ELSE concat(source, '_dataset') END AS suggested_name FROM d""",
    "safe_int": "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey * 1000 END AS value FROM orders",
    "parse_size": """SELECT doc_id, CAST(floor(n_chars / 4.0 * CASE doc_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 1024 WHEN 2 THEN 1048576
        WHEN 3 THEN 1073741824 WHEN 4 THEN 1099511627776 WHEN 5 THEN 1 END) AS BIGINT) AS bytes FROM documents""",
    "truncate_string": "SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(left(text, 197), '...') ELSE text END AS value FROM documents",
    "flatten_struct": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k, user_id AS user_id,
        event_type AS user_last_type FROM events""",
    "chunk_rows": """SELECT event_id, event_type,
        (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 7 AS chunk_no FROM events""",
    "url_ids": """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS app_id, concat('tt', o_custkey) AS title_id,
        o_custkey * 1000 AS votes, CAST(year(o_orderdate) AS VARCHAR) AS year_text FROM orders""",
    "iso_timestamp": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', CAST(ts AS TIMESTAMP))
        WHEN 1 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) - INTERVAL 2 HOUR END AS at FROM events""",
    "parse_price": """SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN CAST(0 AS DOUBLE) WHEN p_partkey % 11 = 1 THEN NULL
        ELSE round(p_retailprice, 2) END AS price FROM part""",
    # data quality and monitoring
    "test_unique": relation("reddit_posts", "author, count(*) AS n_records", "GROUP BY author HAVING count(*) > 1"),
    "test_not_null": relation("stg_reddit_posts", "id", "WHERE score IS NULL"),
    "test_accepted_values": relation(
        "reddit_posts", "subreddit, count(*) AS n_records", "WHERE subreddit NOT IN ('view', 'click') GROUP BY subreddit"
    ),
    "test_relationships": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "test_positive_score": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
    "test_not_future_date": relation(
        "stg_reddit_posts", "id, created_at", "WHERE created_at > TIMESTAMP '2024-01-15 00:00:00' + INTERVAL 1 HOUR"
    ),
    "test_orphans": relation("fct_content", "content_id, source_name", "WHERE source_name = 'news'"),
    "test_event_unique": relation(
        "content_events", "event_id, CAST(2 AS BIGINT) AS occurrence_count", f"WHERE loaded_at <= {SPLIT}"
    ),
    "dq_results": _declared_tests(),
    "dq_results_from_state": _declared_tests(),
    "dq_summary": f"""{with_relations('stg_reddit_posts', 'stg_imdb_titles')}, results(failures) AS (
        SELECT count(*) FROM (SELECT id FROM stg_reddit_posts GROUP BY id HAVING count(*) > 1) UNION ALL
        SELECT count(*) FROM (SELECT author FROM stg_reddit_posts GROUP BY author HAVING count(*) > 1) UNION ALL
        SELECT count(*) FROM stg_reddit_posts WHERE id IS NULL UNION ALL
        SELECT count(*) FROM stg_reddit_posts WHERE title IS NULL UNION ALL
        SELECT count(*) FROM stg_reddit_posts WHERE score IS NULL UNION ALL
        SELECT count(*) FROM (SELECT id FROM stg_imdb_titles GROUP BY id HAVING count(*) > 1) UNION ALL
        SELECT count(*) FROM stg_imdb_titles WHERE id IS NULL UNION ALL
        SELECT count(*) FROM stg_imdb_titles WHERE "year" IS NULL UNION ALL
        SELECT count(*) FROM stg_imdb_titles WHERE "type" NOT IN ('movie'))
        SELECT count(*) FILTER (failures = 0) AS passed, count(*) FILTER (failures > 0) AS failed, count(*) AS total FROM results""",
    "source_freshness": with_relations(*[s.raw_table for s in SOURCES.values()])
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS source_name, max(loaded_at) AS max_loaded_at,
            CASE WHEN max(loaded_at) IS NULL OR {AS_OF} - max(loaded_at) > INTERVAL {s.error_hours} HOUR THEN 'error'
                 WHEN {AS_OF} - max(loaded_at) > INTERVAL {s.warn_hours} HOUR THEN 'warn' ELSE 'pass' END AS status FROM {s.raw_table}"""
        for n, s in SOURCES.items()
    ),
    "validate_records": """SELECT concat('tt', o_orderkey) AS id, concat_ws(',',
            CASE WHEN o_orderkey % 10 = 3 THEN 'missing:title' END,
            CASE WHEN o_orderkey % 11 = 0 THEN 'type:votes' END,
            CASE WHEN o_orderkey % 14 - 1 < 0 OR o_orderkey % 14 - 1 > 10 THEN 'range:rating' END,
            CASE WHEN o_custkey < 5 AND o_orderkey % 11 <> 0 THEN 'range:votes' END) AS violations FROM orders""",
    "reject_sentinel_keys": """SELECT o_orderkey % 5 = 2 AS usable, count(*) AS n_rows,
        count(*) FILTER (o_orderkey % 5 IN (0, 1, 2)) AS n_ids FROM orders GROUP BY 1""",
    "run_metrics": relation(
        "runs", "run_id, rows_processed, rows_saved, CASE WHEN rows_processed = 0 THEN 0 ELSE CAST(rows_saved AS DOUBLE) / rows_processed END AS success_rate"
    ),
    "run_status_counts": relation("runs", "status, count(*) AS runs", "GROUP BY status"),
    "recent_runs": relation("runs", "run_id, source, status, started_at", "ORDER BY started_at DESC, run_id DESC LIMIT 5"),
    "run_success_pct": relation(
        "runs", "count(*) AS total_runs, count(*) FILTER (status = 'SUCCESS') AS successful_runs, "
        "CAST(round(count(*) FILTER (status = 'SUCCESS') * 100.0 / count(*)) AS BIGINT) AS success_pct"
    ),
    "recent_failures": relation(
        "runs", "run_id, status, started_at", "WHERE status = 'FAILED' ORDER BY started_at DESC, run_id DESC LIMIT 5"
    ),
    "ingestion_timeline": relation("runs", "run_id, started_at, rows_processed", "WHERE run_id % 13 <> 0"),
    "rows_by_source": relation("datasets", "source, CAST(sum(row_count) AS BIGINT) AS row_count", "GROUP BY source"),
    "dataset_kpis": f"""{with_relations('datasets', 'runs')}
        SELECT count(*) AS total_datasets, CAST(sum(row_count) AS BIGINT) AS total_rows, (SELECT max(started_at) FROM runs) AS last_run,
               CAST(round_even(count(*) FILTER ({AS_OF} - updated_at < INTERVAL 24 HOUR) * 100.0 / count(*), 0) AS BIGINT) AS freshness
        FROM datasets""",
    "error_rate_by_source": """SELECT event_type AS source, count(*) AS attempts, count(*) FILTER (event_id % 9 = 0) AS errors,
        CAST(count(*) FILTER (event_id % 9 = 0) * 100.0 AS DOUBLE) / count(*) AS error_rate FROM events GROUP BY 1""",
    "log_query": relation(
        "logs", tail="WHERE \"level\" = 'ERROR' AND pipeline_id = 'p3' ORDER BY \"timestamp\" DESC, message DESC LIMIT 50"
    ),
    "log_tail_contains": """SELECT event_id AS line_no FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 200)
        WHERE event_type = 'error' AND event_id % 50 <> 0""",
    # extraction
    "extract_reddit_posts": """
        SELECT event_id AS page_id, i AS item_no, concat('t3_', event_id, s) AS id, concat('Post &talk', event_id) AS title,
               concat('user_', user_id) AS author, event_type AS subreddit,
               CASE i WHEN 0 THEN CAST(floor(value * 40) AS BIGINT) ELSE 0 END AS score, CASE i WHEN 0 THEN user_id ELSE 0 END AS num_comments,
               concat('/r/', event_type, '/', event_id, s) AS post_url, date_trunc('second', CAST(ts AS TIMESTAMP)) AS created_utc,
               '' AS text, CAST(NULL AS VARCHAR) AS error
        FROM events, (VALUES (0, 'a'), (1, 'b')) items(i, s)""",
    "extract_steam_games": """
        SELECT p_partkey AS page_id, 0 AS item_no, CAST(p_partkey AS VARCHAR) AS app_id, p_name AS name,
               CASE WHEN p_partkey % 2 = 0 THEN concat('Made by', p_brand) ELSE '' END AS description,
               CASE WHEN p_partkey % 11 = 0 THEN 'Free to Play' ELSE concat('$', (p_partkey * 7) % 60, '.99') END AS price,
               concat('Jan ', p_size, ', 2024') AS release_date, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS developer,
               CASE WHEN p_partkey % 2 = 0 THEN concat(p_type, ',A,B,C,D') ELSE '' END AS genres,
               CASE WHEN p_partkey % 2 = 0 AND p_size > 25 THEN 'Very Positive' ELSE 'Mixed' END AS rating FROM part""",
    "extract_imdb_titles": """
        WITH o AS (SELECT *, o_orderkey % 3 AS kind FROM orders)
        SELECT o_orderkey AS page_id, 0 AS item_no, concat('tt', lpad(CAST(o_orderkey AS VARCHAR), 7, '0')) AS id,
               concat('Title ', o_orderkey) AS title, CAST(year(o_orderdate) AS VARCHAR) AS "year",
               CAST(concat(o_orderkey % 10, '.', o_custkey % 10) AS DOUBLE) AS rating,
               CASE WHEN kind = 0 THEN o_orderkey % 10 ELSE 0 END AS votes,
               CASE WHEN kind = 2 THEN concat(o_orderstatus, ',Drama') ELSE '' END AS genres,
               CASE WHEN kind = 2 THEN concat('Plot of ', o_orderpriority) ELSE '' END AS plot FROM o""",
    "extract_news_articles": f"""{PIECES}
        SELECT page_id, url, 0 AS item_no, heading AS title, url AS article_url, '' AS source, '' AS author,
               array_to_string(paragraphs, ' ') AS content, left(array_to_string(paragraphs, ' '), 200) AS summary, '' AS tags,
               'page' AS url_source FROM pieces""",
    "land_pages": f"""{PIECES}
        SELECT trim(url) AS url, {norm('heading')} AS title, '' AS author, '' AS source, CAST(NULL AS INTEGER) AS score,
               CAST(NULL AS TIMESTAMP) AS published_at,
               {untag("regexp_replace(array_to_string(paragraphs, ' '), '^\\s+|\\s+$', '', 'g')")} AS body, {AS_OF} AS loaded_at FROM pieces""",
    "land_pages_summary": """
        SELECT 'reddit' AS profile, count(*) AS pages_fetched, 2 * count(*) AS records_extracted, CAST(0 AS BIGINT) AS errors,
               CAST(0 AS DOUBLE) AS duration_seconds, 'SUCCESS' AS status FROM events
        UNION ALL SELECT 'steam', count(*), count(*), 0, 0, 'SUCCESS' FROM part
        UNION ALL SELECT 'imdb', count(*), count(*), 0, 0, 'SUCCESS' FROM orders""",
    "extract_fields": f"""{PIECES}
        SELECT page_id, 0 AS item_no, nullif(heading, '') AS heading, nullif(ad, '') AS ad, array_to_string(links, ' ') AS links,
               nullif(menu[1], '') AS first_link FROM pieces""",
    "extract_source_preset": f"""{PIECES}
        SELECT page_id, url, 0 AS item_no, CAST(NULL AS VARCHAR) AS headline, nullif(paragraphs[1], '') AS summary,
               CAST(NULL AS VARCHAR) AS published, CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS link FROM pieces""",
    "extract_text_links_images": f"""{PIECES}
        SELECT page_id, array_to_string(list_filter(menu, lambda x: x <> ''), ' ') AS text, array_to_string(links[1:5], ' ') AS links FROM pieces""",
    "extract_preset_reddit": """
        SELECT event_id AS page_id, concat('https://p.example/', event_id) AS url, item_no,
               CASE WHEN item_no = 0 THEN concat('Post ', event_id) END AS title, CASE WHEN item_no = 0 THEN CAST(user_id AS VARCHAR) END AS score,
               CASE WHEN item_no = 0 THEN event_type END AS author, CAST(NULL AS VARCHAR) AS subreddit,
               CASE WHEN item_no = 0 THEN concat('/p/', event_id) ELSE '/q' END AS link, CAST(NULL AS VARCHAR) AS comments
        FROM events, (VALUES (0), (1)) items(item_no)""",
    "extract_preset_steam": """
        SELECT p_partkey AS page_id, concat('https://p.example/', p_partkey) AS url, 0 AS item_no, trim(p_name) AS title,
               concat(p_size, '€') AS price, CAST(NULL AS VARCHAR) AS release_date, p_type AS review_score, CAST(NULL AS VARCHAR) AS link,
               concat(p_brand, '.png') AS thumbnail FROM part""",
    "extract_preset_imdb": """
        SELECT o_orderkey AS page_id, concat('https://p.example/', o_orderkey) AS url, 0 AS item_no, trim(o_orderpriority) AS title,
               concat('(', o_orderstatus, ')') AS "year", CAST(o_custkey AS VARCHAR) AS rating, o_orderstatus AS genre,
               CAST(NULL AS VARCHAR) AS votes, concat('/t/', o_orderkey) AS link FROM orders""",
    "extract_preset_custom": """
        SELECT n_nationkey AS page_id, concat('https://p.example/', n_nationkey) AS url, item_no,
               CASE item_no WHEN 0 THEN concat('{"h2": {"text": "', n_name, '"}}') ELSE concat('{"p": {"text": "', n_regionkey, '"}}') END AS record
        FROM nation, (VALUES (0), (1)) items(item_no)""",
    "extract_images": """
        SELECT p_partkey AS page_id, item_no, CASE item_no WHEN 0 THEN concat(trim(p_name), ' in') ELSE '' END AS "text",
               CASE item_no WHEN 0 THEN concat('1 ', p_brand, ' 3') END AS images FROM part, (VALUES (0), (1)) items(item_no)""",
    "extract_cascading": f"""{PIECES}, parts AS (SELECT *,
            array_to_string(list_transform(list_zip(menu, links), lambda x:
                '{{"li": {{"children": [{{"a": {{"text": ' || {quoted('x[1]')} || ', "attrs": {{"href": ' || {quoted('x[2]')} || '}}}}}}]}}}}'), ', ') AS menu_json,
            array_to_string(list_transform(list_filter(list_zip(paragraphs, bold), lambda x: x[1] <> ''), lambda x: CASE WHEN x[2]
                THEN '{{"p": {{"children": [{{"b": {{"text": ' || {quoted('x[1]')} || '}}}}]}}}}' ELSE '{{"p": {{"text": ' || {quoted('x[1]')} || '}}}}' END), ', ') AS body_json
            FROM pieces)
        SELECT page_id, url, item_no, record FROM (
            SELECT page_id, url, 0 AS item_no, '{{"nav": {{"children": [{{"ul": {{"children": [' || menu_json || ']}}}}]}}}}' AS record FROM parts
            UNION ALL SELECT page_id, url, 1, '{{"div": {{"text": ' || {quoted('ad')} || '}}}}' FROM parts
            UNION ALL SELECT page_id, url, 2, '{{"article": {{"children": [{{"h1": {{"text": ' || {quoted('heading')} || '}}}}' ||
                CASE WHEN body_json <> '' THEN ', ' ELSE '' END || body_json || ']}}}}' FROM parts
            UNION ALL SELECT page_id, url, 3, '{{"footer": {{"text": ' || {quoted('footer')} || '}}}}' FROM parts)""",
    "crawl_summary": f"""{PIECES}
        SELECT regexp_extract(url, '^https?://[^/]+/([^/?]*)', 1) AS profile, count(*) FILTER (page_id % 40 <> 7) AS pages_fetched,
               CAST(sum(len(list_filter(paragraphs, lambda x: x <> ''))) AS BIGINT) AS records_extracted,
               count(*) FILTER (page_id % 40 = 7) AS errors, CAST(max(page_id) AS DOUBLE) AS duration_seconds,
               CASE WHEN count(*) FILTER (page_id % 40 = 7) = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM pieces GROUP BY 1""",
    "html_boilerplate_strip": "SELECT page_id, left("
    + "regexp_replace(" * 5
    + "html"
    + "".join(f", '(?is)<{t}\\b.*?</{t}>', '', 'g')" for t in ("script", "style", "svg", "noscript", "head"))
    + ", 12000) AS snippet FROM pages",
    "page_title": "SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages",
    "next_page_link": r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat('https://next.example/', page_id)
            WHEN 1 THEN concat(regexp_extract(url, '^(https?://[^/]+)', 1), '/n/', page_id)
            WHEN 2 THEN concat(regexp_replace(url, '[?#].*$', ''), '?page=', page_id) END AS next_url FROM pages""",
    "page_chains": """
        WITH RECURSIVE aimed AS (
            SELECT url, CASE WHEN page_id % 50 = 49 AND (page_id // 50) % 3 = 0 THEN page_id - 49 WHEN page_id % 50 = 49 THEN NULL
                WHEN page_id % 11 = 5 AND page_id % 50 < 47 THEN page_id + 2 ELSE page_id + 1 END AS target FROM pages),
        links AS (SELECT a.url, min(n.url) AS next_url FROM aimed a LEFT JOIN pages n ON n.page_id = a.target GROUP BY a.url),
        prior AS (SELECT next_url AS url, min(url) AS before FROM links WHERE next_url <> url GROUP BY next_url),
        back AS (
            SELECT url AS page, url AS node, 0 AS steps FROM links
            UNION ALL SELECT b.page, p.before, b.steps + 1 FROM back b JOIN prior p ON b.node = p.url WHERE p.before <> b.page),
        ends AS (SELECT page, arg_max(node, steps) AS first, max(steps) AS far, min(node) AS low, arg_min(steps, node) AS low_at FROM back GROUP BY page),
        placed AS (
            SELECT page, CASE WHEN p.url IS NULL THEN first ELSE low END AS listing, (CASE WHEN p.url IS NULL THEN far ELSE low_at END + 1)::BIGINT AS position
            FROM ends e LEFT JOIN prior p ON p.url = e.first)
        SELECT l.url, l.next_url, a.listing, a.position, CASE WHEN l.next_url IS NULL THEN NULL WHEN t.page IS NULL THEN 'outside'
                WHEN t.listing <> a.listing THEN 'merge' WHEN t.position = a.position + 1 THEN 'next' ELSE 'loop' END AS link
        FROM links l JOIN placed a ON a.page = l.url LEFT JOIN placed t ON t.page = l.next_url""",
    "page_urls": f"""{URL_PARTS} SELECT page_id, n AS page_no, CASE WHEN n = 1 THEN url
            WHEN regexp_matches(base, '[?&]page=') THEN concat(regexp_replace(base, '([?&]page=)[^&]*', concat('\\1', n)), fragment)
            WHEN contains(base, '?') THEN concat(base, '&page=', n, fragment) ELSE concat(base, '?page=', n, fragment) END AS page_url
        FROM parts, (VALUES (1), (2), (3), (4)) plan(n)""",
    "cursor_urls": f"""{URL_PARTS} SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat('c ', page_id, '&') END AS "cursor",
            CASE WHEN page_id % 3 = 0 THEN concat(base, CASE WHEN contains(base, '?') THEN '&' ELSE '?' END, 'cursor=c+', page_id, '%26', fragment) END AS next_url
        FROM parts""",
    "robots_filter": """
        WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) AS path FROM pages)
        SELECT page_id, url, CASE WHEN length(host) % 2 = 1 THEN true WHEN starts_with(path, '/en/') THEN true
            WHEN starts_with(path, '/fr') THEN false WHEN starts_with(path, '/e') THEN false ELSE true END AS allowed FROM p""",
    "flatten_json": """
        SELECT event_id, CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS props_k, CASE WHEN ok THEN CAST(user_id AS BIGINT) END AS user_id,
            CASE WHEN ok THEN event_type END AS user_last_type, CASE WHEN ok AND event_id % 3 = 0 THEN concat(event_id, ',1') END AS tags,
            CASE WHEN ok AND event_id % 5 = 0 THEN concat('"r', event_id, '"') WHEN ok AND event_id % 5 = 1 THEN concat('{"no":', event_id, '}') END AS ref
        FROM (SELECT *, event_id % 7 <> 0 AS ok FROM events)""",
    "json_records": """
        WITH e AS (SELECT event_id, event_id % 8 AS shape, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        SELECT event_id, 0 AS record_no, k FROM e WHERE shape <> 7
        UNION ALL SELECT event_id, 1, k + 1 FROM e WHERE shape NOT IN (5, 7)""",
    "json_records_source": """
        WITH e AS (SELECT event_id % 8 AS shape, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
        r AS (SELECT shape, k FROM e WHERE shape <> 7 UNION ALL SELECT shape, k + 1 FROM e WHERE shape NOT IN (5, 7))
        SELECT CASE shape WHEN 1 THEN 'e' WHEN 3 THEN 'n' WHEN 4 THEN 'a' END AS cursor_kind, count(*) AS records,
               CAST(sum(k) AS BIGINT) AS sum_k FROM r GROUP BY 1""",
    "json_cursor": """SELECT event_id, CASE event_id % 8 WHEN 1 THEN concat('e', user_id) WHEN 3 THEN concat('n', user_id)
            WHEN 4 THEN concat('a', user_id) END AS "cursor" FROM events""",
    "request_bodies": """
        SELECT c_custkey, n AS page_no,
               CASE WHEN c_custkey % 2 = 1 AND n > 1 THEN concat('{"q":"all","limit":10,"after":"c', n, '"}')
                    ELSE concat('{"q":"all","limit":10,"offset":', (n - 1) * 10, '}') END AS cursor_body,
               concat('{"q":"all","page":', n, '}') AS page_body
        FROM customer, (VALUES (1), (2), (3)) plan(n)""",
}


def _columns_of(name: str, columns: str) -> str:
    return f"SELECT {columns} FROM ({ORACLE[name]})"


ORACLE |= {
    "pipeline_run_report": ORACLE["rpt_top_content_by_source"],
    "incr_content_events_keyed": ORACLE["incr_content_events_stream"],
    "dataset_name": _columns_of("slugify", "doc_id, dataset_name, suggested_name"),
    "safe_cast_default": _columns_of("safe_cast", "o_orderkey, as_default"),
    "extract_app_id": _columns_of("url_ids", "o_orderkey, app_id"),
    "extract_title_id": _columns_of("url_ids", "o_orderkey, title_id"),
    "extract_votes": _columns_of("url_ids", "o_orderkey, votes, year_text"),
}

# The SQL functions give what the column functions and tests give.
ORACLE |= {
    f"sql_{name}": ORACLE[name]
    for name in (
        "normalize_text", "clean_html", "trim_strings", "safe_cast", "calculate_growth", "surrogate_key", "test_unique", "test_not_null",
        "test_accepted_values", "test_relationships", "test_positive_score", "test_not_future_date", "test_orphans", "test_event_unique",
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
