"""Records from HTML pages.

Every extractor is one narrow job: ``scan_pages`` runs the selectors of a spec over each page
in Arrow batches (no shuffle, one page at a time), and column expressions turn what matched
into typed records. A page that fails gives one row with ``error`` and never fails the job.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.functions import html_select
from lakeweave.functions.casts import count_or_zero, iso_timestamp, safe_double
from lakeweave.functions.html_select import CascadeScan, FieldSpec, Group, SelectPlan, SelectScan, compile_selector, struct_array
from lakeweave.functions.keys import extract_app_id, extract_title_id, extract_votes, strip_parentheses

# Ship the helper with each job, so executors need nothing installed beyond PySpark.
cloudpickle.register_pickle_by_value(html_select)

PAGES_PER_BATCH = 256


def _arrow_type(fields: tuple[FieldSpec, ...]) -> pa.StructType:
    def one(spec: FieldSpec) -> pa.DataType:
        value = _arrow_type(spec.children) if spec.children else pa.string()
        return pa.list_(value) if spec.multiple else value

    return pa.struct([(spec.name, one(spec)) for spec in fields])


def _ddl(fields: tuple[FieldSpec, ...]) -> str:
    def one(spec: FieldSpec) -> str:
        value = _ddl(spec.children) if spec.children else "string"
        return f"array<{value}>" if spec.multiple else value

    return "struct<" + ", ".join(f"`{spec.name}`: {one(spec)}" for spec in fields) + ">"


def _map_pages(
    pages: DataFrame, html: str, keep: list[str], make_scan, value_type: pa.DataType, value_ddl: str, finish=None, to_array=pa.array
) -> DataFrame:
    """Columns ``keep`` of every page with ``page`` (the scan's value) and ``error``.

    ``finish(value, url)`` may complete a value with the page's url; ``to_array(values, type)`` makes the column. Spark bounds an input batch in bytes
    (``spark.sql.execution.arrow.maxBytesPerBatch``), so pages of any size come in batches that fit.
    """
    kept = [f for f in pages.schema if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"page {value_ddl}", "error string"])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make_scan()
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(start, PAGES_PER_BATCH)
                values, errors = [], []
                urls = part.column("url").to_pylist() if finish else [None] * len(part)
                collecting = gc.isenabled()
                gc.disable()  # records hold no cycles: looking for them after each page takes longer than many pages do
                try:
                    for text, url in zip(part.column("__html").to_pylist(), urls, strict=True):
                        try:
                            value = scan(text or "")
                            values.append(finish(value, url or "") if finish else value)
                            errors.append(None)
                        except Exception as exc:  # noqa: BLE001 - reported in the row
                            values.append(None)
                            errors.append(f"{type(exc).__name__}: {exc}")
                    columns = [part.column(n) for n in names]
                    columns += [to_array(values, value_type), pa.array(errors, pa.string())]
                finally:
                    if collecting:
                        gc.enable()
                yield pa.RecordBatch.from_arrays(columns, [*names, "page", "error"])

    return pages.select(*names, F.col(html).alias("__html")).mapInArrow(run, schema)


def scan_pages(
    pages: DataFrame, fields: list[FieldSpec], html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), finish=None
) -> DataFrame:
    """What the fields match on each page: ``keep`` columns, struct ``page`` and ``error``.

    A single value is NULL when no element matches and empty when the element has no such
    text or attribute; many values come in document order.
    """
    fields = tuple(fields)

    if finish:

        def make_scan():
            plan = SelectPlan(fields)
            return lambda text: SelectScan(plan).scan(text).out

        return _map_pages(pages, html, list(keep), make_scan, _arrow_type(fields), _ddl(fields), finish)
    group = Group(fields)
    return _map_pages(
        pages, html, list(keep), lambda: SelectPlan(fields).record, _arrow_type(fields), _ddl(fields),
        to_array=lambda records, _: struct_array(group, records),
    )


def _one(name: str, selector: str, attribute: str = "text") -> FieldSpec:
    return FieldSpec(name, selector, attribute)


def _many(name: str, selector: str, *children: FieldSpec, attribute: str = "text") -> FieldSpec:
    return FieldSpec(name, selector, attribute, True, children)


def _rows(scanned: DataFrame, records: Column, keep: tuple[str, ...], make=None, one: Column | None = None) -> DataFrame:
    """One row per record (``item_no`` from 0); a failed page keeps one row with its error.

    ``make(record)`` gives the columns of a record when it has a row of its own: there they are compiled, inside an array they would
    be interpreted. A page where ``one`` is not NULL has that as its only record, made already.
    """
    alone, rest = F.array(F.lit(None)), ["error"]
    if one is not None:
        scanned, rest = scanned.withColumn("__one", one), ["error", "__one"]
        records = F.when(F.col("__one").isNotNull(), alone).otherwise(records)
    items = F.when(F.col("error").isNotNull(), alone).otherwise(records)
    rows = scanned.select(*keep, F.posexplode(items).alias("item_no", "r"), *rest)
    if make:
        made = F.when(F.col("r").isNotNull(), make(F.col("r")))
        rows = rows.withColumn("r", made if one is None else F.coalesce(made, F.col("__one")))
    return rows.select(*keep, "item_no", "r.*", "error")


def _first(*values: Column) -> Column:
    """Value of the first element found, empty when none was."""
    return F.coalesce(*values, F.lit(""))


KEEP = ("page_id", "url")


# --- discussion posts --------------------------------------------------------------------------

_POST = (
    _one("fullname", ":scope", "data-fullname"),
    _one("element_id", ":scope", "id"),
    _one("subreddit", ":scope", "data-subreddit"),
    _one("author", ":scope", "data-author"),
    _one("score", ":scope", "data-score"),
    _one("title", "a.title"),
    _one("title_href", "a.title", "href"),
    _one("inner_title", ".title > a"),
    _one("inner_title_href", ".title > a", "href"),
    _one("comments", "a.comments"),
    _one("time", "time", "datetime"),
)
# Where posts sit on a listing page.
REDDIT_FIELDS = [_many("things", "div.thing.link", *_POST), _many("typed", "[data-type='link']", *_POST)]


def _post(p: Column) -> Column:
    number = F.regexp_extract(p["comments"], r"^\s*(\S+)", 1)
    return F.struct(
        F.coalesce(F.nullif(p["fullname"], F.lit("")), p["element_id"]).alias("id"),
        _first(p["title"], p["inner_title"]).alias("title"),
        p["author"].alias("author"),
        p["subreddit"].alias("subreddit"),
        count_or_zero(p["score"]).alias("score"),
        count_or_zero(F.coalesce(number, F.lit("0"))).alias("num_comments"),
        _first(p["title_href"], p["inner_title_href"]).alias("post_url"),
        iso_timestamp(p["time"]).alias("created_utc"),
        F.lit("").alias("text"),
    )


def extract_reddit_posts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Posts of listing pages. A post whose comment link is blank is malformed and left out."""
    page = F.col("page")
    found = F.when(F.size(page["things"]) > 0, page["things"]).otherwise(page["typed"])
    usable = F.filter(found, lambda p: p["comments"].isNull() | (p["comments"] != ""))
    return _rows(scan_pages(pages, REDDIT_FIELDS, html), usable, KEEP, _post)


# --- store games -------------------------------------------------------------------------------

# Where a store page and a search row keep their fields.
STEAM_FIELDS = [
    _one("app_name", "#appHubAppName"),
    _one("app_name_alt", ".apphub_AppName"),
    _one("description", ".game_description_snippet"),
    _one("price", ".game_purchase_price"),
    _one("price_discounted", ".discount_final_price"),
    _one("date", ".date"),
    _one("developers", "#developers_list"),
    _one("developer_row", ".dev_row a"),
    _many("genres", "#genresAndManufacturer a, .details_block a"),
    _one("review", ".responsive_reviewdesc"),
    _one("review_summary", ".game_review_summary"),
    _many(
        "rows", "#search_resultsRows .search_result_row, .search_result_row",
        _one("href", ":scope", "href"),
        _one("name", ".title"),
        _one("price_discounted", ".search_price .discount_final_price"),
        _one("price", ".search_price"),
        _one("released", ".search_released"),
        _one("review", ".search_review_summary", "data-tooltip-html"),
    ),
]
MAX_GENRES = 5


def _game(app_id, name, description, price, release_date, developer, genres, rating) -> Column:
    return F.struct(
        app_id.alias("app_id"), name.alias("name"), description.alias("description"), price.alias("price"),
        release_date.alias("release_date"), developer.alias("developer"), F.lit("").alias("publisher"),
        genres.alias("genres"), rating.alias("rating"), F.lit(0).cast("bigint").alias("review_count"),
    )


def extract_steam_games(pages: DataFrame, html: str = "html") -> DataFrame:
    """Games of store pages (one per page) or of search result pages (one per row)."""
    page = F.col("page")
    none = F.lit("")
    app_page = _game(
        extract_app_id(F.col("url")), _first(page["app_name"], page["app_name_alt"]), _first(page["description"]),
        _first(page["price"], page["price_discounted"]), _first(page["date"]),
        _first(page["developers"], page["developer_row"]), F.slice(page["genres"], 1, MAX_GENRES),
        _first(page["review"], page["review_summary"]),
    )

    def row(r: Column) -> Column:
        return _game(
            extract_app_id(r["href"]), _first(r["name"]), none, _first(r["price_discounted"], r["price"]),
            _first(r["released"]), none, F.array().cast("array<string>"),
            F.substring_index(_first(r["review"]), "<br>", 1),
        )

    is_app = F.coalesce(page["app_name"], page["app_name_alt"]).isNotNull()
    return _rows(scan_pages(pages, STEAM_FIELDS, html), page["rows"], KEEP, row, F.when(is_app, app_page))


# --- film and series titles --------------------------------------------------------------------

_TITLE_ROW = (
    _one("column_link", ".titleColumn a"),
    _one("column_href", ".titleColumn a", "href"),
    _one("link", "a[href*='/title/tt']"),
    _one("href", "a[href*='/title/tt']", "href"),
    _one("column_year", ".titleColumn .secondaryInfo"),
    _one("year", ".cli-title-metadata-item"),
    _one("rating", ".imdbRating strong, .ipc-rating-star--rating"),
    _one("votes", ".imdbRating strong[title]", "title"),
)
# Chart rows, classic table rows and the fields of a title page.
IMDB_FIELDS = [
    _many("chart", ".lister-list .lister-item, .ipc-metadata-list-summary-item", *_TITLE_ROW),
    _one("classic_marker", ".titleColumn"),
    _many("table_rows", "tr", *_TITLE_ROW),
    _one("hero_title", "[data-testid='hero-title-block__title']"),
    _one("header_title", "h1.TitleHeader__TitleText"),
    _one("h1", "h1"),
    _one("year", "[data-testid='hero-title-block__metadata'] a"),
    _one("rating", "[data-testid='hero-rating-bar__aggregate-rating__score'] span"),
    _one("plot", "[data-testid='plot']"),
    _many("genres", "[data-testid='genres'] a, .ipc-chip__text"),
]
UNKNOWN_TITLE = "unknown"


def _title(title_id, title, year, rating, votes, genres, plot) -> Column:
    no_names = F.array().cast("array<string>")
    return F.struct(
        F.coalesce(F.nullif(title_id, F.lit("")), F.lit(UNKNOWN_TITLE)).alias("id"), title.alias("title"),
        year.alias("year"), F.coalesce(safe_double(rating), F.lit(0.0)).alias("rating"), votes.alias("votes"),
        genres.alias("genres"), no_names.alias("directors"), no_names.alias("cast"),
        F.lit(0).cast("bigint").alias("runtime_minutes"), plot.alias("plot"),
    )


def _title_from_row(r: Column) -> Column:
    return _title(
        extract_title_id(_first(r["column_href"], r["href"])), _first(r["column_link"], r["link"]),
        strip_parentheses(_first(r["column_year"], r["year"])), r["rating"], extract_votes(_first(r["votes"])),
        F.array().cast("array<string>"), F.lit(""),
    )


def extract_imdb_titles(pages: DataFrame, html: str = "html") -> DataFrame:
    """Titles of chart pages, else of classic tables, else of a single title page."""
    page = F.col("page")
    single = _title(
        extract_title_id(F.col("url")), _first(page["hero_title"], page["h1"]), _first(page["year"]), page["rating"],
        F.lit(0).cast("bigint"), F.slice(page["genres"], 1, MAX_GENRES), _first(page["plot"]),
    )
    rows = F.when(F.size(page["chart"]) > 0, page["chart"]).when(page["classic_marker"].isNotNull(), page["table_rows"])
    is_title_page = F.coalesce(page["hero_title"], page["header_title"]).isNotNull()
    return _rows(scan_pages(pages, IMDB_FIELDS, html), rows, KEEP, _title_from_row, F.when(rows.isNull() & is_title_page, single))


# --- news articles -----------------------------------------------------------------------------

# Body containers in order of preference, and the other fields of an article.
_BODIES = [".article-body", ".article-content", "[data-testid='article-body']", ".story-body", "article"]
_ARTICLE = (
    _one("h1", "h1"),
    _one("h2", "h2, .headline, .article-title"),
    _one("canonical", "link[rel='canonical']", "href"),
    _one("heading_href", "h1 a, h2 a, .headline a", "href"),
    _one("author_rel", "[rel='author']"),
    _one("author_class", ".author"),
    _one("byline", ".byline"),
    _one("byline_id", "[data-testid='byline']"),
    _one("time", "time[datetime]", "datetime"),
    *(FieldSpec(f"body{i}", s, children=(_one("all", ":scope"), _many("p", "p"))) for i, s in enumerate(_BODIES)),
    _one("summary", ".article-summary"),
    _one("lead", ".lead"),
    _one("standfirst", "[data-testid='standfirst']"),
    _one("description", "meta[name='description']", "content"),
    _many("tags", ".tag, .topic, .category, [data-testid='topic-tag']"),
    _one("site_name", "meta[property='og:site_name']", "content"),
)
NEWS_FIELDS = [
    _one("h1", "h1"),
    _one("article", "article", "id"),
    FieldSpec("body", "body", children=_ARTICLE),
    FieldSpec("whole", ":root", children=_ARTICLE),
    _many("cards", "article, .article-card, .story, .post", *_ARTICLE),
]
SUMMARY_CHARS = 200
MAX_TAGS = 10


def _article(a: Column) -> Column:
    paragraphs = F.coalesce(*[a[f"body{i}"]["p"] for i in range(len(_BODIES))])
    whole = F.coalesce(*[a[f"body{i}"]["all"] for i in range(len(_BODIES))])
    content = F.when(F.size(paragraphs) > 0, F.array_join(paragraphs, " ")).otherwise(F.coalesce(whole, F.lit("")))
    link = _first(F.nullif(a["canonical"], F.lit("")), a["heading_href"])
    return F.struct(
        _first(a["h1"], a["h2"]).alias("title"),
        link.alias("article_url"),
        _first(a["site_name"]).alias("source"),
        _first(a["author_rel"], a["author_class"], a["byline"], a["byline_id"]).alias("author"),
        iso_timestamp(a["time"]).alias("published_at"),
        content.alias("content"),
        F.coalesce(
            a["summary"], a["lead"], a["standfirst"], a["description"], F.left(content, F.lit(SUMMARY_CHARS))
        ).alias("summary"),
        F.filter(F.slice(a["tags"], 1, MAX_TAGS), lambda t: t != "").alias("tags"),
    )


def extract_news_articles(pages: DataFrame, html: str = "html") -> DataFrame:
    """The article of an article page, else the cards of a listing page.

    An article without a link of its own takes the page's url; ``url_source`` says which it was.
    """
    page = F.col("page")
    whole = F.coalesce(page["body"], page["whole"])
    is_article = page["h1"].isNotNull() & page["article"].isNotNull()
    found = F.when(is_article, F.array(whole)).otherwise(page["cards"])
    rows = _rows(scan_pages(pages, NEWS_FIELDS, html), F.transform(found, _article), KEEP)
    own = F.col("article_url") != ""
    return rows.withColumns(
        {
            "url_source": F.when(own, "article").when(F.col("error").isNull(), "page"),
            "article_url": F.when(own, F.col("article_url")).when(F.col("error").isNull(), F.col("url")),
        }
    )


# --- free field specs --------------------------------------------------------------------------

# Container selector and fields (name, selector, attribute) per preset.
SOURCE_PRESETS: dict[str, tuple[str | None, list[tuple[str, str, str]]]] = {
    "reddit": (
        "shreddit-post, [data-testid='post-container'], .Post",
        [
            ("title", "h3, [slot='title']", "text"),
            ("score", "[id^='vote-arrows'] faceplate-number, .score", "text"),
            ("author", "[data-testid='post_author_link'], .author", "text"),
            ("subreddit", "[data-testid='subreddit-name'], .subreddit", "text"),
            ("link", "a[slot='full-post-link'], a.title", "href"),
            ("comments", "a[data-testid='comments-page-link-num-comments']", "text"),
        ],
    ),
    "steam": (
        ".search_result_row, .store_nav_area",
        [
            ("title", ".title, .store_nav_area h2", "text"),
            ("price", ".discount_final_price, .game_purchase_price", "text"),
            ("release_date", ".search_released", "text"),
            ("review_score", ".search_reviewscore span", "data-tooltip-html"),
            ("link", "a", "href"),
            ("thumbnail", "img", "src"),
        ],
    ),
    "imdb": (
        ".lister-item, [data-testid='title-card'], li.ipc-metadata-list-summary-item",
        [
            ("title", ".lister-item-header a, h3 a, [data-testid='title']", "text"),
            ("year", ".lister-item-year, .sc-f30335b4-0", "text"),
            ("rating", ".ratings-imdb-rating strong, [data-testid='ratingGroup--imdb-rating']", "text"),
            ("genre", ".genre", "text"),
            ("votes", ".sort-num_votes-visible span[data-value]", "data-value"),
            ("link", "h3 a, [data-testid='title'] a", "href"),
        ],
    ),
    "news": (
        "article, .article-card, [data-testid='article']",
        [
            ("headline", "h2, h3, .headline", "text"),
            ("summary", "p, .summary, .description", "text"),
            ("published", "time, .timestamp, [datetime]", "datetime"),
            ("author", ".author, .byline, [rel='author']", "text"),
            ("link", "a", "href"),
        ],
    ),
    "custom": (None, []),
}


def preset_fields(source: str) -> tuple[str | None, list[FieldSpec]]:
    container, fields = SOURCE_PRESETS[source]
    return container, [FieldSpec(*f) for f in fields]


def _blank_to_null(value: Column, spec: FieldSpec) -> Column:
    """Empty texts are missing values; the shape follows the spec."""
    if spec.children:
        def record(r: Column) -> Column:
            return F.struct(*[_blank_to_null(r[c.name], c).alias(c.name) for c in spec.children])

        if spec.multiple:
            return F.transform(value, record)
        return F.when(value.isNotNull(), record(value))
    if spec.multiple:
        return F.filter(value, lambda v: v != "")
    return F.nullif(value, F.lit(""))


def extract_fields(
    pages: DataFrame, container: str, fields: list[FieldSpec], html: str = "html", keep: tuple[str, ...] = KEEP
) -> DataFrame:
    """One row per container element with one column per field; nested specs give nested structs."""
    items = FieldSpec("items", container, multiple=True, children=tuple(fields))
    records = F.transform(
        F.col("page")["items"],
        lambda r: F.struct(*[_blank_to_null(r[f.name], f).alias(f.name) for f in fields]),
    )
    return _rows(scan_pages(pages, [items], html, keep), records, keep)


def extract_source_preset(pages: DataFrame, source: str, html: str = "html") -> DataFrame:
    """Records by a source's preset; the custom preset has no container, so it gives nested JSON."""
    container, fields = preset_fields(source)
    if container is None:
        return extract_cascading(pages, None, html)
    return extract_fields(pages, container, fields, html)


def extract_cascading(pages: DataFrame, container: str | None = None, html: str = "html", keep: tuple[str, ...] = KEEP) -> DataFrame:
    """Nested JSON text per container element (or per child of the body)."""

    def make_scan():
        steps = compile_selector(container) if container else None
        return lambda text: CascadeScan(steps).scan(text).records()

    scanned = _map_pages(pages, html, list(keep), make_scan, pa.list_(pa.string()), "array<string>")
    return _rows(scanned, F.transform("page", lambda r: F.struct(r.alias("record"))), keep)


MAX_LINKS = 5
MAX_IMAGES = 3


def extract_text_links_images(pages: DataFrame, container: str, html: str = "html", keep: tuple[str, ...] = KEEP) -> DataFrame:
    """Text (runs joined by blanks) and the first links and images of each container."""
    children = (
        FieldSpec("text", ":scope", separator=" "),
        _many("links", "a[href]", attribute="href"),
        _many("images", "img[src]", attribute="src"),
    )
    items = FieldSpec("items", container, multiple=True, children=children)

    def leading(values: Column, n: int) -> Column:
        return F.when(F.size(values) > 0, F.slice(values, 1, n))

    records = F.transform(
        F.col("page")["items"],
        lambda r: F.struct(
            r["text"].alias("text"),
            leading(r["links"], MAX_LINKS).alias("links"),
            leading(r["images"], MAX_IMAGES).alias("images"),
        ),
    )
    return _rows(scan_pages(pages, [items], html, keep), records, keep)


# --- links to further pages --------------------------------------------------------------------

# Fixed value: what marks the link to the next page.
NEXT_LINK = "a[rel='next'], .next a, [aria-label='Next'], a.next, [aria-label='Next page'] a"


def next_page_link(pages: DataFrame, html: str = "html") -> DataFrame:
    """Absolute url of the next page, NULL when the page links to none."""

    def absolute(found: dict, url: str) -> dict:
        return {"next": urljoin(url, found["next"]) if found["next"] else None}

    scanned = scan_pages(pages, [_one("next", NEXT_LINK, "href")], html, finish=absolute)
    return scanned.select(*KEEP, F.col("page")["next"].alias("next_url"), "error")


def page_cursor(pages: DataFrame, selector: str, attribute: str = "data-cursor", html: str = "html") -> DataFrame:
    """Cursor value found on each page, NULL when absent or blank."""
    scanned = scan_pages(pages, [_one("cursor", selector, attribute)], html)
    return scanned.select(*KEEP, F.nullif(F.col("page")["cursor"], F.lit("")).alias("cursor"), "error")
