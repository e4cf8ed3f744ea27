import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeweave.functions.html_select import FieldSpec, SelectPlan, SelectScan, compile_selector
from lakeweave.operators import extract as x
from lakeweave.operators import json_records as jr
from lakeweave.operators import monitor, urls


@pytest.fixture
def pages(frame):
    """Pages from (url, html) pairs, numbered from 0."""
    return lambda *items: frame([(i, u, h) for i, (u, h) in enumerate(items)], "page_id int, url string, html string")


def select(html, selector, attribute="text"):
    plan = SelectPlan((FieldSpec("v", selector, attribute, True),))
    return SelectScan(plan).scan(html).out["v"]


HTML = """<html><body><div id="top" class="a b"><p class="x">one <b>two</b></p><p>three</p></div>
<ul><li data-k="v1">l1<li data-k="w2">l2</ul><a href="/title/tt1">t</a><script>var p = "<p>no</p>";</script></body></html>"""


def test_selectors():
    assert select(HTML, "p") == ["onetwo", "three"]
    assert select(HTML, "div.a.b > p.x") == ["onetwo"]
    assert select(HTML, "#top p b, li") == ["two", "l1", "l2"]
    assert select(HTML, "[data-k]", "data-k") == ["v1", "w2"]
    assert select(HTML, "li[data-k^='w']") == ["l2"] and select(HTML, "a[href*='/title/tt']", "href") == ["/title/tt1"]
    assert select(HTML, "[data-k=v1]") == ["l1"] and select(HTML, "body > p") == [] and select(HTML, "ul > b") == []
    with pytest.raises(ValueError):
        compile_selector("p:nth-child(2)")


def test_messy_markup():
    assert select("<p>a<p>b<div>c</div>", "p") == ["a", "b"]
    assert select("<table><tr><td>1<td>2<tr><td>3</table>", "td") == ["1", "2", "3"]
    assert select("<td><p>a<table><tr><td><p>b</td></tr></table>", "p") == ["a", "b"]
    assert select("a < b <i>c</i> </x> <i>d", "i") == ["c", "d"]
    assert select('<a title="x > y" href=z/>t</a>', "a", "href") == ["z/"] and select('<a title="x > y" href=z/>t</a>', "a") == ["t"]
    assert select("<p>x &amp; y &eacute;<!-- <p>no</p> --><br/>z</p>", "p") == ["x & y éz"]
    assert select("<P CLASS=Big>t</P>", "p.Big") == ["t"] and select("<div/><p>q</p>", "div p") == []
    assert select("", "p") == [] and select("<p", "p") == [] and select("<script>never closed <p>x</p>", "p") == []


def test_stray_quotes_keep_their_element():
    assert select("<div class=a data-x=it's>t</div><p>u</p>", "div.a") == ["t"]
    assert select("<div class=a data-x=it's>t</div>", "div", "data-x") == ["it's"]
    assert select('<a "b" c=\'x > y\'>t</a>', "a") == ["t"] and select('<a b="open>t</a><i>u</i>', "i") == ["u"]
    assert select('<a b="x>y">t</a>', "a", "b") == ["x>y"] and select("<a b = 'q' c>t</a>", "a", "b") == ["q"]


@pytest.mark.parametrize("broken", ["<a b='c' \"", "<a b=\"", "<!-- x", "<! x", "<a b=\"x' ", "<a", "< a = '", "<a b='c'>", "</b x='\""])
def test_time_grows_with_the_page_however_broken(broken):
    def took(n):
        start = time.perf_counter()
        select(broken * n, "p")
        return time.perf_counter() - start

    took(2_000)
    short, long = min(took(20_000) for _ in range(3)), min(took(80_000) for _ in range(3))
    assert long < 10 * short + 0.2


def test_deep_nesting_does_not_recurse():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert len(select(deep, "div")) == 5000
    assert x is not None


def test_empty_and_minimal_pages_give_nothing(pages):
    df = pages(("u", ""), ("u", "<html><body><p>Nothing here</p></body></html>"), ("u", None))
    for extract in (x.extract_reddit_posts, x.extract_steam_games, x.extract_imdb_titles, x.extract_news_articles):
        assert extract(df).count() == 0


def test_reddit_listing(pages):
    html = """<main><div class="link thing odd" data-score="-7" data-author="harbour_pilot" data-subreddit="tides" data-fullname="t3_moon9">
        <time datetime="2023-06-04T03:02:01+00:00">last summer</time><a class="comments">208 comments, 3 new</a>
        <p class="title"><a class="title" href="/r/tides/comments/moon9/neap"> Why neap tides  lag </a></p></div>
      <div class="thing link" id="x1" data-score="&bull;"><p class="title"><a href="/y">Only inner</a></p><time>?</time></div>
      <div class="thing link" id="x2"><a class="comments"> </a></div>
    </main>"""
    got = x.extract_reddit_posts(pages(("u", html), ("u2", '<section data-type="link" data-fullname="t3_z">q</section>'))).orderBy("page_id", "item_no").collect()
    assert [(r.id, r.title, r.score, r.num_comments, r.post_url, r.created_utc) for r in got] == [
        ("t3_moon9", "Why neap tides  lag", -7, 208, "/r/tides/comments/moon9/neap", datetime(2023, 6, 4, 3, 2, 1)),
        ("x1", "Only inner", 0, 0, "/y", None),
        ("t3_z", "", 0, 0, "", None),
    ]
    assert got[0].subreddit == "tides" and got[0].author == "harbour_pilot" and got[1].author == ""


def test_steam_pages(pages):
    app = """<div class="apphub_AppName">Half Game</div><div class="discount_final_price">$4.99</div><div class="dev_row"><a>Dev</a></div>
      <div id="genresAndManufacturer"><a>1</a><a>2</a></div><div class="details_block"><a>3</a><a>4</a><a>5</a><a>6</a></div>
      <span class="responsive_reviewdesc"> Mostly </span>"""
    rows = """<div id="search_resultsRows"><a class="search_result_row" href="https://s/app/10/x"><span class="title">A</span>
      <div class="search_price"> Free </div><span class="search_review_summary" data-tooltip-html="Good<br>90%"></span></a>
      <a class="search_result_row" href="https://s/bundle/3"><span class="title">B</span></a></div>"""
    got = x.extract_steam_games(pages(("https://s/app/440/", app), ("https://s/search", rows))).orderBy("page_id", "item_no").collect()
    assert [(r.app_id, r.name, r.price, r.rating) for r in got] == [("440", "Half Game", "$4.99", "Mostly"), ("10", "A", "Free", "Good"), ("", "B", "", "")]
    assert got[0].genres == ["1", "2", "3", "4", "5"] and got[0].developer == "Dev" and got[1].genres == []


def test_imdb_pages(pages):
    classic = """<table><tr><th>Rank</th></tr><tr><td class="ratingColumn imdbRating"><strong title="6.1 from 845 votes">6.1</strong></td>
      <td class="titleColumn">37. <a href="/title/tt7654321/?r=37">Three Ferries</a> <span class="secondaryInfo">(2008)</span></td></tr></table>"""
    page = """<h1 class="TitleHeader__TitleText">Film</h1><span class="ipc-chip__text">Drama</span><p data-testid="plot">Plot</p>"""
    bad = """<ul><li class="ipc-metadata-list-summary-item"><a href="/title/tt9/">N</a><span class="ipc-rating-star--rating">n/a</span></li></ul>"""
    got = x.extract_imdb_titles(pages(("u", classic), ("https://i/title/tt5/", page), ("u", bad))).orderBy("page_id", "item_no").collect()
    assert [(r.id, r.title, r.year, r.rating, r.votes) for r in got] == [
        ("unknown", "", "", 0.0, 0), ("tt7654321", "Three Ferries", "2008", 6.1, 6),
        ("tt5", "Film", "", 0.0, 0), ("tt9", "N", "", 0.0, 0)]
    assert got[2].genres == ["Drama"] and got[2].plot == "Plot"


def test_news_article_fields(pages):
    html = """<html><head><link rel="canonical" href="https://head/ignored"></head><body><h1>Head <a href="/own">line</a></h1>
      <span class="byline">By B</span><a rel="author">A. Author</a><time datetime="2024-01-15T12:00:00Z">t</time>
      <article><p>ignored</p></article><div class="article-body"><p> One </p><p></p><p>Two</p></div>
      <p class="lead">Lead text</p><span class="tag">x</span><span class="topic"> </span><span class="tag">y</span>
      <meta property="og:site_name" content="The Paper"></body></html>"""
    r = x.extract_news_articles(pages(("https://page", html))).first()
    assert (r.title, r.article_url, r.url_source, r.author, r.source) == ("Headline", "/own", "article", "A. Author", "The Paper")
    assert r.published_at == datetime(2024, 1, 15, 12) and r.content == "One  Two" and r.summary == "Lead text" and r.tags == ["x", "y"]


def test_news_cards_and_fallbacks(pages):
    cards = """<div class="story"><h2><a href="/1">First</a></h2><div class="story-body">Body text</div></div>
      <div class="post"><h3>no title</h3><link rel="canonical" href="/canon"></div>"""
    long = "<article><h1>T</h1><p>" + "w" * 300 + "</p></article>"
    got = x.extract_news_articles(pages(("https://list", cards), ("https://long", long))).orderBy("page_id", "item_no").collect()
    assert [(r.title, r.article_url, r.url_source, r.content) for r in got[:2]] == [
        ("First", "/1", "article", "Body text"), ("", "/canon", "article", "")]
    assert got[2].article_url == "https://long" and got[2].url_source == "page" and got[2].summary == "w" * 200 and len(got[2].content) == 300


def test_extract_fields_nested(pages):
    html = """<div class="card"><h2> T1 </h2><ul><li><a href="/a">A</a><i>1</i></li><li><i></i></li></ul><img src="i.png"></div>
              <div class="card"><img></div>"""
    spec = [
        FieldSpec.of({"name": "title", "selector": "h2"}),
        FieldSpec.of({"name": "images", "selector": "img", "attribute": "src", "multiple": True}),
        FieldSpec.of({"name": "rows", "selector": "li", "multiple": True, "children": [
            {"name": "link", "selector": "a", "attribute": "href"}, {"name": "n", "selector": "i", "multiple": True}]}),
        FieldSpec.of({"name": "list", "selector": "ul", "children": [{"name": "first", "selector": "a"}]}),
    ]
    got = x.extract_fields(pages(("u", html)), ".card", spec).orderBy("item_no").collect()
    assert got[0].title == "T1" and got[0].images == ["i.png"] and got[0].list.first == "A"
    assert [(r.link, r.n) for r in got[0].rows] == [("/a", ["1"]), (None, [])]
    assert got[1].title is None and got[1].images == [] and got[1].rows == [] and got[1].list is None


def test_presets(pages):
    html = '<div class="Post"><h3>Hi</h3><span class="score">7</span><a class="title" href="/l">x</a></div>'
    r = x.extract_source_preset(pages(("u", html)), "reddit").first()
    assert (r.title, r.score, r.link, r.author) == ("Hi", "7", "/l", None)
    for source in ("steam", "imdb", "news"):
        assert x.extract_source_preset(pages(("u", "<p>none</p>")), source).count() == 0
    assert x.extract_source_preset(pages(("u", "<body><p>t</p></body>")), "custom").first().record == '{"p": {"text": "t"}}'


def test_cascading(pages):
    html = '<body><div class="c" style="s" onclick="f" id="d"><svg><b>no</b></svg><p>t "q"</p><a rel="next nofollow" href="/x"></a><span></span></div><style>s</style><p></p></body>'
    got = [json.loads(r.record) for r in x.extract_cascading(pages(("u", html))).orderBy("item_no").collect()]
    assert got == [{"div": {"attrs": {"id": "d"}, "children": [{"p": {"text": 't "q"'}}, {"a": {"attrs": {"rel": ["next", "nofollow"], "href": "/x"}}}]}}]
    inner = x.extract_cascading(pages(("u", html)), "p").collect()
    assert [json.loads(r.record) for r in inner] == [{"p": {"text": 't "q"'}}]
    deep = x.extract_cascading(pages(("u", "<div>" * 300 + "x" + "</div>" * 300))).first()
    assert deep.record.count('"div"') == 300


def test_text_links_images(pages):
    html = "<section>" + "".join(f'<a href="/{i}"> t{i} </a><img src="s{i}">' for i in range(7)) + "</section><section>plain</section>"
    got = x.extract_text_links_images(pages(("u", html)), "section").orderBy("item_no").collect()
    assert got[0].text == " ".join(f"t{i}" for i in range(7)) and got[0].links == [f"/{i}" for i in range(5)] and got[0].images == ["s0", "s1", "s2"]
    assert got[1].text == "plain" and got[1].links is None and got[1].images is None


def test_landing_splits_records(spark, pages):
    """Valid records, rule breakers and placeholder keys end up in their places; the pages are parsed once."""
    from datetime import UTC

    from lakeweave.operators.lake import Lake
    from lakeweave.plans.crawl import land_pages
    from lakeweave.session import work_dir

    row = '<li class="ipc-metadata-list-summary-item"><a href="/{0}">N</a><span class="ipc-rating-star--rating">{1}</span></li>'
    html = row.format("title/tt1/", "9.0") + row.format("title/tt2/", "11.0") + row.format("name/x", "5")
    lake = Lake(spark, work_dir(spark, "test-land"))
    summary = land_pages(lake, "imdb", pages(("u", html), ("v", "<p>none</p>")), datetime(2024, 2, 1, tzinfo=UTC)).first()
    assert (summary.profile, summary.pages_fetched, summary.records_extracted, summary.errors, summary.status) == ("imdb", 2, 3, 0, "SUCCESS")
    assert [(r.id, r.rating) for r in lake.read("raw", "imdb").collect()] == [("tt1", "9.0")]
    rejects = {json.loads(r.record)["id"]: r.violations for r in lake.read("raw", "imdb_rejects").collect()}
    assert rejects == {"tt2": ["range:rating"], "unknown": ["placeholder key"]}


def test_a_failing_page_gives_an_error_row(pages, monkeypatch):
    df = pages(("good", "<h1>a</h1>"), ("bad", "<h1>boom</h1>"))

    def make_scan():
        def scan(text):
            if "boom" in text:
                raise ValueError("broken page")
            return ["ok"]
        return scan

    import pyarrow as pa

    mapped = x._map_pages(df, "html", ["page_id", "url"], make_scan, pa.list_(pa.string()), "array<string>")
    got = x._rows(mapped, F.transform("page", lambda r: F.struct(r.alias("record"))), ("page_id", "url")).orderBy("page_id").collect()
    assert [(r.url, r.record, r.error) for r in got] == [("good", "ok", None), ("bad", None, "ValueError: broken page")]


def test_extraction_has_no_shuffle(pages):
    df = x.extract_news_articles(pages(("u", "<article><h1>a</h1></article>")))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_next_links_and_cursors(pages):
    df = pages(("https://h/a/b?q=1", '<a rel="next" href="c">n</a>'), ("https://h/a/b", '<div class="next"><a href="//x/y">n</a></div>'),
               ("https://h/a", '<button aria-label="Next"></button>'), ("https://h/a?k=v&k=w", '<i id="m" data-cursor="a b"></i>'))
    assert [r.next_url for r in x.next_page_link(df).orderBy("page_id").collect()] == ["https://h/a/c", "https://x/y", None, None]
    got = urls.cursor_urls(df, "#m").orderBy("page_id").collect()
    assert [r.next_url for r in got] == [None, None, None, "https://h/a?k=v&cursor=a+b"]
    by_text = urls.cursor_urls(df, "a", attribute="text").orderBy("page_id").first()
    assert by_text.cursor == "n"


def test_page_urls(values, frame):
    make = lambda c: urls.next_page_url(c, F.lit(1), 3)
    inputs = ["https://h/p", "https://h/p?page=1&q=a%20b&sort=x", "https://h/p?e=&page=9#f", "https://h/p?x=~*"]
    assert values(inputs, make) == ["https://h/p?page=2", "https://h/p?page=2&q=a+b&sort=x", "https://h/p?e=&page=2#f", "https://h/p?x=~%2A&page=2"]
    assert values(["https://h/p"], lambda c: urls.next_page_url(c, F.lit(3), 3)) == [None]
    plan = urls.page_urls(frame([("https://h",)], "url string"), 3)
    assert [r.page_url for r in plan.orderBy("page_no").collect()] == ["https://h", "https://h?page=2", "https://h?page=3"]


def test_robots(frame):
    rules = frame([("h", "*", 1, "/private/open", True), ("h", "*", 2, "/private", False), ("h", "Bot", 1, "/", False), ("h", "bot", 2, "/x", True)],
                  "host string, agent string, rule_no int, path_prefix string, allow boolean")
    wanted = frame([("https://h/private/open/1",), ("https://h/private",), ("https://h",), ("https://other/private",)], "url string")
    assert {r.url: r.allowed for r in urls.robots_filter(wanted, rules).collect()} == {
        "https://h/private/open/1": True, "https://h/private": False, "https://h": True, "https://other/private": True}
    assert not any(r.allowed for r in urls.robots_filter(wanted, rules, "MyBot/2.0").collect() if "//h" in r.url)
    assert all(r.allowed for r in urls.robots_filter(wanted, rules, enabled=False).collect())


def test_request_bodies(frame):
    plan = frame([(1, None), (2, "c1"), (3, "")], "page_no int, cursor string")
    bodies = lambda t, m: [json.loads(r.body) for r in urls.request_bodies(plan, t, m).orderBy("page_no").collect()]
    assert bodies({"q": "a"}, "page") == [{"q": "a", "page": 1}, {"q": "a", "page": 2}, {"q": "a", "page": 3}]
    assert bodies({"limit": 5}, "cursor") == [{"limit": 5, "offset": 0}, {"limit": 5, "after": "c1"}, {"limit": 5, "offset": 10}]
    assert bodies({"q": 1}, "cursor")[2] == {"q": 1, "offset": 40} and bodies({"q": 1}, "none")[0] == {"q": 1}


RESPONSES = [
    ('[{"a": 1}, 2, {"a": [1, {"b": 2}]}]', [{"a": 1}, {"a": [1, {"b": 2}]}]),
    ('{"data": {"n": 3, "x": {"edges": [{"node": {"i": 1}}, {"cursor": 2}, 7]}}}', [{"i": 1}, {"cursor": 2}]),
    ('{"data": {"x": {"edges": []}, "y": {"items": [{"i": 1}]}}}', []),
    ('{"data": {"x": {"items": [], "nodes": [{"i": 2}, null]}}}', [{"i": 2}]),
    ('{"data": {"x": {}}, "results": [{"r": 1}]}', [{"r": 1}]),
    ('{"items": [], "hits": [{"h": 1}]}', []),
    ('{"data": [{"d": 1}], "items": [{"i": 1}]}', [{"d": 1}]),
    ('{"list": "no", "k": {"z": "q"}}', [{"list": "no", "k": {"z": "q"}}]),
    ('"text"', []), ("7", []), ("", []), ("{broken", []), (None, []),
]


def test_json_records(frame):
    df = frame([(i, r) for i, (r, _) in enumerate(RESPONSES)], "i int, response string")
    got = {}
    for r in jr.json_records(df).orderBy("i", "record_no").collect():
        got.setdefault(r.i, []).append(json.loads(r.record))
    assert [got.get(i, []) for i in range(len(RESPONSES))] == [want for _, want in RESPONSES]


def test_json_cursor(values):
    cases = [
        ('{"next_cursor": "n", "after": "a"}', "n"), ('{"nextCursor": "", "after": "a"}', "a"), ('{"cursor": 5}', None),
        ('{"data": {"x": 1, "y": {"pageInfo": {"hasNextPage": true, "endCursor": "e"}}}}', "e"),
        ('{"data": {"y": {"pageInfo": {"hasNextPage": false, "endCursor": "e"}}}}', None),
        ('{"data": {"cursor": "inner"}}', None), ('{"cursor": 5, "x": {"cursor": "s"}}', None), ('{"after": {"a": 1}}', None), ('["x"]', None), ("", None), (None, None),
    ]
    assert values([c for c, _ in cases], jr.json_cursor) == [want for _, want in cases]


def test_monitoring(frame):
    runs = frame([(1, "SUCCESS", datetime(2024, 1, 1), 200, 180), (2, "FAILED", None, 0, 0), (3, "success", datetime(2024, 1, 2), 10, 10)],
                 "run_id int, status string, started_at timestamp, rows_processed int, rows_saved int")
    assert [r.success_rate for r in monitor.run_metrics(runs).orderBy("run_id").collect()] == [0.9, 0.0, 1.0]
    assert [r.run_id for r in monitor.recent_runs(runs, 2).collect()] == [3, 1]
    assert tuple(monitor.run_success_pct(runs).first()) == (3, 2, 67)
    assert monitor.run_success_pct(runs.limit(0)).first().success_pct == 0
    assert [r.run_id for r in monitor.recent_failures(runs).collect()] == [2]
    assert monitor.ingestion_timeline(runs).count() == 2
    with pytest.raises(ValueError):
        monitor.log_query(runs, 0)
    datasets = frame([("a", 5, datetime(2024, 1, 31, 1)), ("a", 6, datetime(2024, 1, 1))], "source string, row_count bigint, updated_at timestamp")
    kpis = monitor.dataset_kpis(datasets, runs, datetime(2024, 2, 1)).first()
    assert tuple(kpis) == (2, 11, datetime(2024, 1, 2), 50)
    assert monitor.dataset_kpis(datasets.limit(0), runs, datetime(2024, 2, 1)).first().freshness == 0
    lines = frame([(i, f"line {i} {'error' if i % 2 else 'info'}") for i in range(300)], "line_no int, line string")
    assert monitor.log_tail_contains(lines, "ERROR").count() == 100 and monitor.log_tail_contains(lines).count() == 200


def test_made_pages_are_many_tasks_when_the_table_is_large(spark, monkeypatch):
    from lakeweave.catalog import fixtures as fx

    orders = fx.table(spark, "/root/testdata/sf0.001", "orders")
    monkeypatch.setattr(fx, "PAGES_PER_TASK", 10, raising=False)
    spread = fx._spread(spark, orders)
    assert spread.rdd.getNumPartitions() == -(-orders.count() // 10) and spread.count() == orders.count()
    monkeypatch.setattr(fx, "PAGES_PER_TASK", 10**9, raising=False)
    assert fx._spread(spark, orders).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_made_pages_are_spread(spark, monkeypatch):
    from lakeweave.catalog import fixtures as fx, queries

    monkeypatch.setattr(fx, "PAGES_PER_TASK", 10)
    made = queries._made_pages(spark, "/root/testdata/sf0.001", "part", "p_partkey", ["=<div>", "p_name", "=</div>"])
    assert made.rdd.getNumPartitions() == -(-made.count() // 10)


def test_whole_tags_are_found_as_piece_by_piece():
    import random

    from lakeweave.functions.html_select import Markup

    def pieces(html, slow):
        markup, found, position = Markup(html), [], 0
        if slow:
            markup.gone.add("\0")  # the short form is left as soon as something is gone
        while piece := markup.next(position):
            found.append(piece)
            position = piece[1]
        return found

    rng, parts = random.Random(7), ["<a", "<b ", "</a", ">", "=", '"', "'", " ", "x", "/", "<!--", "-->", "<!d", "<?", "<", "\n", 'h="v>"', "k='<i>'"]
    for _ in range(20_000):
        html = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert pieces(html, False) == pieces(html, True), html


def test_elements_alike_are_matched_once_whatever_their_other_attributes():
    plan = SelectPlan((FieldSpec("v", "div.thing", multiple=True, children=(FieldSpec("id", ":scope", "data-id"), FieldSpec("t", ".title > a"))),))
    for k in range(3000):
        out = SelectScan(plan).scan(f'<div class="thing odd" data-id="{k}"><p class=title><a href="/{k}">t{k}</a></p></div>').out
        assert out == {"v": [{"id": str(k), "t": f"t{k}"}]}
    assert len(plan.selected) == 4  # the page, div, p and a


def _random_pages(rng, n):
    tags = "div p ul li a b td tr table h1 article script style Style template br img option select dl dt".split()
    marks = ['class="thing link odd"', "class='x y'", "class=x", 'id="d"', 'href="/title/tt12/?a&amp;b"', "href=z/", 'data-k="v>"', "checked", "CLASS=X Class=q",
             '="', "'", '"', 'a=\' k="x"', "/"]
    loose = ["t", " ", "a < b", "&amp;", "<!-- <p> -->", "<!-->", "<!--", "<!DOCTYPE html>", "<?x", "</", "</script", "</STYLE >", "if (a<b && '</p>')", "</\u017fcript>"]
    for _ in range(n):
        page = []
        for _ in range(rng.randint(0, 30)):
            kind = rng.random()
            if kind < 0.5:
                page.append(f"<{rng.choice(tags)}" + "".join(" " + m for m in rng.sample(marks, rng.choice([0, 0, 1, 1, 2]))) + rng.choice([">"] * 9 + ["/>", ""]))
            else:
                page.append(f"</{rng.choice(tags)}>" if kind < 0.8 else rng.choice(loose))
        yield "".join(page)


MIXED = (
    FieldSpec("a", "div > p.x, ul li", "text", True, (FieldSpec("t", ":scope"), FieldSpec("k", ":scope", "class"), FieldSpec("h", "a[href*='title']", "href"),
                                                      FieldSpec("n", "b", children=(FieldSpec("z", "a", multiple=True), FieldSpec("q", "*", "class", True))))),
    FieldSpec("r", ":root", separator="|"), FieldSpec("u", "td, tr p", "text", True), FieldSpec("e", "table .x div > .thing", "data-k"),
)


@pytest.mark.parametrize(("depth", "states", "seen"), [(256, 8192, 4096), (5, 20, 3)])
def test_pages_are_read_by_states_as_piece_by_piece(monkeypatch, depth, states, seen):
    import random

    import pyarrow as pa

    from lakeweave.functions import html_select as hs

    for name, value in (("MAX_DEPTH", depth), ("MAX_STATES", states), ("MAX_SEEN", seen)):
        monkeypatch.setattr(hs, name, value)
    whole = 0
    plans = [SelectPlan(tuple(f)) for f in (MIXED, x.REDDIT_FIELDS, x.STEAM_FIELDS, x.IMDB_FIELDS, x.NEWS_FIELDS)]
    for html in _random_pages(random.Random(3), 1500):
        for plan in plans:
            want = SelectScan(plan).scan_pieces(html).out
            whole += plan.scan(html) is not None
            record = plan.record(html)
            assert plan.group.named(record) == want and plan.group.listed(want) == record, html
            kind = x._arrow_type(plan.fields)
            assert hs.struct_array(plan.group, [record, None]).equals(pa.array([want, None], kind)), html
    assert whole > 1500


def test_states_do_not_grow_with_the_pages():
    plan = SelectPlan(tuple(x.REDDIT_FIELDS))
    sizes = []
    for k in range(300):
        post = f'<div class="thing link" data-fullname="t3_{k}" id="p{k}"><p class="title"><a class="title" href="/r/{k}">T{k}</a></p></div>'
        things = plan.group.named(plan.record(f"<body>{post * (k % 7 + 1)}</body>"))["things"]
        assert [(t["fullname"], t["element_id"], t["title"], t["inner_title_href"]) for t in things] == [(f"t3_{k}", f"p{k}", f"T{k}", f"/r/{k}")] * (k % 7 + 1)
        sizes.append(plan.size)
    assert sizes[0] == sizes[-1] < 20


def test_deep_pages_are_read():
    plan = SelectPlan((FieldSpec("n", "div > b"), FieldSpec("d", "div", "id", True)))
    out = plan.group.named(plan.record("<div id=i>" * 2000 + "<b>x</b>" + "</div>" * 2000))
    assert out["n"] == "x" and out["d"] == ["i"] * 2000


def test_records_are_made_after_they_have_rows_of_their_own(pages):
    for extract in (x.extract_reddit_posts, x.extract_steam_games, x.extract_imdb_titles):
        assert "transform(" not in extract(pages(("u", "<p>")))._jdf.queryExecution().optimizedPlan().toString()


def test_a_failing_page_has_no_record_made(pages, monkeypatch):
    def broken(self, html):
        raise ValueError("broken page")

    monkeypatch.setattr(x.SelectPlan, "record", broken)
    for extract in (x.extract_reddit_posts, x.extract_steam_games, x.extract_imdb_titles):
        row = extract(pages(("u", "<p>"))).first().asDict()
        assert {k: row.pop(k) for k in ("page_id", "url", "item_no", "error")} == {"page_id": 0, "url": "u", "item_no": 0, "error": "ValueError: broken page"}
        assert set(row.values()) == {None}


def test_counts_that_are_none_are_not_cast(values, frame):
    from lakeweave.functions.casts import count_or_zero

    texts = ["2,700", " 5 ", "\t7\n", "+3", "-4", "1.5", "5.", ".", "", "no", "\u2022", "12a", "9" * 20, "9223372036854775807", "- 1", "\x0112", "1 2", "\u0661", None, "5\n\n"]
    want = [r.v for r in frame([(i, t) for i, t in enumerate(texts)], "i int, t string").selectExpr(
        "i", "coalesce(try_cast(trim(replace(t, ',', '')) as bigint), 0L) as v").orderBy("i").collect()]
    assert values(texts, count_or_zero) == want
    plan = frame([("x",)], "t string").select(count_or_zero(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" in plan or plan.startswith("localrelation")
