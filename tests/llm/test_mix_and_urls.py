import math

import pytest
from pyspark.sql import functions as F

from lakeweave.llm import mix, urls


def water(sizes, weights=(5, 2, 1), share=1.5, repeat=2):
    """Targets by repeated resharing, from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > repeat * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: float(repeat * sizes[s]) for s in over}
        free -= over
    return target


def taken_of(docs, **options):
    documents, mixed = mix.mix_sources(docs, **options)
    taken = mixed.groupBy("uid").agg(F.sum("length").alias("taken"))
    return documents.join(taken, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0))), mixed


def test_targets_and_taken_words(documents, made_up):
    rows = made_up(3, 400, words=120)
    rows = [(i, t, lang, [None, "b", "a", "Z", "é"][i % 5] if i % 11 else "tiny", n) for i, t, lang, _, n in rows]
    rows = [r for r in rows if r[3] != "tiny"] + [(9999, "three tiny words", "en", "tiny", 3)]
    df, mixed = taken_of(documents(rows), block_words=16)
    got = df.collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    want = water(sizes)
    per_source = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        per_source[r.source] = per_source.get(r.source, 0) + r.taken
    for source, n in per_source.items():
        assert abs(n - want[source]) <= 4 * 16
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in taken_of(documents(rows), block_words=16)[0].collect())
    # Every slot is one block of one source, and no span of a document is taken twice in an epoch.
    slots = mixed.groupBy("slot").agg(F.countDistinct("source").alias("sources"), F.sum("length").alias("words")).collect()
    assert all(s.sources <= 1 and s.words <= 16 for s in slots)
    spans = sorted((r.uid, r.epoch, r.start, r.length) for r in mixed.collect())
    assert all(a[:2] != b[:2] or a[2] + a[3] <= b[2] for a, b in zip(spans, spans[1:], strict=False))


def test_slots_are_spread_evenly(spark):
    targets = spark.createDataFrame([("a", 50.0), ("b", 30.0), (None, 20.0)], "source string, target double")
    rows = sorted((r.slot, r.source, r.rank) for r in mix.schedule(targets, 25_000).collect())
    assert [r[0] for r in rows] == list(range(25_000))
    seen = {}
    for slot, source, rank in rows:
        assert rank == seen.get(source, 0)
        seen[source] = rank + 1
        if slot >= 100:
            share = {"a": 0.5, "b": 0.3, None: 0.2}[source]
            assert abs(seen[source] - share * (slot + 1)) < 6


def test_odd_rows_and_empty_tables(documents, odd_rows):
    df, _ = taken_of(documents(odd_rows))
    got = df.collect()
    assert len(got) == len(odd_rows)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (3, 4, 5))
    assert taken_of(documents([]))[0].count() == 0
    assert taken_of(documents([(1, None, None, None)]))[0].collect()[0].target == 0


def test_documents_of_the_mix(documents, made_up):
    rows = made_up(5, 200, words=80)
    docs = documents(rows)
    out = mix.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns
    words, original = {}, {r[0]: r[1] for r in rows}
    for r in out.collect():
        cut = r.text.split()
        assert original[r.doc_id].split()[: len(cut)] == cut and (r.text == original[r.doc_id] or r.n_chars == len(r.text))
        words[r.doc_id] = words.get(r.doc_id, 0) + len(cut)
    taken = {r.doc_id: r.taken for r in taken_of(docs, block_words=16)[0].collect() if r.taken}
    assert words == taken


# --- urls ---------------------------------------------------------------------------------------


def brute_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.example.net", "/en/x", "block"), ("b.org", "", "block"), ("deep.org", "/a/b/c/d/", "allow"), ("b.org", "/q", "allow"),
]
URLS = [
    "http://Example.NET/en/1", "https://x.example.net/en/", "http://a.example.net/en/xyz/1", "http://notexample.net/en/", "http://example.com/de", "http://example.com/de/?a",
    "http://example.com/DE/", "http://x.org/fr/1#top", "http://x.org?/fr/", "http://b.org", "http://c.b.org?x", "http://b.org/q/r", "https://deep.org/a/b/c/d/e", "no scheme/", "://net/", "http://", None, "",
    "http://.net/", "http://a..net/", "http://net", "http://net/", "ftp://u@x.net:80/", "http://ÉX.net/é/", "http://x.net/line\nbreak", "http://" + "a." * 300 + "net/" + "p/" * 300,
]


def test_verdicts(spark):
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    rows = [(i, u, "html", 1, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], None, 1, "x"), (None, "http://x.net/", None, 1, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int, rule string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()), key=repr)
    assert got == sorted(((r[0], *brute_verdict(r[1], RULES)) for r in rows), key=repr)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_very_long_urls(spark):
    """A megabyte of slashes, of dots, and of both, beside rules of several depths."""
    rules = spark.createDataFrame([*RULES, ("x.y.z.w", "/", "block"), ("net", "/" * 20, "allow")], "host string, path string, verdict string")
    n = 1 << 20
    pages = [(1, "http://x.net" + "/" * n), (2, "http://" + "." * n + "net/a"), (3, "http://" + "a." * (n // 4) + "org/fr/" + "b/" * (n // 4)), (4, "http://" + "y" * n), (5, "/" * n)]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}
    assert got == {1: ("net" + "/" * 20, "allow"), 2: ("net/", "block"), 3: ("org/fr/", "allow"), 4: (None, "allow"), 5: (None, "allow")}


def test_share_of_all_words():
    assert math.isclose(sum(water({"a": 100, "b": 100, "c": 1}).values()), 1.5 * 201)
