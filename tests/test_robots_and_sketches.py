"""Robots rules by prefix index against a plain loop, and merged sketches against exact ranks."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lakeweave.operators.urls import robots_filter
from lakeweave.plans import analyses

RULES = "host string, agent string, rule_no int, path_prefix string, allow boolean"


def brute(url, rules, agent):
    """The first fitting rule, from a loop over the host's rules."""
    if url is None or "://" not in url:
        return True
    rest = url.split("://", 1)[1].split("#")[0]
    end = next((i for i, c in enumerate(rest) if c in "/?"), len(rest))
    host, path = rest[:end], rest[end:] if rest[end:].startswith("/") else "/" + rest[end:]
    mine = [r for r in rules if r[0] == host and r[1] != "*" and r[1].lower() in agent.lower()] or [r for r in rules if r[0] == host and r[1] == "*"]
    for _, _, _, prefix, allow in sorted(mine, key=lambda r: r[2]):
        if prefix is not None and (prefix == "*" or path.startswith(prefix)):
            return allow
    return True


def test_prefix_index_equals_a_loop(frame):
    rng = random.Random(4)
    pieces = ["/", "/a", "/a/", "/ab", "/a/b", "*", "", "/a?x", "/é", None, "/a/b/c/d"]
    rules = [(f"h{rng.randrange(4)}", rng.choice(["*", "*", "bot", "other"]), k, rng.choice(pieces), rng.random() < 0.5) for k in range(60)]
    urls = [f"http://h{rng.randrange(6)}{rng.choice(['', '/', '/a', '/ab/c', '/a/b/c/d/e', '/a?x=1', '?q', '/é/x', '/a#f', '#f'])}" for _ in range(200)]
    urls += [None, "", "no url", "http://", "https://H0/a"]
    pages = frame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x")], "page_id int, url string, host string")
    for agent in ("*", "bot", "Bot/1.0"):
        got = robots_filter(pages, frame(rules, RULES), agent)
        assert got.columns == ["page_id", "url", "host", "allowed"] and got.count() == len(urls) + 1
        for r in got.collect():
            assert r.allowed == brute(r.url, rules, agent.split("/")[0]), (r.url, agent)


def test_a_host_with_very_many_rules_and_most_urls(spark):
    """100 000 rules of one host: a url meets one key per length that they have."""
    rules = spark.range(100_000).select(
        F.lit("big").alias("host"), F.lit("*").alias("agent"), F.col("id").alias("rule_no"), F.concat(F.lit("/p"), F.col("id"), F.lit("/")).alias("path_prefix"), (F.col("id") % 2 == 0).alias("allow")
    )
    urls = spark.range(30_000).select("id", F.concat(F.lit("http://big/p"), F.col("id") * 5, F.lit("/x")).alias("url"))
    got = robots_filter(urls, rules)
    assert got.where("allowed <> ((id * 5) % 2 = 0 OR id * 5 >= 100000)").count() == 0
    assert got.count() == 30_000


def test_merged_sketches_are_within_their_error(spark):
    rng = random.Random(8)
    rows = [("a" if k % 3 else "b", rng.choice([rng.gauss(0, 100), float(rng.randrange(5))]), datetime(2024, 1, 1) + timedelta(days=k % 40)) for k in range(40_000)]
    rows += [("c", 7.0, datetime(2024, 1, 1)), ("d", None, datetime(2024, 1, 1)), ("c", float("nan"), datetime(2024, 1, 2))]
    content = spark.createDataFrame(rows, "source_name string, score double, loaded_at timestamp")
    sketches = analyses.daily_score_sketches(content)
    assert sketches.count() == 81 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    estimated = analyses.percentiles_from_sketches(sketches)
    errors = {r.source_name: r for r in analyses.percentile_rank_errors(content, estimated).collect()}
    assert set(errors) == {"a", "b", "c"} and errors["c"].scored == 1
    assert max(max(r[2:]) for r in errors.values()) <= analyses.SKETCH_RANK_ERROR
    # New days alone add to what is stored.
    parts = analyses.daily_score_sketches(content.where("loaded_at < '2024-01-20'")).unionByName(analyses.daily_score_sketches(content.where("loaded_at >= '2024-01-20'")))
    again = analyses.percentile_rank_errors(content, analyses.percentiles_from_sketches(parts)).collect()
    assert max(max(r[2:]) for r in again) <= analyses.SKETCH_RANK_ERROR
