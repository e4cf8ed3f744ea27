"""Page chains against a walk page by page."""

import random

import pytest

from lakeweave.operators.chains import page_chains


def walked(links):
    following = {}
    for url, target in links:
        if url is not None:
            old = following.get(url)
            following[url] = target if old is None else min(old, target) if target is not None else old
    before = {}
    for url, target in following.items():
        if target in following and target != url:
            before[target] = min(before.get(target, url), url)
    place = {}
    for url in following:
        back = [url]
        while back[-1] in before and before[back[-1]] != url:
            back.append(before[back[-1]])
        at = back.index(min(back)) if back[-1] in before else len(back) - 1
        place[url] = (back[at], at + 1)
    out = []
    for url, target in following.items():
        listing, position = place[url]
        if target is None:
            link = None
        elif target not in place:
            link = "outside"
        elif place[target][0] != listing:
            link = "merge"
        else:
            link = "next" if place[target][1] == position + 1 else "loop"
        out.append((url, target, listing, position, link))
    return sorted(out, key=repr)


def chained(frame, links):
    return sorted((tuple(r) for r in page_chains(frame(links, "url string, next_url string")).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_links(frame, seed):
    rng = random.Random(seed)
    urls = [f"u{i:03d}" for i in range(120)]
    links = [(u, rng.choice([None, "elsewhere", u, *rng.sample(urls, 12)])) for u in urls] + [(None, "u001"), ("u005", "u006"), ("u005", None)]
    assert chained(frame, links) == walked(links)


def test_rings_and_tails(frame):
    ring = [(f"r{i}", f"r{(i + 1) % 7}") for i in range(7)]
    links = [*ring, ("a", "r3"), ("s", "s"), ("x", "y"), ("y", "z"), ("z", "y")]
    found = {r[0]: r[2:] for r in chained(frame, links)}
    assert chained(frame, links) == walked(links)
    # The page with the smallest url before r3 takes it and what follows into its chain.
    assert found["a"] == ("a", 1, "next") and found["r2"] == ("a", 8, "loop")
    assert found["s"] == ("s", 1, "loop") and found["z"] == ("x", 3, "loop")


def test_long_chain(spark):
    from pyspark.sql import functions as F

    n = 20_000
    links = spark.range(n).select(F.concat(F.lit("p"), F.col("id")).alias("url"), F.when(F.col("id") < n - 1, F.concat(F.lit("p"), F.col("id") + 1)).alias("next_url"))
    found = page_chains(links).select("listing", "position").agg(F.countDistinct("listing"), F.max("position"), F.countDistinct("position"), F.min("listing")).first()
    assert tuple(found) == (1, n, n, "p0")


def test_empty(frame):
    assert chained(frame, []) == []
