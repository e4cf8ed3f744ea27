import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeweave.llm import simhash
from lakeweave.llm.common import joint_labels


def brute_fingerprint(text):
    words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w.encode()).decode() for w in _words(text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _words(text):
    out, word = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            out, word = ([*out, word] if word else out), ""
        else:
            word += c
    return [*out, word] if word else out


def brute_components(pairs):
    """(id, fingerprint) list to smallest reachable id per position."""
    label = list(range(len(pairs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                label[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            best[root(i)] = min(d, best.get(root(i), d))
    return [best.get(root(i)) for i in range(len(pairs))]


def expected(rows):
    pairs = [(r[0], brute_fingerprint(r[1])) for r in rows]
    return sorted(((d, f"{f:016x}", c) for (d, f), c in zip(pairs, brute_components(pairs), strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_odd_rows(documents, odd_rows):
    assert got(simhash.near_duplicates(documents(odd_rows))) == expected(odd_rows)


def test_near_copies(documents):
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(120):
        text = list(base) if i % 3 else [f"v{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = "changed"
        rows.append((i, " ".join(text)))
    want = expected(rows)
    assert got(simhash.near_duplicates(documents(rows), shard_size=8)) == want
    assert len({c for _, _, c in want}) < 100
    kept = {r.doc_id for r in simhash.one_per_component(documents(rows), shard_size=8).collect()}
    assert kept == {c for _, _, c in want}


def test_one_per_component_keeps_columns_and_one_of_repeated_rows(documents, odd_rows):
    docs = documents(odd_rows)
    out = simhash.one_per_component(docs)
    assert out.columns == docs.columns
    components = {c for _, _, c in expected(odd_rows)}
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(components, key=repr)


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.one_per_component(documents([])).count() == 0


@pytest.mark.parametrize("n", [6, 20, 75, 200])
def test_joint_labels_of_paths(n):
    """Paths, whole and with gaps, over nodes in random order: every link holds to the end."""
    assert joint_labels(6, np.array([0, 4, 2, 3, 5]), np.array([4, 2, 3, 5, 1])).tolist() == [0] * 6
    rng = np.random.default_rng(n)
    for share in (1.0, 0.9, 0.5):
        for _ in range(30):
            order = rng.permutation(n)
            links = [(a, b) for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True) if rng.random() < share]
            rng.shuffle(links)
            label = list(range(n))
            for a, b in links:
                label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
            left, right = np.array(links, dtype=np.int64).reshape(-1, 2).T
            assert joint_labels(n, left, right).tolist() == label


@pytest.mark.parametrize("spread", [64, 6])
def test_tree_finds_all_within_radius(spread):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, spread, 4, dtype=np.uint64)) for _ in range(400)], dtype=np.uint64)
    points = np.unique(base[rng.integers(0, 3, 400)] ^ flips)
    rng.shuffle(points)
    tree = simhash.BKTree(points)
    q, n = tree.within(points, 3)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    assert sorted(zip(q.tolist(), n.tolist(), strict=True)) == sorted(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    for parent in range(len(points)):  # children are keyed by their distance
        for edge, child in enumerate(tree.child[parent].tolist()):
            assert child < 0 or int(points[parent] ^ points[child]).bit_count() == edge


def test_hash_matches_spark(spark):
    text = "Some Ünicode words, here AND there"
    own = simhash.shingle_hashes(text.encode(), 3).view(np.int64).tolist()
    words = ["some", "Ünicode", "words,", "here", "and", "there"]
    shingles = [" ".join(words[i : i + 3]) for i in range(4)]
    rows = spark.createDataFrame(list(enumerate(shingles)), "i int, s string").select("i", F.xxhash64("s").alias("h")).orderBy("i").collect()
    assert own == [r.h for r in rows]
