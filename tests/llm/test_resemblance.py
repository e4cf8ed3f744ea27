import random

import numpy as np

import corpus_pipeline
from lakeweave.llm import resemblance

from test_simhash import _words


def brute_kept(rows, least=0.8):
    """Ids kept: the smallest of each component of texts whose sets of five-word shingles are similar."""
    sets, label = [], list(range(len(rows)))
    for r in rows:
        words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w.encode()).decode() for w in _words(r[1] or "")]
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= least * len(a | b):
                label[root(i)] = root(j)
    best = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        best[root(i)] = min(key, best.get(root(i), key))
    return sorted(best.values())


def kept(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


def near_copies(seed, groups=12, changes=8):
    """Texts with up to ``changes`` changed words: similarities on both sides of 0.8, chains and pairs."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        texts = [[f"w{rng.randrange(5000)}" for _ in range(rng.choice((30, 120, 400)))]]
        for _ in range(rng.randint(1, 9)):
            text = list(rng.choice(texts))
            for _ in range(rng.randint(0, changes)):
                text[rng.randrange(len(text))] = f"c{rng.randrange(5000)}"
            texts.append(text)
        rows += [" ".join(t) for t in texts]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_stage_removes_all_that_are_similar(spark, documents):
    rows = near_copies(1)
    stage = dict(corpus_pipeline.STAGES)["simhash_dedup"]
    want = brute_kept(rows)
    assert kept(stage(spark, documents(rows), "")) == want and 12 < len(want) < len(rows)


def test_blocks_of_a_large_group(documents):
    rows = near_copies(2, groups=2, changes=3)
    base = rows[0][1].split()
    rng = random.Random(3)
    for i in range(80):
        text = list(base)
        text[rng.randrange(len(text))] = f"x{i}"
        rows.append((1000 + i, " ".join(text)))
    assert kept(resemblance.one_per_component(documents(rows), block_size=1000)) == brute_kept(rows)


def test_trees_alone_find_what_three_bits_hold(documents, monkeypatch):
    """Without bands the fingerprints' trees still draw candidates: near copies far above 0.8, in shards of many sizes."""
    monkeypatch.setattr(resemblance, "band_keys", lambda hashes: [])
    rng = random.Random(5)
    rows = []
    for i in range(20):
        text = [f"w{rng.randrange(9000)}" for _ in range(2000)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text[:1000], "new", *text[1000:]]))]
    fps = [resemblance.fingerprint_of(resemblance.shingle_set(t.encode())) for _, t in rows]
    within = sum((a ^ b).bit_count() <= 3 for a, b in zip(fps[::2], fps[1::2], strict=True))
    found = len(rows) - len(kept(resemblance.one_per_component(documents(rows), shard_size=4)))
    assert found == within >= 18


def test_odd_rows_and_empty(documents, odd_rows):
    docs = documents(odd_rows)
    out = resemblance.one_per_component(docs)
    assert out.columns == docs.columns and kept(out) == brute_kept(odd_rows)
    assert resemblance.one_per_component(documents([])).count() == 0


def test_recall_of_the_bands():
    """Sets of a similarity just above 0.8 share a band."""
    rng = np.random.default_rng(4)
    hits = []
    for _ in range(400):
        every = rng.integers(0, 2**63, 200, dtype=np.uint64)
        one, two = (resemblance.band_keys(np.sort(x)) for x in (every[:180], every[20:]))
        hits.append(any(a == b for a, b in zip(one, two, strict=True)))
    assert np.mean(hits) >= 0.995
