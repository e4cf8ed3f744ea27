import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import ann, embed

CLASHING = "cid long, cell int, v string, n int, tree int, rows int, root int, query_id int, score double"


@pytest.fixture
def vectors(spark):
    def make(rows, kind="float"):
        filler = (1, 1, "x", 1, 1, 1, 1, 1, 0.5)
        return spark.createDataFrame([(i, v, *filler) for i, v in rows], f"vec_id long, embedding array<{kind}>, {CLASHING}")

    return make


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, least=0.9):
    n = len(rows)
    width = max([len(v) for _, v in rows if v] or [0])
    links, label = [0] * n, list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    full = [np.array(v + [0.0] * (width - len(v)), dtype=np.float32).astype(float) if usable(v) else None for _, v in rows]
    for i in range(n):
        for j in range(i):
            if full[i] is None or full[j] is None:
                continue
            if full[i] @ full[j] / (np.linalg.norm(full[i]) * np.linalg.norm(full[j])) >= least:
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    best = {}
    for i in range(n):
        if rows[i][0] is not None:
            best[root(i)] = min(rows[i][0], best.get(root(i), rows[i][0]))
    out = [(rows[i][0], links[i], best.get(root(i))) for i in range(n)]
    return sorted(((a, b, c, a == c) for a, b, c in out), key=repr)


def got_links(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def planted(seed, n, dim=12):
    """Random vectors, exact and scaled copies, and chains of near copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            v = list(rng.choice(rows)[1])
            if rng.random() < 0.6:
                v = [x + rng.gauss(0, 0.15) for x in v]
            elif rng.random() < 0.5:
                v = [4 * x for x in v]
        else:
            v = [rng.gauss(0, 1) for _ in range(dim)]
        rows.append((i, [float(np.float32(x)) for x in v]))
    return rows


ODD = [
    (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]),
    (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [2.0, 0.0, 0.0]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (None, [0.0, 3.0]), (None, None), (-4, [1e-30, 1e-30]),
]


@pytest.mark.parametrize("cell,block", [(10_000, 10_000), (40, 16), (7, 3)])
def test_links_equal_brute_force(vectors, cell, block):
    rows = planted(1, 300)
    assert got_links(embed.embedding_duplicates(vectors(rows), cell_size=cell, block_size=block)) == brute_links(rows)


def test_chains_over_many_blocks(vectors):
    """Paths of neighbours 20 degrees apart, in random order: one component each, whatever the blocks."""
    rng = random.Random(3)
    rows = []
    for path in range(6):
        for step in range(18 if path % 2 else 9):
            v = [0.0] * 12
            v[2 * path], v[2 * path + 1] = math.cos(math.radians(20 * step)), math.sin(math.radians(20 * step))
            rows.append(v)
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    for cell, block in ((10_000, 10_000), (20, 8)):
        assert got_links(embed.embedding_duplicates(vectors(rows), cell_size=cell, block_size=block)) == brute_links(rows)


@pytest.mark.parametrize("cell", [1, 3])
def test_pivots_of_one_direction(vectors, cell):
    """Copies scaled so that they round differently are classes and pivots of their own, and still find each other."""
    rng = random.Random(8)
    rows = []
    for _ in range(4):
        v = [rng.gauss(0, 1) for _ in range(12)]
        rows += [[s * x for x in v] for s in (1.0, 3.0, 0.1, 1 / 7, 1.7, 0.3, 11.0, 1 / 3, 7.1, 0.01)]
    rows = list(enumerate(rows))
    assert got_links(embed.embedding_duplicates(vectors(rows, "double"), cell_size=cell)) == brute_links(rows)


def test_many_copies_of_one_vector(vectors):
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(400)] + [(1000 + i, [1.0, 0.5, 0.001 * i]) for i in range(200)] + [(5000, [0.0, 0.0, 1.0])]
    assert got_links(embed.embedding_duplicates(vectors(rows), cell_size=50, block_size=32)) == brute_links(rows)


def test_odd_vectors(vectors):
    assert got_links(embed.embedding_duplicates(vectors(ODD))) == brute_links(ODD)
    assert embed.embedding_duplicates(vectors([])).count() == 0
    assert got_links(embed.embedding_duplicates(vectors([(1, None)]))) == [(1, 0, 1, True)]


def brute_nearest(rows, k, every=5):
    width = max([len(v) for _, v in rows if v] or [0])
    known = [(i, np.array(v + [0.0] * (width - len(v)))) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in known if i % every == 0}):
        for own in [v for i, v in known if i == q]:
            ranked = sorted((-float((v * own).sum()), i) for i, v in known if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    return sorted(out)


def got_nearest(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_all_candidates_give_the_exact_answer(vectors):
    """With the whole table as candidates the answer is exact, ties, lengths and copies included."""
    rows = planted(2, 200) + [(1000 + i, [0.5] * 12) for i in range(60)]
    got = got_nearest(ann.nearest(vectors(rows, "double"), F.col("vec_id") % 5 == 0, k=7, share=1e9, block_size=16))
    want = brute_nearest(rows, 7)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=0, atol=1e-12)


def test_few_candidates_and_odd_vectors(vectors):
    rows = [(i, v) for i, v in ODD if i not in (9,)] + [(20, [1.0, 1.0]), (25, [1.0, -1.0])]
    rows = [(i, v) for i, v in rows if i is None or i >= 0]
    assert got_nearest(ann.nearest(vectors(rows, "double"), F.col("vec_id") % 5 == 0, share=1e9)) == brute_nearest(rows, 20)
    assert ann.nearest(vectors([]), F.lit(True)).count() == 0
    assert ann.nearest(vectors([(1, None)]), F.lit(True)).count() == 0


def test_recall_of_the_production_setting(spark):
    from lakeweave.llm.queries import op4_nearest_neighbours

    sf_dir = "/root/testdata/sf0.01"
    found = {}
    for r in op4_nearest_neighbours(spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(table.vec_id, table.embedding, strict=True)]
    want = {}
    for q, _, i, _ in brute_nearest(rows, 20, every=20):
        want.setdefault(q, set()).add(i)
    recall = np.mean([len(found[q] & ids) / len(ids) for q, ids in want.items()])
    assert set(found) == set(want) and recall >= 0.9


def test_forest_climbs_all_trees_in_step():
    rng = np.random.default_rng(0)
    rows = rng.standard_normal((2000, 8))
    forest = ann.Forest(8, 4, 32, 10, float(np.linalg.norm(rows, axis=1).max()))
    strings = forest.strings(rows, queries=False)
    for tree in range(4):
        prefix, count = np.unique(strings[:, tree] >> 22, return_counts=True)
        forest.counts[tree, prefix] = count
    forest.fill(*[x for x in (np.array([0]), np.array([0]), forest.counts[0, [0]])])
    asked = forest.strings(rows[:50], queries=True)
    levels = forest.levels(asked, 300)
    for i in range(50):
        matches = lambda level, i=i: sum(int(((strings[:, t] >> (32 - level)) == (asked[i, t] >> (32 - level))).sum()) for t in range(4))
        assert levels[i] == 0 or matches(levels[i]) >= 300
        assert levels[i] == 10 or matches(levels[i] + 1) < 300
