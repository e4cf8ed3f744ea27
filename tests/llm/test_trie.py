import hashlib
import random
import zlib

import pytest

from lakeweave.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string"
CLASHING = "conv long, key string, at long, part int, path int, name string, d int, slot int, saved int, `a b` int"


@pytest.fixture
def conversations(spark):
    def make(rows, extra=False):
        if extra:
            return spark.createDataFrame([(*r, 1, "x", 1, 1, 1, "x", 1, 1, 1, 1) for r in rows], f"{COLUMNS}, {CLASHING}")
        return spark.createDataFrame(rows, COLUMNS)

    return make


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute_trie(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, digest(role or "", text or ""), role or "", text or ""))
    convs = {c: [turn[3:] for turn in sorted(turns)] for c, turns in convs.items()}
    nodes = {}  # prefix → members, conversations that end there
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        turns = convs.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), ([], []))[0].append(c)
        nodes[tuple(turns)][1].append(c)
    children = {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, (members, _) in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    return ordered(
        (
            min(members), len(p), min(nodes[p[:-1]][0]) if p else None, len(members), children.get(p, 0), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest(),
        )
        for p, (members, ends) in nodes.items()
    )


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def made_up(seed, n, longest, ids=lambda rng, c: c):
    rng, rows = random.Random(seed), []
    for c in range(n):
        c = ids(rng, c)
        for t in range(rng.choice([1, 2, 3, rng.randint(1, longest)])):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["x", "yy", "é漢", None])))
    return rows


@pytest.mark.parametrize("height,longest", [(2, 10), (3, 40), (16, 40)])
def test_every_node_equals_brute_force(conversations, height, longest):
    """With low bands, three and more levels of bands above each other; ids that repeat, are negative or lie far apart."""
    rows = made_up(height, 50, longest, lambda rng, c: rng.choice([c, c, c * 7, -c, 10**15 + c]))
    assert ordered(trie.prefix_trie(conversations(rows), height=height).collect()) == brute_trie(rows)


def test_depths_at_the_edges_of_bands(conversations):
    """Conversations that end at, just before and just after whole blocks of one and of two levels, all on one line."""
    rows = [(100 * n, t, "user", f"turn {t}") for n in range(1, 29) for t in range(n)]
    assert ordered(trie.prefix_trie(conversations(rows), height=3).collect()) == brute_trie(rows)


def test_one_conversation_holds_most_rows_and_many_are_alike(conversations):
    rows = [(700, t, "user", f"turn {t % 5}") for t in range(600)] + [(c, 0, "user", "hello") for c in range(1000, 1300)]
    rows += [(701, 0, "user", "turn 0")] * 50
    assert ordered(trie.prefix_trie(conversations(rows), height=4).collect()) == brute_trie(rows)


def test_odd_rows_and_empty_tables(conversations):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, None, None), (1, None, None, None), (1, 0, "", ""), (2, 5, "user", ""), (2, 5, "user", ""), (2, 5, "us", "er"), (2, 5, "use", "r"),
        (300, 0, "user", "x" * 100_000), (301, 1, "user", "x" * 100_000), (-150, 0, "a", "b"), (-100, 0, "c", "d"), (199, 0, "user", "base is absent"), (2**62, 2**62, "user", "late"),
    ]
    got = ordered(trie.prefix_trie(conversations(rows, extra=True)).collect())
    assert got == brute_trie(rows)
    assert got == ordered(trie.prefix_trie(conversations(rows[::-1])).collect())
    assert trie.prefix_trie(conversations([])).count() == 0
    assert trie.prefix_trie(conversations(rows[:1])).count() == 0


def test_turnless_conversations_are_members_of_the_root(conversations):
    """Conversations of one turn that give it up for a base that does not exist."""
    rows = [(c, 0, "user", "x") for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6]
    got = ordered(trie.prefix_trie(conversations(rows)).collect())
    assert got == brute_trie(rows) and len(got) == 1 and got[0][5] == 1
