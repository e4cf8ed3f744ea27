import itertools
import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["the", "of", "und", "die", "la", "que", "été", "año", "Straße", "x1", "42", "don't", "a", "漢字", "B"]

# Names that operators use inside, and names that need quoting: none of them may get in the way.
CLASHING = "uid long, fp long, root string, `a b` string, `end` int, name string, block int, rows int, score int, bucket int, n int, at int, size int, _uid_ int, here string"


@pytest.fixture
def documents(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""

    def make(rows, extra=True):
        rows = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        if not extra:
            return spark.createDataFrame(rows, DOCS)
        width = CLASHING.count(",") + 1
        kinds = [c.strip().split()[-1] for c in CLASHING.split(",")]
        filler = tuple("x" if k == "string" else 1 for k in kinds)
        assert len(filler) == width
        return spark.createDataFrame([r + filler for r in rows], f"{DOCS}, {CLASHING}")

    return make


@pytest.fixture
def odd_rows():
    """Rows that every operator has to take."""
    rng = random.Random(5)
    long_text = " ".join(rng.choice(WORDS) + str(i % 977) for i in range(60_000))
    shared = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, "The same text of a few words, twice.\nAnd a second line that has more than eight words in it.", "en", "s1", 30),
        (2, "The same text of a few words, twice.\nAnd a second line that has more than eight words in it.", "en", "s1", 30),
        (3, None, None, None, None),
        (4, "", "en", "s2", 0),
        (5, " \n\t \r\n", "de", "s2", 6),
        (6, long_text, "de", "s1", len(long_text)),
        (7, f"start {shared} stop", "en", "s3", 9),
        (8, f"other {shared} end", "en", None, 9),
        (8, f"other {shared} end", "en", None, 9),
        (None, "no id here but words", "en", "s1", 4),
        (None, None, None, "s3", None),
        (9, "42 17 !! ??", "es", "s2", 11),
        (10, "word", None, "s2", 4),
        (11, "word word word word", "fr", "", 4),
        (12, "\x1c odd\x1cseparators and spaces\x85", "fr", "s1", 4),
        (2**62, "largest id", "fr", "s1", 4),
        (-5, "negative id", "fr", "s1", 4),
    ]
    return rows


@pytest.fixture
def made_up():
    """Random documents that share passages and lines."""

    def make(seed, n, vocabulary=12, words=60):
        rng = random.Random(seed)
        pool = [f"w{i}" for i in range(vocabulary)]
        texts = []
        for _ in range(n):
            text = [rng.choice(pool) for _ in range(rng.randint(0, words))]
            if texts and rng.random() < 0.6:
                other = rng.choice(texts).split()
                at = rng.randint(0, len(other))
                text = text[: rng.randint(0, 10)] + other[at : at + rng.randint(1, 50)] + text[:5]
            separators = itertools.cycle([" ", " ", " ", "\n"])
            texts.append("".join(w + next(separators) for w in text).strip() if rng.random() < 0.9 else " ".join(text))
        return [(i, t, "en", f"s{rng.randint(0, 3)}", len(t)) for i, t in enumerate(texts)]

    return make
