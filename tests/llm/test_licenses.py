import random

import pytest

from lakeweave.llm import licenses
from lakeweave.llm.licenses import NOTICES, NoticeFinder

from conftest import SF_DIR


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if ord(c) >= 128 or c in "0123456789abcdefghijklmnopqrstuvwxyz" else " " for c in lowered).split(" ")


def brute_base(text, phrases=licenses.PHRASES):
    words = [w for w in words_of(text) if w]
    places = []
    for phrase, label in phrases:
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def fewest_edits(notice, text):
    """Edits from a notice to the nearest substring of a text, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def changed(rng, notice, edits):
    chars = list(notice)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("abcdeé ")
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz é"))
    return "".join(chars)


def test_seeds_and_verification_equal_dynamic_programming():
    """For every notice of every text: found if and only if some substring is within its edits, and with the fewest of them."""
    rng, finder = random.Random(1), NoticeFinder(NOTICES)
    filler = ["lorem", "gnu", "license", "the", "public", "under", "é", "cc", "by", "4", "0"]
    for _ in range(250):
        n = rng.randrange(len(NOTICES))
        around = [" ".join(rng.choice(filler) for _ in range(rng.randint(0, 12))) for _ in range(2)]
        text = " " + " ".join(f"{around[0]} {changed(rng, NOTICES[n][0], rng.randint(0, finder.errors[n] + 2))} {around[1]}".split()) + " "
        got = {}
        for s in finder.verified(text):
            assert fewest_edits(finder.wanted[s.notice], text[s.start : s.end]) <= s.edits
            got[s.notice] = min(got.get(s.notice, 99), s.edits)
        want = {m: fewest_edits(w, text) for m, w in enumerate(finder.wanted)}
        assert got == {m: edits for m, edits in want.items() if edits <= finder.errors[m]}


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("licensed under cc-by 4.0", "cc-by"),
        ("Licensed under CC BY NC ND 4.0", "cc-by-nc-nd"),
        ("This work is licensed under the GNU General Public Licence, version 3.", "gpl"),
        ("the GNU Lesser General Public License", "gpl,lgpl"),
        ("Released under tha MIT Licence!", "mit"),
        ("Mozilla  Publick\nLicense", "mpl"),
        ("PERMISSION IS HEREBY GRANTED, free of charge, to any persons obtaining the copy", "mit"),
        ("licensed under nothing at all", ""),
        ("a public license of the general kind", ""),
        ("the limit license", ""),
    ],
)
def test_labels(documents, text, labels):
    row = licenses.license_labels(licenses.scan_licenses(documents([(1, text)]))).first()
    assert row.labels == labels and (row.score > 0) == bool(labels)


def test_base_places_equal_brute_force(documents, odd_rows):
    rng = random.Random(4)
    pool = ["mit", "MIT", "license", "License,", "apache", "general", "public", "é", "x9", "mitlicense", "licensé", "-"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(1000 + i, r[1]) for i, r in enumerate(odd_rows)]
    rows += [(2000, "mit license mit license"), (2001, "ＭＩＴ license"), (2002, "mit license" * 3), (2003, "\x00mit\x7flicense`")]
    got = licenses.license_labels(licenses.scan_licenses(documents(rows))).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {i: brute_base(t) for i, t in rows}
    for r in got:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert r.score == 1 if r.n_base else 0 <= r.score <= 1


def test_spans(documents):
    text = "Ümlaut first. Relased under the MIT-licens; then: Licensed  under the Apache License, Version 2.0 and more"
    row = licenses.scan_licenses(documents([(1, text)])).first()
    assert [(s.label, s.first_word, s.last_word, s.edits, s.matched) for s in row.spans] == [
        ("mit", 2, 6, 2, "relased under the mit licens"), ("apache", 8, 15, 0, "licensed under the apache license version 2 0")
    ]
    assert [(p.label, p.word) for p in row.places] == [("apache", 11)]
    assert row.spans[0].score == pytest.approx(1 - 2 / 30)


def test_long_texts_and_text_full_of_seeds(documents):
    rows = [(1, "word " * 300_000 + "released under the mit licence"), (2, "released under thx " * 3000), (3, "gnu general public license " * 3000)]
    got = {r.doc_id: r for r in licenses.license_labels(licenses.scan_licenses(documents(rows))).collect()}
    assert got[1].labels == "mit" and got[1].n_words == 300_005
    assert got[2].labels == "" and got[3].n_base == 3000 and got[3].last_word == 4 * 2999 + 1


def test_odd_rows_and_empty_tables(documents, odd_rows):
    got = licenses.license_labels(licenses.scan_licenses(documents(odd_rows))).collect()
    assert len(got) == len(odd_rows)
    assert all((r.n_words, r.n_base, r.first_word, r.labels, r.score) == (0, 0, None, "", 0) for r in got if r.doc_id in (3, 4, 5))
    assert licenses.scan_licenses(documents([])).count() == 0


def test_labels_of_the_documents_table(spark):
    """The planted lines are found, and nothing else is labelled."""
    docs = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet")
    got = {r.doc_id: r for r in licenses.license_labels(licenses.scan_licenses(docs)).collect()}
    for r in docs.collect():
        text = " ".join(w for w in words_of(r.text) if w)
        assert bool(got[r.doc_id].labels) == any(w in text for w in ("mit license", "apache license", "general public license", "cc by"))
