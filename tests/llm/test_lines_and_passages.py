import hashlib

import pytest

from lakeweave.llm import lines, recompress


def brute_lines(rows, min_words):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        text = rows[i][1]
        if text is None:
            out[i] = (rows[i][0], 0, 0, None)
            continue
        parts = text.split("\n")
        gone = [False] * len(parts)
        for p in range(len(parts)):
            words = 0
            for q in range(p + 1, len(parts) + 1):
                words += len(parts[q - 1].encode().split())
                if words < min_words:
                    continue
                window = tuple(parts[p:q])
                if window in seen:
                    gone[p:q] = [True] * (q - p)
                seen.add(window)
        out[i] = (rows[i][0], len(parts), sum(gone), "\n".join(x for x, g in zip(parts, gone, strict=True) if not g))
    return sorted(out, key=repr)


def got_lines(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_words", [0, 1, 3, 8, 30])
def test_lines(documents, made_up, min_words):
    rows = made_up(min_words, 60, vocabulary=3)
    assert got_lines(lines.dedup_lines(documents(rows), min_words)) == brute_lines(rows, min_words)


def test_lines_of_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert got_lines(out) == brute_lines(odd_rows, lines.MIN_WORDS)
    changed = {r.doc_id: r for r in out.where("n_removed > 0").collect()}
    assert changed[2].text == "" and changed[2].n_chars == 0


def test_long_windows_of_short_lines(documents):
    """Windows of many lines take several rounds of doubling."""
    rows = [(i, "\n".join(["a b", "", "c", ""] * 6 + [f"own {i}"])) for i in range(3)] + [(9, "\n" * 40)]
    assert got_lines(lines.dedup_lines(documents(rows), 17)) == brute_lines(rows, 17)


def test_short_tails_go_with_their_run(documents):
    """A last line of few words, blank lines and a short first line belong to the maximal run."""
    run = "Hello\n\none line of quite a few words that repeats\n\nbye now\n"
    rows = [(1, run + "alone"), (2, "before\n" + run + "after"), (3, run), (4, "bye now"), (5, "Hello\nbye now")]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(documents(rows)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("before\nafter", 5), 3: ("", 5), 4: ("bye now", 0), 5: (rows[4][1], 0)}
    assert got_lines(lines.dedup_lines(documents(rows))) == brute_lines(rows, 8)


def brute_passages(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((rows[i][0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got_passages(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("vocabulary", [1, 2, 4, 1000])
@pytest.mark.parametrize("window", [20, 27])
def test_passages(documents, made_up, monkeypatch, vocabulary, window):
    monkeypatch.setattr(recompress, "BUCKET_BYTES", 2000)
    rows = made_up(vocabulary, 60, vocabulary)
    assert got_passages(recompress.remove_repeats(documents(rows), window)) == brute_passages(rows, window)


def test_passages_of_odd_rows(documents, odd_rows):
    out = recompress.remove_repeats(documents(odd_rows), with_text=True)
    assert got_passages(out) == brute_passages(odd_rows, 20)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert kept[8] in ("other end", "") and kept[3] == ""


def test_short_windows_are_refused(documents):
    with pytest.raises(ValueError, match="20 words"):
        recompress.remove_repeats(documents([]), 19)


def test_empty(documents):
    assert lines.dedup_lines(documents([])).count() == 0
    assert recompress.remove_repeats(documents([])).count() == 0
    assert lines.dedup_lines(documents([(1, None)])).collect()[0].n_lines == 0
    assert recompress.remove_repeats(documents([(1, None)])).collect()[0].n_words == 0


def test_equal_passages_are_cut_alike():
    import numpy as np

    rng = np.random.default_rng(1)
    for vocabulary in (2, 5, 1000):
        passage = rng.integers(0, vocabulary, 200).astype(np.uint64)
        marks = []
        for _ in range(2):
            whole = np.concatenate((rng.integers(0, vocabulary, 50).astype(np.uint64), passage, rng.integers(0, vocabulary, 50).astype(np.uint64)))
            first = np.zeros(len(whole), dtype=bool)
            first[0] = True
            cut = recompress.borders(recompress.mixed(whole), first)
            marks.append(cut[50 + recompress.REACH : 250 - recompress.REACH])
            assert np.diff(np.nonzero(cut)[0]).max() <= recompress.WIDEST
        assert (marks[0] == marks[1]).all()
