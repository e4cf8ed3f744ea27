import random
import zlib
from dataclasses import replace

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeweave.llm import packing, tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PLAIN = {BYTE: Tokenizer.from_file(BYTE), WORD: Tokenizer.from_file(WORD)}
PIECES = [
    "a", "b", "Foo", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", "\xa0", " ", " ", "é", "é", "1", "23", "!", "'s", "'re", ".", ",", "İ", "ß",
    "<|endoftext|>", "<|startoftext|>", "　", "漢字", "́", "\r\n", "Word", "naïve", "×",
]


def ids_of(path, text):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("path,cut", [(BYTE, tokens.SPACED), (WORD, tokens.BARE)])
def test_cache_gives_the_ids_of_whole_texts(path, cut):
    cache = tokens.TokenCache(path, cut)
    cache.LIMIT = 40  # starts again often

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=4))
    def check(texts):
        assert [x.tolist() for x in cache.encode(texts)] == [ids_of(path, t) for t in texts]

    check()


def expected_files(rows):
    out, start = [], 0
    for doc, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*ids_of(WORD, text), 2]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def read_back(manifest):
    return [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in tokens.read_token_files(manifest).collect()]


def test_files_round_trip(documents, odd_rows, made_up):
    rows = [r for r in odd_rows if r[0] not in (8, None)] + [(100 + r[0], *r[1:]) for r in made_up(1, 200)]
    assert sorted(read_back(tokens.write_token_files(documents(rows), WORD, 2)), key=lambda r: r[1]) == expected_files(rows)


def test_repeated_and_null_ids(documents, odd_rows):
    got = read_back(tokens.write_token_files(documents(odd_rows), WORD, 2))
    got.sort(key=lambda r: r[1])
    assert sorted((repr(r[0]), *r[2:]) for r in got) == sorted((repr(r[0]), *r[2:]) for r in expected_files(odd_rows))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    keys = [(r[0] is not None, r[0] or 0) for r in got]
    assert keys == sorted(keys)


def test_file_format(documents):
    rows = [(i, f"text number {i} here") for i in range(50)]
    shards = tokens.write_token_files(documents(rows), WORD, 2).orderBy("shard").collect()
    store, base = pyarrow.fs.FileSystem.from_uri(shards[0].folder)
    flat, first = [], 0
    for s in shards:
        ids = np.memmap(f"{base}/{s['name']}.ids", dtype=s.width, mode="r")
        offsets = np.memmap(f"{base}/{s['name']}.off", dtype="<u8", mode="r")
        assert (s.first_id, s.n_ids, s.n_docs) == (first, len(ids), len(offsets) - 1) and offsets[0] == 0 and offsets[-1] == len(ids)
        assert ids.dtype.itemsize == 2 and all(ids[int(b) - 1] == 2 for b in offsets[1:])
        flat += ids.tolist()
        first += len(ids)
    assert flat == [i for _, t in rows for i in [*ids_of(WORD, t), 2]]


def test_no_rows_no_shards(documents):
    manifest = tokens.write_token_files(documents([]), WORD, 2)
    assert manifest.count() == 0 and tokens.read_token_files(manifest).count() == 0
    assert read_back(tokens.write_token_files(documents([(1, None)]), WORD, 2)) == [(1, 0, 1, crc([2]))]


# --- packing ------------------------------------------------------------------------------------


def check_packing(rows, pieces, window=1024):
    """Every id once, the right ids in each piece, no gap in a sequence, all but the last one full."""
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append([*ids_of(BYTE, r[1]), 0])
    assert sum(p.length for p in pieces) == sum(len(ids) for docs in want.values() for ids in docs)
    by_doc, sequences = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
        fits = [ids for ids in want[p.doc_id] if len(ids) == p.doc_tokens and crc(ids[p.start : p.start + p.length]) == p.ids_crc32]
        assert fits and p.length > 0
    for doc, found in by_doc.items():
        if len(want[doc]) == 1:
            found.sort(key=lambda p: p.start)
            assert [p.start for p in found] == np.cumsum([0, *[p.length for p in found]])[:-1].tolist()
    assert sorted(sequences) == list(range(len(sequences)))
    for s, found in sequences.items():
        found.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in found])
        assert [p.offset for p in found] == [0, *ends[:-1].tolist()] and (ends[-1] == window or s == len(sequences) - 1)
    return sequences


def test_packing_is_whole_and_gapless(documents, odd_rows, made_up):
    rows = odd_rows + [(100 + r[0], *r[1:]) for r in made_up(2, 150)]
    pieces = packing.pack_documents(documents(rows), BYTE, with_ids=True).collect()
    check_packing(rows, pieces)
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in pieces)


def test_every_window_keeps_the_proportions(documents):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(1, 600), "en", rng.choice(["a", "a", "a", "b", "b", None])) for i in range(400)]
    pieces = packing.pack_documents(documents(rows), BYTE).collect()
    sequences = check_packing(rows, pieces)
    total = {}
    for p in pieces:
        total[p.source] = total.get(p.source, 0) + p.length
    share = {s: n / sum(total.values()) for s, n in total.items()}
    for s in range(len(sequences) - 1):
        for source in total:
            found = sum(p.length for p in sequences[s] if p.source == source)
            assert abs(found - 1024 * share[source]) <= 2 * packing.SLOT


def test_given_weights_hold_until_a_queue_ends(documents):
    rows = [(i, "word " * 300, "en", "ab"[i % 2]) for i in range(100)]
    sequences = check_packing(rows, packing.pack_documents(documents(rows), BYTE, weights={"a": 3.0, "b": 1.0}).collect())
    for s in range(15):
        assert abs(sum(p.length for p in sequences[s] if p.source == "a") - 768) <= 2 * packing.SLOT
    assert {p.source for p in sequences[len(sequences) - 2]} == {"b"}


def test_small_sources_share_a_queue(documents, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    rows = [(i, "word " * (i % 90), "en", f"s{i % 9}" if i % 10 else None) for i in range(300)]
    check_packing(rows, packing.pack_documents(documents(rows), BYTE).collect())


def test_nothing_to_pack(documents):
    assert packing.pack_documents(documents([]), BYTE).count() == 0
    assert [(p.length, p.doc_tokens) for p in packing.pack_documents(documents([(1, None)]), BYTE).collect()] == [(1, 1)]


def test_schedule_covers_every_place_once():
    rng = random.Random(1)
    for trial in range(60):
        n = rng.randint(1, 6)
        lengths = np.array([rng.choice([1, 5, 127, 128, 129, 1000, 1024, 5000, 20000]) for _ in range(n)])
        weights = lengths.astype(float) if trial % 2 else np.array([rng.choice([0.5, 1, 2, 5]) for _ in range(n)], dtype=float)
        schedule = packing.RoundRobin(lengths, weights, 1024, 128)
        used = np.zeros(lengths.sum(), dtype=int)
        for q in range(n):
            starts = np.array(sorted({0, *[rng.randrange(lengths[q]) for _ in range(4)]}))
            doc, start, length, place = schedule.pieces(q, starts, np.diff(np.append(starts, lengths[q])))
            assert (place // 1024 == (place + length - 1) // 1024).all()
            for a, m in zip(place, length, strict=True):
                used[a : a + m] += 1
        assert (used == 1).all()


def test_words_are_cut_off_from_their_stops():
    """One word with several stops is one word to learn; cuts join to the text and ids stay those of the whole."""
    texts = ["one two, two. two; two! Two:two?", "", "a.b,c é, 1.5 it's. x|y <|endoftext|>, end", " ", ".", "two\ntwo,\n.two", "ü.x"]
    column = tokens.spaced_column(tokens.pa.array(["skipped here", *texts], tokens.pa.large_string()).slice(1))
    assert ["".join(x) for x in column.to_pylist()] == texts
    assert {w for words in column.slice(0, 1).to_pylist() for w in words} == {"one", " two", " Two", ",", ".", ";", "!", ":two", "?"}
    cache = tokens.TokenCache(BYTE, tokens.SPACED)
    assert [x.tolist() for x in cache.encode(texts)] == [ids_of(BYTE, t) for t in texts]
    assert cache.encode([]) is not None and tokens.spaced_column(tokens.pa.array([], tokens.pa.large_string())).to_pylist() == []


def test_bare_words_are_cut_off_from_their_stops():
    cache, texts = tokens.TokenCache(WORD, tokens.BARE), ["word word, word. word", "", "\tword\r\nword!  ", "it's. a.'s", " naïve, ß. a.́b"]
    assert [x.tolist() for x in cache.encode(texts)] == [ids_of(WORD, t) for t in texts]
    column = tokens.bare_column(tokens.pa.array(texts[:2], tokens.pa.large_string()))
    assert column.to_pylist() == [["word", " word", ",", " word", ".", " word"], []]
    assert tokens.bare_column(tokens.pa.array([], tokens.pa.large_string())).to_pylist() == []


def test_texts_are_encoded_a_few_at_once():
    """What a worker makes of texts stays small, however many come in one batch."""
    cut, sizes = tokens.SPACED.column, []
    watched = replace(tokens.SPACED, column=lambda column: sizes.append(sum(map(len, column.to_pylist()))) or cut(column))
    assert [len(x) for x in tokens.TokenCache(BYTE, watched).encode(["some words " * 30_000] * 8)] == [len(ids_of(BYTE, "some words " * 30_000))] * 8
    assert sum(sizes) == 8 * 330_000 and max(sizes) < 1 << 21


@pytest.mark.parametrize("path,cut", [(BYTE, tokens.SPACED), (WORD, tokens.BARE)])
def test_words_are_learnt_without_marks_and_line_ends(path, cut):
    text = " ".join(f"été{a} rest{a}" for a in ",.;:!?#$%&*") + " été$$$ rest%%% rest\nrest ×. ÷, Ö*"
    cache = tokens.TokenCache(path, cut)
    assert [x.tolist() for x in cache.encode([text])] == [ids_of(path, text)]
    assert {w for w in cache.row if "rest" in w.lower() or "t" in w} <= {"été", " été", "rest", " rest", "\nrest"}


@pytest.mark.parametrize("path,cut", [(BYTE, tokens.SPACED), (WORD, tokens.BARE)])
def test_letters_are_mapped_by_bytes_as_by_characters(path, cut):
    cache = tokens.TokenCache(path, cut)
    letters = "\0".join([" Aß", "ÀÖØöøÿ", "z"])
    by_bytes = cache._mapped(letters)
    assert cache.bytewise and (by_bytes, len(by_bytes.split("\0"))) == (letters.translate(cache.alphabet), 3)
