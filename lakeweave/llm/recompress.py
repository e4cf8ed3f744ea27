"""Substring dedup by recompression: rounds that name runs and pairs find where repeated passages can start."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import stored, text_bytes

WINDOW = 20
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
# Longest symbols that a pair round may join. Whether a place is a border of the last round depends on the words within
# 1 + sum(ROUNDS) of it, and no symbol but a run is longer than 2 * max(ROUNDS).
ROUNDS = (1, 1, 1, 2, 2)
REACH = 1 + sum(ROUNDS)
WIDEST = 2 * max(ROUNDS)
_ODD = np.uint64(0x9E3779B97F4A7C15)  # any odd number: powers of it have inverses modulo 2^64
_TURNS = [np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for turn in range(len(ROUNDS))]
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and the number of words of each text. Arrow cuts at ASCII white space; no word becomes a Python object."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).view(pa.large_string()))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy() > 0  # white space at the ends of a text leaves empty parts
    upto = np.concatenate(([0], np.cumsum(full)))
    offsets = lists.offsets.to_numpy()
    return words.filter(pa.array(full)), np.diff(upto[offsets - offsets[0]])


def word_names(words: pa.Array) -> np.ndarray:
    """128-bit names of words; each different one is hashed once."""
    numbered = words.dictionary_encode()
    raw = b"".join(map(xxhash.xxh3_128_digest, numbered.dictionary.view(pa.large_binary()).to_pylist()))
    return np.frombuffer(raw, dtype=np.uint64).reshape(-1, 2)[numbered.indices.to_numpy()]


def borders(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks the words at which a symbol of the last round starts. ``first`` marks the first word of each document.

    Round 0 names maximal runs of one word. Every later round halves the alphabet by a bit of the name and joins a symbol of the left
    half with a following one of the right half, unless either is longer than the round allows. A name is a hash of what it stands for, so
    equal runs and pairs have equal names wherever they are, without any exchange between tasks. What a round does at a
    place depends on the two symbols there, so equal passages are cut alike but for ``REACH`` words at their ends.
    Words inside a run that is wider than any other symbol count as borders too.
    """
    n = len(names)
    head = np.ones(n, dtype=bool)
    head[1:] = (names[1:] != names[:-1]) | first[1:]
    start = np.nonzero(head)[0]
    length = np.diff(np.append(start, n))
    name = np.where(length > 1, mixed(names[start] + length.astype(np.uint64) * _ODD), names[start])
    alone = first[start]
    inside = np.repeat(length > WIDEST, length)
    for turn, longest in enumerate(ROUNDS):
        right = mixed(name + _TURNS[turn]) >> np.uint64(63) == 1
        short = length <= longest
        joins = (short & ~right)[:-1] & (short & right)[1:] & ~alone[1:]
        at = np.nonzero(joins)[0]
        name[at] = mixed(name[at] * _ODD + name[at + 1])
        length[at] += length[at + 1]
        keep = np.ones(len(name), dtype=bool)
        keep[at + 1] = False
        start, length, name, alone = start[keep], length[keep], name[keep], alone[keep]
    marks = inside
    marks[start] = True
    return marks


class Spans:
    """Names of all spans of a sequence of word names, from running sums of a polynomial modulo 2^64."""

    def __init__(self, names: np.ndarray):
        n = len(names)
        powers = np.ones(n + 1, dtype=np.uint64)
        inverse = np.ones(n + 1, dtype=np.uint64)
        powers[1:], inverse[1:] = np.cumprod(np.full(n, _ODD)), np.cumprod(np.full(n, _ODD_INVERSE))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(names * powers[:n], out=self.sums[1:])
        self.inverse = inverse

    def name(self, start: np.ndarray, width: int) -> np.ndarray:
        return mixed((self.sums[start + width] - self.sums[start]) * self.inverse[start])


class Passages:
    """The windows and anchors of a group of documents.

    The anchor of a window is its first border at least ``(window - WIDEST) // 2`` words in, together with as many words on both
    sides. All that decides lies inside the window, so equal windows have equal anchors.
    """

    def __init__(self, texts: pa.Array, window: int):
        words, counts = words_of(texts)
        ends = np.cumsum(counts)
        every = word_names(words)
        self.window, self.names = window, every
        n = len(every)
        first = np.zeros(n + 1, dtype=bool)
        first[ends - counts] = True
        # Windows: places with enough words left in their document.
        left = np.repeat(ends, counts) - np.arange(n)
        self.windows = np.nonzero(left >= window)[0]
        side = (window - WIDEST) // 2
        if not len(self.windows):
            self.anchor_of, self.anchor_keys = np.empty(0, np.int64), np.empty(0, np.uint64)
            return
        marks = np.append(borders(np.ascontiguousarray(every[:, 0]), first[:n]), True)
        after = np.where(marks, np.arange(n + 1), n)
        after = np.minimum.accumulate(after[::-1])[::-1]
        anchors, self.anchor_of = np.unique(after[self.windows + side], return_inverse=True)
        self.anchor_keys = Spans(every[:, 0]).name(anchors - side, 2 * side)

    def candidates(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose anchor key is repeated, and their 128-bit names."""
        at = self.windows[repeated[self.anchor_of]] if len(self.windows) else self.windows
        return at, np.stack([Spans(np.ascontiguousarray(self.names[:, i])).name(at, self.window) for i in (0, 1)], axis=1)


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys by bucket, and the bucket of each in that order. ``keys`` are rows of one or two numbers."""
    bucket = ((keys if keys.ndim == 1 else keys[:, 0]) >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order].astype(np.int64)


def _rows_by_bucket(group: int, keys: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    order, bucket = _dealt(keys, buckets)
    cuts = np.nonzero(np.diff(bucket))[0] + 1
    return [(int(b[0]), group, keys[o].tobytes()) for o, b in zip(np.split(order, cuts), np.split(bucket, cuts), strict=True) if len(o)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of one or two numbers in sorted order, the first index of each, and the row of every key."""
    keys = keys[:, None] if keys.ndim == 1 else keys
    order = np.lexsort(keys.T[::-1])  # stable: the first of equal keys comes first
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
    back = np.empty(len(keys), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    return keys[order[new]], order[new], back


def _judge(earlier: bool):
    """For the keys that each group sent to this bucket: do they occur in another (an earlier) group? One bit per key, in the order sent."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        width = 2 if earlier else 1
        sent = table.column("keys").to_pylist()
        counts = [len(k) // (8 * width) for k in sent]
        keys = np.frombuffer(b"".join(sent), dtype=np.uint64).reshape(-1, width)
        distinct, first, back = _distinct(keys)
        hit = first[back] != np.arange(len(keys)) if earlier else np.bincount(back, minlength=len(distinct))[back] > 1
        cuts = np.cumsum(counts)[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(hit, cuts)]
        return pa.table({"group": table.column("group"), "bucket": table.column("bucket"), "n": pa.array(counts, pa.int32()), "bits": pa.array(bits, pa.binary())})

    return run


def _answers(marks: list[dict] | None) -> np.ndarray:
    """The bits that came back for a group: of its keys in the order that ``_dealt`` gives them."""
    bits = [np.unpackbits(np.frombuffer(m["bits"], dtype=np.uint8), count=m["n"]) for m in sorted(marks or [], key=lambda m: m["bucket"])]
    return np.concatenate(bits).astype(bool) if bits else np.empty(0, dtype=bool)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive documents as one row: the unit that asks and is answered. Groups follow the order of the documents."""
    base, count = TaskContext.get().partitionId() << 32, 0
    kind, ids, texts, size = None, [], [], 0

    def row() -> pa.RecordBatch:
        columns = [pa.array([base + count]), pa.array([ids], pa.list_(kind)), pa.array([texts], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["group", "ids", "texts"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            if ids and size + len(text) > GROUP_BYTES:
                yield row()
                ids, texts, size, count = [], [], 0, count + 1
            ids.append(doc)
            texts.append(text)
            size += len(text)
    if ids:
        yield row()


def _ask_anchors(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield _asked(_rows_by_bucket(group, np.unique(Passages(texts.values, window).anchor_keys), buckets))

    return run


def _asked(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, group, keys = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(group, pa.int64()), pa.array(keys, pa.binary())], ["bucket", "group", "keys"])


PLACES = -1  # in place of a bucket: the row holds where a group's windows are, not what it asks


def _ask_windows(window: int, buckets: int):
    """The names of a group's candidate windows by bucket, and one row with their places.

    Places are three rows of 32-bit integers: first words, the number of the name among those asked, and whether the group holds the window earlier.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, texts, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                passages = Passages(texts.values, window)
                keys, _, back = _distinct(passages.anchor_keys)
                keys = keys[:, 0]
                elsewhere = np.empty(len(keys), dtype=bool)
                elsewhere[_dealt(keys, buckets)[0]] = _answers(marks)
                repeated = (elsewhere | (np.bincount(back, minlength=len(keys)) > 1))[back]
                at, names = passages.candidates(repeated)
                keys, first, back = _distinct(names)
                number = np.empty(len(keys), dtype=np.int64)
                number[_dealt(keys, buckets)[0]] = np.arange(len(keys))
                places = np.stack([at, number[back], first[back] != np.arange(len(at))]).astype(np.int32)
                yield _asked([*_rows_by_bucket(group, keys, buckets), (PLACES, group, places.tobytes())])

    return run


def _removed(window: int, with_text: bool):
    """Kept and removed words of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, texts, places, marks in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words, counts = words_of(texts.values)
                at, number, known = np.frombuffer(places, dtype=np.int32).reshape(3, -1)
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                if len(at):
                    later = at[(known == 1) | _answers(marks)[number]]
                    np.add.at(cover, later, 1)
                    np.add.at(cover, later + window, -1)
                kept = np.cumsum(cover)[:-1] == 0
                upto, ends = np.concatenate(([0], np.cumsum(kept))), np.concatenate(([0], np.cumsum(counts)))
                lists = pa.LargeListArray.from_arrays(pa.array(upto[ends]), words.filter(pa.array(kept)))
                joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).view(pa.large_binary())
                digests = [hashlib.sha256(t).hexdigest() for t in joined.to_pylist()]
                columns = [docs.values, pa.array(counts, pa.int64()), pa.array(counts - np.diff(upto[ends]), pa.int64()), pa.array(digests, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns, names = [*columns, joined.cast(pa.binary()).cast(pa.string())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``(doc_id, text)``, and the kept words if ``with_text``.

    A word is removed if a window of ``window`` consecutive words of its document covers it whose words also start earlier
    (smaller ``doc_id``, or same document and earlier word), all judged on the input. Words are runs without ASCII white space.

    Documents are put in order and gathered into groups of a few MB. A first exchange finds the anchors (places of the recompressed texts with
    the words around them) that occur more than once; only windows with such an anchor can repeat. A second exchange decides those windows by
    128-bit names of their words. In both, a group sends each distinct key once, packed by bucket, and gets a bit back for
    each: a passage that many documents share costs one key per group. Buckets grow in number with the corpus, not in size.

    A null text has no words. Null ids come first; equal ids are ordered by a hash of the text. An empty table gives no rows; other
    columns are not read.
    """
    if window < 2 * REACH + WIDEST:
        raise ValueError(f"windows need at least {2 * REACH + WIDEST} words")
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    groups = stored(dealt.select("doc_id", "text").mapInArrow(_grouped, f"group long, ids array<{kind}>, texts array<binary>"), "repeat_groups")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))

    asked = "bucket int, group long, keys binary"
    answer = "group long, bucket int, n int, bits binary"

    def by_group(answers: DataFrame, into: str) -> DataFrame:
        return answers.groupBy("group").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias(into))

    anchors = groups.select("group", "texts").mapInArrow(_ask_anchors(window, buckets), asked).groupBy("bucket").applyInArrow(_judge(False), answer)
    marked = groups.join(stored(by_group(anchors, "anchors"), "repeat_anchors"), "group", "left")
    # As a table, because the places are wanted again when the answers are there.
    windows = stored(marked.select("group", "texts", "anchors").mapInArrow(_ask_windows(window, buckets), asked), "repeat_asked")
    judged = windows.where(F.col("bucket") != PLACES).groupBy("bucket").applyInArrow(_judge(True), answer)
    places = windows.where(F.col("bucket") == PLACES).select("group", F.col("keys").alias("places"))
    marked = groups.join(places, "group").join(stored(by_group(judged, "windows"), "repeat_windows"), "group", "left")
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return marked.select("ids", "texts", "places", "windows").mapInArrow(_removed(window, with_text), schema + (", kept string" if with_text else ""))
