"""Token ids of whole texts, and their binary form: flat unsigned integers with 64-bit document offsets."""

from __future__ import annotations

import codecs
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeweave.llm.common import stored
from lakeweave.session import work_dir

# White space as Unicode defines it, which is what the tokenizers' own patterns mean by \s. (Fixed values.)
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_WORD = re.compile(f"[^{SPACE}]+")
# Plain searches for single marks are far faster than a pattern.
_UNUSUAL = ["  ", " \n", "\n ", "\n\n", "\x00", *"\t\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_WIDE = [m for m in _UNUSUAL if len(m) == 1 and ord(m) > 127]  # white space beyond ASCII
_TEXT_AT_ONCE = 1 << 20
_STOP, _ASCII_LETTER, _SPACED_AT, _BARE_AT = (
    np.isin(np.arange(256), list(x)) for x in (b".,;:!?#$%&*", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", b" \n", b" \t\n\x0b\x0c\r")
)
# Second bytes of the letters from U+00C0 to U+00FF, whose first byte is C3; the other two there are signs.
_LATIN_LEAD, _LATIN_TAIL = 0xC3, np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])


def spaced_chunks(text: str) -> list[str]:
    """A text cut before every run of white space. Byte-level patterns give a run to what follows it or keep it alone,
    so no token crosses a cut."""
    if any(mark in text for mark in _UNUSUAL):
        return _CHUNK.findall(text)
    return text.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")


def bare_words(text: str) -> list[str]:
    """The runs between white space, for tokenizers that drop it."""
    # str.split() takes four separators for white space that Unicode does not.
    return _WORD.findall(text) if any(mark in text for mark in _SEPARATORS) else text.split()


def _cut_column(texts: pa.Array, space: np.ndarray) -> pa.Array:
    """Texts cut before every byte of ``space``, behind line ends, and between a Latin letter and a stop: those are never one token, and far
    fewer words differ without their stops. The cuts share the bytes of the texts."""
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(bounds[0]), int(bounds[-1])) if len(texts) else (0, 0)
    if low == high:
        return pa.LargeListArray.from_arrays(np.zeros(len(texts) + 1, dtype=np.int64), pa.array([], pa.large_string()))
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[low:high]
    first = space[raw]
    first[1:] |= raw[:-1] == 10
    stops = np.flatnonzero(_STOP[raw[1:]]) + 1
    last, before = raw[stops - 1], raw[np.maximum(stops - 2, 0)]
    first[stops[_ASCII_LETTER[last] | _LATIN_TAIL[last] & (before == _LATIN_LEAD)]] = True
    first[bounds[:-1][bounds[:-1] < bounds[1:]] - low] = True
    starts = np.append(np.flatnonzero(first), high - low)
    words = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts + low), texts.buffers()[2])
    return pa.LargeListArray.from_arrays(np.searchsorted(starts, bounds - low), words)


def spaced_column(texts: pa.Array) -> pa.Array:
    """The same for a column of texts without unusual marks."""
    return _cut_column(texts, _SPACED_AT)


def bare_column(texts: pa.Array) -> pa.Array:
    """The same for a column of texts whose white space is ASCII; a cut keeps the white space before it, which has no ids."""
    return _cut_column(texts, _BARE_AT)


@dataclass(frozen=True)
class Cut:
    """How texts are cut for a tokenizer, and the cuts that it always keeps whole.

    ``simple`` matches one word of Latin letters only (first group), which the tokenizer's normalizer does no more to than ``lower`` says.
    """

    split: Callable[[str], list[str]]
    simple: str
    lower: bool
    column: Callable[[pa.Array], pa.Array]  # cuts whole columns, for texts with none of the marks
    marks: tuple[str, ...]


_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SPACED = Cut(spaced_chunks, f"( ?[{_LETTERS}]+)", lower=False, column=spaced_column, marks=tuple(_UNUSUAL))
BARE = Cut(bare_words, f"[ \\t-\\r]?([{_LETTERS}]+)", lower=True, column=bare_column, marks=(*_SEPARATORS, *_WIDE))


class TokenCache:
    """Ids by word for one tokenizer file: most words of a corpus repeat, and looking one up is cheaper than merging it anew.

    The parts of a simple cut go straight to the tokenizer's model; any other cut goes through the whole tokenizer.
    Bounded: a full cache starts again, which costs time and changes no id.
    """

    LIMIT = 500_000
    _open: dict[tuple, TokenCache] = {}

    def __init__(self, path: str, cut: Cut):
        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        # The model's alphabet for single characters, as the tokenizer itself maps them.
        letters = [c for c in map(chr, range(256)) if c == " " or re.fullmatch(f"[{_LETTERS}]", c)]
        mapped = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c) for c in letters}
        self.alphabet = {ord(c): found[0][0] for c, found in mapped.items() if len(found) == 1}
        if self.cut.lower:  # white space before a word is dropped
            self.alphabet |= dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))
        self.bytewise = self._by_bytes()
        self._clear()

    @classmethod
    def of(cls, path: str, cut: Cut) -> TokenCache:
        """One per worker process, shared by its tasks."""
        key = (path, cut.split.__name__)
        if key not in cls._open:
            cls._open[key] = cls(path, cut)
        return cls._open[key]

    def _by_bytes(self) -> str:
        """The alphabet by bytes of UTF-8, which is mapped faster; empty if it is none."""
        table = list(map(chr, range(256)))
        for c, to in self.alphabet.items():
            if to:
                if len(to) != len(raw := chr(c).encode()):
                    return ""
                for b, x in zip(raw, to, strict=True):
                    table[b] = x
        whole = "".join(table)
        return whole if all(codecs.charmap_decode(chr(c).encode(), "strict", whole)[0] == to for c, to in self.alphabet.items() if to) else ""

    @property
    def width(self) -> np.dtype:
        """Smallest unsigned type that holds every id."""
        return np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)  # of the ids of a row; the next row's start ends them
        self.used = 0

    def _learn(self, new: list[str], needed: list[str], other: list[list[str]]) -> bool:
        """Add new words, and those of other texts. A full cache starts again, with those and the needed ones; says whether it did, as rows are others then."""
        if other:
            new = list({*new}.union(w for words in other for w in words if w not in self.row))
        if not new:
            return False
        again = len(self.row) + len(new) > self.LIMIT
        if again:
            self._clear()
            new = list({*needed}.union(*other))
        simple, rest, flat, lengths = self._simple(new)
        for encoded in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False):
            ids = encoded.ids
            flat += ids
            lengths.append(len(ids))
        first, upto = len(self.row), self.used + len(flat)
        self.ids, self.starts = _room(self.ids, upto), _room(self.starts, first + len(new) + 1)
        self.ids[self.used : upto] = flat
        self.starts[first : first + len(new) + 1] = self.used + np.concatenate(([0], np.cumsum(np.array(lengths, dtype=np.int64))))
        self.used = upto
        self.row.update(zip(simple + rest, range(first, first + len(new)), strict=True))
        return again

    def _simple(self, words: list[str]) -> tuple[list[str], list[str], list[int], list[int]]:
        """The simple cuts, all others, the ids of the simple ones after each other, and how many each has."""
        fits = pc.match_substring_regex(pa.array(words, pa.large_string()), f"\\A{self.cut.simple}\\z").to_numpy(zero_copy_only=False)
        simple, rest = list(compress(words, fits)), list(compress(words, ~fits))
        if not simple:
            return simple, rest, [], []
        letters = "\0".join(simple)  # mapped all at once: no letter is mapped to the separator
        found = list(map(self.tokenizer.model.tokenize, self._mapped(letters.lower() if self.cut.lower else letters).split("\0")))
        return simple, rest, [t.id for tokens in found for t in tokens], list(map(len, found))

    def _mapped(self, letters: str) -> str:
        """Letters in the model's alphabet."""
        if not self.bytewise:
            return letters.translate(self.alphabet)
        raw = letters.encode()
        return codecs.charmap_decode(raw.translate(None, b" \t\n\x0b\x0c\r") if self.cut.lower else raw, "strict", self.bytewise)[0]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, as the tokenizer gives them for the whole text.

        Texts are cut and their words numbered as columns: only different words become Python strings. Texts with unusual white space are cut one by one.
        """
        at = 0
        while at < len(texts):
            start, size = at, 0
            while at < len(texts) and (size < _TEXT_AT_ONCE or at == start):
                size += len(texts[at])
                at += 1
            yield from self._encode_some(texts[start:at])

    def _encode_some(self, texts: list[str]) -> Iterator[np.ndarray]:
        marks = self.cut.marks
        plain = [not any(mark in text for mark in marks) for text in texts]
        cuts = self.cut.column(pa.array([t for t, p in zip(texts, plain, strict=True) if p], pa.large_string()))
        numbered = cuts.flatten().dictionary_encode()
        known, other = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), [self.cut.split(t) for t, p in zip(texts, plain, strict=True) if not p]
        by_number = np.fromiter(map(self.row.get, known, repeat(-1)), dtype=np.int64, count=len(known))
        missing = by_number < 0
        new = list(compress(known, missing))
        again = self._learn(new, known, other)
        row = self.row.__getitem__
        if again:
            by_number = np.fromiter(map(row, known), dtype=np.int64, count=len(known))
        elif new:
            by_number[missing] = np.fromiter(map(row, new), dtype=np.int64, count=len(new))
        columns = self._ids(by_number[numbered.indices.to_numpy()] if known else by_number, cuts.offsets.to_numpy() - cuts.offsets[0].as_py())
        singles = (self._ids(np.fromiter(map(row, words), dtype=np.int64, count=len(words)), np.array([0, len(words)])) for words in other)
        for p in plain:
            yield next(columns) if p else next(next(singles))

    def _ids(self, rows: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of the words between neighbouring offsets, gathered at once."""
        starts = self.starts[rows]
        lengths = self.starts[rows + 1] - starts
        ends = np.concatenate(([0], np.cumsum(lengths)))
        places = np.repeat(starts - ends[:-1], lengths)
        places += np.arange(int(ends[-1]))
        flat = self.ids[places]
        del places
        cuts = ends[offsets]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield flat[a:b]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    larger[: len(array)] = array
    return larger


def texts_of(column: pa.Array) -> list[str]:
    """Null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def crc_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, cut: Cut = BARE, folder: str | None = None) -> DataFrame:
    """Write the ids of ``(doc_id, text)`` in ascending ``doc_id`` order; returns the manifest, one row per shard.

    Texts are dealt by ranges of ``doc_id``, so shard numbers follow the order, and every task writes one shard:

    * ``<name>.ids``: the ids, each document closed by ``end_id``, as unsigned 16-bit integers (32-bit for a larger vocabulary), nothing else;
    * ``<name>.off``: n + 1 unsigned 64-bit offsets into it, counted in ids;
    * ``<name>.doc``: the document ids, as an Arrow file.

    All three can be memory-mapped. The manifest has ``(shard, name, folder, width, n_docs, n_ids, first_doc, first_id)``; the last two come
    from prefix sums over the shards. Every attempt of a task writes files of its own name and only the
    attempt that succeeds is in the manifest, so lost executors leave no wrong bytes.

    A null text is empty and has the end id alone. Null ids come first; equal ids are ordered by a hash of the text, which also
    deals a hot id to several shards; equal rows are equal documents. An empty table has no shards. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TokenCache.of(tokenizer_path, cut)
        width = cache.width if end_id < 1 << 16 else np.dtype("<u4")
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:8]}"
        offsets, ids_out, doc_out = [np.zeros(1, dtype="<u8")], None, None
        try:
            for batch in batches:
                if not len(batch):
                    continue
                if ids_out is None:
                    store.create_dir(base, recursive=True)
                    ids_out = store.open_output_stream(f"{base}/{name}.ids")
                    doc_file = store.open_output_stream(f"{base}/{name}.doc")
                    doc_out = pyarrow.ipc.new_file(doc_file, pa.schema([("doc_id", batch.column(0).type)]))
                lengths = []
                for ids in cache.encode(texts_of(batch.column(1))):
                    ids_out.write(ids.astype(width).tobytes())
                    ids_out.write(np.array([end_id], dtype=width).tobytes())
                    lengths.append(len(ids) + 1)
                offsets.append((offsets[-1][-1] + np.cumsum(np.array(lengths, dtype="<u8"))).astype("<u8"))
                doc_out.write_batch(pa.RecordBatch.from_arrays([batch.column(0)], ["doc_id"]))
        finally:
            if ids_out is not None:
                ids_out.close()
                doc_out.close()
                doc_file.close()
        if ids_out is None:
            return
        every = np.concatenate(offsets)
        with store.open_output_stream(f"{base}/{name}.off") as out:
            out.write(every.tobytes())
        row = [[shard], [name], [folder], [width.str], [len(every) - 1], [int(every[-1])]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["shard", "name", "folder", "width", "n_docs", "n_ids"])

    dealt = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = stored(dealt.select("doc_id", "text").mapInArrow(write, "shard long, name string, folder string, width string, n_docs long, n_ids long"), "token_shards")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    first = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(into) for c, into in (("n_docs", "first_doc"), ("n_ids", "first_id"))]
    return manifest.select("*", *first)


def _open(store: pyarrow.fs.FileSystem, path: str):
    """A local file is memory-mapped; elsewhere it is read as a whole, one shard at a time."""
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with store.open_input_file(path) as source:
        return source.read_buffer()


def read_token_files(manifest: DataFrame, doc_kind: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files, ``start`` counted over all shards, ``ids`` as 32-bit integers in bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                store, base = pyarrow.fs.FileSystem.from_uri(shard["folder"])
                name = f"{base}/{shard['name']}"
                ids = np.frombuffer(_open(store, f"{name}.ids"), dtype=shard["width"])
                offsets = np.frombuffer(_open(store, f"{name}.off"), dtype="<u8").astype(np.int64)
                at = 0
                for docs in _batches(_open(store, f"{name}.doc")):
                    for low in range(0, len(docs), 1024):
                        part = docs.column(0).slice(low, 1024)
                        bounds = offsets[at : at + len(part) + 1]
                        found = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                        columns = [part, pa.array(bounds[:-1] + shard["first_id"]), pa.array(np.diff(bounds)), pa.array(found, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
                        at += len(part)

    # A shard is a task's work; the few manifest rows are dealt out again.
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, f"doc_id {doc_kind}, start long, n_tokens long, ids binary")


def _batches(buffer: pa.Buffer) -> Iterator[pa.RecordBatch]:
    reader = pyarrow.ipc.open_file(buffer)
    for i in range(reader.num_record_batches):
        yield reader.get_batch(i)
