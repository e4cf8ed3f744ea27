"""One CSV file read by many tasks, although its quoted values may hold line ends.

Spark's text reader deals byte ranges of the file to tasks, as whole lines. Whether a range starts inside a quoted value depends on all
ranges before it, but a range can say for both cases how it ends: a two-state automaton. The states compose from the first range on,
and a second pass cuts every range at its first true record. Records are stored with a separator that the file does not contain, and
Spark's own CSV reader parses them, one by one and in parallel.

Two things differ from the reading by one task: texts of rejected records have ``\\n`` for every line end inside them and quotes around white space
alone, and carriage returns that stand alone on a line of a file with ``\\n`` line ends are not kept.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.session import file_bytes, file_size, work_dir

QUOTE, COMMA = b'"', b","
# Characters that may separate the stored records; one that the file does not contain is taken.
SEPARATORS = ["\x1e", "\x1f", "\x1d", "\x1c", "\x02", "\x03", "\x04", "\x05"]
_HEAD = 1 << 16


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is open at the end of a line, given whether one is open at its start.

    A quote opens at the start of a field only. Doubled quotes are part of the value; one that neither ends the field nor is doubled makes the
    rest of the field unquoted, as in Spark's reader.
    """
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == QUOTE:
                at, inside = at + 1, True
            else:
                at = line.find(COMMA, at) + 1
                if not at:
                    return False
                continue
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        if line[at + 1 : at + 2] == QUOTE:
            at += 2
            continue
        at = line.find(COMMA, at + 1) + 1  # the field ends here, with or without text behind the quote
        if not at:
            return False
        inside = False


def splittable(spark: SparkSession, path: str, encoding: str) -> bool:
    """Whether the ranges of a file may be cut at the byte of a line end: one file, an encoding that extends ASCII, and line ends with ``\\n``."""
    size = file_size(spark, path)
    if not size:
        return False
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        return False
    head = file_bytes(spark, path, 0, _HEAD)
    first = next((i for i, b in enumerate(head) if b in b"\r\n"), -1)
    return not name.startswith(("utf-16", "utf-32", "cp037", "cp500")) and first >= 0 and (head[first : first + 1] == b"\n" or head[first : first + 2] == b"\r\n")


@dataclass(frozen=True)
class Ranges:
    """What the first pass finds: the ranges that start inside a value, the range in which the record that reaches into a range began, the range
    of a record that is open at the end of the file, and a separator that no line has."""

    inside: dict[int, bool]
    began: dict[int, int]
    open_at_end: int | None
    separator: str


class RangedCsv:
    """A splittable CSV file with a header, as stored records that any number of tasks can parse. ``folder`` holds them until it is removed."""

    def __init__(self, spark: SparkSession, path: str, encoding: str = "UTF-8"):
        self.spark, self.path, self.encoding = spark, path, encoding
        head = file_bytes(spark, path, 0, _HEAD)
        end = next(i for i, b in enumerate(head) if b in b"\r\n")
        self.crlf = head[end : end + 2] == b"\r\n"
        self.ends_with_line = file_bytes(spark, path, file_size(spark, path) - 1, 1) == b"\n"
        self.header, self.header_lines = self._first_record()
        self.folder = work_dir(spark, "csv-records")

    def _first_record(self) -> tuple[bytes, int]:
        """The header, and the number of lines down to its end, from the start of the file."""
        size, n = file_size(self.spark, self.path), _HEAD
        while True:
            lines = file_bytes(self.spark, self.path, 0, n).split(b"\n")
            inside, held = False, []
            for i, line in enumerate(lines if n >= size else lines[:-1]):
                line = self._plain(line, i == 0)
                if not line and not held:
                    continue  # empty lines before the header are no records
                held.append(line)
                inside = inside_after(line, inside)
                if not inside:
                    return b"\n".join(held), i + 1
            if n >= size:
                return b"\n".join(held), len(lines)
            n *= 4

    def _plain(self, line: bytes, first: bool) -> bytes:
        """A line without the byte-order mark of the file and, where lines end with both characters, without the carriage return."""
        line = line.removeprefix(codecs.BOM_UTF8) if first else line
        return line.removesuffix(b"\r") if self.crlf else line

    def _lines(self) -> DataFrame:
        """Lines with the start of their range, in the file's order inside a range."""
        text = self.spark.read.option("lineSep", "\n").text(self.path)
        return text.select(F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))

    # --- first pass: the automaton of every range ---

    def ranges(self) -> Ranges:
        """One small row per range reaches the driver: how it ends if it starts outside or inside a value, and whether that value ends in it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list] = {}  # range → [end from outside, end from inside, whether a value open at the start is closed, separators used]
            for start, line in _rows(batches):
                state = found.setdefault(start, [False, True, False, set()])
                line = self._plain(line, False)
                if QUOTE in line:
                    state[0], state[1] = inside_after(line, state[0]), inside_after(line, state[1])
                    state[2] = state[2] or not state[1]
                state[3].update(c for c in SEPARATORS if c.encode() in line)
            rows = [(start, *state[:3], "".join(state[3])) for start, state in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, _STATE, strict=True)], names=list("soicu"))

        rows = self._lines().mapInArrow(run, "s long, o boolean, i boolean, c boolean, u string").collect()
        inside, began, opened, now = {}, {}, None, False
        for r in sorted(rows, key=lambda r: r.s):
            inside[r.s] = now
            if now:
                began[r.s] = opened
            ends_inside = r.i if now else r.o
            if ends_inside and (not now or r.c):
                opened = r.s
            now = ends_inside
        free = [c for c in SEPARATORS if c not in set("".join(r.u for r in rows))]
        if not free:
            raise ValueError(f"{self.path} contains all of the characters that may separate stored records")
        return Ranges(inside, began, opened if now else None, free[0])

    # --- second pass: records, and pieces of those that reach over ranges ---

    def _records(self, ranges: Ranges, pieces: bool) -> DataFrame:
        """``(run, start, record)``: whole records, or the pieces of records that reach over ranges, with the range in which the record began."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            start, held, inside, reached, n, size = None, [], False, False, 0, 0

            def end_range() -> None:
                # The header is no record, not even if it reaches over ranges.
                if held and pieces and not (start == 0 and n <= self.header_lines):
                    out.append((ranges.began[start] if reached else start, start, b"\n".join(held) + b"\n"))

            for new, line in _rows(batches):
                if new != start:
                    end_range()
                    start, held, n = new, [], 0
                    inside = reached = ranges.inside[start]
                n += 1
                line = self._plain(line, start == 0 and n == 1)
                held.append(line)
                inside = inside_after(line, inside)
                if inside:
                    continue
                if reached == pieces and not (start == 0 and n <= self.header_lines):
                    out.append((ranges.began[start] if reached else start, start, b"\n".join(held)))
                    size += sum(map(len, held))
                held, reached = [], False
                if size > _BATCH:
                    yield _batch(out)
                    out, size = [], 0
            end_range()
            yield _batch(out)

        return self._lines().mapInArrow(run, "run long, start long, record binary")

    def _joined(self, ranges: Ranges) -> DataFrame:
        """Records that reach over ranges. At most two pieces come from a range."""
        # A range that ends one record and begins another has two pieces, of different runs.
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda p: p["record"])
        runs = self._records(ranges, pieces=True).groupBy("run").agg(pieces.alias("pieces"))
        if 0 in ranges.began.values() and self._header_reaches(ranges):
            runs = runs.where("run <> 0")
        record = F.aggregate("pieces", F.lit(b""), lambda a, b: F.concat(a, b))
        if ranges.open_at_end is not None and not self.ends_with_line:
            record = F.when(F.col("run") == ranges.open_at_end, F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)
        return runs.select(record.alias("record"))

    def _header_reaches(self, ranges: Ranges) -> bool:
        """Whether the header is longer than the first range, so that its pieces are those of the range's only run."""
        first = self._lines().where("start = 0").count()
        return first < self.header_lines

    def store(self) -> str:
        """Write the records and return the separator to read them with. Every part starts with the header, which the reader skips."""
        ranges = self.ranges()
        records = self._records(ranges, pieces=False).select("record")
        if any(ranges.inside.values()) or ranges.open_at_end is not None:
            records = records.unionByName(self._joined(ranges))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([self.text(self.header)])], ["value"])
            for batch in batches:
                texts = [self.text(r) for r in batch.column(0).to_pylist() if r]  # empty lines are no records
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

        records.mapInArrow(run, "value string").write.option("lineSep", ranges.separator).text(self.folder)
        return ranges.separator

    def text(self, record: bytes) -> str:
        """A record as the reader has to see it: white space alone is quoted, or it would be skipped."""
        value = record.decode(self.encoding, "replace")
        return value if value.strip() else f'"{value}"'

    def __getstate__(self):  # tasks need no session
        return {k: v for k, v in vars(self).items() if k != "spark"}


_STATE = [pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
_BATCH = 1 << 22


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary()], strict=True)], ["run", "start", "record"])
