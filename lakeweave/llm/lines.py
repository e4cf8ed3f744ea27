"""Line dedup: repeated runs of lines by distributed prefix doubling over line names; later copies are deleted."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import stored, text_bytes

MIN_WORDS = 8


def _windows(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the shortest windows of ``min_words`` words: one from every line on and one up to every line, where the text allows."""
    upto = np.cumsum(words)
    before = np.concatenate(([0], upto[:-1]))
    here = np.arange(len(words))
    # A window has one line at least, also when min_words is 0.
    last = np.maximum(np.searchsorted(upto, before + min_words), here)
    first = np.minimum(np.searchsorted(before, upto - min_words, side="right") - 1, here)
    onward = last < len(words)
    back = (first >= 0) & (last[first] != here)  # others are the window from their first line on
    starts = np.concatenate((here[onward], first[back]))
    lengths = np.concatenate((last[onward], here[back])) - starts + 1
    order = np.argsort(starts, kind="stable")
    return starts[order], lengths[order]


def _lines_of(min_words: int):
    """One row per line: position, digest, and the lengths of the windows that start there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, positions, digests, needs, counts = [], [], [], [], []
            for i, text in enumerate(text_bytes(batch.column(2))):
                if not batch.column(2)[i].is_valid:
                    continue
                lines = text.split(b"\n")
                starts, lengths = _windows(np.array([len(x.split()) for x in lines]), min_words)
                needs.append(lengths)
                counts.append(np.bincount(starts, minlength=len(lines)))
                rows.append(np.full(len(lines), i))
                positions.append(np.arange(len(lines)))
                digests += [hashlib.blake2b(x, digest_size=16).digest() for x in lines]
            if not rows:
                continue
            row = pa.array(np.concatenate(rows))
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(needs).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(np.concatenate(positions).astype(np.int32)), pa.array(digests, pa.binary()), lists],
                ["uid", "doc_id", "pos", "digest", "needs"],
            )

    return run


def repeated_windows(lines: DataFrame) -> DataFrame:
    """Later copies ``(uid, pos, need)`` among windows of ``need`` lines, from ``(uid, doc_id, pos, digest, needs)``.

    Suffixes of the line sequences are grouped by ever longer prefixes. The name of a block of lines is the place of
    its first copy, so equal names mean equal blocks and need no check. Round k knows the names of all blocks of
    2^k lines that occur more than once; two overlapping ones name any length up to 2^(k+1), and two adjacent ones are the next round. Blocks that occur once
    drop out, as everything longer that starts there occurs once. The suffixes with an equal name form an interval of the
    suffix array whose common prefix is the block; its first member is kept, the others are later copies.
    """
    here = F.struct("doc_id", "uid", "pos").alias("here")
    first = lines.groupBy("digest").agg(F.min(here).alias("name"), F.count("*").alias("n")).where("n > 1").select("digest", "name")
    # As a table the names are a plain side of the join, so that Spark can split the rows of a very common line.
    first = stored(first, "line_first")
    longest = F.coalesce(F.array_max("needs"), F.lit(0)).alias("longest")
    named = stored(lines.join(first, "digest").select("uid", "doc_id", "pos", "needs", longest, "name"), "line_names")
    found = named.where(F.array_contains("needs", 1)).where(F.struct("doc_id", "uid", "pos") != F.col("name")).select("uid", "pos", F.lit(1).alias("need"))
    size = 1
    while named.where(F.col("longest") > size).limit(1).count():
        # Windows of up to twice the block: their first and their last block overlap or touch.
        ends = named.select(F.col("uid").alias("u"), F.col("pos").alias("p"), F.col("name").alias("end"))
        due = named.where(F.col("longest") > size).select("uid", "doc_id", "pos", "name", F.explode("needs").alias("need"))
        due = due.where((F.col("need") > size) & (F.col("need") <= 2 * size))
        whole = due.join(ends, (F.col("uid") == F.col("u")) & (F.col("pos") + F.col("need") - size == F.col("p"))).drop("u", "p")
        heads = whole.groupBy("need", "name", "end").agg(F.min(here).alias("first"))
        later = whole.join(heads, ["need", "name", "end"]).where(F.struct("doc_id", "uid", "pos") != F.col("first"))
        found = found.unionByName(later.select("uid", "pos", "need"))
        # Names of blocks of twice the size, for windows that are longer still.
        longer = named.where(F.col("longest") > 2 * size).select("uid").distinct()
        pairs = named.join(longer, "uid", "left_semi").join(ends, (F.col("uid") == F.col("u")) & (F.col("pos") + size == F.col("p"))).drop("u", "p")
        twice = pairs.groupBy("name", "end").agg(F.min(here).alias("next"), F.count("*").alias("n")).where("n > 1").drop("n")
        named = stored(pairs.join(twice, ["name", "end"]).select("uid", "doc_id", "pos", "needs", "longest", F.col("next").alias("name")), "line_names")
        size *= 2
    return found


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated line runs, plus ``n_lines`` and ``n_removed``.

    Lines end at ``\\n`` and are compared byte for byte. A run is any number of consecutive whole lines of one text that hold
    ``min_words`` words or more. Every line of a run whose lines also start earlier (smaller ``doc_id``, or same document and earlier
    line) is removed: maximal repeats go from their first to their last line. Runs are judged on the input.

    A maximal run is the union of its shortest windows of ``min_words`` words, those from its lines on and those up to its lines: the former reach from
    its first line to the last that leaves enough words behind it, the latter cover each line after that. So only they are looked up.
    Kept lines are joined by ``\\n`` again.

    All columns and rows stay, an empty table stays empty; a text whose lines all go is empty, a null text stays null with 0 lines, an empty text is
    one empty line. Null ids come first; repeated rows are ordered by their place in the input. ``n_chars``, if there,
    follows the text.
    """
    names = docs.columns
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("uid"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), "line_docs")
    text_at, doc_at = f"c{names.index('text')}", f"c{names.index('doc_id')}"
    lines = numbered.select("uid", doc_at, text_at).mapInArrow(
        _lines_of(min_words), f"uid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, pos int, digest binary, needs array<int>"
    )
    covered = stored(repeated_windows(stored(lines, "lines")), "line_windows")
    gone = covered.groupBy("uid").agg(F.collect_list(F.struct("pos", "need")).alias("gone"))
    joined = numbered.join(gone, "uid", "left").drop("uid")
    added = ["n_lines", "n_removed"]
    kept = [i for i, c in enumerate(names) if c not in added]  # columns of these names are replaced
    fields = [f"c{i} {docs.schema.fields[i].dataType.simpleString()}" for i in kept]
    out = joined.select(*[f"c{i}" for i in kept], "gone").mapInArrow(
        _rebuild(kept.index(names.index("text")), kept.index(names.index("n_chars")) if "n_chars" in names else None), ", ".join([*fields, "n_lines long", "n_removed long"])
    )
    return out.toDF(*[names[i] for i in kept], *added)


def _rebuild(text_at: int, chars_at: int | None):
    """Texts without the lines of the windows in the last column, with the numbers of lines and of removed lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths, counts, removed = [], [], [], []
            columns = batch.columns[:-1]
            old = columns[chars_at].to_pylist() if chars_at is not None else [None] * len(batch)
            for text, windows, n_chars in zip(columns[text_at].to_pylist(), batch.column(len(columns)), old, strict=True):
                kept = [] if text is None else text.split("\n")
                counts.append(len(kept))
                drop = np.zeros(len(kept) + 1, dtype=np.int64)
                if windows.is_valid:
                    pos, need = (windows.values.field(f).to_numpy() for f in ("pos", "need"))
                    np.add.at(drop, pos, 1)
                    np.add.at(drop, pos + need, -1)
                    drop = np.cumsum(drop)
                    text = "\n".join([x for x, d in zip(kept, drop.tolist(), strict=False) if not d])
                    n_chars = len(text)
                removed.append(int((drop[:-1] > 0).sum()))
                texts.append(text)
                lengths.append(n_chars)
            columns[text_at] = pa.array(texts, pa.string())
            if chars_at is not None:
                columns[chars_at] = pa.array(lengths, columns[chars_at].type)
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [f"x{i}" for i in range(len(columns) - 2)] + ["n_lines", "n_removed"])

    return run
