"""License notices in texts: exact phrases, and short notices within a few edits.

A notice that occurs with at most ``k`` edits and is cut into ``k + 1`` pieces leaves one piece untouched. So the pieces are exact seeds:
plain searches find them, and the regex library looks for the notice with bounded errors in the few characters around a seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import read_columns, text_bytes

# Phrases whose words have to stand consecutively, with their labels. (Fixed values.)
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Short notices as their words, with their labels. Relatives that differ by less than the allowed edits are all listed: the nearest one counts.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
]
CHARS_PER_EDIT = 12  # a notice may differ by one edit for so many of its characters

# A-Z to lower case, all other ASCII but digits and letters to spaces; what lies beyond ASCII belongs to words.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SPAN = "struct<label: string, notice: string, first_word: long, last_word: long, edits: int, score: double, matched: string>"
SCHEMA = f"doc_id {{kind}}, n_words long, places array<struct<label: string, word: long>>, spans array<{SPAN}>"


def plain_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text as the scan sees them."""
    return text.translate(_PLAIN).split()


@dataclass(frozen=True)
class Span:
    """A notice found in ``" words joined by spaces "``: characters from ``start`` to ``end``, ``edits`` away from the notice."""

    notice: int
    start: int
    end: int
    edits: int


class NoticeFinder:
    """All notices with their seeds and patterns, prepared once per task."""

    def __init__(self, notices: list[tuple[str, str]], chars_per_edit: int = CHARS_PER_EDIT):
        self.notices = notices
        self.wanted = [f" {words} " for words, _ in notices]
        self.errors = [len(words) // chars_per_edit for words, _ in notices]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(w, literal_spaces=True)}){{e<={k}}}") for w, k in zip(self.wanted, self.errors, strict=True)]
        self.seeds: dict[str, list[tuple[int, int]]] = {}  # piece → (notice, its offset there)
        for n, (wanted, k) in enumerate(zip(self.wanted, self.errors, strict=True)):
            cuts = [len(wanted) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                self.seeds.setdefault(wanted[a:b], []).append((n, a))

    def candidates(self, text: str) -> set[tuple[int, int]]:
        """(notice, where it would start without edits before the seed) of every seed in the text."""
        found = set()
        for seed, uses in self.seeds.items():
            at = text.find(seed)
            while at >= 0:
                found.update((n, at - offset) for n, offset in uses)
                at = text.find(seed, at + 1)
        return found

    def verified(self, text: str) -> set[Span]:
        """The best occurrence around every seed, if it is within the notice's errors."""
        found = set()
        for n, at in self.candidates(text):
            k = self.errors[n]
            low = max(0, at - k)
            match = self.patterns[n].search(text[low : at + len(self.wanted[n]) + k])
            if match:
                found.add(Span(n, low + match.start(), low + match.end(), sum(match.fuzzy_counts)))
        return found

    def find(self, text: str) -> list[Span]:
        """Occurrences that do not overlap, in order: of those that do, the one with the fewest edits stays, then the longest notice, then the first."""
        kept: list[Span] = []
        spans = sorted(self.verified(text), key=lambda s: (s.edits, -len(self.wanted[s.notice]), s.start, s.end, s.notice))
        taken: set[int] = set()  # inner characters of kept spans; neighbours share the space between them
        for s in spans:
            inside = range(s.start + 1, s.end - 1)
            if taken.isdisjoint(inside):
                taken.update(inside)
                kept.append(s)
        return sorted(kept, key=lambda s: (s.start, s.end))


def phrase_places(text: str, phrases: list[tuple[str, str]]) -> list[dict]:
    """Every place of every phrase in ``" words joined by spaces "``, overlapping ones too, with the number of its first word."""
    out = []
    for phrase, label in phrases:
        wanted = f" {phrase} "
        at = text.find(wanted)
        word, counted = 0, 0
        while at >= 0:
            word += text.count(" ", counted, at)
            counted = at
            out.append({"label": label, "word": word})
            at = text.find(wanted, at + 1)
    return sorted(out, key=lambda p: (p["word"], p["label"]))


def scan_licenses(
    docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """Words, phrase places and notice spans of every document: ``(doc_id, n_words, places, spans)``.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. ``places`` has the label and first word of each exact
    phrase. ``spans`` has for each notice within its edits (one for ``chars_per_edit`` characters; inserted, deleted or replaced ones) its label, its words, the
    first and last word it touches, the edits, ``1 - edits / length`` as score, and the text found. Whole texts are searched, in one narrow pass.

    A null text is empty and has no words; an empty table gives none back; ties and repeated rows are judged alike, row by row; null ids are
    kept; other columns, whatever their names, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(notices, chars_per_edit)
        for batch in batches:
            counts, places, spans = [], [], []
            for raw in text_bytes(batch.column(1)):
                words = plain_words(raw)
                text = " " + b" ".join(words).decode("utf-8", "surrogateescape") + " "
                counts.append(len(words))
                places.append(phrase_places(text, phrases))
                spans.append([_span_row(finder, text, s) for s in finder.find(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(places, _PLACES), pa.array(spans, _SPANS)], ["doc_id", "n_words", "places", "spans"]
            )

    return read_columns(docs, "doc_id", "text").mapInArrow(run, SCHEMA.format(kind=docs.schema["doc_id"].dataType.simpleString()))


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_SPANS = pa.list_(
    pa.struct([
        ("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("score", pa.float64()),
        ("matched", pa.string()),
    ])
)


def _span_row(finder: NoticeFinder, text: str, span: Span) -> dict:
    words, label = finder.notices[span.notice]
    matched = text[span.start : span.end]
    start = span.start + (len(matched) - len(matched.lstrip(" ")))
    first = text.count(" ", 0, start) - 1  # a word's number is the number of spaces before it, but for the leading one
    return {
        "label": label, "notice": words, "first_word": first, "last_word": first + matched.strip(" ").count(" "), "edits": span.edits,
        "score": 1 - span.edits / len(words), "matched": matched.strip(" ").encode("utf-8", "replace").decode("utf-8"),
    }


def license_labels(scanned: DataFrame) -> DataFrame:
    """One row per scanned document: places and their first and last word, labels of phrases and of both, and the best score.

    The score is 1 with an exact phrase, else that of the best notice, else 0. Labels are distinct, sorted, and joined by commas; empty without any.
    """
    base = F.transform("places", lambda p: p["label"])
    words = F.transform("places", lambda p: p["word"])
    found = F.transform("spans", lambda s: s["label"])
    best = F.array_max(F.transform("spans", lambda s: s["score"]))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, found)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
