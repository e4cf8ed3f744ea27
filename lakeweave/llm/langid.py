"""Language identification: TF-IDF vectors of byte n-grams against several clustered centroids per language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

UNKNOWN = "und"
BUCKETS = 1 << 13
SAMPLE_PER_LANGUAGE = 800
CENTROIDS = 4
ROUNDS = 8
# A text is rejected when it is farther from its centroid than this share of pieces, about as rich in n-grams, of texts that the centroids were not fitted on.
REJECT_QUANTILE = 0.999
CLASSES = BUCKETS.bit_length()
PIECES_AT_LEAST = 200
LETTER = re.compile(r"[^\W\d_]")
_BYTES_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 64


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the 2- and 3-byte n-grams of the lower-cased text, hashed into buckets. ASCII other than letters and apostrophes counts as white space."""
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", dtype=np.uint8)
    letter = (raw >= 97) & (raw <= 122) | (raw >= 128) | (raw == 39)
    raw = np.where(letter, raw, np.uint8(32))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(raw), _BYTES_AT_ONCE):
        x = raw[at : at + _BYTES_AT_ONCE + 2].astype(np.uint32)
        two = x[:-1] << 8 | x[1:]
        three = two[:-1] << 8 | x[2:]
        two = two[: _BYTES_AT_ONCE]
        for grams in (two | np.uint32(1 << 24), three):
            mixed = grams * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return counts


def vectors_of(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log counts times IDF, scaled to length 1."""
    rows = np.empty(counts.shape)
    for at in range(0, len(counts), _ROWS_AT_ONCE):  # the intermediate arrays are of a few rows
        part = np.log1p(counts[at : at + _ROWS_AT_ONCE]) * idf
        rows[at : at + _ROWS_AT_ONCE] = part / np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1e-12)
    return rows


def richness(counts: np.ndarray) -> np.ndarray:
    """Class of each row: the power of two below its number of different n-grams. Repeating a word adds nothing."""
    return np.log2(np.maximum(1, (counts > 0).sum(axis=1))).astype(np.int64)


@dataclass
class Model:
    """Centroids (unit rows), their language, and the largest distance that each accepts in each class. Size: languages times centroids."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    limits: np.ndarray


def labelled(docs: DataFrame) -> Column:
    """Training rows: a language is given and CRC-32 of the id as text, modulo 4, is not 2."""
    return F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the task that contain each bucket; the last row has the number of texts."""
    total = np.zeros(BUCKETS + 1, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total[:-1] += ngram_counts(text) > 0
            total[-1] += 1
    if total[-1]:
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def _centers(rows: np.ndarray, centroids: int) -> np.ndarray:
    """Spherical k-means."""
    centers = rows[:1]
    for _ in range(1, min(centroids, len(rows))):  # next start: the text farthest from all starts
        centers = np.concatenate((centers, rows[[(rows @ centers.T).max(axis=1).argmin()]]))
    for _ in range(ROUNDS):
        near = (rows @ centers.T).argmax(axis=1)
        sums = np.array([rows[near == i].sum(axis=0) if (near == i).any() else centers[i] for i in range(len(centers))])
        centers = sums / np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return centers


def _pieces(text: str, turn: int) -> list[str]:
    """The text, and every third of its beginnings of 8, 16, 32, ... characters with a letter."""
    upto = [8 << j for j in range(turn % 3, len(text).bit_length(), 3) if 8 << j < len(text)]
    return [text, *[text[:n] for n in upto if LETTER.search(text[:n])]]


def _limits(texts: list[str], rows: np.ndarray, idf: np.ndarray, centroids: int, quantile: float) -> np.ndarray:
    """Largest accepted distance of each class: the quantile over pieces of each half of the texts, by centroids of the other half.

    A class with few pieces takes those of the shorter classes too, which are farther away. Limits never grow with the class.
    """
    halves = [np.arange(i, len(texts), 2) for i in (0, 1)] if len(texts) > 1 else [np.array([0])] * 2
    distance, kind = [], []
    for one, other in (halves, halves[::-1]):
        centers = _centers(rows[one], centroids)
        pieces = [p for i in other.tolist() for p in _pieces(texts[i], i // 2)]
        for at in range(0, len(pieces), _ROWS_AT_ONCE):
            counts = np.array([ngram_counts(p) for p in pieces[at : at + _ROWS_AT_ONCE]])
            distance.append(1 - (vectors_of(counts, idf) @ centers.T).max(axis=1))
            kind.append(richness(counts))
    distance, kind = np.concatenate(distance), np.concatenate(kind)
    limits = np.empty(CLASSES)
    for k in range(CLASSES):
        low = next((j for j in range(k, 0, -1) if ((kind >= j) & (kind <= k)).sum() >= PIECES_AT_LEAST), 0)
        near = distance[(kind >= low) & (kind <= k)]
        limits[k] = np.quantile(near, quantile, method="higher") if len(near) else 1.0
    return np.maximum.accumulate(limits[::-1])[::-1]


def _clusters(idf: np.ndarray, centroids: int, quantile: float):
    """Centroids of the sample of one language, and how far from them texts are accepted."""

    def run(key: tuple, sample: pa.Table) -> pa.Table:
        texts = sample.sort_by("rank").column("text").to_pylist()
        rows = np.empty((len(texts), BUCKETS))
        for at in range(0, len(texts), _ROWS_AT_ONCE):
            rows[at : at + _ROWS_AT_ONCE] = vectors_of(np.array([ngram_counts(t) for t in texts[at : at + _ROWS_AT_ONCE]]), idf)
        centers = _centers(rows, centroids)
        limits = _limits(texts, rows, idf, centroids, quantile)
        n = len(centers)
        columns = {
            "lang": pa.array([key[0].as_py()] * n, pa.string()),
            "centroid": pa.array([c.astype("<f4").tobytes() for c in centers], pa.binary()),
            "far": pa.array([limits.tolist()] * n, pa.list_(pa.float64())),
        }
        return pa.table(columns)

    return run


def train(
    docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS, quantile: float = REJECT_QUANTILE
) -> Model | None:
    """Fit on ``(doc_id, text, lang)``: document frequencies over all training rows, centroids on ``sample`` of them per language.

    The sample holds the rows of smallest hash of each language, so it is the same whatever the partitions. Texts without a letter teach
    nothing. None if there is nothing to learn from. The driver holds one number per language.
    """
    lessons = docs.select("doc_id", "text", "lang").where(labelled(docs) & F.col("text").rlike(r"\p{L}"))
    total = lessons.select("text").mapInArrow(_document_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    if not len(total):
        return None
    counts = np.zeros(BUCKETS + 1, dtype=np.int64)
    counts[total.column("bucket").to_numpy()] = total.column("n").to_numpy()
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1.0
    # Hashes below a threshold that about twice the sample passes; so few texts travel, however many tasks there are.
    # The smallest hash passes always: rows of the same id and text have one hash, so chance alone could draw none of them.
    chance = F.pmod(F.xxhash64(F.lit("lesson"), F.col("doc_id"), F.col("text")), F.lit(1 << 40))
    sizes = lessons.groupBy("lang").agg(F.count("*").alias("n"), F.min(chance).alias("low")).orderBy("lang").collect()
    shares = [(r.lang, min(1.0, max((2.0 * sample + 100) / r.n, (r.low + 1) / (1 << 40)))) for r in sizes]
    share = F.create_map(*[F.lit(x) for row in shares for x in row])
    drawn = lessons.where(chance < share[F.col("lang")] * F.lit(float(1 << 40)))
    ranked = drawn.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(chance, "doc_id"))).where(F.col("rank") <= sample)
    by_language = ranked.select("lang", "rank", "text").groupBy("lang")
    fitted = by_language.applyInArrow(_clusters(idf, centroids, quantile), "lang string, centroid binary, far array<double>")
    fitted = fitted.toArrow().sort_by("lang")
    rows = np.array([np.frombuffer(x, dtype="<f4") for x in fitted.column("centroid").to_pylist()])
    return Model(idf, rows, fitted.column("lang").to_pylist(), np.array(fitted.column("far").to_pylist()))


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                texts = part.column("text").to_pylist()
                language, score, accepted = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
                known = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
                for at in range(0, len(known) if model is not None else 0, _ROWS_AT_ONCE):
                    some = known[at : at + _ROWS_AT_ONCE]
                    counts = np.array([ngram_counts(texts[i]) for i in some])
                    cosine = vectors_of(counts, model.idf) @ model.centroids.T
                    for i, row, c, k in zip(some, cosine, cosine.argmax(axis=1).tolist(), richness(counts).tolist(), strict=True):
                        language[i], score[i] = model.languages[c], float(min(1.0, max(0.0, row[c])))
                        accepted[i] = bool(1 - row[c] <= model.limits[c, k])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                    [*part.schema.names, "lang_pred", "score", "accepted"],
                )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``accepted``.

    Only ``text`` enters the prediction, and it is read whole. ``accepted`` is false beyond the distance limit of the centroid
    for texts about as rich in n-grams. Null texts, texts without a
    letter, and all texts if there was nothing to learn from are ``und`` with score 0, and not accepted. Rows, also repeated ones, and
    other columns stay; an empty table stays empty. Equal cosines go to the language that sorts first.
    """
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("lang_pred", "score", "accepted")])  # replaced
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_predict(model), f"{schema}, lang_pred string, score double, accepted boolean")
