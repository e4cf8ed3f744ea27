"""Near-duplicates by similarity: SimHash trees and MinHash bands draw the candidates, the Jaccard similarity of the shingle sets decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import components, joint_labels, stored, text_bytes
from lakeweave.llm.simhash import SHARD_SIZE, component_labels, fingerprint_of, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS: 0.99997 at 0.8.
BANDS = 20
ROWS = 4
# Shingles of a block of sets.
BLOCK_SIZE = 1 << 16
_FACTORS = np.random.default_rng(42).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes in order."""
    return np.unique(shingle_hashes(text, width))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed key for each band; none for an empty set."""
    if not len(hashes):
        return []
    low = np.array([(hashes * f).min() for f in _FACTORS]).reshape(BANDS, ROWS)
    return [int(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), i)).view(np.int64)) for i, row in enumerate(low)]


def _described(width: int):
    """Digest, number of shingles, SimHash fingerprint and band keys of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in text_bytes(batch.column(2))]
            columns = [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
            columns.append(pa.array(np.array([fingerprint_of(s) for s in sets], dtype=np.uint64).view(np.int64)))
            columns.append(pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["uid", "doc_id", "digest", "n", "fp", "keys"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, width).tobytes() for t in text_bytes(batch.column(1))], pa.binary())], ["cid", "shingles"])

    return run


def similar(sets: list[np.ndarray], n_left: int, same: bool, least: float) -> np.ndarray:
    """Smallest member of each local component: links are pairs of the first ``n_left`` sets with the others (or among them if ``same``).

    A set is only compared while there are sets it is not yet connected with.
    """
    sizes = np.array([len(s) for s in sets])
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = 0 if same else n_left
    label, marked = np.arange(len(sets)), np.zeros(len(names), dtype=np.int64)
    for i in range(n_left):
        others = max(first, i + 1)
        if others == len(sets) or (label[others:] == label[i]).all():
            continue
        own = place[starts[i] : starts[i] + sizes[i]]
        marked[own] = 1
        both = np.add.reduceat(marked[place[starts[others] :]], starts[others:] - starts[others])
        marked[own] = 0
        near = others + np.nonzero(both >= least * (sizes[i] + sizes[others:] - both))[0]
        if len(near):
            label = joint_labels(len(sets), np.full(len(near), label[i]), label[near])[label]
    return label


def _block_links(least: float):
    """Links of two blocks of sets: each linked set with the smallest of its local component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i in range(len(batch)):
                same = batch.column(2)[i].as_py()
                blocks = [batch.column(c)[i].values for c in ((0,) if same else (0, 1))]
                ids = np.concatenate([x.field("cid").to_numpy() for x in blocks])
                sets = [np.frombuffer(s, dtype=np.uint64) for x in blocks for s in x.field("shingles").to_pylist()]
                label = similar(sets, len(blocks[0]), same, least)
                linked = np.nonzero(label != np.arange(len(ids)))[0]
                a.append(ids[linked])
                b.append(ids[label[linked]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

    return run


def _tree_keys(classes: DataFrame, shard_size: int) -> DataFrame:
    """``(cid, n, key)``: one key for all classes of a component of fingerprints, as the BK-trees link them."""
    some = classes.where("n > 0")
    labels = component_labels(stored(some.groupBy("fp").agg(F.min("cid").alias("first")), "near_fingerprints"), shard_size)
    return some.join(labels.hint("merge"), "fp").select("cid", "n", F.xxhash64(F.lit("tree"), "label").alias("key"))


def one_per_component(
    docs: DataFrame, width: int = SHINGLE, least: float = SIMILARITY, block_size: int = BLOCK_SIZE, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their near-duplicate component (null ids last), one for each component.

    Documents are linked if their sets of ``width``-word shingles (words in ASCII lower case; a shorter text is one shingle) have a
    Jaccard similarity of ``least`` or more. Equal sets are one class. Candidates are the classes of one component of SimHash
    fingerprints (of the sets, three bits, found by the BK-trees of ``simhash``) and those that share a band of MinHash values, for
    most pairs near 0.8 are more than three bits apart. Both are compared in blocks of
    bounded size, all pairs of a group, so that a large group is many tasks; a block emits one local root per set, never pairs.
    A pair is missed only if it shares neither, and it counts all the same where other documents connect it. Null texts and texts
    without words are one component. Of rows with the same id the first one read stays. An empty table gives an empty one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("uid")), "near_docs")
    texts = numbered.select("uid", "doc.doc_id", "doc.text")
    described = stored(texts.mapInArrow(_described(width), f"uid long, doc_id {kind}, digest binary, n long, fp long, keys array<long>"), "near_sets")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    merged = described.groupBy("digest").agg(F.min(place).alias("first"), *[F.first(c).alias(c) for c in ("n", "fp", "keys")])
    classes = stored(merged.select(F.col("first.uid").alias("cid"), "first", "n", "fp", "keys"), "near_classes")
    rows = classes.select("cid", "n", F.explode("keys").alias("key")).unionByName(_tree_keys(classes, shard_size))
    rows = stored(rows, "near_keys")
    groups = rows.groupBy("key").agg(F.count("*").alias("members"), F.ceil(F.sum("n") / block_size).alias("blocks")).where("members > 1")
    groups = stored(groups.select("key", "blocks"), "near_groups")
    members = rows.join(groups, "key").select("cid", "key", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"))
    members = stored(members, "near_members")
    wanted = stored(members.select("cid").distinct(), "near_wanted")
    sets = texts.join(wanted.hint("merge"), F.col("uid") == F.col("cid"), "left_semi").select("uid", "text").mapInArrow(_sets(width), "cid long, shingles binary")
    sets = stored(sets, "near_shingles")
    blocks = members.join(sets.hint("merge"), "cid").groupBy("key", "block").agg(F.collect_list(F.struct("cid", "shingles")).alias("sets"))
    blocks = stored(blocks, "near_blocks")
    pairs = blocks.alias("one").join(blocks.alias("two"), F.expr("one.key = two.key and one.block <= two.block"))
    pairs = pairs.select(F.col("one.sets").alias("x"), F.col("two.sets").alias("y"), F.expr("one.block = two.block").alias("same"))
    roots = components(pairs.mapInArrow(_block_links(least), "a long, b long"))
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left").select("first", F.coalesce("root", "cid").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.uid")
    # The kept ids grow with the documents: one plan for all sizes, and no broadcast that only small tables allow.
    return numbered.join(stored(kept, "near_kept").hint("merge"), "uid", "left_semi").select("doc.*")
