"""SimHash near-duplicates: 64-bit fingerprints of word shingles, matched by BK-trees over shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import components, joint_labels, stored, text_bytes

BITS = 64
RADIUS = 3
SHINGLE = 3
SHARD_SIZE = 1024
SEED = 42
_HASHES_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle of the text (words in ASCII lower case, joined by one space), repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(words) - width + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 without hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[at : at + _HASHES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*ids, fp)`` of every row: the fingerprint as a signed 64-bit number. Texts are read whole.

    Null texts and texts without words have fingerprint 0. Rows are kept as they are, also repeated ones and null ids.
    """
    wanted = docs.select(*ids, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint_of(shingle_hashes(t, width)) for t in text_bytes(batch.column(len(ids)))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], [*ids, "fp"])

    return wanted.mapInArrow(run, ", ".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in ids) + ", fp long")


class BKTree:
    """BK-tree of 64-bit fingerprints: at most one child of a node for each Hamming distance to it."""

    def __init__(self, points: np.ndarray):
        """Places all points level by level: each waits at a node until it is the first of its distance there."""
        self.points = points
        self.child = np.full((len(points), BITS + 1), -1, dtype=np.int32)
        waiting = np.arange(1, len(points))
        at = np.zeros(len(waiting), dtype=np.int64)
        while len(waiting):
            edge = np.bitwise_count(points[waiting] ^ points[at]).astype(np.int64)
            slots, first = np.unique(at * (BITS + 1) + edge, return_index=True)
            self.child.ravel()[slots] = waiting[first]
            stays = np.ones(len(waiting), dtype=bool)
            stays[first] = False
            at = self.child[at, edge][stays].astype(np.int64)
            waiting = waiting[stays]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, node) index pairs at most ``radius`` apart. From a node at distance d only the edges
        ``d - radius .. d + radius`` can lead to a match, by the triangle inequality."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        found_q, found_n = [], []
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.points[node]).astype(np.int64)
            near = distance <= radius
            found_q.append(query[near])
            found_n.append(node[near])
            edges = distance[:, None] + np.arange(-radius, radius + 1)
            inside = (edges >= 0) & (edges <= BITS)
            below = np.where(inside, self.child[node[:, None], np.clip(edges, 0, BITS)], -1)
            row, column = np.nonzero(below >= 0)
            query, node = query[row], below[row, column].astype(np.int64)
        return np.concatenate(found_q or [query]), np.concatenate(found_n or [node])


def _tree_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a tree with a block of fingerprints: each linked one with the smallest of its local component."""
    for batch in batches:
        a, b = [], []
        for tree, block, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
            nodes, queries = (x.values.to_numpy().view(np.uint64) for x in (tree, block))
            q, n = BKTree(nodes).within(queries, RADIUS)
            both = nodes if same else np.concatenate((nodes, queries))
            label = joint_labels(len(both), n, q + (0 if same else len(nodes)))
            linked = np.nonzero(label != np.arange(len(both)))[0]
            a.append(both[linked].view(np.int64))
            b.append(both[label[linked]].view(np.int64))
        none = [np.empty(0, dtype=np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or none)) for x in (a, b)], ["a", "b"])


def linked_fingerprints(distinct: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all fingerprint pairs at most three bits apart.

    Two such fingerprints agree in one of four 16-bit quarters. A shard holds the fingerprints that agree in the leading
    bits of one quarter; the number of bits follows the corpus, so that a shard has about ``shard_size`` of them. A shard
    that is larger is cut into several trees of that size. Every tree is sent to the blocks of fingerprints of its own
    shard, and to no other; a tree and a block are both bounded, whatever the corpus holds.
    """
    n = distinct.count()
    bits = min(16, max(0, math.ceil(math.log2(max(1, n) / shard_size))))
    quarter = lambda i: F.shiftright(F.col("fp"), 48 - 16 * i).bitwiseAND(F.lit(0xFFFF))
    shard = lambda i: F.shiftright(quarter(i), 16 - bits) + F.lit(i << 16)
    rows = stored(distinct.select("fp", F.explode(F.array(*[shard(i) for i in range(4)])).alias("shard")), "simhash_shards")
    trees = F.greatest(F.lit(1), F.round(F.col("count") / shard_size)).cast("int")
    sizes = stored(rows.groupBy("shard").count().select("shard", trees.alias("trees")), "simhash_sizes")
    blocks = (
        rows.join(sizes, "shard")
        .groupBy("shard", F.pmod(F.xxhash64("fp"), F.col("trees")).alias("block"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    blocks = stored(blocks, "simhash_trees")
    pairs = blocks.alias("t").join(blocks.alias("q"), F.expr("t.shard = q.shard and t.block <= q.block"))
    return pairs.select(F.col("t.fps").alias("tree"), F.col("q.fps").alias("block"), F.expr("t.block = q.block").alias("same")).mapInArrow(_tree_links, "a long, b long")


def component_labels(distinct: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """``(fp, label)``: the smallest ``first`` over the component of each fingerprint, from ``(fp, first)``."""
    roots = components(linked_fingerprints(distinct, shard_size))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash_roots")
    return rooted.join(rooted.groupBy("root").agg(F.min("first").alias("label")), "root").select("fp", "label")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, shard_size: int = SHARD_SIZE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``(doc_id, text)``.

    ``fingerprint`` is 16 hex digits. Documents whose fingerprints differ in at most three bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable (null only if a component has null ids alone). Null and empty
    texts have fingerprint 0 and are linked like any other. Repeated rows are one more document each. An empty table
    gives an empty result; other columns are not read.
    """
    fps = stored(fingerprints(docs, width), "simhash_fps")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_distinct")
    labels = component_labels(distinct, shard_size)
    return fps.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("label").alias("component_id"))


def one_per_component(docs: DataFrame, width: int = SHINGLE, shard_size: int = SHARD_SIZE) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their near-duplicate component (null ids last), one for each component.

    All texts without words are one component. Of rows with the same id the first one read stays.
    """
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("uid")), "simhash_docs")
    fps = stored(fingerprints(numbered.select("uid", "doc.doc_id", "doc.text"), width, ("doc_id", "uid")), "simhash_fps")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    distinct = stored(fps.groupBy("fp").agg(F.min(place).alias("first")), "simhash_distinct")
    kept = component_labels(distinct, shard_size).select("label.uid").distinct()
    # The kept ids grow with the documents: one plan for all sizes, and no broadcast that only small tables allow.
    return numbered.join(stored(kept, "simhash_kept").hint("merge"), "uid", "left_semi").select("doc.*")
