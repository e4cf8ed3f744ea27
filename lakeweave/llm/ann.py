"""Approximate nearest neighbours by inner product: a forest of sorted hash-string arrays, searched by prefix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.llm.common import stored
from lakeweave.llm.vectors import as_bytes, dimension, matrix, packed

TREES = 12
BITS = 32
DEPTH = 12
CANDIDATE_SHARE = 1.5
BLOCK_SIZE = 4096
SEED = 7


class Forest:
    """What every task needs to know: the hash functions and, per tree, how many strings start with each prefix of ``depth`` bits.

    Its size depends on the parameters alone.
    """

    def __init__(self, dim: int, trees: int, bits: int, depth: int, longest: float):
        self.trees, self.bits, self.depth, self.longest, self.dim = trees, bits, depth, longest, dim
        self.planes = np.random.default_rng(SEED).standard_normal((dim + 1, trees * bits))
        self.counts = np.zeros((trees, 1 << depth), dtype=np.int64)

    def strings(self, rows: np.ndarray, queries: bool) -> np.ndarray:
        """Hash strings, one column per tree, first bit highest.

        Inner product becomes cosine with one more component: rows are filled up to the longest length, queries get 0.
        """
        lengths = np.sqrt(np.einsum("ij,ij->i", rows / self.longest, rows / self.longest))
        extra = np.zeros(len(rows)) if queries else np.sqrt(np.maximum(0.0, 1.0 - lengths**2))
        signs = np.concatenate((rows / self.longest, extra[:, None]), axis=1) @ self.planes > 0
        weights = (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))[None, None, :]
        return (signs.reshape(len(rows), self.trees, self.bits) * weights).sum(axis=2)

    def fill(self, tree: np.ndarray, prefix: np.ndarray, count: np.ndarray) -> None:
        self.counts[tree, prefix] = count
        self.starts = np.concatenate((np.zeros((self.trees, 1), dtype=np.int64), np.cumsum(self.counts, axis=1)), axis=1)

    def block_of(self, tree: np.ndarray, prefix: np.ndarray, size: int) -> np.ndarray:
        """Blocks are consecutive pieces of a sorted array, cut between prefixes."""
        return self.starts[tree, prefix] // size

    def levels(self, strings: np.ndarray, wanted: float) -> np.ndarray:
        """The deepest level at which all trees together have ``wanted`` strings that share that many bits with the query.

        Every tree starts at the longest prefix and all climb in step, one bit at a time.
        """
        level = np.zeros(len(strings), dtype=np.int64)
        undecided = np.ones(len(strings), dtype=bool)
        tree = np.arange(self.trees)[None, :]
        for depth in range(self.depth, 0, -1):
            low, high = self.span(strings, np.full(len(strings), depth))
            enough = undecided & ((self.starts[tree, high] - self.starts[tree, low]).sum(axis=1) >= wanted)
            level[enough] = depth
            undecided &= ~enough
        return level

    def span(self, strings: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last prefix of ``depth`` bits that agrees with the strings in the first ``level`` bits."""
        low = strings >> (self.bits - level)[:, None]
        shift = (self.depth - level)[:, None]
        return low << shift, (low + 1) << shift


def _index_rows(forest: Forest, block_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = forest.strings(matrix(batch.column(1), forest.dim), queries=False)
            tree = np.tile(np.arange(forest.trees), len(strings))
            row = pa.array(np.repeat(np.arange(len(strings)), forest.trees))
            block = forest.block_of(tree, strings.ravel() >> (forest.bits - forest.depth), block_size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.astype(np.int32)), pa.array(block), pa.array(strings.ravel()), batch.column(0).take(row), batch.column(1).take(row)],
                ["tree", "part", "string", "cid", "v"],
            )

    return run


def _query_rows(forest: Forest, block_size: int, wanted: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1), forest.dim)
            strings = forest.strings(rows, queries=True)
            level = forest.levels(strings, wanted)
            low, high = forest.span(strings, level)
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for tree in range(forest.trees):
                first = forest.block_of(tree, low[:, tree], block_size)
                last = np.maximum(first, (forest.starts[tree, high[:, tree]] - 1) // block_size)
                many = last - first + 1
                row = np.repeat(np.arange(len(rows)), many)
                step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                for column, x in zip(out, (np.full(len(row), tree, dtype=np.int32), first[row] + step, strings[row, tree], level[row], row), strict=True):
                    column.append(x)
            tree, part, string, level, row = map(np.concatenate, out)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (tree, part, string, level.astype(np.int32))), batch.column(0).take(row), batch.column(1).take(row)],
                ["tree", "part", "string", "level", "qid", "v"],
            )

    return run


def _search(forest: Forest, k: int):
    """The best ``k`` rows of an index block for each query of a query block, among those that share the query's prefix."""
    dim, bits = forest.dim, forest.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qids, found, scores = [], [], []
            for i in range(len(batch)):
                index, wanted = batch.column(0)[i].values, batch.column(1)[i].values
                strings = index.field("string").to_numpy()
                order = np.argsort(strings, kind="stable")  # the sorted array of this piece of the tree
                strings, cids, rows = strings[order], index.field("cid").to_numpy()[order], matrix(index.field("v"), dim)[order]
                queries = matrix(wanted.field("v"), dim)
                shift = bits - wanted.field("level").to_numpy().astype(np.int64)
                prefix = wanted.field("string").to_numpy() >> shift
                low = np.searchsorted(strings, prefix << shift)
                high = np.searchsorted(strings, (prefix + 1) << shift)
                for qid, query, a, b in zip(wanted.field("qid").to_numpy(), queries, low, high, strict=True):
                    if a == b:
                        continue
                    score = rows[a:b] @ query
                    if len(score) > k:  # ties with the k-th stay, the ids decide later
                        near = np.nonzero(score >= np.partition(score, len(score) - k)[len(score) - k] - 1e-12 * forest.longest**2)[0]
                    else:
                        near = np.arange(len(score))
                    # The score of a pair is summed in one fixed order, whatever block it was found in.
                    exact = (rows[a:b][near] * query).sum(axis=1)
                    qids.append(np.full(len(near), qid))
                    found.append(cids[a:b][near])
                    scores.append(exact)
            none = [np.empty(0, dtype=np.int64)], [np.empty(0)]
            columns = [np.concatenate(qids or none[0]), np.concatenate(found or none[0]), np.concatenate(scores or none[1])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "cid", "score"])

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", column: str = "embedding",
    trees: int = TREES, share: float = CANDIDATE_SHARE, depth: int = DEPTH, block_size: int = BLOCK_SIZE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row that ``is_query`` holds for, ``k`` rows of large inner product.

    Each tree sorts the hash strings of all rows. A query finds its longest prefixes in all trees and climbs all trees in
    step until their matches number ``share`` times the rows (rows found in several trees count for each): a share,
    not a number, so that recall does not fall as the table grows. All matches are scored on the original vectors.

    Identical vectors are searched once; of each class the ``k + 1`` smallest ids can reach a result, so no more are kept. A class larger than a block and a tree's
    dense prefixes are cut into blocks. Ties go to the smaller id. Null, zero and non-finite vectors are neither queries
    nor results, and neither are rows with a null id; shorter vectors count as filled with zeros. A repeated id counts once per row, as a candidate and as a query,
    and is never a result of itself. With fewer candidates than ``k`` all those found are returned. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    dim = dimension(vectors, column)
    asked = vectors.select(F.col(id_column).alias("query_id")).where(is_query & F.col(id_column).isNotNull())
    rows = stored(as_bytes(vectors, id_column, column, dim).where("v is not null and vec_id is not null"), "ann_rows")
    few = rows.withColumn("at", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    merged = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stored(merged.withColumn("cid", F.monotonically_increasing_id()), "ann_classes")
    total = classes.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    members = rows.join(classes.select("v", "cid"), "v").join(asked.distinct(), F.col("vec_id") == F.col("query_id")).select("query_id", "cid")
    members = stored(members, "ann_queries")

    longest = classes.select("v").mapInArrow(_longest(dim), "longest double").agg(F.max("longest")).first()[0]
    forest = Forest(dim, trees, BITS, depth, longest)
    shared = classes.select("cid", "v")
    # The histogram has one entry per tree and prefix of ``depth`` bits, however many rows there are.
    histogram = shared.mapInArrow(_prefixes(forest), "tree int, prefix long, n long").groupBy("tree", "prefix").agg(F.sum("n").alias("n")).toArrow()
    forest.fill(*(histogram.column(c).to_numpy() for c in ("tree", "prefix", "n")))

    index = shared.mapInArrow(_index_rows(forest, block_size), "tree int, part long, string long, cid long, v binary")
    # Dense prefixes make a part larger than a block: it is cut by id.
    tree, prefix = np.nonzero(forest.counts)  # no more parts than prefixes
    kinds, back = np.unique(np.stack((tree, forest.block_of(tree, prefix, block_size))), axis=1, return_inverse=True)
    sizes = np.bincount(back.ravel(), weights=forest.counts[tree, prefix])
    pieces = [(t, p, math.ceil(n / (2 * block_size))) for (t, p), n in zip(kinds.T.tolist(), sizes.tolist(), strict=True)]
    parts = spark.createDataFrame(pieces, "tree int, part long, pieces long")
    blocks = packed(index.join(parts, ["tree", "part"]), ["tree", "part"], F.col("pieces"), "cid", ["string", "cid", "v"])
    queries = shared.join(members.select("cid").distinct(), "cid").select(F.col("cid").alias("qid"), "v")
    n = queries.count()
    asking = queries.mapInArrow(_query_rows(forest, block_size, share * total), "tree int, part long, string long, level int, qid long, v binary")
    asking = packed(asking, ["tree", "part"], F.lit(max(1, math.ceil(n / 1024))), "qid", ["string", "level", "qid", "v"])
    pairs = blocks.alias("i").join(asking.alias("q"), ["tree", "part"]).select(F.col("i.rows").alias("x"), F.col("q.rows").alias("y"))
    found = stored(pairs.mapInArrow(_search(forest, k + 1), "qid long, cid long, score double").distinct(), "ann_found")

    # k + 1 classes of each query, by score and smallest id, hold its k nearest ids besides its own.
    known = found.join(classes.select("cid", "ids"), "cid")
    by_class = W.partitionBy("qid").orderBy(F.desc("score"), F.col("ids")[0])
    ids = known.withColumn("at", F.row_number().over(by_class)).where(F.col("at") <= k + 1).select("qid", "score", F.explode("ids").alias("vec_id"))
    by_id = W.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = ids.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1).select("qid", "score", "vec_id")
    answers = members.join(best, F.col("cid") == F.col("qid")).where("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _longest(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(0), dim)
            yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max()))] if len(rows) else [], pa.float64())], ["longest"])

    return run


def _prefixes(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = forest.strings(matrix(batch.column(1), forest.dim), queries=False) >> (forest.bits - forest.depth)
            keys, count = np.unique(prefix + (np.arange(forest.trees) << forest.depth), return_counts=True)
            tree = (keys >> forest.depth).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(keys & ((1 << forest.depth) - 1)), pa.array(count)], ["tree", "prefix", "n"])

    return run
