"""Shared pieces of the training-data operators: stored intermediates, word splitting, connected components."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.session import remove_folder, work_dir

# ASCII white space separates words; everything else belongs to them. bytes.split() follows the same rule.
WORD = r"[^\x20\x09-\x0D]+"


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Shuffle files of the write inside are removed as soon as it ends: its result is a table by then."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_made: list[str] = []  # folders of the tables below, until they are released


def made_tables() -> list[str]:
    """Folders of the intermediate tables made so far and not released."""
    return list(_made)


def release(spark: SparkSession, tables: list[str]) -> None:
    """Remove intermediate tables. For use once the results that read them are written."""
    for path in tables:
        if path in _made:
            _made.remove(path)
            remove_folder(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, independent of executors that get lost.

    The table stays until ``release``.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    _made.append(path)
    with _shuffle_cleanup(spark):
        df.write.option("compression", "zstd").parquet(path)
    # No schema inference, and a size the optimizer can compare with its broadcast threshold.
    return spark.read.schema(df.schema).parquet(path)


def read_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the wanted columns, so that extra ones (whatever their names) neither travel nor clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, null as empty, without decoding."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def joint_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest node of each local component of nodes 0..n-1 under the given links."""
    label = np.arange(n, dtype=np.int64)
    while len(left):
        # Only roots get a new label, the larger one of a link the smaller: trees never lose a member, and a link inside a tree is done.
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:  # follow labels to their own labels
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        left, right = label[left], label[right]
        open_ = left != right
        left, right = left[open_], right[open_]
    return label


def components(edges: DataFrame) -> DataFrame:
    """Nodes of an undirected graph with the smallest node they reach: ``(node, root)``, from ``(a, b)`` links.

    Large-star and small-star rounds: every node hands its larger neighbours (then its smaller ones) to its
    smallest neighbour, until nothing changes. Each round is two partial aggregations and two joins on node
    ids, the links never grow in number, and every round is stored, so a lost executor costs one round.
    Isolated nodes are not listed. Null ends and self links are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, "links")
    mark = _fingerprint(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        old, edges = _made[-1], stored(small, "links")
        before, mark = mark, _fingerprint(edges)
        remove_folder(edges.sparkSession, old)  # the links of the round before
        _made.remove(old)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free checksum of a link table: equal for equal sets."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h
