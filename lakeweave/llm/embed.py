"""Embedding near-duplicates: an exact metric range join over pivot cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import components, joint_labels, stored
from lakeweave.llm.vectors import as_bytes, dimension, matrix, packed, unit

COSINE = 0.9
CELL_SIZE = 8192
MAX_PIVOTS = 1024
BLOCK_SIZE = 2048
# Slack of the bounds: far above the rounding of a chord, far below any distance that matters.
SLACK = 1e-7


def _chords(similarity: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors, which is a metric, from their cosine."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * similarity))


def _homes(pivots: np.ndarray):
    """Adds the nearest pivot and the distance to it."""
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = _chords(unit(matrix(batch.column(2), dim)) @ pivots.T)
            home = distance.argmin(axis=1)
            near = distance[np.arange(len(home)), home]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), pa.array(near)], [*batch.schema.names, "cell", "distance"])

    return run


def _visits(pivots: np.ndarray, radius: np.ndarray, reach: float):
    """Copies of a vector for the cells of smaller number that may hold a vector within reach.

    Let x live at pivot p. A vector y of cell q within reach of x has d(x, q) <= d(x, y) + d(y, q) <= reach + radius(q)
    and d(x, q) <= reach + d(y, q) <= reach + d(y, p) <= 2 reach + d(x, p), both by the triangle inequality. y is also on
    q's side of the plane between p and q, and x lies (d(x, q)^2 - d(x, p)^2) / 2 d(p, q) away from that plane.
    """
    dim = pivots.shape[1]
    between = _chords(pivots @ pivots.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = batch.column(3).to_numpy()
            distance = _chords(unit(matrix(batch.column(2), dim)) @ pivots.T)
            own = distance[np.arange(len(home)), home][:, None]
            plane = (distance**2 - own**2) <= 2.0 * between[home] * (reach + SLACK) + SLACK  # parallel pivots are 0 apart, up to rounding
            near = (distance <= radius[None, :] + reach + SLACK) & (distance <= own + 2 * reach + SLACK) & plane
            near &= np.arange(len(pivots))[None, :] < home[:, None]
            row, cell = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(pa.array(row)) for i in range(3)], pa.array(cell.astype(np.int32))], ["cid", "n", "v", "cell"])

    return run


def _block_links(dim: int, least: float):
    """Links between two blocks: for each linked vector its links there (counted with copies) and a local root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, links, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i in range(len(batch)):
                same = batch.column(2)[i].as_py()
                one, two = (batch.column(c)[i].values for c in (0, 1))
                ids = [x.field("cid").to_numpy() for x in (one, two)]
                copies = [x.field("n").to_numpy() for x in (one, two)]
                left, right = (unit(matrix(x.field("v"), dim)) for x in (one, two))
                n = len(left)
                total = n if same else n + len(right)
                label, count = np.arange(total), np.zeros(total, dtype=np.int64)
                for at in range(0, n, 256):
                    near = left[at : at + 256] @ right.T >= least
                    if same:  # every pair once: the upper triangle, without the vector itself
                        near &= np.arange(len(right))[None, :] > np.arange(at, at + len(near))[:, None]
                    row, column = np.nonzero(near)
                    if not len(row):
                        continue
                    row, other = row + at, column + (0 if same else n)
                    np.add.at(count, row, copies[1][column])
                    np.add.at(count, other, copies[0][row])
                    ends = np.unique(np.stack((label[row], label[other]), axis=1), axis=0)
                    label = joint_labels(total, ends[:, 0], ends[:, 1])[label]
                every = ids[0] if same else np.concatenate(ids)
                hit = np.nonzero(count)[0]
                a.append(every[hit])
                links.append(count[hit])
                b.append(every[label[hit]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, links, b)], ["a", "links", "b"])

    return run


def embedding_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", cosine: float = COSINE, cell_size: int = CELL_SIZE, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row: exact links at ``cosine`` and above.

    Identical vectors are one class with a count. Pivots are classes drawn by hash; each class lives in the cell of its
    nearest pivot and visits the cells of smaller number that the triangle inequality leaves open. A cell joins its own
    classes and its visitors block by block, so that a hot cell is many tasks, and emits link counts and one local root per
    class, never pairs.

    Null and zero vectors and those with null or non-finite components link with nothing (``n_links`` 0, a component of
    their own). Shorter vectors count as filled with zeros. Repeated rows are links of each other. A row with a null
    id is a vector like any other; a component's id is the smallest that is not null. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    dim = dimension(vectors, column)
    rows = stored(as_bytes(vectors, id_column, column, dim), "embed_rows")
    merged = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = stored(merged.withColumn("cid", F.monotonically_increasing_id()), "embed_classes")
    total = classes.count()
    wanted = min(MAX_PIVOTS, max(1, math.ceil(total / cell_size)))
    # At most MAX_PIVOTS vectors come to the driver and go to the tasks.
    drawn = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(wanted).toArrow().column("v").combine_chunks()
    pivots = unit(matrix(drawn, dim))
    if total:
        reach = math.sqrt(2.0 - 2.0 * cosine)
        shared = classes.select("cid", "n", "v")
        homes = stored(shared.mapInArrow(_homes(pivots), "cid long, n long, v binary, cell int, distance double"), "embed_homes")
        radius = np.zeros(len(pivots))
        for r in homes.groupBy("cell").agg(F.max("distance").alias("r")).collect():  # one row per pivot
            radius[r.cell] = r.r
        visits = homes.select("cid", "n", "v", "cell").mapInArrow(_visits(pivots, radius, reach), "cid long, n long, v binary, cell int")
        placed = stored(homes.select("cid", "n", "v", "cell", F.lit(True).alias("home")).unionByName(visits.withColumn("home", F.lit(False))), "embed_placed")
        sizes = placed.groupBy("cell", "home").count().withColumn("blocks", F.ceil(F.col("count") / block_size)).drop("count")
        sized = placed.join(stored(sizes, "embed_sizes"), ["cell", "home"])
        blocks = stored(packed(sized, ["cell", "home"], F.col("blocks"), "cid", ["cid", "n", "v"]), "embed_blocks")
        one, two = blocks.where("home").alias("one"), blocks.alias("two")
        pairs = one.join(two, F.expr("one.cell = two.cell and (not two.home or one.block <= two.block)"))
        same = F.expr("two.home and one.block = two.block")
        pairs = pairs.select(F.col("one.rows").alias("x"), F.col("two.rows").alias("y"), same.alias("same"))
        found = stored(pairs.mapInArrow(_block_links(dim, cosine), "a long, links long, b long"), "embed_links")
    else:
        found = spark.createDataFrame([], "a long, links long, b long")
    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "cid")
    known = classes.join(counts, "cid", "left").join(roots, "cid", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    known = stored(known.select("v", "first", n_links.alias("n_links"), F.coalesce("root", "cid").alias("root")), "embed_known")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    answer = known.join(smallest, "root").select("v", "n_links", "component_id")
    out = rows.join(answer, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.col("vec_id").eqNullSafe(component)
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
