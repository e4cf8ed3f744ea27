"""Embedding vectors as rows of bytes, identical ones merged into classes, classes packed into bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ELEMENT = np.dtype("<f8")


def dimension(vectors: DataFrame, column: str) -> int:
    """The longest vector; shorter ones count as filled up with zeros."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def as_bytes(vectors: DataFrame, id_column: str, column: str, dim: int) -> DataFrame:
    """``(vec_id, v)``: components as bytes of doubles, null for vectors that take no part.

    Those are null vectors, zero vectors and vectors with null or non-finite components.
    """
    kind = vectors.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.cast(pa.float64())
            # A null component becomes NaN, and so spoils its vector like any non-finite one.
            flat = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            null = np.asarray(lists.is_null())
            out = []
            for i in range(len(batch)):
                values = flat[offsets[i] : offsets[i + 1]]
                if null[i] or not np.isfinite(values).all() or not values.any():
                    out.append(None)
                    continue
                full = np.zeros(dim, dtype=ELEMENT)
                full[: len(values)] = values + 0.0  # no negative zeros
                out.append(full.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    return vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("v")).mapInArrow(run, f"vec_id {kind}, v binary")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of bytes as a matrix."""
    if len(column) == 0:
        return np.zeros((0, dim))
    return np.frombuffer(b"".join(column.to_pylist()), dtype=ELEMENT).reshape(len(column), dim)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that no square leaves the range of doubles."""
    if not rows.size:
        return rows
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def packed(rows: DataFrame, keys: list[str], chunks: Column, by: str, fields: list[str]) -> DataFrame:
    """Rows of a key gathered into ``chunks`` blocks by a hash of ``by``: ``(*keys, block, rows)``."""
    block = F.pmod(F.xxhash64(by), chunks).cast("int")
    return rows.groupBy(*keys, block.alias("block")).agg(F.collect_list(F.struct(*fields)).alias("rows"))
