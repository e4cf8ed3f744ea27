"""Row numbering and shape helpers that stay parallel when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Replace nested structs by one column per leaf, named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for field in schema:
            here = (*path, field.name)
            found += leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
        return found

    paths = leaves(df.schema, ())
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in paths])


def numbered_rows(df: DataFrame, keys: list[str], order: list[str], slot: Column, name: str = "row_no") -> DataFrame:
    """Exact row numbers per key, in the total order given by ``order``, without one task per key.

    ``slot`` must be non-decreasing along ``order`` (for example ``id div 100000`` or the hour of
    a timestamp). Rows are numbered inside (key, slot); the offset of each slot is a running
    total over the slot counts, which are few compared with the rows.
    """
    slotted = df.withColumn("__slot", slot)
    group = [*keys, "__slot"]
    counts = slotted.groupBy(*group).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    inner = Window.partitionBy(*group).orderBy(*order)
    numbered = slotted.withColumn("__inner", F.row_number().over(inner))
    return (
        numbered.join(offsets, group)
        .withColumn(name, F.col("__offset") + F.col("__inner"))
        .drop("__slot", "__inner", "__offset")
    )


def chunk_rows(df: DataFrame, size: int, keys: list[str], order: list[str], slot: Column) -> DataFrame:
    """Number consecutive, non-overlapping chunks of ``size`` rows per key (``chunk_no`` from 0)."""
    numbered = numbered_rows(df, keys, order, slot, "__row")
    return numbered.withColumn("chunk_no", F.floor((F.col("__row") - 1) / F.lit(size))).drop("__row")
