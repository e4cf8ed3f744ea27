"""Source mixture: water-filled targets, a low-discrepancy slot schedule, equal-token blocks of shuffled documents."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.llm.common import WORD, stored

# Conjugate of the golden ratio: its multiples modulo 1 are evenly spread at every length.
GOLDEN = 0.6180339887498949
BLOCK_WORDS = 128
ROWS_PER_CHUNK = 10_000
CELLS = 4096


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _by_source() -> Column:
    """Code point order (bytes of UTF-8 compare alike), null last."""
    return F.col("source").cast("binary").asc_nulls_last()


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2) -> DataFrame:
    """Words to take per source: ``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources by code point, null last, take ``weights`` in turn. They split ``share`` of all words by weight; a target
    stops at ``repeat`` times its source's words and the excess goes to the others by weight. With sources ordered by
    limit per weight, those that stop come first, so running sums give the level that all others reach. The windows
    run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(_by_source())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(repeat)))
    rows = rows.withColumn("per_weight", F.col("limit") / F.col("weight"))
    order = W.orderBy("per_weight", _by_source())
    before, rest, all_ = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing), W.partitionBy()
    budget = F.least(F.sum("source_size").over(all_) * F.lit(float(share)), F.sum("limit").over(all_))
    # The level if exactly the sources before this one stop. The first that fits is right, and it is the largest that fits.
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    rows = rows.withColumn("level", level).withColumn("level", F.max(F.expr("case when level <= per_weight then level end")).over(all_))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("weight") * F.col("level")))
    return rows.select("source", "source_size", target.alias("target"))


def _running(rows: DataFrame, key: str, chunk: str, order: list[str], amount: str, into: str) -> DataFrame:
    """Sum of ``amount`` over the rows of the key that come earlier in (chunk, order).

    Chunks are consecutive pieces of the order. Their totals are added up first (one row per key and chunk), then
    each (key, chunk) is summed alone, so a key with a third of all rows is spread over many tasks.
    """
    totals = rows.groupBy(key, chunk).agg(F.sum(amount).alias("_sum"))
    earlier = W.partitionBy(key).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(F.col(key).alias("_key"), F.col(chunk).alias("_chunk"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = W.partitionBy(key, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = local.join(bases, F.col(key).eqNullSafe(F.col("_key")) & (F.col(chunk) == F.col("_chunk")))
    return joined.withColumn(into, F.col("_base") + F.col("_local")).drop("_key", "_chunk", "_base", "_local")


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """Slots ``(slot, source, rank)``: slot k goes to the source whose share holds the k-th multiple of the golden ratio.

    Shares are cumulative targets in source order. Interval lookup is an equi-join on cells of [0, 1); ``rank`` counts
    the slots of a source from 0.
    """
    spark = targets.sparkSession
    order, all_ = W.orderBy(_by_source()), W.partitionBy()
    upto = F.sum("target").over(order.rowsBetween(W.unboundedPreceding, 0))
    running = targets.where("target > 0").select("source", upto.alias("upto"), F.sum("target").over(all_).alias("total"))
    shares = running.select(
        "source",
        F.coalesce(F.lag("upto").over(order) / F.col("total"), F.lit(0.0)).alias("low"),
        F.when(F.lead("upto").over(order).isNull(), F.lit(1.0)).otherwise(F.col("upto") / F.col("total")).alias("high"),
    )
    cell = lambda x: F.floor(x * CELLS)
    cells = shares.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), F.least(cell(F.col("high")), F.lit(CELLS - 1)))))
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") + F.lit(0.5)) * F.lit(GOLDEN) % F.lit(1.0)).alias("point"))
    chosen = (
        points.withColumn("cell", cell(F.col("point")))
        .join(stored(cells, "mix_shares"), "cell")
        .where("low <= point and point < high")
        .select("slot", "source", F.floor(F.col("slot") / ROWS_PER_CHUNK).alias("chunk"), F.lit(1).alias("one"))
    )
    return _running(chosen, "source", "chunk", ["slot"], "one", "rank").select("slot", "source", "rank")


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2, block_words: int = BLOCK_WORDS, seed: str = "mix", uid: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Mix documents ``(doc_id, text, source)`` to target weights.

    Returns the documents ``(uid, doc_id, size, source, source_size, target)``, one per row read, and the mix
    ``(slot, source, uid, epoch, start, length)``: in slot order, words ``start .. start + length`` of a document.
    Every source is shuffled by a hash of the id, cut into blocks of ``block_words`` words and repeated up to
    ``repeat`` times; its r-th slot takes its r-th block. Null texts and texts without words have size 0 and give
    no piece; a null source is a source; repeated rows are documents of their own; equal hashes are ordered by size
    and row. Other columns are not read. ``uid`` names a column that numbers the rows; without it they are numbered here.
    """
    shuffle = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    number = F.col(uid) if uid else F.monotonically_increasing_id()
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), shuffle.alias("shuffle"), number.alias("uid")), "mix_sizes")
    targets = stored(source_targets(sized, weights, share, repeat), "mix_targets")
    n, words = sized.count(), targets.agg(F.sum("target")).first()[0] or 0
    chunks = max(1, math.ceil(n / ROWS_PER_CHUNK))
    chunk = F.shiftright(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long") * chunks, 32)
    documents = sized.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = _running(documents.where("size > 0").withColumn("chunk", chunk), "source", "chunk", ["shuffle", "size", "uid"], "size", "at")
    spans = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1)))).withColumn("at", F.col("at") + F.col("epoch") * F.col("source_size"))
    last = F.floor((F.col("at") + F.col("size") - 1) / block_words)
    pieces = (
        spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block_words), last)))
        .withColumn("start", F.greatest(F.lit(0), F.col("block") * block_words - F.col("at")))
        .withColumn("length", F.least("size", (F.col("block") + 1) * block_words - F.col("at")) - F.col("start"))
        .select(F.col("source").alias("_source"), "block", "uid", "epoch", "start", "length")
    )
    slots = schedule(targets, math.ceil(words / block_words))
    mixed = slots.join(pieces, (F.col("rank") == F.col("block")) & F.col("source").eqNullSafe(F.col("_source")))
    return documents.select("uid", "doc_id", "size", "source", "source_size", "target"), mixed.select("slot", "source", "uid", "epoch", "start", "length")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of ``docs``: a document once for every epoch that takes it, cut to the words taken.

    A source's taken words end inside at most one document, which keeps its first words, joined by one space; all
    others keep their text as it is. Columns stay as they are; ``n_chars`` follows the text. Documents without words
    take no part in a mix of words and go.
    """
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mix_docs")
    documents, mixed = mix_sources(numbered.select("row", "doc.doc_id", "doc.text", "doc.source"), weights, share, repeat, block_words, uid="row")
    taken = mixed.groupBy("uid", "epoch").agg(F.sum("length").alias("taken")).join(documents.select("uid", "size"), "uid")
    words = F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0))
    partly = F.col("taken") < F.col("size")
    text = F.when(partly, F.array_join(F.slice(words, 1, F.col("taken").cast("int")), " ")).otherwise(F.col("doc.text"))
    doc = F.col("doc").withField("text", text)
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.when(partly, F.length(text).cast("long")).otherwise(F.col("doc.n_chars")))
    return numbered.join(taken, F.col("row") == F.col("uid")).select(doc.alias("doc")).select("doc.*")
