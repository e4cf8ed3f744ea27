"""Exploratory analyses over the content fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweave.functions.numbers import growth, round_half_up, stable_sum
from lakeweave.session import as_table, materialized


def score_histogram(content: DataFrame) -> DataFrame:
    """Rows per source and distinct score (NULL is its own bin), stored because it is read twice.

    Partial aggregation collapses repeated scores before the shuffle, so a source with a
    third of all rows sends its distinct scores, not its rows; the content is scanned once.
    """
    return materialized(content.groupBy("source_name", "score").agg(F.count("*").alias("n")))


SLOTS = 256


def _with_slots(histogram: DataFrame) -> DataFrame:
    """Add ``slot``: scores in ascending pieces of about equally many distinct values, wherever a source's scores lie.

    The borders are approximate quantiles of the distinct scores, one row per source. As a stored table their size is
    known, so the histogram stays where it is while they are small. Any borders give exact ranks.
    """
    shares = [k / SLOTS for k in range(1, SLOTS)]
    borders = histogram.groupBy("source_name").agg(F.percentile_approx("score", shares, 4 * SLOTS).alias("__borders"))
    placed = histogram.join(as_table(borders.withColumnRenamed("source_name", "__source"), "score_slots"), F.col("source_name").eqNullSafe(F.col("__source")))
    slot = F.size(F.filter("__borders", lambda b: b < F.col("score")))
    return placed.withColumn("slot", slot).drop("__source", "__borders")


def _ranked_histogram(histogram: DataFrame) -> DataFrame:
    """Add the first rank (from 0) of each non-NULL score and the number of scored rows per source.

    Ranks are running totals inside (source, slot) plus the total of the slots below, so no
    task ever orders all distinct scores of one source.
    """
    scored = _with_slots(histogram.where(F.col("score").isNotNull()))
    per_source = Window.partitionBy("source_name")
    slots = scored.groupBy("source_name", "slot").agg(F.sum("n").alias("slot_n"))
    earlier = per_source.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select(
        "source_name", "slot",
        F.coalesce(F.sum("slot_n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("slot_n").over(per_source).alias("scored"),
    )
    below = Window.partitionBy("source_name", "slot").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    inside = scored.withColumn("inner_rank", F.coalesce(F.sum("n").over(below), F.lit(0)))
    return inside.join(slots, ["source_name", "slot"]).withColumn("first_rank", F.col("offset") + F.col("inner_rank"))


def _continuous_percentile(p: float) -> Column:
    """Exact continuous percentile as an aggregate over a ranked histogram."""
    position = F.lit(p) * (F.col("scored") - 1).cast("double")
    low, high = F.floor(position), F.ceil(position)

    def score_at(rank: Column) -> Column:
        inside = (F.col("first_rank") <= rank) & (rank < F.col("first_rank") + F.col("n"))
        return F.max(F.when(inside, F.col("score")))

    fraction = F.max(position - low)
    at_low = score_at(low)
    return round_half_up(at_low + (score_at(high) - at_low) * fraction, 6)


# Reported percentiles.
PERCENTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}


def score_percentiles(content: DataFrame) -> DataFrame:
    """Exact percentiles per source, from the histogram instead of a sorted copy of all rows."""
    ranked = _ranked_histogram(score_histogram(content))
    return ranked.groupBy("source_name").agg(
        *[_continuous_percentile(p).alias(name) for name, p in PERCENTILES.items()]
    )


def score_percentiles_approx(content: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Bounded-memory estimate of the same percentiles in one scan, for scores with very many distinct values."""
    scored = content.where(F.col("score").isNotNull())
    return scored.groupBy("source_name").agg(
        *[F.percentile_approx("score", p, accuracy).alias(name) for name, p in PERCENTILES.items()]
    )


SKETCH_K = 400  # accuracy of a sketch; a larger one is more exact
SKETCH_RANK_ERROR = 0.01  # the true rank of an estimated percentile is at most so far off, merged sketches included


def daily_score_sketches(content: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch of the scores per source and day of loading: a few kilobytes each, however many scores. To be stored: a new day adds its sketches."""
    scored = content.where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))
    return scored.groupBy("source_name", F.to_date("loaded_at").alias("loaded_on")).agg(F.kll_sketch_agg_double(F.col("score").cast("double"), k).alias("sketch"))


def percentiles_from_sketches(sketches: DataFrame) -> DataFrame:
    """Percentiles per source from stored sketches of any days, merged; no content is read. See ``SKETCH_RANK_ERROR``."""
    merged = sketches.groupBy("source_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(
        "source_name", F.kll_sketch_get_n_double("sketch").alias("scored"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in PERCENTILES.items()],
    )


def percentile_rank_errors(content: DataFrame, estimated: DataFrame) -> DataFrame:
    """How far each estimated percentile is from its rank: the distance to the range of ranks that its value has among all scores."""
    histogram = score_histogram(content).where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))
    joined = histogram.join(estimated, "source_name")
    n = F.sum("n")

    def error(name: str, p: float) -> Column:
        below = F.coalesce(F.sum(F.when(F.col("score") < F.col(name), F.col("n"))), F.lit(0)) / n
        upto = F.coalesce(F.sum(F.when(F.col("score") <= F.col(name), F.col("n"))), F.lit(0)) / n
        return F.greatest(below - F.lit(p), F.lit(p) - upto, F.lit(0.0)).alias(name)

    return joined.groupBy("source_name").agg(n.alias("scored"), *[error(name, p) for name, p in PERCENTILES.items()])


def content_distribution(content: DataFrame) -> DataFrame:
    """Count, share, mean, median and range of the score per source, all from the score histogram."""
    histogram = score_histogram(content)
    n, score = F.col("n"), F.col("score")
    summary = histogram.groupBy("source_name").agg(
        F.sum(n).alias("content_count"),
        round_half_up(F.sum(score * n) / F.sum(F.when(score.isNotNull(), n)), 2).alias("avg_score"),
        F.max(score).alias("max_score"),
        F.min(score).alias("min_score"),
    )
    medians = _ranked_histogram(histogram).groupBy("source_name").agg(
        round_half_up(_continuous_percentile(0.5), 2).alias("median_score")
    )
    # One row per source is left here, so the unpartitioned window is tiny.
    everything = F.sum("content_count").over(Window.partitionBy())
    share = round_half_up(F.col("content_count") * F.lit(100.0) / everything.cast("double"), 2)
    return summary.join(medians, "source_name", "left").select(
        "source_name", "content_count", share.alias("pct_of_total"), "avg_score", "median_score",
        "max_score", "min_score",
    )


def monthly_volume(content: DataFrame) -> DataFrame:
    return (
        content.where(F.col("created_at").isNotNull())
        .groupBy(F.date_trunc("month", "created_at").alias("month"), "source_name")
        .agg(F.count("*").alias("items_published"), round_half_up(F.avg("score"), 2).alias("avg_score"))
    )


def weekly_growth(content: DataFrame) -> DataFrame:
    """Week-over-week change of the mean score and of the volume per source (weeks start on Monday)."""
    weekly = (
        content.where(F.col("created_at").isNotNull())
        .groupBy("source_name", F.date_trunc("week", "created_at").alias("week_start"))
        .agg(round_half_up(F.avg("score"), 2).alias("avg_score"), F.count("*").alias("item_count"))
    )
    order = Window.partitionBy("source_name").orderBy("week_start")
    lagged = weekly.withColumns(
        {
            "prev_week_score": F.lag("avg_score").over(order),
            "prev_week_count": F.lag("item_count").over(order),
        }
    )
    return lagged.select(
        "source_name", "week_start", "avg_score", "item_count", "prev_week_score",
        growth(F.col("avg_score"), F.col("prev_week_score")).alias("score_growth_pct"),
        growth(F.col("item_count"), F.col("prev_week_count")).alias("volume_growth_pct"),
    )


def top_authors(content: DataFrame, k: int = 20, min_items: int = 3) -> DataFrame:
    """Best authors by mean score; ties by source and author so that the cut is the same every run."""
    return (
        content.where(F.col("author").isNotNull())
        .groupBy("source_name", "author")
        .agg(
            F.count("*").alias("item_count"),
            round_half_up(F.avg("score"), 2).alias("avg_score"),
            F.max("score").alias("best_score"),
        )
        .where(F.col("item_count") >= min_items)
        .orderBy(F.desc_nulls_last("avg_score"), "source_name", "author")
        .limit(k)
    )


def daily_velocity(content: DataFrame) -> DataFrame:
    """Items and score per day and source, with the change against the previous active day."""
    daily = (
        content.where(F.col("created_at").isNotNull())
        .groupBy(F.to_date("created_at").alias("day"), "source_name")
        .agg(F.count("*").alias("items"), stable_sum(F.col("score")).alias("total_score"))
    )
    previous = F.lag("total_score").over(Window.partitionBy("source_name").orderBy("day"))
    return daily.withColumn("prev_day_total_score", previous).withColumn(
        "score_delta", round_half_up(F.col("total_score") - F.col("prev_day_total_score"), 6)
    )
