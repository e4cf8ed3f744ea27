"""Engagement metrics kept up to date from changes: stored partial aggregates per source and day."""

from __future__ import annotations

import json
import re
import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.functions.keys import surrogate_key
from lakeweave.functions.numbers import round_half_up
from lakeweave.session import as_table, child_names, matching_paths, read_text, remove_folder, write_once

PARTIAL_SCHEMA = "source_name string, n bigint, scored bigint, odd bigint, total decimal(38,12), odd_total double, high double, low double, loaded_at timestamp, activity_date date"
_COLUMNS = ["source_name", "n", "scored", "odd", "total", "odd_total", "high", "low", "loaded_at", "activity_date"]

# Days that one task writes: every day is a file, and files are what the writing costs.
DAYS_PER_TASK = 64
# What the state reads of the content: a caller that stores the content for it needs no others.
READ_COLUMNS = ["source_name", "score", "created_at", "loaded_at"]


def _day() -> Column:
    return F.to_date("created_at")


def partials(content: DataFrame) -> DataFrame:
    """What a (source, day) needs to be merged with others: counts, sum, extremes, newest load.

    The sum is a decimal, which gives back exactly what was put in. Scores that are no decimal (``odd``: infinite ones, NaN, from 10^20 on) have a sum of their own, which cannot be taken back.
    """
    score = F.col("score").cast("double")
    exact = F.when(~F.isnan(score) & (F.abs(score) < 1e20), score.cast("decimal(38,12)"))
    odd = F.when(exact.isNull(), score)
    return (
        content.where(F.col("created_at").isNotNull())
        .groupBy("source_name", _day().alias("activity_date"))
        .agg(
            F.count("*").alias("n"), F.count("score").alias("scored"), F.count(odd).alias("odd"), F.coalesce(F.sum(exact), F.lit(0)).cast("decimal(38,12)").alias("total"),
            F.sum(odd).alias("odd_total"), F.max(score).alias("high"),
            F.min(score).alias("low"), F.max(F.col("loaded_at").cast("timestamp")).alias("loaded_at"),
        )
        .select(*_COLUMNS)
    )


class MetricsState:
    """Partial aggregates of the content fact below ``path``, stored day by day.

    A change is a set of rows that came and one of rows that went (a corrected row is in both). Only days with changes are read and written. Counts and sums take
    rows back; where a row that went had an extreme or the newest load of its source and day, nothing stored tells the next one, so
    those (source, day) pairs are aggregated anew from the content. Numbered commits name the folder of each day: a run that dies leaves all days as they were.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _newest(self) -> dict:
        """The newest commit: its number and, for each day, the folder that holds it."""
        numbers = [int(n[:-5]) for n in child_names(self.spark, f"{self.path}/commits") if re.fullmatch(r"\d+\.json", n)]
        return json.loads(read_text(self.spark, f"{self.path}/commits/{max(numbers):09d}.json")) if numbers else {"seq": 0, "days": {}}

    def _read(self, days: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/{folder}/activity_date={day}" for day, folder in sorted(days.items())]
        if not paths:
            return self.spark.createDataFrame([], PARTIAL_SCHEMA)
        return self.spark.read.schema(PARTIAL_SCHEMA).option("basePath", self.path).parquet(*paths).select(*_COLUMNS)

    def _store(self, rows: DataFrame, now: dict, touched: set[str], n_days: int) -> None:
        """Write whole days, ``n_days`` at most, and commit; a touched day without rows is gone."""
        folder = f"days={uuid.uuid4().hex[:12]}"
        rows.repartition(max(1, -(-n_days // DAYS_PER_TASK)), "activity_date").write.partitionBy("activity_date").parquet(f"{self.path}/{folder}")
        written = {p.rsplit("=", 1)[1]: folder for p in matching_paths(self.spark, f"{self.path}/{folder}/activity_date=*")}
        kept = {day: f for day, f in now["days"].items() if day not in touched}
        write_once(self.spark, f"{self.path}/commits/{now['seq'] + 1:09d}.json", json.dumps({"seq": now["seq"] + 1, "days": kept | written}))

    def rebuild(self, content: DataFrame) -> None:
        """From the whole content."""
        now, rows = self._newest(), as_table(partials(content), "metrics-partials")
        self._store(rows, now, set(now["days"]), rows.select("activity_date").distinct().count())

    def apply(self, came: DataFrame, went: DataFrame, content: DataFrame) -> set[date]:
        """Take a change in; ``content`` is the fact after it, read only for pairs that cannot be derived. Returns the days rewritten."""
        now = self._newest()
        plus, minus = partials(came).withColumn("sign", F.lit(1)), partials(went).withColumn("sign", F.lit(-1))
        change = as_table(plus.unionByName(minus), "metrics-change")  # at most two rows per source and changed day
        touched = {str(r[0]) for r in change.select("activity_date").distinct().collect()}
        before = self._read({day: f for day, f in now["days"].items() if day in touched}).withColumn("sign", F.lit(0))
        rows = before.unionByName(change)
        added = F.col("sign") >= 0

        def signed(c: str) -> Column:
            return F.sum(F.col(c) * F.when(F.col("sign") < 0, -1).otherwise(1)).alias(c)

        def lost(c: str, most) -> Column:
            """Whether what went reaches the extreme of what was there or came."""
            went, rest = most(F.when(F.col("sign") < 0, F.col(c))), most(F.when(added, F.col(c)))
            return F.coalesce(went >= rest if most is F.max else went <= rest, F.lit(False))

        stuck = F.coalesce(F.max(F.when(F.col("sign") < 0, F.col("odd") > 0)), F.lit(False))
        merged = as_table(
            rows.groupBy("source_name", "activity_date").agg(
                signed("n"), signed("scored"), signed("odd"), signed("total").cast("decimal(38,12)").alias("total"),
                F.sum(F.when(added, F.col("odd_total"))).alias("odd_total"), F.max(F.when(added, F.col("high"))).alias("high"), F.min(F.when(added, F.col("low"))).alias("low"),
                F.max(F.when(added, F.col("loaded_at"))).alias("loaded_at"),
                (lost("high", F.max) | lost("low", F.min) | lost("loaded_at", F.max) | stuck).alias("anew"),
            ).where("n > 0"),
            "metrics-merged",
        )
        columns = _COLUMNS
        pairs = merged.where("anew").select(F.col("source_name").alias("s"), F.col("activity_date").alias("d"))
        days = [r[0] for r in pairs.select("d").distinct().collect()]  # of the changed days
        derived = merged.where("not anew").select(*columns)
        if days:
            # A range and the list of days are pushed to the scan; the join leaves the pairs that are needed.
            near = content.where(_day().isin(days) & (F.col("created_at") >= F.lit(min(days)).cast("timestamp")))
            anew = near.join(pairs, F.col("source_name").eqNullSafe(F.col("s")) & (_day() == F.col("d")), "left_semi")
            derived = derived.unionByName(partials(anew))
        self._store(derived, now, touched, len(touched))
        return {date.fromisoformat(d) for d in touched}

    def partials(self) -> DataFrame:
        """The stored partial aggregates."""
        return self._read(self._newest()["days"])

    def metrics(self, as_of: datetime | None = None) -> DataFrame:
        """The relation ``fct_engagement_metrics`` from the state alone."""
        total = F.when(F.col("scored") > 0, F.col("total").cast("double") + F.coalesce("odd_total", F.lit(0.0)))
        rows = self.partials().select(
            surrogate_key(F.col("source_name"), F.col("activity_date")).alias("metric_key"), "source_name", "activity_date", F.col("n").alias("content_count"),
            round_half_up(total / F.col("scored"), 2).alias("avg_score"), F.col("high").alias("max_score"), F.col("low").alias("min_score"),
            round_half_up(total, 6).alias("total_score"), F.col("loaded_at").alias("last_loaded_at"),
        )
        return rows if as_of is None else rows.withColumn("dbt_created_at", F.lit(as_of).cast("timestamp"))

    def expire(self) -> None:
        """Remove folders that the newest commit does not name."""
        live = set(self._newest()["days"].values())
        for name in child_names(self.spark, self.path):
            if name.startswith("days=") and name not in live:
                remove_folder(self.spark, f"{self.path}/{name}")
