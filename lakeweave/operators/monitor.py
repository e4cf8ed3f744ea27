"""Aggregates over pipeline runs, datasets, crawl status rows and log lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def success_rate(saved: Column, processed: Column) -> Column:
    """Saved share of the processed rows; 0 when nothing was processed."""
    return F.when(processed == 0, F.lit(0.0)).otherwise(saved.cast("double") / processed.cast("double"))


def run_metrics(runs: DataFrame) -> DataFrame:
    """Per-run counters with the success rate and, when the run ended, its duration in seconds."""
    rate = success_rate(F.col("rows_saved"), F.col("rows_processed"))
    out = runs.withColumn("success_rate", rate)
    if "ended_at" in runs.columns:
        span = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / F.lit(1e6)
        out = out.withColumn("duration_seconds", span)
    return out


def run_status_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count("*").alias("runs"))


def recent_runs(runs: DataFrame, k: int = 5) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("started_at"), F.desc("run_id")).limit(k)


def run_success_pct(runs: DataFrame) -> DataFrame:
    """Successful share of all runs in percent, status compared without case; 0 without runs."""
    hit = F.count_if(F.lower("status") == "success")
    share = F.when(F.count("*") == 0, F.lit(0)).otherwise(F.round(hit * F.lit(100.0) / F.count("*")))
    return runs.agg(F.count("*").alias("total_runs"), hit.alias("successful_runs"), share.cast("bigint").alias("success_pct"))


def recent_failures(runs: DataFrame, k: int = 5) -> DataFrame:
    """Latest failed runs."""
    return recent_runs(runs.where(F.lower("status") == "failed"), k)


def ingestion_timeline(runs: DataFrame) -> DataFrame:
    """Rows processed over time; runs whose start cannot be parsed are left out."""
    return (
        runs.select("run_id", F.try_to_timestamp(F.col("started_at").cast("string")).alias("started_at"), "rows_processed")
        .where(F.col("started_at").isNotNull())
        .orderBy("started_at", "run_id")
    )


def rows_by_source(datasets: DataFrame) -> DataFrame:
    return datasets.groupBy("source").agg(F.sum("row_count").alias("row_count"))


def dataset_kpis(datasets: DataFrame, runs: DataFrame, as_of: datetime) -> DataFrame:
    """Headline numbers: datasets, rows, the last run's start and the share updated within a day."""
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("updated_at"))
    fresh = F.count_if(age < F.lit(86_400 * 1_000_000))
    n = F.count("*")
    kpis = datasets.agg(
        n.alias("total_datasets"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.when(n == 0, F.lit(0)).otherwise(F.rint(fresh * F.lit(100.0) / n)).cast("bigint").alias("freshness"),
    )
    last_run = runs.agg(F.max("started_at").alias("last_run")).scalar()
    return kpis.select("total_datasets", "total_rows", last_run.alias("last_run"), "freshness")


def error_rate_by_source(status_rows: DataFrame) -> DataFrame:
    """Failed share of the attempts per source, in percent."""
    failed = F.count_if(F.upper("status") == "FAILED")
    return status_rows.groupBy("source").agg(
        F.count("*").alias("attempts"),
        failed.alias("errors"),
        (failed * F.lit(100.0) / F.count("*")).alias("error_rate"),
    )


def crawl_summary(extracted: DataFrame) -> DataFrame:
    """Per profile: pages, records, errors, time span and the final status.

    ``extracted`` has one row per page: profile, n_records, error, started_at, ended_at.
    """
    errors = F.count("error")
    return extracted.groupBy("profile").agg(
        F.count_if(F.col("error").isNull()).alias("pages_fetched"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("records_extracted"),
        errors.alias("errors"),
        ((F.unix_micros(F.max("ended_at")) - F.unix_micros(F.min("started_at"))) / F.lit(1e6)).alias("duration_seconds"),
        F.when(errors == 0, "SUCCESS").otherwise("FAILED").alias("status"),
    )


# --- logs --------------------------------------------------------------------------------------

MAX_LOG_LIMIT = 10_000


def log_query(logs: DataFrame, limit: int = 100, level: str | None = None, pipeline_id: str | None = None) -> DataFrame:
    """The last ``limit`` matching entries in time order."""
    if not 1 <= limit <= MAX_LOG_LIMIT:
        raise ValueError(f"limit must lie between 1 and {MAX_LOG_LIMIT}")
    if level:
        logs = logs.where(F.upper("level") == level.upper())
    if pipeline_id:
        logs = logs.where(F.col("pipeline_id") == pipeline_id)
    order = ["timestamp", "message"]
    return logs.orderBy(*[F.desc(c) for c in order]).limit(limit).orderBy(*order)


def log_tail_contains(lines: DataFrame, level: str = "ALL", tail: int = 200) -> DataFrame:
    """The last ``tail`` lines, then those that mention the level. ``lines`` has (line_no, line)."""
    last = lines.orderBy(F.desc("line_no")).limit(tail)
    if level.upper() != "ALL":
        last = last.where(F.upper("line").contains(level.upper()))
    return last.orderBy("line_no")
