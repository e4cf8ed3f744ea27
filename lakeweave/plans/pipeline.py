"""One pipeline run: lake promotion, warehouse load, models, event log, data tests, run record."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.operators.history import EventLog
from lakeweave.operators.lake import Lake, Silver, lake_pipeline
from lakeweave.operators.quality import run_tests
from lakeweave.operators.warehouse import Warehouse
from lakeweave.plans.build import build_models
from lakeweave.schemas import SOURCES

RUN_SCHEMA = (
    "run_id string, status string, started_at timestamp, rows_fetched bigint, rows_processed bigint, "
    "rows_saved bigint, rows_skipped bigint, rows_failed bigint, failed_tests int, duration_seconds double, error string"
)


@dataclass
class RunResult:
    run_id: str
    status: str
    steps: DataFrame
    tests: DataFrame | None
    models: dict[str, DataFrame]


def load_silver(lake: Lake, warehouse: Warehouse, source: str, as_of: datetime) -> int:
    """Replace a source's raw table by the current silver snapshot; returns the rows loaded, 0 without data."""
    silver = Silver(lake, source).snapshot(SOURCES[source].key)
    if silver is None:
        return 0
    return warehouse.load(SOURCES[source].raw_table, silver, as_of, "overwrite").rows_loaded


def run_pipeline(spark: SparkSession, lake: Lake, warehouse: Warehouse, as_of: datetime, event_log_path: str | None = None) -> RunResult:
    """Run everything for the sources that have data.

    A failing source is reported in ``steps`` and left out; any failed data test fails the run.
    """
    run_id, start = uuid.uuid4().hex, time.monotonic()
    steps = lake_pipeline(lake, {n: s.key for n, s in SOURCES.items()}, as_of)
    outcomes = {r.source: r for r in steps.collect()}
    raw, status_rows = {}, []
    for name, contract in SOURCES.items():
        loaded, status, error = 0, outcomes[name].status, outcomes[name].error
        if status != "failed":
            try:
                loaded = load_silver(lake, warehouse, name, as_of)
                if loaded:
                    raw[name] = warehouse.table(contract.raw_table)
            except Exception as exc:  # noqa: BLE001 - reported in the status row
                status, error = "failed", str(exc)
        status_rows.append((run_id, name, status, loaded, error))
    fetched, rejected, current = (sum(r[c] for r in outcomes.values()) for c in ("rows", "rejected", "current"))
    steps = spark.createDataFrame(status_rows, "run_id string, source string, status string, rows bigint, error string")

    models, tests, failed = {}, None, 0
    if raw:
        def store(name: str, df: DataFrame) -> DataFrame:
            warehouse.replace(name, df)
            return warehouse.table(name)

        models = build_models(spark, raw, as_of, store)
        log = EventLog(spark, event_log_path or f"{warehouse.root}/{warehouse.schema}/incr_content_events")
        models["incr_content_events"] = log.run(models["int_content_unified"])
        warehouse.replace("test_results", run_tests(models, as_of))
        tests = warehouse.table("test_results")
        failed = tests.where(F.col("failures") > 0).count()
    errors = [f"{r[1]}: {r[4]}" for r in status_rows if r[2] == "failed"]
    status = "FAILED" if failed or errors else "SUCCESS"
    took = time.monotonic() - start
    # Fetched and processed: the rows of the versions that this run took in. Saved: those that are current in silver;
    # skipped: those that a newer row of their key outdates; failed: those without a usable key.
    record = (run_id, status, as_of, fetched, fetched, current, fetched - current - rejected, rejected, failed, took, "; ".join(errors) or None)
    warehouse.append_rows("pipeline_runs", spark.createDataFrame([record], RUN_SCHEMA))
    return RunResult(run_id, status, steps, tests, models)
