"""Every operator as a query over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.catalog import fixtures as fx
from lakeweave.catalog.fixtures import AS_OF, SPLIT
from lakeweave.functions import casts, keys, numbers, rows, sql_forms, text
from lakeweave.operators import chains, extract, history, json_records, lake as lake_ops, monitor, quality, quality_state, urls
from lakeweave.functions.html_select import FieldSpec
from lakeweave.operators.lake import Lake
from lakeweave.operators.warehouse import Warehouse, register_view, stamp_loaded_at
from lakeweave.plans import analyses, crawl, intermediate, marts, metrics_state, reports
from lakeweave.plans.build import build_content, build_models, stage_all
from lakeweave.plans.pipeline import run_pipeline
from lakeweave.schemas import SOURCES
from lakeweave.session import as_table, child_names, materialized, replace_folder, work_dir
from lakeweave.sources import files
from lakeweave.sources.adapters import split_sentinel_keys
from lakeweave.sources.seeds import content_categories, source_metadata
from lakeweave.streaming import event_log, keyed_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DAY1, DAY2 = datetime(2024, 1, 20, tzinfo=UTC), datetime(2024, 1, 21, tzinfo=UTC)


def query(fn: Query) -> Query:
    """Register under the function's name; ``fn_`` marks those named after a library function or module."""
    QUERIES[fn.__name__.removeprefix("fn_")] = fn
    return fn


def _utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, work_dir(spark, "lake"))


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, work_dir(spark, "warehouse"), f"wh_{uuid.uuid4().hex[:12]}")


def _staged(spark, sf, source):
    return stage_all({source: fx.RAW[source](spark, sf)}, AS_OF)[source]


@cache
def _unified(spark, sf):
    """The lazy plan, built once per session and folder."""
    return intermediate.int_content_unified(stage_all(fx.raw_sources(spark, sf), AS_OF))


@cache
def _content(spark, sf):
    return build_content(spark, fx.raw_sources(spark, sf), AS_OF)


def _dim_sources(spark):
    return marts.dim_sources(source_metadata(spark), content_categories(spark))


# --- lake, files, warehouse --------------------------------------------------------------------


@query
def lake_write(spark, sf):
    lake = _lake(spark)
    lake.write("raw", "reddit", fx.reddit_posts(spark, sf), DAY1, "posts.parquet")
    return lake.read("raw", "reddit", with_version=True)


@query
def lake_read(spark, sf):
    lake, posts = _lake(spark), fx.reddit_posts(spark, sf)
    lake.write("raw", "reddit", posts.where(F.col("loaded_at") <= SPLIT).select("id", "score", "loaded_at"), DAY1)
    lake.write("raw", "reddit", posts.where(F.col("loaded_at") > SPLIT).select("id", "score", "loaded_at", "subreddit"), DAY2)
    return lake.read("raw", "reddit").select("id", "score", "loaded_at", "subreddit")


@query
def lake_read_as_of_date(spark, sf):
    lake, posts = _lake(spark), fx.reddit_posts(spark, sf)
    lake.write("raw", "reddit", posts.where(F.col("loaded_at") <= SPLIT), DAY1)
    lake.write("raw", "reddit", posts.where(F.col("loaded_at") > SPLIT), DAY2)
    return lake.read("raw", "reddit", day=DAY2.date())


def _lake_with_steam_loads(spark, sf):
    lake = _lake(spark)
    for k, at in enumerate(fx.STEAM_LOADS):
        lake.write("raw", "steam", fx.steam_load(spark, sf, k), at.replace(tzinfo=UTC), f"load{k}")
    return lake


@query
def lake_versions(spark, sf):
    return _lake_with_steam_loads(spark, sf).versions("raw", "steam")


@query
def lake_entries(spark, sf):
    """Rows per source from the footers of all files; paths, times, sizes and the number of files differ from run to run."""
    entries = _lake_with_steam_loads(spark, sf).entries("raw")
    sound = F.col("filename").endswith(".parquet") & F.col("path").contains("/raw/steam/ingest_date=") & (F.col("size_bytes") > 0) & F.col("created_at").isNotNull()
    return entries.groupBy("layer", "source").agg(F.sum("row_count").alias("row_count"), F.bool_and(sound).alias("sound"))


@query
def lake_datasets(spark, sf):
    return _lake_with_steam_loads(spark, sf).datasets("raw").select("layer", "source", "ingest_date", "name", "row_count")


@query
def lake_promote(spark, sf):
    lake = _lake_with_steam_loads(spark, sf)
    raw = lake.unpromoted("raw", "bronze", "steam")
    lake.promote("raw", "bronze", "steam", raw, DAY2, "all")
    return lake.read("bronze", "steam")


@query
def lake_pipeline(spark, sf):
    """A run, a load whose run died after the bronze copy, the next run, a backfill under an earlier time, and a run without news."""
    lake, key = _lake(spark), {"steam": "app_id"}
    loads = [(fx.steam_load(spark, sf, k), at.replace(tzinfo=UTC), f"load{k}") for k, at in enumerate(fx.STEAM_LOADS)]
    at = fx.STEAM_LOADS[2].replace(tzinfo=UTC)
    lake.write("raw", "steam", *loads[1])
    lake_ops.lake_pipeline(lake, key, at)
    lake.write("raw", "steam", *loads[2])
    lake.copy_versions("raw", "bronze", "steam", [(loads[2][1].date(), "load2")])
    lake_ops.lake_pipeline(lake, key, at + timedelta(hours=1))
    keyless = loads[0][0].limit(1).withColumn("app_id", F.lit(None).cast("string"))
    lake.write("raw", "steam", loads[0][0].unionByName(keyless), *loads[0][1:])
    lake_ops.lake_pipeline(lake, key, at - timedelta(days=2))
    lake_ops.lake_pipeline(lake, key, at + timedelta(hours=2))
    return lake_ops.Silver(lake, "steam").snapshot("app_id")


@query
def silver_directory(spark, sf):
    """Orders loaded priority by priority into buckets of 2 000 rows, which split on the way, then corrections of the large ones."""
    lake, key = _lake(spark), {"orders": "o_orderkey"}
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    at = datetime(2024, 1, 1, tzinfo=UTC)
    for k, priority in enumerate(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]):
        load = orders.where(F.col("o_orderpriority") == priority).withColumn("loaded_at", F.lit(at).cast("timestamp"))
        lake.write("raw", "orders", load, at + timedelta(hours=k), f"load{k}")
        lake_ops.lake_pipeline(lake, key, at + timedelta(hours=k), bucket_rows=2000)
    large = orders.where("o_totalprice > 400000").withColumn("o_totalprice", F.col("o_totalprice") / 2).withColumn("loaded_at", F.lit(at + timedelta(days=1)).cast("timestamp"))
    lake.write("raw", "orders", large, at + timedelta(hours=5), "load5")
    lake_ops.lake_pipeline(lake, key, at + timedelta(hours=5), bucket_rows=2000)
    return lake_ops.Silver(lake, "orders").snapshot("o_orderkey").drop("loaded_at")


@query
def dataset_catalog(spark, sf):
    """Local datasets plus a remote listing derived from the documents: only unseen names of usable keys are added."""
    lake = _lake_with_steam_loads(spark, sf)
    remote = fx.table(spark, sf, "documents").select(
        F.concat(
            F.lit("raw/"), F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.lit("/")).otherwise(F.lit("-")),
            F.lit("load"), F.col("doc_id").cast("string"),
            F.when(F.col("doc_id") % 3 == 0, F.lit(".json")).otherwise(F.lit(".parquet")),
        ).alias("key"),
        F.col("n_chars").alias("size_bytes"),
    )
    listed = lake.catalog(remote)
    size = F.when(F.col("source") == "s3", F.col("size_bytes")).alias("remote_size")
    return listed.select("layer", "source", "name", "row_count", size)


@query
def dataset_preview(spark, sf):
    """Which 100 rows come is open: their number, and that each is a row of the dataset."""
    shown = _lake_with_steam_loads(spark, sf).preview("steam", "load1")
    whole = fx.steam_load(spark, sf, 1)
    known = shown.join(whole.select(*[F.col(c).alias(f"_{c}") for c in whole.columns]), reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in whole.columns]), "left_semi")
    return shown.agg(F.count("*").alias("shown")).withColumn("known", known.agg(F.count("*")).scalar())


@query
def table_preview_page(spark, sf):
    """Third page of 50 orders, most expensive first."""
    orders = fx.table(spark, sf, "orders")
    return (
        orders.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(100).limit(50)
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query
def parquet_load(spark, sf):
    return files.parquet_load(spark, f"{sf}/customer.parquet")


@query
def parquet_load_dir(spark, sf):
    lake = _lake_with_steam_loads(spark, sf)
    return files.parquet_load_dir(spark, lake.path("raw", "steam")).select("app_id", "price", "loaded_at")


def _customer_csv(spark, sf):
    folder = work_dir(spark, "csv") + "/customer.csv"
    fx.table(spark, sf, "customer").write.option("header", True).csv(folder)
    return folder


@query
def csv_to_parquet(spark, sf):
    source = _customer_csv(spark, sf)
    schema = fx.table(spark, sf, "customer").schema
    return spark.read.parquet(files.csv_to_parquet(spark, source, schema=schema))


@query
def csv_dir_to_parquet(spark, sf):
    """Two folders with a file of the same name each; what is stored, and how many files failed."""
    folder, customer = work_dir(spark, "csv"), fx.table(spark, sf, "customer")
    for k in range(2):
        part = f"{folder}/part{k}"
        customer.where(F.col("c_custkey") % 2 == k).coalesce(1).write.option("header", True).csv(part)
        written = next(n for n in child_names(spark, part) if n.startswith("part-"))
        replace_folder(spark, f"{part}/{written}", f"{part}/customer.csv")
    status = files.csv_dir_to_parquet(spark, folder, work_dir(spark, "converted")).collect()
    assert all(r.success for r in status), status
    stored = [history.sync_columns(spark.read.parquet(r.output_path), customer.dtypes) for r in status]
    return intermediate.union_frames(stored)


INGEST_COLUMNS = ["source", "layer", "files_ingested", "rows_total", "success"]


@query
def ingest_dataframe(spark, sf):
    return files.ingest_dataframe(_lake(spark), "imdb", fx.imdb_titles(spark, sf), DAY1).select(*INGEST_COLUMNS)


@query
def ingest_file(spark, sf):
    return files.ingest_file(_lake(spark), "lineitem", f"{sf}/lineitem.parquet", DAY1).select(*INGEST_COLUMNS)


@query
def ingest_file_rows(spark, sf):
    """What the raw layer holds after a file was taken in."""
    lake = _lake(spark)
    files.ingest_file(lake, "orders", f"{sf}/orders.parquet", DAY1)
    return lake.read("raw", "orders")


@query
def ingest_directory(spark, sf):
    return files.ingest_directory(_lake(spark), "all", sf, DAY1).select(*INGEST_COLUMNS)


@query
def count_rows(spark, sf):
    n = files.count_rows(spark, [f"{sf}/lineitem.parquet", f"{sf}/orders.parquet"])
    return spark.createDataFrame([(n,)], "row_count bigint")


@query
def save_records(spark, sf):
    lake = _lake(spark)
    files.save_records(fx.imdb_titles(spark, sf), lake, "titles")
    return spark.read.parquet(files.save_records(fx.steam_games(spark, sf), lake, "titles"))


@query
def warehouse_append(spark, sf):
    wh, games = _warehouse(spark), fx.steam_games(spark, sf)
    wh.load("steam_games", games, AS_OF)
    wh.load("steam_games", games.select(*reversed(games.columns)), AS_OF)
    return wh.table("steam_games").groupBy("app_id", "name", "loaded_at").agg(F.count("*").alias("copies"))


@query
def warehouse_overwrite(spark, sf):
    """The second load replaces the table by a part of itself."""
    wh = _warehouse(spark)
    wh.load("steam_games", fx.steam_games(spark, sf), AS_OF)
    wh.load("steam_games", wh.table("steam_games").where(F.col("rating") != "Mixed"), AS_OF, "overwrite")
    return wh.table("steam_games")


def _incremental_warehouse(spark, sf):
    wh, posts = _warehouse(spark), fx.reddit_posts(spark, sf)
    wh.load("reddit_posts", posts.where(F.col("loaded_at") <= SPLIT), AS_OF, "incremental")
    wh.load("reddit_posts", posts, AS_OF, "incremental")
    return wh


@query
def warehouse_incremental(spark, sf):
    return _incremental_warehouse(spark, sf).table("reddit_posts").select("id", "score", "loaded_at")


@query
def load_result(spark, sf):
    return _incremental_warehouse(spark, sf).load_log().select(
        "table_name", "rows_loaded", "rows_skipped", "mode", "success"
    )


@query
def load_parquet(spark, sf):
    wh = _warehouse(spark)
    wh.load_parquet("customer", f"{sf}/customer.parquet", AS_OF, "overwrite")
    return wh.table("customer")


@query
def fn_stamp_loaded_at(spark, sf):
    posts = fx.reddit_posts(spark, sf)
    kept = F.when(F.col("id") < "t3_5", F.col("loaded_at"))
    return stamp_loaded_at(posts.withColumn("loaded_at", kept), AS_OF).select("id", "loaded_at")



@query
def fn_register_view(spark, sf):
    return register_view(spark, "customer_view", f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")



@query
def run_sql(spark, sf):
    wh = _warehouse(spark)
    wh.load_parquet("orders", f"{sf}/orders.parquet", AS_OF)
    return wh.query(
        f"SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS max_price FROM {wh.schema}.orders "
        "WHERE o_orderstatus = :status GROUP BY o_orderpriority",
        status="F",
    )


@query
def catalog_info(spark, sf):
    wh = _warehouse(spark)
    wh.load_parquet("customer", f"{sf}/customer.parquet", AS_OF)
    wh.load_parquet("nation", f"{sf}/nation.parquet", AS_OF)
    info = wh.catalog_info()
    return info.where(F.col("table_name") != "load_log").select("table_name", "ordinal", "column_name", "row_count")


def _logs(spark, sf):
    path = work_dir(spark, "logs")
    fx.log_lines(spark, sf).select("value").write.text(path)
    return files.log_source(spark, path)


@query
def log_source(spark, sf):
    return _logs(spark, sf)


# --- models ------------------------------------------------------------------------------------


@query
def stg_reddit_posts(spark, sf):
    return _staged(spark, sf, "reddit")


@query
def stg_steam_games(spark, sf):
    return _staged(spark, sf, "steam")


@query
def stg_imdb_titles(spark, sf):
    return _staged(spark, sf, "imdb")


@query
def stg_news_articles(spark, sf):
    return _staged(spark, sf, "news")


@query
def int_reddit_posts_enriched(spark, sf):
    return intermediate.int_reddit_posts_enriched(_staged(spark, sf, "reddit"), content_categories(spark))


@query
def int_steam_games_enriched(spark, sf):
    return intermediate.int_steam_games_enriched(_staged(spark, sf, "steam"), content_categories(spark))


@query
def int_content_unified(spark, sf):
    return _unified(spark, sf)


@query
def union_frames(spark, sf):
    posts = fx.reddit_posts(spark, sf).select("id", "title", "author")
    titles = fx.imdb_titles(spark, sf).select("id", "title", "year")
    return intermediate.union_frames([posts, titles])


def _with_content_counts(dim, spark, sf):
    counts = _unified(spark, sf).groupBy("source_name").agg(F.count("*").alias("content_count"))
    return dim.join(counts, "source_name", "left")


@query
def dim_sources(spark, sf):
    """The dimension, with the rows each source contributes."""
    return _with_content_counts(_dim_sources(spark), spark, sf)


@query
def dim_content_types(spark, sf):
    return _with_content_counts(marts.dim_content_types(content_categories(spark)), spark, sf)


@query
def fct_content(spark, sf):
    return _content(spark, sf)


@query
def fct_engagement_metrics(spark, sf):
    return marts.fct_engagement_metrics(_content(spark, sf))


def _kept_metrics(spark, sf):
    """Metrics from a state that was built with faults: scores of every month's 7th are doubled, the 8th is missing, the 9th has its rows twice.
    Three changes correct them."""
    content = as_table(_content(spark, sf).select(*metrics_state.READ_COLUMNS), "fct_content")
    day, state = F.dayofmonth("created_at"), metrics_state.MetricsState(spark, work_dir(spark, "metrics-state"))
    on = {k: content.where(day == k) for k in (7, 8, 9)}
    doubled = on[7].withColumn("score", F.col("score") * 2)
    state.rebuild(content.where(day.isNull() | ~day.isin(7, 8)).unionByName(doubled).unionByName(on[9]))
    state.apply(on[7], doubled, content.where(day.isNull() | (day != 8)).unionByName(on[9]))
    state.apply(on[8], content.limit(0), content.unionByName(on[9]))
    state.apply(content.limit(0), on[9], content)
    state.expire()
    return state.metrics()


@query
def fct_engagement_metrics_from_state(spark, sf):
    return _kept_metrics(spark, sf)


@query
def rpt_daily_ingestion_summary_from_state(spark, sf):
    return reports.rpt_daily_ingestion_summary(_kept_metrics(spark, sf))


@query
def rpt_top_content_by_source(spark, sf):
    return reports.rpt_top_content_by_source(_content(spark, sf)).orderBy("source_name", "rank_within_source")


@query
def rpt_content_freshness(spark, sf):
    return reports.rpt_content_freshness(_content(spark, sf), AS_OF).orderBy(F.desc("hours_since_last_load"))


@query
def rpt_daily_ingestion_summary(spark, sf):
    metrics = marts.fct_engagement_metrics(_content(spark, sf))
    return reports.rpt_daily_ingestion_summary(metrics).orderBy(F.desc("activity_date"))


@query
def an_content_distribution(spark, sf):
    return analyses.content_distribution(_content(spark, sf)).orderBy(F.desc("content_count"))


@query
def an_score_percentiles(spark, sf):
    return analyses.score_percentiles(_content(spark, sf)).orderBy("source_name")


@query
def score_percentiles_sketch(spark, sf):
    """Percentiles from stored daily sketches: whether all ranks are within the stated error of the exact ones."""
    content = as_table(_content(spark, sf), "fct_content")
    sketches = as_table(analyses.daily_score_sketches(content), "score-sketches")
    errors = analyses.percentile_rank_errors(content, analyses.percentiles_from_sketches(sketches))
    worst = F.greatest(*[F.col(name) for name in analyses.PERCENTILES])
    return errors.select("source_name", "scored", (worst <= analyses.SKETCH_RANK_ERROR).alias("within_error"))


@query
def an_monthly_volume(spark, sf):
    return analyses.monthly_volume(_content(spark, sf)).orderBy(F.desc("month"), "source_name")


@query
def an_weekly_growth(spark, sf):
    return analyses.weekly_growth(_content(spark, sf)).orderBy("source_name", F.desc("week_start"))


@query
def an_top_authors(spark, sf):
    return analyses.top_authors(_content(spark, sf))


@query
def an_daily_velocity(spark, sf):
    return analyses.daily_velocity(_content(spark, sf)).orderBy(F.desc("day"), "source_name")


@query
def pipeline_run(spark, sf):
    """A whole run on fresh folders: rows per stored relation."""
    lake, wh = _lake(spark), _warehouse(spark)
    for name, df in fx.raw_sources(spark, sf).items():
        lake.write("raw", name, df, DAY1)
    result = run_pipeline(spark, lake, wh, AS_OF.replace(tzinfo=UTC))
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("relation"), "row_count")
        for name, df in result.models.items()
    ]
    return intermediate.union_frames(counted)


@query
def pipeline_run_report(spark, sf):
    """The content of a report that a run has stored."""
    lake, wh = _lake(spark), _warehouse(spark)
    for name, df in fx.raw_sources(spark, sf).items():
        lake.write("raw", name, df, DAY1)
    run_pipeline(spark, lake, wh, AS_OF.replace(tzinfo=UTC))
    return wh.table("rpt_top_content_by_source").select(*rpt_top_content_by_source(spark, sf).columns)


# --- incremental log and history ---------------------------------------------------------------


def _two_batches(spark, sf):
    unified = _unified(spark, sf)
    return unified.where(F.col("loaded_at") <= SPLIT), unified


@query
def incr_content_events(spark, sf):
    """Second run of the event log: only rows above the first run's high-water mark."""
    first, everything = _two_batches(spark, sf)
    target = history.content_events(first)
    return history.content_events_increment(everything, target)


@query
def incr_content_events_replay(spark, sf):
    """Both runs on a stored log."""
    first, everything = _two_batches(spark, sf)
    log = history.EventLog(spark, work_dir(spark, "events") + "/log")
    log.run(first)
    return log.run(everything)


@query
def incr_full_refresh(spark, sf):
    first, everything = _two_batches(spark, sf)
    log = history.EventLog(spark, work_dir(spark, "events") + "/log")
    log.run(everything)
    return log.run(first, full_refresh=True)


@query
def incr_event_upsert(spark, sf):
    """Corrected titles of the games replace the stored events of the same id."""
    unified = _unified(spark, sf)
    log = history.EventLog(spark, work_dir(spark, "events") + "/log")
    log.run(unified)
    games = history.content_events(unified.where(F.col("source_name") == "steam"))
    return log.upsert(games.withColumn("title", F.upper("title")))


@query
def incr_upsert_by_key(spark, sf):
    """Games of the second load replace those of the first; the first load has only even keys."""
    old = fx.steam_load(spark, sf, 0).where(F.col("app_id").cast("bigint") % 2 == 0)
    new = fx.steam_load(spark, sf, 1).where(F.col("app_id").cast("bigint") % 3 == 0)
    return history.upsert_by_key(old, new, "app_id").select("app_id", "price", "loaded_at")


@query
def incr_schema_sync(spark, sf):
    """The stored shape takes the incoming columns: one added, one dropped."""
    stored = fx.reddit_posts(spark, sf).select("id", "author", "score")
    return history.sync_columns(stored, [("id", "string"), ("score", "string"), ("flair", "string")])


def _late_events(spark, sf, folder: str) -> DataFrame:
    """Streaming events of several batches; the sources' clocks are weeks apart, and some rows come twice."""
    streams, files_at_once = {}, spark.sparkContext.defaultParallelism
    for name, df in fx.raw_sources(spark, sf).items():
        path = f"{folder}/raw/{name}"
        late = F.pmod(F.xxhash64(SOURCES[name].key), F.lit(3)) == 0
        df.where(~late).repartition(files_at_once).write.parquet(path)
        again = df.where(late | (F.pmod(F.xxhash64(SOURCES[name].key), F.lit(5)) == 0))
        again.repartition(files_at_once).write.mode("append").parquet(path)
        streams[name] = event_log.read_raw_stream(spark, path, df.schema, max_files=files_at_once)
    return event_log.incr_content_events_stream(intermediate.int_content_unified(stage_all(streams, AS_OF)))


@query
def incr_content_events_stream(spark, sf):
    raw = work_dir(spark, "stream")
    event_log.start_event_log(_late_events(spark, sf, raw), f"{raw}/log", f"{raw}/checkpoint").awaitTermination()
    return history.EventLog(spark, f"{raw}/log").read()


@query
def incr_content_events_keyed(spark, sf):
    """The same batches through keyed state with a clock per source and a horizon of three days."""
    raw = work_dir(spark, "keyed")
    events = _late_events(spark, sf, raw)
    keyed_state.start_keyed_log(events, f"{raw}/log", f"{raw}/checkpoint", horizon_seconds=3 * 86_400).awaitTermination()
    return keyed_state.KeyedEventLog(spark, f"{raw}/log").read(events.schema)


def _steam_history(spark, sf):
    loads = [fx.steam_load(spark, sf, k) for k in range(len(fx.STEAM_LOADS))]
    staged = [stage_all({"steam": load}, AS_OF)["steam"] for load in loads]
    return [s.select(*history.STEAM_TRACKED) for s in staged]


@query
def scd_steam_game_prices(spark, sf):
    return history.scd2_from_history(intermediate.union_frames(_steam_history(spark, sf)), "app_id")


@query
def scd_steam_price_changes(spark, sf):
    """Only loads that changed the tracked values open a version."""
    loads = intermediate.union_frames(_steam_history(spark, sf))
    return history.scd2_from_history(loads, "app_id", check_cols=["name", "price", "rating", "developer", "genres"])


@query
def scd_reddit_post_scores(spark, sf):
    staged = [stage_all({"reddit": fx.reddit_load(spark, sf, k)}, AS_OF)["reddit"] for k in range(2)]
    loads = intermediate.union_frames([s.select(*history.REDDIT_TRACKED) for s in staged])
    return history.scd2_from_history(loads, "id")


@query
def scd2_apply(spark, sf):
    """The same history built load by load."""
    first, *later = _steam_history(spark, sf)
    snapshot = history.scd2_from_history(first, "app_id")
    for load in later:
        snapshot = history.scd2_apply(materialized(snapshot), load, "app_id")
    return snapshot


@query
def scd2_stored(spark, sf):
    """The same history as a stored table, one load at a time, the last one twice; the middle one cannot come again."""
    table = history.HistoryTable(spark, work_dir(spark, "history"), "app_id")
    loads = _steam_history(spark, sf)
    for k, load in enumerate(loads):
        table.apply(load, f"load{k}")
    table.apply(load, f"load{k}")
    try:
        table.apply(loads[1], "load1")
    except ValueError:
        return table.read()
    raise AssertionError("a load out of order was taken in")


@query
def scd2_as_of(spark, sf):
    snapshot = history.scd2_from_history(intermediate.union_frames(_steam_history(spark, sf)), "app_id")
    at = F.lit(datetime(2024, 1, 27)).cast("timestamp")
    return history.scd2_as_of(snapshot, at).select("app_id", "price", "dbt_valid_from", "dbt_valid_to")


# --- scalar functions --------------------------------------------------------------------------


@query
def fn_normalize_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("value"))


@query
def fn_clean_html(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.clean_html(F.col("html")).alias("value"))


@query
def fn_trim_strings(spark, sf):
    padded = F.concat(F.lit("  　"), F.col("p_name"), F.lit("  "))
    return fx.table(spark, sf, "part").select("p_partkey", text.trim_text(padded).alias("value"))


def _dirty_orders(spark, sf) -> DataFrame:
    """Orders with prices and days as dirty text."""
    dirty = F.concat(
        F.lit(" "), F.round(F.col("o_totalprice") / 100, 1).cast("string"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("d")).when(F.col("o_orderkey") % 7 == 1, F.lit("e1"))
        .when(F.col("o_orderkey") % 7 == 2, F.lit("f")).when(F.col("o_orderkey") % 7 == 3, F.lit("x")).otherwise(F.lit(" ")),
    )
    day = F.concat(F.date_format("o_orderdate", "yyyy/M/d"), F.when(F.col("o_orderkey") % 5 == 0, F.lit("x")).otherwise(F.lit("")))
    return fx.table(spark, sf, "orders").withColumns({"dirty": dirty, "day": day})


@query
def fn_safe_cast(spark, sf):
    dirty = F.col("dirty")
    return _dirty_orders(spark, sf).select(
        "o_orderkey", casts.safe_int(dirty).alias("as_int"), casts.safe_double(dirty).alias("as_double"),
        casts.safe_int_from_double(F.col("o_totalprice")).alias("price_int"), casts.safe_date(F.col("day")).alias("as_date"),
        casts.cast_or_default(dirty, "double", -1.0).alias("as_default"),
    )


@query
def fn_round_half_up(spark, sf):
    """Values on both sides of 1e13, also negative ones and exact halves."""
    sign = F.when(F.col("l_orderkey") % 2 == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    x = sign * (F.col("l_extendedprice") + F.lit(0.005)) * F.pow(F.lit(10.0), F.col("l_linenumber").cast("double") * 2)
    items = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))
    return items.select("l_orderkey", "l_linenumber", *[numbers.round_half_up(F.col("x"), p).alias(f"places_{p}") for p in (0, 2, 3)])


@query
def fn_calculate_growth(spark, sf):
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.growth(F.col("l_linenumber"), (F.col("l_orderkey") % 5)).alias("growth_pct"),
    )


@query
def fn_surrogate_key(spark, sf):
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", keys.surrogate_key(F.col("o_orderkey"), status).alias("key"),
        keys.surrogate_key_fallback(F.col("o_orderkey"), status).alias("fallback_key"),
    )


@query
def fn_strip_strings(spark, sf):
    padded = fx.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("\t "), "role", F.lit(" \n")).alias("role"), F.concat("text", F.lit("\r\n")).alias("text")
    )
    return text.strip_strings(padded)


@query
def fn_slugify(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", text.slugify(F.col("text")).alias("slug"), text.dataset_name(F.col("source")).alias("dataset_name"),
        text.suggested_dataset_name(F.col("text"), F.col("source")).alias("suggested_name"),
    )


@query
def fn_dataset_name(spark, sf):
    return fn_slugify(spark, sf).select("doc_id", "dataset_name", "suggested_name")


def _sql_call(spark, df: DataFrame, columns: str) -> DataFrame:
    """Calls of the SQL functions over a temporary view."""
    sql_forms.register_macros(spark)
    name = f"calls_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return spark.sql(f"SELECT {columns} FROM {name}")


@query
def sql_normalize_text(spark, sf):
    return _sql_call(spark, fx.table(spark, sf, "documents"), "doc_id, normalize_text(text) AS value")


@query
def sql_clean_html(spark, sf):
    return _sql_call(spark, fx.table(spark, sf, "pages"), "page_id, clean_html(html) AS value")


@query
def sql_trim_strings(spark, sf):
    return _sql_call(spark, fx.table(spark, sf, "part"), "p_partkey, trim_text(concat('\u00a0 \u3000', p_name, '  ')) AS value")


@query
def sql_safe_cast(spark, sf):
    return _sql_call(
        spark, _dirty_orders(spark, sf), "o_orderkey, safe_int(dirty) AS as_int, safe_double(dirty) AS as_double, "
        "safe_int_from_double(o_totalprice) AS price_int, safe_date(day) AS as_date, coalesce(safe_double(dirty), -1.0D) AS as_default",
    )


@query
def sql_calculate_growth(spark, sf):
    return _sql_call(spark, fx.table(spark, sf, "lineitem"), "l_orderkey, l_linenumber, calculate_growth(l_linenumber, l_orderkey % 5) AS growth_pct")


@query
def sql_surrogate_key(spark, sf):
    parts = "array(string(o_orderkey), CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END)"
    return _sql_call(spark, fx.table(spark, sf, "orders"), f"o_orderkey, surrogate_key({parts}) AS key, surrogate_key_fallback({parts}) AS fallback_key")


@query
def fn_safe_cast_default(spark, sf):
    return fn_safe_cast(spark, sf).select("o_orderkey", "as_default")


@query
def fn_safe_int(spark, sf):
    shown = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), F.format_number(F.col("o_custkey") * 1000, 0), F.lit(" "))
    )
    return fx.table(spark, sf, "orders").select("o_orderkey", casts.count_or_zero(shown).alias("value"))


@query
def fn_parse_size(spark, sf):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("B", " kb", "MB", " Gb", "tb", "", " XB")]), (F.col("doc_id") % 7 + 1).cast("int"))
    shown = F.concat((F.col("n_chars") / 4).cast("string"), unit)
    return fx.table(spark, sf, "documents").select("doc_id", casts.parse_size(shown).alias("bytes"))


@query
def fn_truncate_string(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", text.truncate_string(F.col("text")).alias("value"))


@query
def fn_flatten_struct(spark, sf):
    parsed = fx.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"),
        F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("type")).alias("last")).alias("user"),
    )
    return rows.flatten_struct(parsed, "_")


@query
def flatten_json(spark, sf):
    """Event objects whose fields differ from row to row; names and types are found in the texts."""
    n = F.col("event_id").cast("string")
    body = F.concat(
        F.lit('{"props": '), "props", F.lit(', "user": {"id": '), F.col("user_id").cast("string"), F.lit(', "last": {"type": "'), "event_type", F.lit('"}}'),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(', "tags": ['), n, F.lit(", 1]"))).otherwise(""),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(', "ref": "r'), n, F.lit('"'))).when(F.col("event_id") % 5 == 1, F.concat(F.lit(', "ref": {"no": '), n, F.lit("}"))).otherwise(""),
        F.lit("}"),
    )
    texts = fx.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, body).otherwise("no JSON").alias("body"))
    return json_records.flatten_json(texts, "body", "_").withColumn("tags", F.array_join("tags", ","))


@query
def fn_chunk_rows(spark, sf):
    """Chunks of 7 events per type, in id order."""
    events = fx.table(spark, sf, "events").select("event_id", "event_type")
    slot = F.floor(F.col("event_id") / F.lit(100_000))
    return rows.chunk_rows(events, 7, ["event_type"], ["event_id"], slot)


@query
def fn_url_ids(spark, sf):
    urls_of = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("https://store.example/app/"), F.col("o_orderkey").cast("string"), F.lit("/name/")).alias("game"),
        F.concat(F.lit("/title/tt"), F.col("o_custkey").cast("string"), F.lit("/?x")).alias("title"),
        F.concat(F.lit("based on "), F.format_number(F.col("o_custkey") * 1000, 0), F.lit(" votes")).alias("votes"),
        F.concat(F.lit("("), F.year("o_orderdate").cast("string"), F.lit(")")).alias("year"),
    )
    return urls_of.select(
        "o_orderkey", keys.extract_app_id(F.col("game")).alias("app_id"), keys.extract_title_id(F.col("title")).alias("title_id"),
        keys.extract_votes(F.col("votes")).alias("votes"), keys.strip_parentheses(F.col("year")).alias("year_text"),
    )


@query
def fn_extract_app_id(spark, sf):
    return fn_url_ids(spark, sf).select("o_orderkey", "app_id")


@query
def fn_extract_title_id(spark, sf):
    return fn_url_ids(spark, sf).select("o_orderkey", "title_id")


@query
def fn_extract_votes(spark, sf):
    return fn_url_ids(spark, sf).select("o_orderkey", "votes", "year_text")


@query
def fn_iso_timestamp(spark, sf):
    shown = F.concat(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.col("event_id") % 3 == 0, F.lit("Z")).when(F.col("event_id") % 3 == 1, F.lit("+02:00")).otherwise(F.lit(" later")),
    )
    return fx.table(spark, sf, "events").select("event_id", casts.iso_timestamp(shown).alias("at"))


@query
def fn_parse_price(spark, sf):
    shown = F.when(F.col("p_partkey") % 11 == 0, F.lit("Free to Play")).when(F.col("p_partkey") % 11 == 1, F.lit("soon")).otherwise(
        F.concat(F.lit("$"), F.format_number("p_retailprice", 2))
    )
    return fx.table(spark, sf, "part").select("p_partkey", casts.parse_price(shown).alias("price"))


# --- data quality and monitoring ---------------------------------------------------------------


@query
def test_unique(spark, sf):
    return quality.test_unique(fx.reddit_posts(spark, sf), "author")


@query
def test_not_null(spark, sf):
    return quality.test_not_null(_staged(spark, sf, "reddit"), "score").select("id")


@query
def test_accepted_values(spark, sf):
    return quality.test_accepted_values(fx.reddit_posts(spark, sf), "subreddit", ["view", "click"])


@query
def test_relationships(spark, sf):
    orders = fx.table(spark, sf, "orders")
    customers = fx.table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return quality.test_relationships(orders, "o_custkey", customers, "c_custkey").select("o_orderkey", "o_custkey")


@query
def test_positive_score(spark, sf):
    return quality.test_positive_score(fx.table(spark, sf, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query
def test_not_future_date(spark, sf):
    at = datetime(2024, 1, 15)
    return quality.test_not_future_date(_staged(spark, sf, "reddit"), "created_at", at).select("id", "created_at")


@query
def test_orphans(spark, sf):
    """Facts of sources missing from a dimension without news."""
    dims = _dim_sources(spark).where(F.col("source_name") != "news")
    return quality.test_orphans(_content(spark, sf), dims)


@query
def test_event_unique(spark, sf):
    """Events of overlapping batches repeat; the log itself has none."""
    first, everything = _two_batches(spark, sf)
    return quality.test_event_unique(history.content_events(first).unionByName(history.content_events(everything)))


def _sql_test(spark, df: DataFrame, test: str, columns: str, column: str = "", argument: str = "", parent: DataFrame | None = None, parent_column: str = ""):
    """The failing rows of a test, through its SQL function on a temporary view."""
    name = f"test_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(f"{name}_rows")
    if parent is not None:
        parent.createOrReplaceTempView(f"{name}_parent")
    sql_forms.register_test(spark, name, test, f"{name}_rows", column, "" if parent is None else f"{name}_parent", parent_column)
    return spark.sql(f"SELECT {columns} FROM {name}({argument})")


@query
def sql_test_unique(spark, sf):
    return _sql_test(spark, fx.reddit_posts(spark, sf), "unique", "author, n_records", "author")


@query
def sql_test_not_null(spark, sf):
    return _sql_test(spark, _staged(spark, sf, "reddit"), "not_null", "id", "score")


@query
def sql_test_accepted_values(spark, sf):
    return _sql_test(spark, fx.reddit_posts(spark, sf), "accepted_values", "subreddit, n_records", "subreddit", "array('view', 'click')")


@query
def sql_test_relationships(spark, sf):
    customers = fx.table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    orders = fx.table(spark, sf, "orders")
    return _sql_test(spark, orders, "relationships", "o_orderkey, o_custkey", "o_custkey", parent=customers, parent_column="c_custkey")


@query
def sql_test_positive_score(spark, sf):
    return _sql_test(spark, fx.table(spark, sf, "customer"), "positive_score", "c_custkey, c_acctbal", "c_acctbal")


@query
def sql_test_not_future_date(spark, sf):
    return _sql_test(spark, _staged(spark, sf, "reddit"), "not_future_date", "id, created_at", "created_at", "timestamp'2024-01-15 00:00:00'")


@query
def sql_test_orphans(spark, sf):
    dims = _dim_sources(spark).where(F.col("source_name") != "news")
    return _sql_test(spark, _content(spark, sf), "orphans", "content_id, source_name", parent=dims)


@query
def sql_test_event_unique(spark, sf):
    first, everything = _two_batches(spark, sf)
    both = history.content_events(first).unionByName(history.content_events(everything))
    return _sql_test(spark, both, "event_unique", "event_id, occurrence_count")


@query
def dq_results(spark, sf):
    """Every declared test on every relation; each reads only the columns it tests. What other relations are built from
    is stored once, as a run does it."""
    stored = ("int_content_unified", "fct_content", "fct_engagement_metrics")
    models = build_models(spark, fx.raw_sources(spark, sf), AS_OF, lambda name, df: as_table(df, name) if name in stored else df)
    return quality.run_tests(models, AS_OF)


@query
def dq_results_from_state(spark, sf):
    """The same from stored states: the rows come in two versions, each tested once, and the states are merged. Relations that are
    aggregates have no versions and are tested whole."""
    raw, key = fx.raw_sources(spark, sf), F.coalesce(F.dayofmonth("loaded_at") % 2, F.lit(0))
    whole = [n for n in quality.DECLARED_TESTS if n.startswith(("rpt_", "fct_engagement"))]
    state = quality_state.QualityState(spark, work_dir(spark, "test-state"), {n: t for n, t in quality.DECLARED_TESTS.items() if n not in whole})
    for k in (0, 1):
        models = build_models(spark, {n: df.where(key == k) for n, df in raw.items()}, AS_OF)
        state.add(f"v{k}", {n: df for n, df in models.items() if n not in whole and not (k and n.startswith("dim_"))}, AS_OF)
    assert not state.add("v1", {}, AS_OF)
    state.compact()
    content = as_table(build_content(spark, raw, AS_OF), "fct_content")
    metrics = marts.fct_engagement_metrics(content, AS_OF)
    aggregates = {
        "fct_engagement_metrics": metrics, "rpt_top_content_by_source": reports.rpt_top_content_by_source(content),
        "rpt_content_freshness": reports.rpt_content_freshness(content, AS_OF), "rpt_daily_ingestion_summary": reports.rpt_daily_ingestion_summary(metrics),
    }
    return state.results(AS_OF).unionByName(quality.run_tests(aggregates, AS_OF))


@query
def dq_summary(spark, sf):
    """Outcome of the staging tests, with one column that does have missing values."""
    staged = {source: _staged(spark, sf, source) for source in ("reddit", "imdb")}
    tests = {
        "reddit": quality.TableTests(("id", "author"), ("id", "title", "score")),
        "imdb": quality.TableTests(("id",), ("id", "year"), accepted={"type": ["movie"]}),
    }
    return quality.dq_summary(quality.run_tests(staged, AS_OF, tests))


@query
def source_freshness(spark, sf):
    return quality.source_freshness(fx.raw_sources(spark, sf), AS_OF)


@query
def validate_records(spark, sf):
    """Titles with ratings pushed out of range for some keys, one missing title, and their broken rules."""
    records = fx.table(spark, sf, "orders").select(
        F.concat(F.lit("tt"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderkey") % 10 != 3, F.col("o_orderpriority")).alias("title"),
        ((F.col("o_orderkey") % 14) - 1).cast("double").alias("rating"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("many")).otherwise((F.col("o_custkey") - 5).cast("string")).alias("votes"),
    )
    valid, rejected = quality.validate_records(records, quality.RECORD_RULES["imdb_title"])
    none = F.lit("").alias("violations")
    return valid.select("id", none).unionByName(rejected.select("id", F.array_join("violations", ",").alias("violations")))


@query
def fn_reject_sentinel_keys(spark, sf):
    """Placeholder keys counted per kind."""
    records = fx.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("unknown")).when(F.col("o_orderkey") % 5 == 1, F.lit(""))
        .when(F.col("o_orderkey") % 5 == 2, F.col("o_orderkey").cast("string")).alias("id")
    )
    good, bad = split_sentinel_keys(records, SOURCES["imdb"])
    return good.select("id", F.lit(True).alias("usable")).unionByName(bad.select("id", F.lit(False).alias("usable"))).groupBy(
        "usable"
    ).agg(F.count("*").alias("n_rows"), F.count("id").alias("n_ids"))



@query
def run_metrics(spark, sf):
    return monitor.run_metrics(fx.pipeline_runs(spark, sf)).select("run_id", "rows_processed", "rows_saved", "success_rate")


@query
def run_status_counts(spark, sf):
    return monitor.run_status_counts(fx.pipeline_runs(spark, sf))


@query
def recent_runs(spark, sf):
    return monitor.recent_runs(fx.pipeline_runs(spark, sf)).select("run_id", "source", "status", "started_at")


@query
def run_success_pct(spark, sf):
    return monitor.run_success_pct(fx.pipeline_runs(spark, sf))


@query
def recent_failures(spark, sf):
    return monitor.recent_failures(fx.pipeline_runs(spark, sf)).select("run_id", "status", "started_at")


@query
def ingestion_timeline(spark, sf):
    runs = fx.pipeline_runs(spark, sf)
    shown = F.when(F.col("run_id") % 13 != 0, F.col("started_at").cast("string")).otherwise(F.lit("pending"))
    return monitor.ingestion_timeline(runs.withColumn("started_at", shown))


@query
def rows_by_source(spark, sf):
    return monitor.rows_by_source(fx.datasets(spark, sf))


@query
def dataset_kpis(spark, sf):
    return monitor.dataset_kpis(fx.datasets(spark, sf), fx.pipeline_runs(spark, sf), AS_OF)


@query
def error_rate_by_source(spark, sf):
    status = F.when(F.col("event_id") % 9 == 0, "FAILED").otherwise("SUCCESS")
    return monitor.error_rate_by_source(
        fx.table(spark, sf, "events").select(F.col("event_type").alias("source"), status.alias("status"))
    )


@query
def crawl_summary(spark, sf):
    """Extraction outcome per language section of the crawled hosts."""
    found = extract.extract_fields(
        fx.table(spark, sf, "pages"), "article", [FieldSpec("p", "p", multiple=True)]
    ).select("page_id", "url", F.size("p").alias("n_records"), "error")
    start = F.lit(AS_OF).cast("timestamp")
    return monitor.crawl_summary(
        found.select(
            F.regexp_extract("url", r"^https?://[^/]+/([^/?]*)", 1).alias("profile"), "n_records",
            F.when(F.col("page_id") % 40 == 7, F.lit("timeout")).alias("error"),
            start.alias("started_at"), F.timestamp_add("SECOND", F.col("page_id"), start).alias("ended_at"),
        )
    )


@query
def log_query(spark, sf):
    return monitor.log_query(_logs(spark, sf), 50, "error", "p3")


@query
def log_tail_contains(spark, sf):
    lines = fx.log_lines(spark, sf).withColumnRenamed("value", "line")
    return monitor.log_tail_contains(lines, "error").select("line_no")


# --- extraction --------------------------------------------------------------------------------


@query
def extract_reddit_posts(spark, sf):
    return extract.extract_reddit_posts(fx.reddit_pages(spark, sf)).drop("url")


@query
def extract_steam_games(spark, sf):
    games = extract.extract_steam_games(fx.steam_pages(spark, sf))
    return games.withColumn("genres", F.array_join("genres", ",")).drop("url", "publisher", "review_count", "error")


@query
def extract_imdb_titles(spark, sf):
    titles = extract.extract_imdb_titles(fx.imdb_pages(spark, sf))
    return titles.withColumn("genres", F.array_join("genres", ",")).select(
        "page_id", "item_no", "id", "title", "year", "rating", "votes", "genres", "plot"
    )


@query
def extract_news_articles(spark, sf):
    articles = extract.extract_news_articles(fx.table(spark, sf, "pages"))
    return articles.withColumn("tags", F.array_join("tags", ",")).drop("published_at", "error")


@query
def land_pages(spark, sf):
    """News pages through extraction, validation and cleaning into the raw layer, then staged."""
    lake = _lake(spark)
    crawl.land_pages(lake, "news", fx.table(spark, sf, "pages"), AS_OF.replace(tzinfo=UTC))
    return stage_all({"news": lake.read("raw", "news")}, AS_OF)["news"]


@query
def land_pages_summary(spark, sf):
    """Store, film and post pages landed: pages, records and status per source."""
    lake, at = _lake(spark), AS_OF.replace(tzinfo=UTC)
    made = {"reddit": fx.reddit_pages, "steam": fx.steam_pages, "imdb": fx.imdb_pages}
    return intermediate.union_frames([crawl.land_pages(lake, name, make(spark, sf), at) for name, make in made.items()])


@query
def extract_fields(spark, sf):
    """Headings, paragraphs and the navigation as nested records of every page."""
    specs = [
        FieldSpec("heading", "article h1"),
        FieldSpec("ad", "div.ad"),
        FieldSpec("menu", "nav", children=(FieldSpec("links", "li > a[href^='/']", "href", True), FieldSpec("first", "a"))),
        FieldSpec("scripts", "body > script", "src", True),
    ]
    found = extract.extract_fields(fx.table(spark, sf, "pages"), "html", specs)
    return found.select(
        "page_id", "item_no", "heading", "ad", F.array_join("menu.links", " ").alias("links"), F.col("menu.first").alias("first_link"),
    )


@query
def extract_source_preset(spark, sf):
    return extract.extract_source_preset(fx.table(spark, sf, "pages"), "news").drop("error")


def _made_pages(spark, sf, name, key, html):
    """Pages with markup for one preset, from the rows of a driver table."""
    made = F.concat(*[F.lit(p[1:]) if p.startswith("=") else F.col(p).cast("string") for p in html])
    return fx._spread(spark, fx.table(spark, sf, name)).select(F.col(key).alias("page_id"), F.concat(F.lit("https://p.example/"), F.col(key)).alias("url"), made.alias("html"))


@query
def extract_preset_reddit(spark, sf):
    pages = _made_pages(spark, sf, "events", "event_id", [
        "=<div class='Post'><h3> Post ", "event_id", "= </h3><span class='score'>", "user_id", "=</span><a class='title' href='/p/", "event_id",
        "='>x</a><i class=author>", "event_type", "=</i></div><shreddit-post><a slot=full-post-link href=/q></a></shreddit-post>"])
    return extract.extract_source_preset(pages, "reddit").drop("error")


@query
def extract_preset_steam(spark, sf):
    pages = _made_pages(spark, sf, "part", "p_partkey", [
        "=<a class=search_result_row><span class='title'>", "p_name", "=</span><div class=discount_final_price> ", "p_size",
        "=&euro;</div><p class=search_reviewscore><span data-tooltip-html='", "p_type", "='></span></p><img src='", "p_brand", "=.png'><img src=no></a>"])
    return extract.extract_source_preset(pages, "steam").drop("error")


@query
def extract_preset_imdb(spark, sf):
    pages = _made_pages(spark, sf, "orders", "o_orderkey", [
        "=<div class=lister-item><h3 class=lister-item-header><a href='/t/", "o_orderkey", "='>", "o_orderpriority", "=</a><b class=lister-item-year>(",
        "o_orderstatus", "=)</b></h3><p class=ratings-imdb-rating><strong>", "o_custkey", "=</strong></p><i class=genre>",
        "o_orderstatus", "=</i></div>"])
    return extract.extract_source_preset(pages, "imdb").drop("error")


@query
def extract_preset_custom(spark, sf):
    """No container of its own: one nested record per child of the body."""
    pages = _made_pages(spark, sf, "nation", "n_nationkey", ["=<body><h2>", "n_name", "=</h2><p>", "n_regionkey", "=</p></body>"])
    return extract.extract_source_preset(pages, "custom").drop("error")


@query
def extract_images(spark, sf):
    """The first three of up to five images, and the text around them."""
    pages = _made_pages(spark, sf, "part", "p_partkey", ["=<div>", "p_name", "=<img src=1><img src='", "p_brand", "='><b>in</b><img><img src=3><img src=4></div><div></div>"])
    found = extract.extract_text_links_images(pages, "div")
    return found.select("page_id", "item_no", "text", F.array_join("images", " ").alias("images"))


@query
def extract_cascading(spark, sf):
    return extract.extract_cascading(fx.table(spark, sf, "pages")).drop("error")


@query
def extract_text_links_images(spark, sf):
    found = extract.extract_text_links_images(fx.table(spark, sf, "pages"), "nav")
    return found.select("page_id", "text", F.array_join("links", " ").alias("links"))


@query
def html_boilerplate_strip(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.html_boilerplate_strip(F.col("html")).alias("snippet"))


@query
def page_title(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.page_title(F.col("html")).alias("title"))


def _pages_with_next(spark, sf):
    """Pages with a pager appended: absolute, rooted, relative or no link, and a cursor button on some."""
    pages = fx.table(spark, sf, "pages")
    n = F.col("page_id").cast("string")
    href = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("https://next.example/"), n))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("/n/"), n))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("?page="), n))
    )
    link = F.when(href.isNotNull(), F.concat(F.lit('<div class="next"><a href="'), href, F.lit('">more</a></div>'))).otherwise(F.lit(""))
    cursor = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<button id="more" data-cursor="c '), n, F.lit('&amp;"></button>'))).otherwise(F.lit(""))
    return pages.withColumn("html", F.concat("html", link, cursor))


@query
def next_page_link(spark, sf):
    return extract.next_page_link(_pages_with_next(spark, sf)).select("page_id", "next_url")


@query
def page_chains(spark, sf):
    """Listings of up to 50 pages, found by the links in the pages; some pages skip one, some listings end where they began."""
    pages = fx.table(spark, sf, "pages")
    n, last = F.col("page_id"), F.col("page_id") % 50 == 49
    ring = F.floor(n / 50) % 3 == 0
    target = F.when(last & ring, n - 49).when(last, None).when((n % 11 == 5) & (n % 50 < 47), n + 2).otherwise(n + 1)
    targets = fx.table(spark, sf, "pages").select(F.col("page_id").alias("target"), F.col("url").alias("href"))
    linked = pages.withColumn("target", target).join(targets, "target", "left")
    link = F.concat(F.lit('<div class="next"><a href="'), F.replace("href", F.lit("&"), F.lit("&amp;")), F.lit('">more</a></div>'))
    found = extract.next_page_link(linked.withColumn("html", F.concat("html", F.coalesce(link, F.lit("")))))
    return chains.page_chains(found.select("url", "next_url"))


@query
def page_urls(spark, sf):
    return urls.page_urls(fx.table(spark, sf, "pages"), 4).select("page_id", "page_no", "page_url")


@query
def cursor_urls(spark, sf):
    return urls.cursor_urls(_pages_with_next(spark, sf), "#more").select("page_id", "cursor", "next_url")


@query
def robots_filter(spark, sf):
    return urls.robots_filter(fx.table(spark, sf, "pages").select("page_id", "url"), fx.robots_rules(spark, sf))


@query
def fn_json_records(spark, sf):
    found = json_records.json_records(fx.api_responses(spark, sf))
    return found.select("event_id", "record_no", F.get_json_object("record", "$.k").cast("int").alias("k"))



@query
def json_records_source(spark, sf):
    """The same responses landed as text files, one response per line, with records per cursor kind."""
    path = work_dir(spark, "responses")
    fx.api_responses(spark, sf).select("response").write.text(path)
    lines = spark.read.text(path).withColumnRenamed("value", "response")
    kind = F.substring(json_records.json_cursor(F.col("response")), 1, 1).alias("cursor_kind")
    found = json_records.json_records(lines.select("response", kind))
    return found.groupBy("cursor_kind").agg(
        F.count("*").alias("records"), F.sum(F.get_json_object("record", "$.k").cast("bigint")).alias("sum_k")
    )


@query
def json_cursor(spark, sf):
    return fx.api_responses(spark, sf).select("event_id", json_records.json_cursor(F.col("response")).alias("cursor"))


@query
def request_bodies(spark, sf):
    """Three planned pages per customer, the later ones with a cursor for odd keys."""
    plan = fx.table(spark, sf, "customer").select(
        "c_custkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page_no")
    )
    odd = (F.col("c_custkey") % 2 == 1) & (F.col("page_no") > 1)
    plan = plan.withColumn("cursor", F.when(odd, F.concat(F.lit("c"), F.col("page_no").cast("string"))))
    by_cursor = urls.request_bodies(plan, {"q": "all", "limit": 10}, "cursor").withColumnRenamed("body", "cursor_body")
    return urls.request_bodies(by_cursor, {"q": "all"}, "page").select("c_custkey", "page_no", "cursor_body", F.col("body").alias("page_body"))


def queries() -> dict[str, Query]:
    """All queries; each pins the session to UTC, which every timestamp rule relies on."""

    def pinned(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: pinned(fn) for name, fn in QUERIES.items()}
