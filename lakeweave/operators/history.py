"""Incremental event log and type-2 history on plain Parquet."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.keys import surrogate_key
from lakeweave.operators.lake import latest_per_key
from lakeweave.session import child_names, materialized, or_none, path_exists, read_text, remove_folder, replace_folder, write_once

EVENT_COLUMNS = ["content_id", "source_name", "natural_key", "title", "score", "created_at", "loaded_at"]


# --- incremental event log ---------------------------------------------------------------------


def content_events(unified: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Event rows of the unified content; the id covers the item and its load time. ``columns`` replaces the usual ones."""
    return unified.select(
        surrogate_key(F.col("content_id"), F.col("loaded_at")).alias("event_id"),
        *(columns or EVENT_COLUMNS),
        F.to_date("loaded_at").alias("event_date"),
    )


def newer_than(incoming: DataFrame, target: DataFrame, watermark: str = "loaded_at") -> DataFrame:
    """Incoming rows above the target's high-water mark (a timestamp); all stamped rows when the target is empty.

    The mark is a scalar subquery that is never NULL, so Spark evaluates it once and can push the
    plain comparison into the scan.
    """
    start = F.lit("0001-01-01").cast("timestamp")
    mark = target.agg(F.coalesce(F.max(watermark), start).alias("mark")).scalar()
    return incoming.where(F.col(watermark) > mark)


def content_events_increment(unified: DataFrame, target: DataFrame | None, columns: list[str] | None = None) -> DataFrame:
    """Events to add to ``target``; with no target (first run or full refresh) the whole history."""
    source = unified if target is None else newer_than(unified, target)
    return content_events(source, columns)


def upsert_by_key(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target after replacing the rows whose key appears in ``incoming`` (one row per key) and adding the rest."""
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def sync_columns(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Project to exactly ``columns`` (name, type): new ones become NULL, dropped ones disappear."""
    have = set(df.columns)
    return df.select(
        *[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in columns]
    )


class EventLog:
    """The event log as a Parquet folder partitioned by ``event_date``.

    Its columns are those of the last write, kept beside the data, so no file footer is opened to learn them: a column
    that a later run adds is NULL in older rows, one that it drops is gone from the log.

    Corrected days are staged as a whole, then announced by one small file, then moved in day by day. Once announced they count: until all are in place, readers take
    them from the staging folder, and the next writer finishes the work of one that stopped.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def columns(self) -> T.StructType | None:
        """The columns of the log; None when there is no log."""
        stored = or_none(self.spark, f"{self.path}/_columns", lambda: self.spark.read.text(f"{self.path}/_columns", wholetext=True))
        return None if stored is None else T.StructType.fromJson(json.loads(stored.first()[0]))

    def read(self) -> DataFrame | None:
        columns, announced = self.columns(), self._announced()
        if columns is None:
            return None
        log = self.spark.read.schema(columns).parquet(self.path)
        if announced is None:
            return log
        staged = sync_columns(self._staged(announced), columns_of(columns))
        return log.where(~_on_days(announced["days"])).unionByName(staged)

    def _announced(self) -> dict | None:
        """Corrected days that are complete but perhaps not all in place."""
        path = f"{self.path}__announced.json"
        return json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else None

    def _staged(self, announced: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(announced["columns"])).parquet(announced["folder"])

    def finish(self) -> None:
        """Move announced days in; doing it twice changes nothing. Every writer does so first."""
        announced = self._announced()
        if announced is not None:
            self._write(self._staged(announced), "overwrite", "dynamic")
            remove_folder(self.spark, f"{self.path}__announced.json")
            remove_folder(self.spark, announced["folder"])

    def _write(self, events: DataFrame, mode: str, partitions: str = "static", path: str | None = None) -> None:
        """Write by day. Rebalancing gathers a day's rows into few files and splits a crowded day over tasks."""
        path = path or self.path
        writer = events.hint("rebalance", F.col("event_date")).write.mode(mode).partitionBy("event_date")
        writer.option("partitionOverwriteMode", partitions).parquet(path)
        described = self.spark.createDataFrame([(events.schema.json(),)], "value string")
        described.coalesce(1).write.mode("overwrite").text(f"{path}/_columns")

    def _replace(self, events: DataFrame) -> None:
        """A new folder first, then the swap: a failed write leaves the log as it was."""
        new = f"{self.path}__new-{uuid.uuid4().hex[:12]}"
        self._write(events, "error", path=new)
        replace_folder(self.spark, new, self.path)

    def newest_day(self) -> DataFrame | None:
        """The newest partition, which holds the high-water mark: the day is the date of the load time. The listing names it."""
        days = [n.removeprefix("event_date=") for n in child_names(self.spark, self.path) if n.startswith("event_date=")]
        days = [d for d in days if d != "__HIVE_DEFAULT_PARTITION__"]
        stored = self.read()
        if stored is None or not days:
            return None
        return stored.where(F.col("event_date") == F.lit(max(days)).cast("date"))

    def run(self, unified: DataFrame, full_refresh: bool = False, columns: list[str] | None = None) -> DataFrame:
        """Append the events above the high-water mark (or rebuild) and return the log as it is afterwards.

        An event id covers the load time, so an id above the mark cannot be stored yet: appending is
        the upsert, and a repeated run appends nothing. ``columns`` is the model's column list of this run.
        """
        self.finish()
        newest = None if full_refresh else self.newest_day()
        events = content_events_increment(unified, newest, columns)
        if newest is None:
            self._replace(events)
        else:
            self._write(events, "append")
        return self.read()

    def add(self, events: DataFrame) -> None:
        """Append the events whose id the log does not hold, whatever their load time; each id once.

        An id covers the load time, so only the days of the given events are searched. Repeating a batch adds nothing.
        """
        self.finish()
        events = materialized(events.dropDuplicates(["event_id"]))
        stored = self.read()
        if stored is None:
            self._replace(events)
            return
        days = [r[0] for r in events.select("event_date").distinct().collect()]  # calendar days of one batch
        same_days = stored.where(F.col("event_date").isin(days) | F.col("event_date").isNull())
        self._write(events.join(same_days.select("event_id"), "event_id", "left_anti").select(*events.columns), "append")

    def upsert(self, events: DataFrame) -> DataFrame:
        """Replace stored events by corrected ones of the same id and add the rest.

        Only the days of the given events are rewritten, all of them or, if the writer stops before they are announced, none.
        """
        self.finish()
        stored = self.read()
        if stored is None:
            self._replace(events)
            return self.read()
        days = [r[0] for r in events.select("event_date").distinct().collect()]  # calendar days of one batch
        touched = sync_columns(stored.where(_on_days(days)), events.dtypes)
        staging = f"{self.path}__staging-{uuid.uuid4().hex[:12]}"
        upsert_by_key(touched, events, "event_id").write.parquet(staging)
        known = {"folder": staging, "days": [None if d is None else str(d) for d in days], "columns": events.schema.jsonValue()}
        write_once(self.spark, f"{self.path}__announced.json", json.dumps(known))
        self.finish()
        return self.read()


def columns_of(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _on_days(days: list) -> Column:
    """Rows of some calendar days; None stands for rows without one."""
    known = [F.lit(str(d)).cast("date") for d in days if d is not None]
    some = F.coalesce(F.col("event_date").isin(known), F.lit(False)) if known else F.lit(False)
    return some | F.col("event_date").isNull() if None in days else some


# --- type-2 history ----------------------------------------------------------------------------

STEAM_TRACKED = ["app_id", "name", "price", "rating", "developer", "genres", "loaded_at"]
REDDIT_TRACKED = ["id", "title", "author", "subreddit", "score", "num_comments", "url", "created_at", "loaded_at"]


def _slot(updated_at: str, slot_seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(updated_at)) / F.lit(slot_seconds * 1_000_000))


def with_next_value(df: DataFrame, key: str, updated_at: str, name: str, slot_seconds: int = 3600) -> DataFrame:
    """``lead(updated_at)`` per key, computed inside (key, hour) and stitched across hours.

    A key that holds a third of all rows is spread over its hours. Only the last row of each
    (key, hour) enters the per-key window that links an hour to the next one in use; both
    branches read the same shuffled rows.
    """
    group = Window.partitionBy(key, "__slot")
    windowed = df.withColumn("__slot", _slot(updated_at, slot_seconds)).withColumns(
        {
            name: F.lead(updated_at).over(group.orderBy(updated_at)),
            "__slot_first": F.min(updated_at).over(group),
        }
    )
    inner = windowed.where(F.col(name).isNotNull())
    edges = windowed.where(F.col(name).isNull())
    linked = edges.withColumn(name, F.lead("__slot_first").over(Window.partitionBy(key).orderBy("__slot")))
    return inner.unionByName(linked).drop("__slot", "__slot_first")


def _with_scd_columns(df: DataFrame, key: str, updated_at: str) -> DataFrame:
    return df.select(
        surrogate_key(F.col(key), F.col(updated_at)).alias("dbt_scd_id"),
        *[c for c in df.columns if c != "dbt_valid_to"],
        F.col(updated_at).alias("dbt_updated_at"),
        F.col(updated_at).alias("dbt_valid_from"),
        "dbt_valid_to",
        F.col("dbt_valid_to").isNull().alias("dbt_is_current"),
    )


def one_row_per_version(df: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Collapse repeated loads of the same key and time. Partial aggregation handles hot keys."""
    rest = [c for c in df.columns if c not in (key, updated_at)]
    if not rest:
        return df.dropDuplicates([key, updated_at])
    picked = df.groupBy(key, updated_at).agg(F.max(F.struct(*rest)).alias("__row"))
    return picked.select(*[F.col(c) if c in (key, updated_at) else F.col(f"__row.{c}").alias(c) for c in df.columns])


def scd2_from_history(
    history: DataFrame, key: str, updated_at: str = "loaded_at", check_cols: list[str] | None = None
) -> DataFrame:
    """Validity ranges from all loads of a source.

    Timestamp strategy by default: every newer load opens a version. With ``check_cols`` a load
    whose tracked values equal those of the version before it opens none.
    """
    rows = one_row_per_version(history.where(F.col(key).isNotNull()), key, updated_at)
    if check_cols:
        rows = _changed_only(rows, key, updated_at, check_cols)
    return _with_scd_columns(with_next_value(rows, key, updated_at, "dbt_valid_to"), key, updated_at)


def _changed_only(rows: DataFrame, key: str, updated_at: str, check_cols: list[str], slot_seconds: int = 3600) -> DataFrame:
    """Rows whose tracked values differ from the key's previous row, with the same (key, hour) split."""
    state = F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in check_cols]))
    group = Window.partitionBy(key, "__slot")
    windowed = rows.withColumn("__state", state).withColumn("__slot", _slot(updated_at, slot_seconds)).withColumns(
        {
            "__before": F.lag("__state").over(group.orderBy(updated_at)),
            "__slot_last": F.max_by("__state", updated_at).over(group),
        }
    )
    inner = windowed.where(F.col("__before").isNotNull())
    edges = windowed.where(F.col("__before").isNull())
    linked = edges.withColumn("__before", F.lag("__slot_last").over(Window.partitionBy(key).orderBy("__slot")))
    changed = ~F.col("__state").eqNullSafe(F.col("__before"))
    return inner.unionByName(linked).where(changed).select(*rows.columns)


def scd2_apply(snapshot: DataFrame, batch: DataFrame, key: str, updated_at: str = "loaded_at") -> DataFrame:
    """Snapshot after one load: close the open version of each newer key and open a new one.

    A load counts with its newest row per key. Keys absent from it keep their open version; rows not
    newer than the open version change nothing. Closed versions pass through without a shuffle; open ones are unique per key, so the
    join has no hot key however long a key's history is.
    """
    columns = snapshot.columns
    batch = latest_per_key(batch, key, updated_at)
    closed = snapshot.where(F.col("dbt_valid_to").isNotNull())
    old = snapshot.where(F.col("dbt_valid_to").isNull()).select(F.col(key).alias("__key"), F.struct(*columns).alias("o"))
    fresh = batch.where(F.col(key).isNotNull()).withColumn("dbt_valid_to", F.lit(None).cast("timestamp"))
    fresh = _with_scd_columns(fresh, key, updated_at)
    new = fresh.select(F.col(key).alias("__key"), F.struct(*[fresh[c] for c in columns]).alias("n"))
    both = old.join(new, "__key", "full_outer")
    opens = F.col("n").isNotNull() & (
        F.col("o").isNull() | (F.col("n")["dbt_valid_from"] > F.col("o")["dbt_valid_from"])
    )
    closing = opens & F.col("o").isNotNull()
    kept = (
        F.col("o")
        .withField("dbt_valid_to", F.when(closing, F.col("n")["dbt_valid_from"]))
        .withField("dbt_is_current", ~closing)
    )
    versions = F.array_compact(F.array(F.when(F.col("o").isNotNull(), kept), F.when(opens, F.col("n"))))
    current = both.select(F.explode(versions).alias("v")).select("v.*")
    return closed.unionByName(current)


def scd2_as_of(snapshot: DataFrame, at: Column) -> DataFrame:
    """The version of every key that was valid at a point in time."""
    return snapshot.where(
        (F.col("dbt_valid_from") <= at) & (F.col("dbt_valid_to").isNull() | (at < F.col("dbt_valid_to")))
    )


HISTORY_BUCKETS = 64
HISTORY_COMMIT = "load string, folder string, buckets array<int>, merged string, columns string"
CLOSED_FOLDERS = 16  # so many folders of closed versions are merged to one


class HistoryTable:
    """A stored type-2 history. Names of loads sort in load order.

    ``closed/<folder>`` holds the versions that a load closed, ``open/<folder>/bucket=<n>`` the open versions of the key buckets that it
    touched; the newest load of a bucket holds its current ones. ``commits`` has one row per load, written last: what is not named there does
    not count, so a load that dies half-way changes nothing. Every version knows the load that opened it, so any earlier
    state can be read without keeping earlier open sets: those are removed once two newer loads no longer need them. A new load opens
    no closed file. From time to time one merges the closed folders of the loads before it (``merged`` in its commit). The columns are kept in the commits, so
    no footer is opened to learn them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, updated_at: str = "loaded_at"):
        self.spark, self.path, self.key, self.updated_at = spark, path.rstrip("/"), key, updated_at

    def _commits(self) -> list:
        """One row per load; a repeated load counts as last written."""
        folder = f"{self.path}/commits"
        found = or_none(self.spark, folder, lambda: self.spark.read.schema(HISTORY_COMMIT).option("recursiveFileLookup", True).parquet(folder))
        return [] if found is None else sorted(found.collect(), key=lambda r: r.load)

    def loads(self) -> list[str]:
        return [r.load for r in self._commits()]

    @staticmethod
    def _open_folders(commits: list) -> dict[int, str]:
        return {bucket: r.folder for r in commits for bucket in r.buckets}

    def _parts(self, paths: list[str], commits: list) -> DataFrame | None:
        columns = [r.columns for r in commits if r.columns]
        if not paths:
            return None
        return self.spark.read.option("recursiveFileLookup", True).schema(T.StructType.fromJson(json.loads(columns[-1]))).parquet(*paths)

    def _closed_folders(self, commits: list) -> list[str]:
        """The newest merged folder and those of the loads since then."""
        start = max((i for i, r in enumerate(commits) if r.merged), default=0)
        merged = [commits[start].merged] if commits and commits[start].merged else []
        return merged + [r.folder for r in commits[start:]]

    def _open(self, commits: list, buckets: list[int] | None = None) -> DataFrame | None:
        """Open versions (of some buckets). Which buckets a folder has comes from its listing."""
        held, there = self._open_folders(commits), {}
        paths = []
        for bucket, folder in sorted(held.items()):
            if buckets is None or bucket in buckets:
                if folder not in there:
                    there[folder] = set(child_names(self.spark, f"{self.path}/open/{folder}"))
                if f"bucket={bucket}" in there[folder]:
                    paths.append(f"{self.path}/open/{folder}/bucket={bucket}")
        return self._parts(paths, commits)

    def _versions(self, commits: list, before: str | None, buckets: list[int] | None = None) -> DataFrame | None:
        """All versions with the load that opened them, as they were before a load."""
        closed = self._parts([f"{self.path}/closed/{f}" for f in self._closed_folders(commits)], commits)
        current = self._open(commits, buckets)
        if closed is None or current is None:
            return closed if current is None else current
        if buckets is not None:
            closed = closed.where(self._bucket().isin(buckets))
        if before is None:
            return current.unionByName(closed, allowMissingColumns=True)
        reopened = F.col("__closed_by") >= before
        everything = current.unionByName(closed, allowMissingColumns=True).where(F.col("__opened_by") < before)
        return everything.withColumns(
            {
                "dbt_valid_to": F.when(~F.coalesce(reopened, F.lit(False)), F.col("dbt_valid_to")),
                "dbt_is_current": F.coalesce(reopened, F.lit(False)) | F.col("dbt_is_current"),
            }
        )

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(HISTORY_BUCKETS)).cast("int")

    def read(self, before: str | None = None) -> DataFrame | None:
        """The history, or its state before a load."""
        commits = self._commits()
        if not [r for r in commits if before is None or r.load < before]:
            return None
        found = self._versions(commits, before)
        return None if found is None else found.drop("__opened_by", "__closed_by")

    def apply(self, batch: DataFrame, load: str) -> DataFrame:
        """Add a load under ``load`` and return the history. Repeating the newest load replaces it.

        A load that does not sort last is refused: the later ones were built without it. Only the open
        versions of the touched key buckets are read and written.
        """
        commits = self._commits()
        if commits and load < commits[-1].load:
            raise ValueError(f"load {load!r} comes before the stored load {commits[-1].load!r}; loads are added in order")
        batch = batch.where(F.col(self.key).isNotNull())
        repeated = commits and load == commits[-1].load
        touched = {r[0] for r in batch.select(self._bucket()).distinct().collect()}
        touched |= set(commits[-1].buckets) if repeated else set()
        # Only a repeated load reopens what it had closed; a new one needs the open versions alone.
        before = self._versions(commits, load, sorted(touched)) if repeated else self._open(commits, sorted(touched)) if commits else None
        mark = {"__opened_by": F.lit(load), "__closed_by": F.lit(None).cast("string")}
        if before is None:
            after = scd2_from_history(latest_per_key(batch, self.key, self.updated_at), self.key, self.updated_at).withColumns(mark)
        else:
            opened = before.where(F.col("dbt_is_current"))
            known = opened.select(F.col("dbt_scd_id").alias("__id"), F.col("__opened_by"))
            after = scd2_apply(opened.drop("__opened_by", "__closed_by"), batch, self.key, self.updated_at)
            after = after.join(known, F.col("dbt_scd_id") == F.col("__id"), "left").drop("__id").withColumn("__opened_by", F.coalesce("__opened_by", F.lit(load)))
            after = after.withColumn("__closed_by", F.when(~F.col("dbt_is_current"), F.lit(load)))
        after = materialized(after)
        folder = f"at-{load}-{uuid.uuid4().hex[:8]}"
        after.where(~F.col("dbt_is_current")).write.parquet(f"{self.path}/closed/{folder}")
        rows = after.where(F.col("dbt_is_current")).withColumn("bucket", self._bucket()).hint("rebalance", F.col("bucket"))
        rows.write.partitionBy("bucket").parquet(f"{self.path}/open/{folder}")
        earlier = [r for r in commits if r.load < load]
        columns = rows.drop("bucket").schema
        known = T.StructType.fromJson(json.loads(earlier[-1].columns)) if earlier else columns
        columns = T.StructType([*columns, *[f for f in known if f.name not in columns.names]])
        commit = self.spark.createDataFrame([(load, folder, sorted(touched), self._merge_closed(earlier), columns.json())], HISTORY_COMMIT)
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/at-{load}")
        self._tidy()
        return self.read()

    def _merge_closed(self, commits: list) -> str | None:
        """Closed versions of all loads so far in one folder, if they lie in many. The folders stay, for readers that have begun."""
        folders = self._closed_folders(commits)
        if len(folders) <= CLOSED_FOLDERS:
            return None
        name = f"upto-{commits[-1].load}-{uuid.uuid4().hex[:8]}"
        self._parts([f"{self.path}/closed/{f}" for f in folders], commits).coalesce(max(1, len(folders) // 4)).write.parquet(f"{self.path}/closed/{name}")
        return name

    def _tidy(self) -> None:
        """Remove open buckets that neither the state after the newest load nor the one before it needs."""
        commits = self._commits()
        needed = {(f, b) for some in (commits, commits[:-1]) for b, f in self._open_folders(some).items()}
        for r in commits:
            for bucket in r.buckets:
                path = f"{self.path}/open/{r.folder}/bucket={bucket}"
                if (r.folder, bucket) not in needed and path_exists(self.spark, path):
                    remove_folder(self.spark, path)
