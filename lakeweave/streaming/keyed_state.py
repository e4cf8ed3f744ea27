"""Streaming event log with keyed state: every source has its own clock, and what was seen lately is known without reading the log."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakeweave.session import child_names, or_none, path_exists, read_text, write_once

HORIZON_SECONDS = 7 * 24 * 3600
SLOTS = 64
HOUR = 3_600_000_000  # microseconds
IDS_AT_ONCE = 1_000_000  # remembered ids that a task holds before it writes them back
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SeenEvents(StatefulProcessor):
    """Ids of one slot of a source that are younger than the horizon, and the newest load time the slot has met.

    Rows above ``clock - horizon`` come out once, marked as not late. Rows below it (or without a load time) may have been
    forgotten: all come out, marked late, for the writer to look them up. The clock that decides is the one before
    the batch, so the order of its rows does not matter.

    The ids of an hour are one entry, read and written once by a batch that has rows of it: the store is another process, and asking it
    for every row takes far longer than all the rest.
    """

    def __init__(self, horizon_seconds: int):
        self.horizon = horizon_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen_by_hour", "hour long", "ids string")
        self.clock = handle.getValueState("clock", "at long")
        self.swept = handle.getValueState("swept", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = self.clock.get()[0] if self.clock.exists() else None
        mark = None if clock is None else clock - self.horizon
        newest = clock
        known: dict[int, set] = {}
        changed: set[int] = set()
        for part in rows:
            timed = part["at"].notna().to_numpy()
            at = part["at"].fillna(0).to_numpy().astype(np.int64)
            late = ~timed if mark is None else ~timed | (at < mark)
            keep = late.copy()
            hours = (at // HOUR).tolist()
            ids = part["event_id"].tolist()
            for i in np.flatnonzero(~late).tolist():
                hour = hours[i]
                if hour not in known:
                    known[hour] = self._ids_of(hour)
                if ids[i] not in known[hour]:
                    known[hour].add(ids[i])
                    changed.add(hour)
                    keep[i] = True
            if timed.any():
                top = int(at[timed].max())
                newest = top if newest is None else max(newest, top)
            if sum(map(len, known.values())) > IDS_AT_ONCE:
                self._remember(known, changed)
            yield part.assign(late=late)[keep].drop(columns=["at", "slot"])
        self._remember(known, changed)
        if newest is not None and newest != clock:
            self.clock.update((newest,))
            self._forget(newest - self.horizon)

    def _ids_of(self, hour: int) -> set:
        return set(json.loads(self.seen.getValue((hour,))[0])) if self.seen.containsKey((hour,)) else set()

    def _remember(self, known: dict[int, set], changed: set[int]) -> None:
        """Write changed hours back and let go of all."""
        for hour in changed:
            self.seen.updateValue((hour,), (json.dumps(list(known[hour])),))
        known.clear()
        changed.clear()

    def _forget(self, mark: int) -> None:
        """Remove the hours below the horizon. The state is gone over when the clock has moved by an eighth of the horizon, not at every batch."""
        if self.swept.exists() and mark - self.swept.get()[0] < self.horizon // 8:
            return
        self.swept.update((mark,))
        for (hour,) in [k for k in self.seen.keys() if (k[0] + 1) * HOUR <= mark]:
            self.seen.removeKey((hour,))

    def close(self) -> None:
        pass


def new_events(events: DataFrame, slots: int = SLOTS, horizon_seconds: int = HORIZON_SECONDS) -> DataFrame:
    """Streaming events with a ``late`` column; each id that the state remembers comes once.

    A source is spread over ``slots`` keys by the hash of the event id, so one with a third of all rows is many groups.
    A null source is a source. No watermark: one source's clock never drops another's rows.
    """
    schema = T.StructType([*events.schema.fields, T.StructField("late", T.BooleanType())])
    keyed = events.withColumns({"at": F.unix_micros("loaded_at"), "slot": F.pmod(F.xxhash64("event_id"), F.lit(slots))})
    return keyed.groupBy("source_name", "slot").transformWithStateInPandas(SeenEvents(horizon_seconds), schema, "Append", "None")


class KeyedEventLog:
    """The log as one folder per micro-batch. A batch that is repeated after a failure writes its own folder anew, so it adds nothing twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self, before: int | None = None) -> list[str]:
        numbers = [int(n.removeprefix("batch=")) for n in child_names(self.spark, self.path) if n.startswith("batch=")]
        folders = [f"{self.path}/batch={n}" for n in sorted(numbers) if before is None or n < before]
        return [f for f in folders if path_exists(self.spark, f"{f}/_SUCCESS")]

    def read(self, schema: T.StructType, before: int | None = None) -> DataFrame | None:
        """Events of the finished batches (of those ``before`` a number); None without any."""
        folders = self._folders(before)
        if not folders:
            return None
        return or_none(self.spark, self.path, lambda: self.spark.read.schema(schema).parquet(*folders))

    def write_batch(self, batch: DataFrame, number: int) -> None:
        """Store a micro-batch: its new events as they are, its late ones if neither the log nor the batch holds them.

        The stored days are searched for late rows only, and only their days; a batch without any reads nothing of the log.
        """
        batch = batch.persist()  # the state is updated once for a batch; the rows are read up to three times
        try:
            fresh, late = batch.where(~F.col("late")).drop("late"), batch.where("late").drop("late").dropDuplicates(["event_id"])
            days = [r[0] for r in late.select("event_date").distinct().collect()]  # calendar days of one batch
            out = fresh
            if days:
                late = late.join(fresh.select("event_id"), "event_id", "left_anti")
                stored = self.read(fresh.schema, before=number)
                if stored is not None:
                    known = [d for d in days if d is not None]
                    same_days = F.col("event_date").isin(known) | F.col("event_date").isNull() if known else F.col("event_date").isNull()
                    late = late.join(stored.where(same_days).select("event_id"), "event_id", "left_anti")
                out = fresh.unionByName(late)
            out.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        finally:
            batch.unpersist()


def start_keyed_log(
    events: DataFrame, path: str, checkpoint: str, slots: int = SLOTS, horizon_seconds: int = HORIZON_SECONDS
) -> StreamingQuery:
    """Add everything available now to the log, each id once, then stop; a restart continues from the checkpoint.

    State lives in the RocksDB store below the checkpoint and holds the ids of the last ``horizon_seconds`` of each source's
    own clock (and an eighth more). Older rows are still added once: they are compared with the stored days. The number
    of slots places ids in the state, so it is fixed when the log begins: another one is refused.
    """
    spark = events.sparkSession
    log, fixed = KeyedEventLog(spark, path), f"{path.rstrip('/')}__slots"
    if not path_exists(spark, fixed):
        write_once(spark, fixed, str(slots))
    elif int(read_text(spark, fixed)) != slots:
        raise ValueError(f"the log at {path} has {read_text(spark, fixed)} slots")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # a query takes the settings at its start
    try:
        writer = new_events(events, slots, horizon_seconds).writeStream.option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).foreachBatch(log.write_batch).start()
    finally:
        spark.conf.set(_PROVIDER, before)
