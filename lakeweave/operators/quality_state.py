"""Data tests whose state is stored version by version, so that a run reads new versions only."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import asdict
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.operators.quality import DECLARED_TESTS, TableTests
from lakeweave.session import child_names, read_text, remove_folder, write_once

STATE_SCHEMA = "test_no int, parent boolean, h1 bigint, h2 bigint, at timestamp, n bigint"


class QualityState:
    """Mergeable state of the declared tests below ``path``, one folder per version until they are merged.

    A version is an increment of the tested relations: rows that are added and never changed. Its state has a count for each row test, the timestamps that
    lie ahead, and for uniqueness and references the number of rows per value, the value as a 128-bit hash, sorted. States add up: duplicates across versions and
    references to parents of other versions come out as if all rows were read at once. Other declarations have a state of their own,
    because versions have to be read again for them. Numbered commits name the folders that count and the versions they hold, so a run that dies leaves the
    state as it was.
    """

    def __init__(self, spark: SparkSession, path: str, declared: dict[str, TableTests] | None = None):
        self.spark, self.declared = spark, DECLARED_TESTS if declared is None else declared
        described = repr(sorted((name, sorted(asdict(t).items())) for name, t in self.declared.items()))
        self.path = f"{path.rstrip('/')}/{hashlib.sha256(described.encode()).hexdigest()[:12]}"
        self.tests = self._numbered()

    def _numbered(self) -> list[tuple[str, str, str]]:
        """(relation, test, column) of every test; the position is its number."""
        tests = []
        for name, t in self.declared.items():
            for test, columns in (
                ("unique", t.unique), ("not_null", t.not_null), ("accepted_values", t.accepted), ("not_future_date", t.not_future), ("positive_score", t.positive),
                ("relationships", t.references),
            ):
                tests += [(name, test, c) for c in columns]
        if {"fct_content", "dim_sources"} <= set(self.declared):
            tests.append(("fct_content", "no_orphans", "source_name"))
        if "incr_content_events" in self.declared:
            tests.append(("incr_content_events", "event_unique", "event_id"))
        return tests

    def _newest(self) -> dict:
        numbers = [int(n[:-5]) for n in child_names(self.spark, f"{self.path}/commits") if re.fullmatch(r"\d+\.json", n)]
        if not numbers:
            return {"seq": 0, "folders": [], "versions": []}
        return json.loads(read_text(self.spark, f"{self.path}/commits/{max(numbers):09d}.json"))

    def _commit(self, seq: int, folders: list[str], versions: list[str]) -> None:
        write_once(self.spark, f"{self.path}/commits/{seq:09d}.json", json.dumps({"seq": seq, "folders": folders, "versions": versions}))

    def versions(self) -> list[str]:
        """Versions that the state holds."""
        return self._newest()["versions"]

    def add(self, version: str, relations: dict[str, DataFrame], as_of: datetime) -> bool:
        """Test the rows of one version, in one pass per relation, and store the outcome. A version that is held already is not read again."""
        now = self._newest()
        if version in now["versions"]:
            return False
        limit = F.lit(as_of).cast("timestamp") + F.expr("interval 1 hour")
        entries = self.spark.createDataFrame([], STATE_SCHEMA).drop("n")
        for name, df in relations.items():
            found = self._entries(name, limit)
            if found:
                entries = entries.unionByName(df.select(F.explode(F.array(*found)).alias("e")).where(F.col("e").isNotNull()).select("e.*"))
        folder = self._write(entries.withColumn("n", F.lit(1).cast("bigint")))
        self._commit(now["seq"] + 1, [*now["folders"], folder], [*now["versions"], version])
        return True

    def _write(self, rows: DataFrame) -> str:
        folder = f"state-{uuid.uuid4().hex[:12]}"
        summed = rows.groupBy("test_no", "parent", "h1", "h2", "at").agg(F.sum("n").alias("n"))
        summed.sortWithinPartitions("test_no", "h1", "h2").write.parquet(f"{self.path}/{folder}")
        return folder

    def _entries(self, name: str, limit: Column) -> list[Column]:
        """What a row of a relation adds to the state, one expression per test that the relation takes part in."""
        found = []
        for no, (relation, test, column) in enumerate(self.tests):
            if test in ("relationships", "no_orphans"):
                parent, key = ("dim_sources", "source_name") if test == "no_orphans" else self.declared[relation].references[column]
                if name == parent:
                    found.append(F.when(F.col(key).isNotNull(), _entry(no, True, F.col(key))))
            if relation != name:
                continue
            c, tests = F.col(column), self.declared[name]
            if test in ("unique", "relationships"):
                found.append(F.when(c.isNotNull(), _entry(no, False, c)))
            elif test in ("event_unique", "no_orphans"):
                found.append(_entry(no, False, c))
            elif test == "not_null":
                found.append(F.when(c.isNull(), _entry(no)))
            elif test == "accepted_values":
                found.append(F.when(~c.isin(tests.accepted[column]), _entry(no)))
            elif test == "not_future_date":
                found.append(F.when(c > limit, _entry(no, at=c)))
            else:
                found.append(F.when(c < 0, _entry(no)))
        return found

    def _stored(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(STATE_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], STATE_SCHEMA)

    def results(self, as_of: datetime) -> DataFrame:
        """Failures of every test over all versions: ``(relation, test, column_name, failures)``. Reads states, no relation.

        ``as_of`` may be later than those of the versions, not earlier: timestamps are kept that lay ahead when their version came.
        """
        limit = F.lit(as_of).cast("timestamp") + F.expr("interval 1 hour")
        child = F.coalesce(F.sum(F.when(~F.col("parent"), F.col("n"))), F.lit(0)).alias("n")
        kinds = {test: [no for no, t in enumerate(self.tests) if t[1] == test] for test in {t[1] for t in self.tests}}
        is_one = lambda *tests: F.col("test_no").isin([no for t in tests for no in kinds.get(t, [])])
        folders, paired = self._newest()["folders"], is_one("relationships", "no_orphans")
        stored = self._stored(folders)
        # A folder holds a value of a test once: a single one has only values and their parents to bring together.
        alone = stored.where(~paired) if len(folders) == 1 else stored.limit(0)
        several = stored.where(paired) if len(folders) == 1 else stored
        values = several.groupBy("test_no", "h1", "h2", "at").agg(child, F.max("parent").alias("known")).select("test_no", "at", "n", "known")
        values = values.unionByName(alone.select("test_no", "at", "n", F.lit(False).alias("known")))
        failing = (
            F.when(is_one("unique", "event_unique"), (F.col("n") > 1).cast("bigint"))
            .when(is_one("relationships", "no_orphans"), F.when(F.col("known"), 0).otherwise(F.col("n")))
            .when(is_one("not_future_date"), F.when(F.col("at") > limit, F.col("n")).otherwise(0))
            .otherwise(F.col("n"))
        )
        failures = values.groupBy("test_no").agg(F.sum(failing).alias("failures"))
        tests = self.spark.createDataFrame([(no, *t) for no, t in enumerate(self.tests)], "test_no int, relation string, test string, column_name string")
        return tests.join(failures, "test_no", "left").select("relation", "test", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))

    def compact(self) -> None:
        """Merge the folders of all versions to one, for when there are many."""
        now = self._newest()
        if len(now["folders"]) > 1:
            self._commit(now["seq"] + 1, [self._write(self._stored(now["folders"]))], now["versions"])
            for folder in now["folders"]:
                remove_folder(self.spark, f"{self.path}/{folder}")


def _entry(no: int, parent: bool = False, value: Column | None = None, at: Column | None = None) -> Column:
    """One entry of a test; a value travels as two independent 64-bit hashes of its text."""
    text = None if value is None else value.cast("string")
    none = F.lit(None).cast("bigint")
    return F.struct(
        F.lit(no).alias("test_no"), F.lit(parent).alias("parent"), (none if text is None else F.xxhash64(text)).alias("h1"),
        (none if text is None else F.xxhash64(F.lit("second"), text)).alias("h2"), (F.lit(None) if at is None else at).cast("timestamp").alias("at"),
    )
