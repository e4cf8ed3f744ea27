"""Catalog tables on Parquet with append, overwrite and incremental loads."""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeweave.operators.history import sync_columns
from lakeweave.schemas import create_table_sql
from lakeweave.session import child_names, remove_folder


@dataclass(frozen=True)
class LoadResult:
    table_name: str
    schema: str
    rows_loaded: int
    rows_skipped: int
    mode: str
    duration_seconds: float
    success: bool


LOAD_LOG_SCHEMA = (
    "table_name string, schema string, rows_loaded bigint, rows_skipped bigint, mode string, "
    "duration_seconds double, success boolean"
)
LOAD_LOG = "load_log"


def stamp_loaded_at(df: DataFrame, as_of: datetime) -> DataFrame:
    """Keep an incoming ``loaded_at``; fill it with ``as_of`` where it is missing."""
    now = F.lit(as_of).cast("timestamp")
    stamped = F.coalesce(F.col("loaded_at").cast("timestamp"), now) if "loaded_at" in df.columns else now
    return df.withColumn("loaded_at", stamped)


class Warehouse:
    """Tables of one database, stored below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str = "main"):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.root}/{schema}'")

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def _new_folder(self, table: str) -> str:
        return f"{self.root}/{self.schema}/{table}/{uuid.uuid4().hex}"

    def table_exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._name(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    # --- loads ---

    def load(self, table: str, df: DataFrame, as_of: datetime, mode: str = "append", watermark: str = "loaded_at") -> LoadResult:
        """Load a frame and record the outcome in the load log."""
        start = time.monotonic()
        df = stamp_loaded_at(df, as_of)
        if mode == "overwrite":
            loaded, skipped = self._overwrite(table, df)
        elif mode == "incremental":
            loaded, skipped = self._incremental(table, df, watermark)
        elif mode == "append":
            loaded, skipped = self._append(table, df)
        else:
            raise ValueError(f"unknown load mode {mode!r}")
        result = LoadResult(table, self.schema, loaded, skipped, mode, time.monotonic() - start, True)
        self.append_rows(LOAD_LOG, self.spark.createDataFrame([tuple(asdict(result).values())], LOAD_LOG_SCHEMA))
        return result

    def append_rows(self, table: str, df: DataFrame) -> None:
        """Append without load bookkeeping, for the pipeline's own records."""
        self._insert(table, df)

    def replace(self, table: str, df: DataFrame) -> int:
        """Store a relation as a table, replacing its content; returns its rows."""
        return self._overwrite(table, df)[0]

    def load_parquet(self, table: str, path: str, as_of: datetime, mode: str = "append") -> LoadResult:
        return self.load(table, self.spark.read.parquet(path), as_of, mode)

    def _create(self, table: str, df: DataFrame, location: str | None = None) -> None:
        if not self.table_exists(table):
            self.spark.sql(create_table_sql(self._name(table), df.schema, location or self._new_folder(table)))

    def _insert(self, table: str, df: DataFrame) -> int:
        """Insert by column name; the row count is observed during the write, not by a second pass."""
        self._create(table, df)
        seen = Observation(f"insert_{uuid.uuid4().hex}")
        target = self.table(table)
        missing = set(df.columns) - set(target.columns)
        if missing:
            raise ValueError(f"table {table} has no columns {sorted(missing)}; load it in overwrite mode")
        aligned = sync_columns(df, target.dtypes).observe(seen, F.count(F.lit(1)).alias("n"))
        aligned.write.insertInto(self._name(table))
        return seen.get["n"]

    def _append(self, table: str, df: DataFrame) -> tuple[int, int]:
        return self._insert(table, df), 0

    def _overwrite(self, table: str, df: DataFrame) -> tuple[int, int]:
        """Write a new folder first, then point the table at it: the source may be the table itself,
        and a failed load leaves the old content in place.

        With unchanged columns the table only changes its location, so there is always a table to read. The folder
        that it leaves stays for readers that have begun, until the next overwrite.
        """
        seen = Observation(f"overwrite_{uuid.uuid4().hex}")
        folder = self._new_folder(table)
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        before = self._location(table) if self.table_exists(table) else None
        if before and self.table(table).dtypes == df.dtypes:
            self.spark.sql(f"ALTER TABLE {self._name(table)} SET LOCATION '{folder}'")
            self.spark.catalog.refreshTable(self._name(table))
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")
            self._create(table, df, folder)
        root = folder.rsplit("/", 1)[0]
        for name in child_names(self.spark, root):
            if name not in (folder.rsplit("/", 1)[1], (before or "").rstrip("/").rsplit("/", 1)[-1]):
                remove_folder(self.spark, f"{root}/{name}")
        return seen.get["n"], 0

    def _location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._name(table)}")
        return described.where("col_name = 'Location'").first().data_type

    def _incremental(self, table: str, df: DataFrame, watermark: str) -> tuple[int, int]:
        """Insert rows above the table's newest watermark; everything when the table is empty.

        The comparison reaches the scan of the source, so files below the mark are not read. The rows left out are
        counted from the watermark column alone.
        """
        if not self.table_exists(table):
            return self._append(table, df)
        mark = self.table(table).agg(F.max(watermark)).first()[0]
        if mark is None:
            return self._append(table, df)
        newer = F.col(watermark) > F.lit(mark)
        loaded = self._insert(table, df.where(newer))
        return loaded, df.where(~F.coalesce(newer, F.lit(False))).count()

    # --- metadata ---

    def query(self, sql: str, **args) -> DataFrame:
        return self.spark.sql(sql, args=args or None)

    def load_log(self) -> DataFrame:
        return self.table(LOAD_LOG)

    def columns(self, table: str) -> DataFrame:
        """(ordinal, name, type) of a table."""
        fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(self.table(table).schema)]
        return self.spark.createDataFrame(fields, "ordinal int, name string, type string")

    def table_info(self, table: str) -> dict | None:
        """Name, schema, row count and columns; None when there is no such table."""
        if not self.table_exists(table):
            return None
        columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in self.table(table).schema]
        return {"name": table, "schema": self.schema, "row_count": self.table(table).count(), "columns": columns}

    def list_tables(self) -> list[dict]:
        names = sorted(t.name for t in self.spark.catalog.listTables(self.schema) if t.tableType != "TEMPORARY")
        return [self.table_info(name) for name in names]

    def catalog_info(self) -> DataFrame:
        """One row per table and column with the table's row count."""
        rows = [
            (t["name"], i, c["name"], c["type"], t["row_count"])
            for t in self.list_tables()
            for i, c in enumerate(t["columns"])
        ]
        return self.spark.createDataFrame(
            rows, "table_name string, ordinal int, column_name string, data_type string, row_count bigint"
        )


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Expose a Parquet path to SQL without loading it."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)
