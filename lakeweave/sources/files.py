"""File readers and converters: Parquet, CSV, log lines, record files."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.operators.lake import Lake
from lakeweave.session import file_size, materialized, or_none, path_exists
from lakeweave.sources.csv_ranges import RangedCsv, splittable

CORRUPT = "_corrupt_record"
JOBS_AT_ONCE = 8


def parquet_load(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet file or folder; FileNotFoundError when it does not exist."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def parquet_load_dir(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame | None:
    """All matching files below a folder, columns united; None when there are none."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return or_none(spark, path, lambda: reader.option("mergeSchema", True).parquet(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, encoding: str = "UTF-8", rejects: bool = False) -> DataFrame:
    """CSV with a header. Types are inferred unless given; undecodable bytes become U+FFFD.

    Quoted values may hold line ends and doubled quotes. A file larger than one read partition is read by many tasks (``csv_ranges``: its records are
    stored in the shared folder first), others by one. Records that do not fit a given schema, or with ``rejects`` the
    inferred one, keep their text in ``_corrupt_record`` (see ``split_corrupt``).
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    if _is_large(spark, path) and splittable(spark, path, encoding):
        ranged = RangedCsv(spark, path, encoding)
        reader, path = reader.option("lineSep", ranged.store()), ranged.folder
    else:
        reader = reader.option("multiLine", True).option("encoding", encoding)
    if not schema:
        inferred = reader.option("inferSchema", True).csv(path)
        if not rejects:
            return inferred
        schema = inferred.schema
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(full).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def _is_large(spark: SparkSession, path: str) -> bool:
    """Whether a file would be more than one task's share of a splittable format."""
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return (file_size(spark, path) or 0) > limit


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(records that fit, texts of those that do not); without a corrupt-record column everything fits."""
    if CORRUPT not in df.columns:
        return df, None
    df = materialized(df)  # the column can only be judged once all others are parsed
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def csv_to_parquet(
    spark: SparkSession, path: str, dest: str | None = None, schema: T.StructType | None = None, encoding: str = "UTF-8"
) -> str:
    """Convert one CSV file (or folder of equal files) and return the Parquet folder.

    Records that do not fit the schema, given or inferred, go to ``<dest>.rejects``.
    """
    dest = dest or path.removesuffix(".csv") + ".parquet"
    _convert_csv(spark, path, dest, schema, encoding)
    return dest


def _convert_csv(spark: SparkSession, path: str, dest: str, schema: T.StructType | None, encoding: str) -> tuple[int, int]:
    """Rows and rejects written."""
    good, bad = split_corrupt(read_csv(spark, path, schema, encoding, rejects=True))
    rows, left = Observation(), Observation()
    good.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(dest)
    if bad.isEmpty():
        return rows.get["n"], 0
    bad.observe(left, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{dest}.rejects")
    return rows.get["n"], left.get["n"]


def list_files(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the matching files below a folder (a listing, no content)."""
    if not path_exists(spark, path):
        return []
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return sorted(row.path for row in found.load(path).select("path").collect())


STATUS_SCHEMA = "path string, output_path string, rows bigint, rejected bigint, success boolean, error string"


def relative_name(path: str, root: str) -> str:
    """Path of a listed file below the folder that was listed."""
    plain = [re.sub(r"^[a-z0-9]+:/+", "/", p).rstrip("/") for p in (path, root)]
    return plain[0].removeprefix(plain[1]).lstrip("/") or plain[0].rsplit("/", 1)[-1]


def _side_by_side(work: Callable, items: list) -> list:
    """Small jobs of one driver, several at a time: the files of a folder may each have columns of their own."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return list(pool.map(work, items))


def csv_dir_to_parquet(spark: SparkSession, path: str, dest: str, schema: T.StructType | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Convert every CSV below a folder under its relative name; a bad file leaves a failed status row.

    Each file has columns and types of its own, or all have the given schema. Records that do not fit go to ``<output_path>.rejects``.
    """

    def convert(source: str) -> tuple:
        try:
            out = f"{dest}/{relative_name(source, path).removesuffix('.csv')}.parquet"
            return source, out, *_convert_csv(spark, source, out, schema, encoding), True, None
        except Exception as exc:  # noqa: BLE001 - reported in the status row
            return source, None, 0, 0, False, str(exc)

    return spark.createDataFrame(_side_by_side(convert, list_files(spark, path, "*.csv")), STATUS_SCHEMA)


def count_rows(spark: SparkSession, paths: list[str]) -> int:
    """Rows in all files, from the footers; unreadable files are skipped."""
    reader = spark.read.schema("_none string").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
    return reader.parquet(*paths).count() if paths else 0


# --- ingestion into the raw layer --------------------------------------------------------------

INGEST_SCHEMA = (
    "source string, layer string, files_ingested int, rows_total bigint, output_path string, success boolean, error string"
)


def _ingest(lake: Lake, source: str, load, at: datetime, version: str | None) -> tuple:
    seen = Observation()
    try:
        counted = load().observe(seen, F.count(F.lit(1)).alias("n"))
        path = lake.write("raw", source, counted, at, version)
        return (source, "raw", 1, seen.get["n"], path, True, None)
    except Exception as exc:  # noqa: BLE001 - reported in the result
        return (source, "raw", 0, 0, None, False, str(exc))


def ingest_dataframe(lake: Lake, source: str, df: DataFrame, at: datetime, version: str | None = None) -> DataFrame:
    """Write a frame to the raw layer; the result row reports rows, path and any error."""
    return lake.spark.createDataFrame([_ingest(lake, source, lambda: df, at, version)], INGEST_SCHEMA)


def version_of(name: str) -> str:
    """A version name for a file name or relative path, one for each: other characters than ``A-Za-z0-9._-`` are escaped."""
    return re.sub(r"[^A-Za-z0-9._-]", lambda m: "".join(f"+{b:02X}" for b in m.group().encode()), name)


def ingest_file(lake: Lake, source: str, path: str, at: datetime) -> DataFrame:
    """Copy one Parquet file into the raw layer under its own name."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    result = _ingest(lake, source, lambda: parquet_load(lake.spark, path), at, version_of(name))
    return lake.spark.createDataFrame([result], INGEST_SCHEMA)


def ingest_directory(lake: Lake, source: str, path: str, at: datetime) -> DataFrame:
    """Ingest every Parquet file below a folder as a version named by its relative path; one summary row, successful if
    any file was or none existed. Different paths have different names: what a version name may not hold is written as ``+`` and its bytes in hexadecimal."""
    files = list_files(lake.spark, path, "*.parquet")

    def one(file: str) -> tuple:
        return _ingest(lake, source, lambda: parquet_load(lake.spark, file), at, version_of(relative_name(file, path)))

    results = _side_by_side(one, files)
    ok = [r for r in results if r[5]]
    summary = (
        source, "raw", len(ok), sum(r[3] for r in ok), ok[-1][4] if ok else path, bool(ok) or not files,
        "; ".join(r[6] for r in results if not r[5]) or None,
    )
    return lake.spark.createDataFrame([summary], INGEST_SCHEMA)


def save_records(df: DataFrame, lake: Lake, name: str) -> str:
    """Replace the records of one named dataset in the raw layer."""
    dest = f"{lake.path('raw', name)}/data.parquet"
    df.write.mode("overwrite").parquet(dest)
    lake.note_columns("raw", name, df.schema)
    return dest


def union_record_frames(frames: list[DataFrame]) -> DataFrame:
    """Records of several shapes with the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- log lines ---------------------------------------------------------------------------------


def parse_log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Structured entries (timestamp, level, message, pipeline_id) of JSON log lines.

    The entry may be wrapped in ``record``; time and level may be objects or plain text.
    Blank and unparsable lines are dropped. Every part is its own path lookup, so a filter on one
    part that moves below the projection does not parse the others.
    """
    line = F.trim(F.col(column))
    wrapped = F.get_json_object(line, "$.record").isNotNull()

    def entry(path: str) -> Column:
        return F.when(wrapped, F.get_json_object(line, f"$.record.{path}")).otherwise(F.get_json_object(line, f"$.{path}"))

    def part(name: str, inner: str, default: str) -> Column:
        value = entry(name)
        return F.coalesce(entry(f"{name}.{inner}"), F.when(~value.startswith("{"), value), F.lit(default))

    return lines.where(F.json_object_keys(line).isNotNull()).select(
        part("time", "repr", "").alias("timestamp"),
        part("level", "name", "INFO").alias("level"),
        F.coalesce(entry("message"), line).alias("message"),
        F.nullif(entry("extra.pipeline_id"), F.lit("")).alias("pipeline_id"),
    )


def log_source(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))
