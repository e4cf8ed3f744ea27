"""Four-layer Parquet lake.

Layout: ``<base>/<layer>/<source>/ingest_date=YYYY-MM-DD/version=<name>/part-*.parquet``.
One write is one version folder, so repeating a failed write replaces its own output only,
and a reader of one day touches one partition.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from dataclasses import astuple, dataclass, replace
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from lakeweave.session import as_table, child_names, matching_paths, or_none, read_text, write_once

# Lake layers, in promotion order.
LAYERS = ["raw", "bronze", "silver", "gold"]

ENTRY_SCHEMA = (
    "layer string, source string, path string, filename string, created_at timestamp, size_bytes bigint, row_count bigint"
)
PREVIEW_ROWS = 100
_PARTITION = r"/ingest_date=(\d{4}-\d{2}-\d{2})/version=([^/]+)/"


def _one_form(path: str) -> Column:
    """Listings and file metadata write local paths with a different number of slashes."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def check_layer(layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return layer


def version_name(at: datetime) -> str:
    """UTC ISO time with hyphens instead of colons."""
    return at.astimezone(UTC).isoformat().replace(":", "-")


class Lake:
    """Reads and writes the layers below one base path (any Hadoop file system, object stores included)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, layer: str, source: str) -> str:
        return f"{self.base}/{check_layer(layer)}/{source}"

    def version_path(self, layer: str, source: str, day: date, version: str) -> str:
        return f"{self.path(layer, source)}/ingest_date={day.isoformat()}/version={version}"

    # --- writing ---

    def write(self, layer: str, source: str, df: DataFrame, at: datetime, version: str | None = None) -> str:
        """Write one version under the UTC day of ``at`` and return its folder; other versions stay."""
        version = re.sub(r"\.parquet$", "", version or version_name(at))
        if not re.fullmatch(r"[A-Za-z0-9._+-]+", version):
            raise ValueError(f"version name {version!r} is not usable as a folder name")
        dest = self.version_path(layer, source, at.astimezone(UTC).date(), version)
        df.write.mode("overwrite").parquet(dest)
        self.note_columns(layer, source, df.schema)
        return dest

    # --- columns ---

    def _columns_path(self, layer: str, source: str) -> str:
        return f"{self.base}/_columns/{check_layer(layer)}/{source}"

    def note_columns(self, layer: str, source: str, schema: T.StructType) -> None:
        """Keep a list of columns beside the data, a small file for each different list. Writing the same one twice does no harm."""
        text = json.dumps([f.jsonValue() for f in schema], sort_keys=True)
        mark, names = hashlib.sha256(text.encode()).hexdigest()[:16], child_names(self.spark, self._columns_path(layer, source))
        if not any(n.endswith(f"-{mark}.json") for n in names):
            try:
                write_once(self.spark, f"{self._columns_path(layer, source)}/{len(names):06d}-{mark}.json", text)
            except FileExistsError:  # a write at the same time noted the same columns: the name holds their hash
                pass

    def columns(self, layer: str, source: str) -> T.StructType | None:
        """The union of the columns of all versions, in the order they came; None where none are kept, because another tool wrote the files."""
        fields: dict[str, T.StructField] = {}
        for name in child_names(self.spark, self._columns_path(layer, source)):
            if re.fullmatch(r"\d+-[0-9a-f]+\.json", name):
                for described in json.loads(read_text(self.spark, f"{self._columns_path(layer, source)}/{name}")):
                    field = T.StructField.fromJson(described)
                    known = fields.setdefault(field.name, field)
                    if known.dataType != field.dataType:
                        raise ValueError(f"column {field.name!r} of {layer}/{source} is {known.dataType.simpleString()} and {field.dataType.simpleString()} in different versions")
        return T.StructType(list(fields.values())) if fields else None

    # --- reading ---

    def read(
        self, layer: str, source: str, day: date | None = None, schema: T.StructType | None = None,
        with_version: bool = False,
    ) -> DataFrame | None:
        """All versions (or those of one day) with the columns of the source; None when there are none.

        No footer is opened to learn the columns, unless another tool wrote the files.
        """
        root = self.path(layer, source)
        scan = f"{root}/ingest_date={day.isoformat()}" if day else root
        return self._read_paths(layer, source, [scan], schema, with_version)

    def _read_paths(self, layer: str, source: str, paths: list[str], schema=None, with_version: bool = False) -> DataFrame | None:
        if not matching_paths(self.spark, paths[0]):
            return None
        return self._read_files(paths, schema or self.columns(layer, source), with_version)

    def _read_files(self, paths: list[str], schema: T.StructType | None, with_version: bool = False) -> DataFrame | None:
        reader = self.spark.read.option("recursiveFileLookup", True)
        reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
        df = or_none(self.spark, paths[0], lambda: reader.parquet(*paths))
        if df is None or not with_version:
            return df
        file_path = F.col("_metadata.file_path")
        return df.select(
            "*",
            F.regexp_extract(file_path, _PARTITION, 1).cast("date").alias("ingest_date"),
            F.regexp_extract(file_path, _PARTITION, 2).alias("version"),
        )

    def read_legacy(self, path: str) -> DataFrame | None:
        """A tree dated as ``YYYY/MM/DD/*.parquet``, written by other tools."""
        return self._read_files([path], None)

    def _files(self, root: str) -> DataFrame | None:
        """One row per Parquet file below ``root``; the listing reads no file content."""
        return or_none(
            self.spark,
            root,
            lambda: self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(root)
            .select("path", "modificationTime", "length"),
        )

    def versions(self, layer: str, source: str) -> DataFrame:
        """(ingest_date, version) of every stored version; folders with malformed dates are skipped."""
        files = self._files(self.path(layer, source))
        if files is None:
            return self.spark.createDataFrame([], "ingest_date date, version string")
        return (
            files.select(
                F.regexp_extract("path", _PARTITION, 1).try_cast("date").alias("ingest_date"),
                F.regexp_extract("path", _PARTITION, 2).alias("version"),
            )
            .where(F.col("ingest_date").isNotNull())
            .distinct()
        )

    def listed_versions(self, layer: str, source: str) -> set[tuple[date, str]]:
        """The same from one listing, without a job. A version counts once it has a data file."""
        found = set()
        for path in matching_paths(self.spark, f"{self.path(layer, source)}/ingest_date=*/version=*/*.parquet"):
            match = re.search(_PARTITION, path)
            try:
                found.add((date.fromisoformat(match.group(1)), match.group(2)))
            except (AttributeError, ValueError):  # no date
                continue
        return found

    def legacy_versions(self, path: str) -> DataFrame:
        """Days of a ``YYYY/MM/DD`` tree that hold files; other folders and impossible dates are skipped."""
        files = self._files(path)
        if files is None:
            return self.spark.createDataFrame([], "version_date date")
        day = F.regexp_extract("path", r"/(\d+/\d+/\d+)/[^/]+$", 1)
        return (
            files.select(F.try_to_date(F.nullif(F.translate(day, "/", "-"), F.lit("")), "yyyy-MM-dd").alias("version_date"))
            .where(F.col("version_date").isNotNull())
            .distinct()
        )

    def entries(self, layer: str, source: str | None = None) -> DataFrame:
        """One row per data file of a layer: source, path, name, time, size, and rows from its footer."""
        root = f"{self.base}/{check_layer(layer)}"
        scan = f"{root}/{source}" if source else root
        files = self._files(scan)
        if files is None:
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        files = files.withColumn("path", _one_form("path")).join(self._row_counts(scan), "path", "left")
        below_layer = F.substring_index(F.col("path"), f"/{layer}/", -1)
        parts = F.split(below_layer, "/")
        return files.select(
            F.lit(layer).alias("layer"),
            F.when(F.size(parts) > 1, parts[0]).otherwise("").alias("source"),
            "path",
            F.substring_index("path", "/", -1).alias("filename"),
            F.col("modificationTime").alias("created_at"),
            F.col("length").alias("size_bytes"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
        )

    def _row_counts(self, scan: str) -> DataFrame:
        """Rows of every file below a folder; no column is read, so the footers answer."""
        rows = self.spark.read.schema("_none string").option("recursiveFileLookup", True).parquet(scan)
        return rows.groupBy(_one_form("_metadata.file_path").alias("path")).agg(F.count("*").alias("row_count"))

    def datasets(self, layer: str, source: str | None = None) -> DataFrame:
        """One row per version: files, bytes and rows. Row counts come from the file footers."""
        root = f"{self.base}/{check_layer(layer)}"
        scan = f"{root}/{source}" if source else root
        files = self._files(scan)
        if files is None:
            return self.spark.createDataFrame(
                [], "layer string, source string, ingest_date date, name string, n_files bigint, size_bytes bigint, row_count bigint"
            )
        pattern = r"/" + layer + r"/([^/]+)" + _PARTITION
        return (
            files.withColumn("path", _one_form("path")).join(self._row_counts(scan), "path", "left")
            .groupBy(
                F.lit(layer).alias("layer"),
                F.regexp_extract("path", pattern, 1).alias("source"),
                F.regexp_extract("path", pattern, 2).cast("date").alias("ingest_date"),
                F.regexp_extract("path", pattern, 3).alias("name"),
            )
            .agg(
                F.count("*").alias("n_files"),
                F.sum("length").alias("size_bytes"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
            )
        )

    def catalog(self, remote: DataFrame | None = None) -> DataFrame:
        """Datasets of all layers, plus remote objects (key, size_bytes, modified_at) not listed yet by name.

        Only remote Parquet keys of at least three path parts count; among equal names the first key wins.
        """
        frames = [self.datasets(layer) for layer in LAYERS]
        local = frames[0]
        for frame in frames[1:]:
            local = local.unionByName(frame)
        local = local.select("layer", "source", "name", "size_bytes", "row_count")
        if remote is None:
            return local
        usable = remote.where(
            F.col("key").endswith(".parquet") & (F.size(F.split("key", "/")) >= 3)
        ).withColumn("name", F.regexp_replace(F.substring_index("key", "/", -1), r"\.parquet$", ""))
        first = usable.groupBy("name").agg(F.min_by("size_bytes", "key").alias("size_bytes"))
        extra = first.join(local.select("name"), "name", "left_anti").select(
            F.lit("raw").alias("layer"), F.lit("s3").alias("source"), "name", "size_bytes",
            F.lit(None).cast("bigint").alias("row_count"),
        )
        return local.unionByName(extra)

    def preview(self, source: str, name: str, rows: int = PREVIEW_ROWS) -> DataFrame | None:
        """First rows of the dataset ``name`` in the first layer that has it (the limit stops the scan early)."""
        name = re.sub(r"\.parquet$", "", name)
        for layer in LAYERS:
            root = self.path(layer, source)
            found = or_none(
                self.spark, root, lambda root=root: self.spark.read.parquet(f"{root}/ingest_date=*/version={name}")
            )
            if found is not None:
                return found.limit(rows)
        return None

    # --- promotion ---

    def promote(self, source_layer: str, dest_layer: str, source: str, df: DataFrame, at: datetime, version: str | None = None) -> str:
        check_layer(source_layer)
        return self.write(dest_layer, source, df, at, version)

    def unpromoted(self, source_layer: str, dest_layer: str, source: str, with_version: bool = False) -> DataFrame | None:
        """Rows of the versions present in one layer and absent from the next.

        Version lists are folder names, not data; the read below scans the pending folders only.
        """
        have = self.versions(source_layer, source)
        pending = have.join(self.versions(dest_layer, source), ["ingest_date", "version"], "left_anti").collect()
        paths = [self.version_path(source_layer, source, r.ingest_date, r.version) for r in pending]
        return self._read_paths(source_layer, source, paths, None, with_version) if paths else None

    def copy_versions(self, source_layer: str, dest_layer: str, source: str, versions: list[tuple[date, str]]) -> DataFrame:
        """Copy whole versions to another layer in one job and return the copied rows.

        Only the folders of these versions are replaced, so a repeated copy changes nothing.
        """
        paths = [self.version_path(source_layer, source, day, version) for day, version in versions]
        rows = self._read_paths(source_layer, source, paths, None, with_version=True)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("ingest_date", "version").parquet(self.path(dest_layer, source))
        self.note_columns(dest_layer, source, T.StructType([f for f in rows.schema if f.name not in ("ingest_date", "version")]))
        copies = [self.version_path(dest_layer, source, day, version) for day, version in versions]
        return self._read_paths(dest_layer, source, copies)

    def latest_version(self, layer: str, source: str) -> DataFrame | None:
        """Rows of the newest version only: the current snapshot of a layer that stores snapshots."""
        newest = self.versions(layer, source).orderBy(F.desc("ingest_date"), F.desc("version")).limit(1).collect()
        if not newest:
            return None
        return self._read_paths(layer, source, [self.version_path(layer, source, newest[0].ingest_date, newest[0].version)])


def _newest_first(df: DataFrame, key: str, updated_at: str, leave_out: tuple[str, ...] = ()) -> WindowSpec:
    """Rows of a key from new to old; equal times by the row's content, so every run finds the same order."""
    sortable = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rest = [F.desc_nulls_last(c) for c in sortable if c not in (key, updated_at, *leave_out)]
    return Window.partitionBy(key).orderBy(F.desc_nulls_last(updated_at), *rest)


def latest_per_key(df: DataFrame, key: str, updated_at: str = "loaded_at") -> DataFrame:
    """The newest row per key; ties by the row's content, so every run picks the same one. Rows without a key all stay.

    The rank filter becomes a per-task reduction before the shuffle, so copies of a hot key
    collapse where they are read.
    """
    newest = _first_ranked(df.where(F.col(key).isNotNull()), _newest_first(df, key, updated_at))
    return newest.unionByName(df.where(F.col(key).isNull()))


def _first_ranked(df: DataFrame, order: WindowSpec) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") == 1).drop("__rank")


# --- silver: the current row of every key, in a growing directory of hash buckets ----------------

BUCKET_ROWS = 1_000_000  # a bucket that would hold more is split
FILL = 0.7  # how full buckets are meant to be after a first load or a split
MERGE_SHARE = 0.25  # a bucket is merged once so large a share of its base has been added to it,
MERGE_FOLDERS = 16  # or once it is spread over so many folders
FULL_EVERY = 32  # every so many commits, one holds the whole directory: a reader needs no older ones
VERSIONS_PER_RUN = 1000


@dataclass(frozen=True)
class Bucket:
    """Keys whose hash ends in ``bits`` (``depth`` binary digits): rows of its base and added to it since, current rows, and the folders with them, base first."""

    depth: int
    bits: int
    base: int
    added: int
    live: int
    folders: tuple[tuple[date, str], ...]

    @property
    def name(self) -> str:
        return bucket_name(self.depth, self.bits)


def bucket_name(depth: int, bits: int) -> str:
    return f"{depth}-{bits}"


@dataclass
class Directory:
    """All buckets by (depth, bits), the bronze versions taken in, the columns, and the number of the commit that this state is of."""

    seq: int
    buckets: dict[tuple[int, int], Bucket]
    taken: set[tuple[date, str]]
    columns: T.StructType | None

    def after(self, commit: dict) -> Directory:
        """The state after one more commit."""
        buckets = {k: b for k, b in self.buckets.items() if list(k) not in commit["gone"]}
        for b in commit["buckets"]:
            buckets[b["depth"], b["bits"]] = Bucket(**b | {"folders": tuple(_named(f) for f in b["folders"])})
        columns = T.StructType.fromJson(commit["columns"]) if commit["columns"] else self.columns
        return Directory(commit["seq"], buckets, self.taken | {_named(v) for v in commit["taken"]}, columns)


def _named(folder: list[str]) -> tuple[date, str]:
    return date.fromisoformat(folder[0]), folder[1]


def _plain(folders) -> list[list[str]]:
    return [[day.isoformat(), version] for day, version in folders]


class Silver:
    """The silver layer of one source: the newest row per key, by extendible hashing.

    Every bucket has its own depth: the number of hash bits that lead to it. A load adds to the buckets it touches only the rows that are new or newer there, so what is
    written grows with the load. Readers take the last added row of a key. A bucket is merged (base and additions become one base) when
    the additions have grown to a share of it, and split, as often as needed, when it has too many current rows; both happen in
    the commit of the load that causes them.

    A run writes one silver version with a folder per bucket, then adds one commit, a small file: the new state of the touched buckets, those that were
    split away, and the bronze versions taken in. Commits are numbered, so a backfill under an earlier time counts. A run that
    dies before its commit has changed nothing: the next one takes the same bronze versions again.
    """

    def __init__(self, lake: Lake, source: str, bucket_rows: int = BUCKET_ROWS):
        self.lake, self.spark, self.source, self.bucket_rows = lake, lake.spark, source, bucket_rows
        self.commits_path = f"{lake.base}/_commits/{source}"  # beside the layers, so no catalog lists it

    # --- state ---

    def directory(self) -> Directory:
        """The current state, from the newest whole commit and those after it. Its size is that of metadata: buckets and version names."""
        state = Directory(0, {}, set(), None)
        numbers = [int(n[:-5]) for n in child_names(self.spark, self.commits_path) if re.fullmatch(r"\d+\.json", n)]
        newest = max(numbers, default=0)
        for n in range(max(1, newest - newest % FULL_EVERY), newest + 1):
            state = state.after(json.loads(read_text(self.spark, self._commit_path(n))))
        return state

    def _commit_path(self, seq: int) -> str:
        return f"{self.commits_path}/{seq:09d}.json"

    def _commit(self, state: Directory, changed: list[Bucket], gone: list[Bucket], taken: list[tuple[date, str]], columns: T.StructType | None) -> None:
        """One small file; fails if another run has taken this number."""
        seq = state.seq + 1
        if seq % FULL_EVERY == 0:
            left = {k: b for k, b in state.buckets.items() if k not in {(g.depth, g.bits) for g in gone}} | {(b.depth, b.bits): b for b in changed}
            changed, taken, columns = list(left.values()), sorted({*state.taken, *taken}), columns or state.columns
        commit = {
            "seq": seq, "buckets": [vars(b) | {"folders": _plain(b.folders)} for b in changed], "gone": [[b.depth, b.bits] for b in gone],
            "taken": _plain(taken), "columns": columns.jsonValue() if columns else None,
        }
        write_once(self.spark, self._commit_path(seq), json.dumps(commit))

    # --- reading ---

    def _folders(self, buckets: list[Bucket]) -> list[str]:
        return [f"{self.lake.version_path('silver', self.source, day, version)}/bucket={b.name}" for b in buckets for day, version in b.folders]

    def _rows(self, state: Directory, buckets: list[Bucket]) -> DataFrame:
        """All stored rows of some buckets, with the number of the commit that wrote them. The stored columns spare the footers."""
        rows = self.lake._read_files(self._folders(buckets), state.columns, with_version=True)
        return rows.withColumn("__seq", F.regexp_extract("version", r"-(\d+)(\.split)?$", 1).cast("long")).select(*[f"`{c}`" for c in state.columns.names], "__seq")

    def _current(self, state: Directory, buckets: list[Bucket], key: str) -> DataFrame:
        """The current rows of some buckets. Merged ones are read as they are, rows are compared only in those with additions."""
        merged, open_ = [[b for b in buckets if (len(b.folders) > 1) == added] for added in (False, True)]
        frames = []
        if merged:
            frames.append(self.lake._read_files(self._folders(merged), state.columns))
        if open_:
            frames.append(_last_written(self._rows(state, open_), key).drop("__seq"))
        return reduce(DataFrame.unionByName, frames)

    def snapshot(self, key: str) -> DataFrame | None:
        """The current rows; None when there are none."""
        state = self.directory()
        buckets = [b for b in state.buckets.values() if b.folders]
        return self._current(state, buckets, key) if buckets else None

    # --- writing ---

    def _depth(self, rows: int) -> int:
        """Bits that bring so many rows down to buckets that are not full."""
        return max(0, math.ceil(math.log2(max(rows, 1) / (FILL * self.bucket_rows))))

    def _placed(self, rows: DataFrame, key: str, buckets: list[Bucket]) -> DataFrame:
        """Rows with the ``bucket`` they belong to: their hash is cut to the few depths that occur, and one cut is a bucket."""
        known = self.spark.createDataFrame([(b.depth, b.bits, b.name) for b in buckets], "__depth int, __bits bigint, bucket string")
        depths = F.array(*[F.lit(d) for d in sorted({b.depth for b in buckets})])
        cut = rows.withColumn("__depth", F.explode(depths)).withColumn("__bits", _last_bits(key, F.col("__depth")))
        return cut.join(known, ["__depth", "__bits"]).drop("__depth", "__bits")

    def _write(self, rows: DataFrame, day: date, version: str) -> str:
        path = self.lake.version_path("silver", self.source, day, version)
        rows.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
        self.lake.note_columns("silver", self.source, T.StructType([f for f in rows.schema if f.name != "bucket"]))
        return path

    def _counts(self, path: str) -> dict[str, int]:
        """Rows of every bucket of a version, from the footers."""
        rows = self.spark.read.schema("_none string, bucket string").parquet(path).groupBy("bucket").count()
        return {r.bucket: r["count"] for r in rows.collect()}

    def merge(self, fresh: DataFrame | None, key: str, at: datetime, taken: list[tuple[date, str]], n: int, state: Directory | None = None) -> int:
        """Take in ``n`` rows, then commit. Returns how many of them are current now."""
        state = state or self.directory()
        day, version = at.astimezone(UTC).date(), f"{version_name(at)}-{state.seq + 1:06d}"
        if not n:
            self._commit(state, [], [], taken, None)
            return 0
        live = sum(b.live for b in state.buckets.values())
        if n > MERGE_SHARE * live:
            return self._rewrite(state, fresh, key, n, (day, version), taken)
        winners, columns = self._winners(state, fresh, key)
        found = {r.bucket: r for r in winners.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("__known").alias("known")).collect()}
        changed, full = [], []
        for b in state.buckets.values():
            if b.name in found:
                r = found[b.name]
                b = replace(b, added=b.added + r.n, live=b.live + r.n - r.known, folders=(*b.folders, (day, version)))
                (full if b.live > self.bucket_rows or b.added > MERGE_SHARE * b.base or len(b.folders) > MERGE_FOLDERS else changed).append(b)
        rows = winners.drop("__known")
        out, made = rows.where(F.col("bucket").isin([b.name for b in changed])), []
        if full:
            new = rows.where(F.col("bucket").isin([b.name for b in full])).drop("bucket").withColumn("__seq", F.lit(state.seq + 1).cast("long"))
            before = [old for b in full if (old := state.buckets[b.depth, b.bits]).folders]
            both = new.unionByName(self._rows(state, before), allowMissingColumns=True) if before else new
            made = [child for b in full for child in self._children(b)]
            merged = self._placed(_last_written(both, key).drop("__seq"), key, made)
            out = out.unionByName(merged) if changed else merged
        if found:
            path = self._write(out, day, version)
            made = _counted(made, self._counts(path) if made else {}, (day, version))
        self._commit(state, changed + made, self._replaced(full, made), taken, columns)
        return sum(r.n for r in found.values())

    def _children(self, full: Bucket) -> list[Bucket]:
        """What a bucket becomes when it is merged: itself, or the buckets it is split into."""
        more = self._depth(full.live) if full.live > self.bucket_rows else 0
        return [Bucket(full.depth + more, full.bits + (i << full.depth), 0, 0, 0, ()) for i in range(1 << more)]

    @staticmethod
    def _replaced(old: list[Bucket], new: list[Bucket]) -> list[Bucket]:
        stay = {(b.depth, b.bits) for b in new}
        return [b for b in old if (b.depth, b.bits) not in stay]

    def _rewrite(self, state: Directory, fresh: DataFrame, key: str, n: int, folder: tuple[date, str], taken: list[tuple[date, str]]) -> int:
        """A load that is large against what is stored (a first one too): all buckets become new bases in one pass, then full ones are split."""
        old, won = [b for b in state.buckets.values() if b.folders], Observation()
        new = fresh.withColumn("__new", F.lit(True))
        merged = self._current(state, old, key).unionByName(new, allowMissingColumns=True) if old else new
        columns = T.StructType([f for f in merged.schema if f.name != "__new"])
        depth = self._depth(n)
        buckets = [replace(b, folders=()) for b in state.buckets.values()] or [Bucket(depth, i, 0, 0, 0, ()) for i in range(1 << depth)]
        rows = _first_ranked(merged, _newest_first(merged, key, "loaded_at")).observe(won, F.count("__new").alias("n")).drop("__new")
        path = self._write(self._placed(rows, key, buckets), *folder)
        made = _counted(buckets, self._counts(path), folder)
        full = [b for b in made if b.live > self.bucket_rows]
        if full:
            again = (folder[0], f"{folder[1]}.split")
            children = [child for b in full for child in self._children(b)]
            parts = self.lake._read_files(self._folders(full), columns)
            children = _counted(children, self._counts(self._write(self._placed(parts, key, children), *again)), again)
            made = [b for b in made if b not in full] + children
        self._commit(state, made, self._replaced(list(state.buckets.values()), made), taken, columns)
        return won.get["n"]

    def _winners(self, state: Directory, fresh: DataFrame, key: str) -> tuple[DataFrame, T.StructType]:
        """Fresh rows that are newer than what is stored of their key, with their ``bucket`` and whether the key was ``__known``; and all columns.

        Only touched buckets are read, and of these only rows of the fresh keys take part. The result is a table of at most the load's size.
        """
        placed = self._placed(fresh, key, list(state.buckets.values()))
        names = {r[0] for r in placed.select("bucket").distinct().collect()}  # at most one per bucket
        touched = [b for b in state.buckets.values() if b.name in names and b.folders]
        new = placed.withColumn("__new", F.lit(True))
        if touched:
            stored = self._rows(state, touched).join(fresh.select(key).distinct(), key, "left_semi")
            stored = _last_written(stored, key).drop("__seq").withColumn("__known", F.lit(True))
            both = stored.unionByName(new, allowMissingColumns=True)
        else:
            empty = self.spark.createDataFrame([], state.columns).withColumn("__known", F.lit(True))
            both = empty.unionByName(new, allowMissingColumns=True)
        columns = T.StructType([f for f in both.schema if f.name not in ("__known", "__new", "bucket")])
        known = F.coalesce(F.max("__known").over(Window.partitionBy(key)), F.lit(False))
        ranked = both.withColumn("__rank", F.row_number().over(_newest_first(both, key, "loaded_at", ("__known", "bucket"))))
        ranked = ranked.withColumn("__known", known).where((F.col("__rank") == 1) & F.col("__new")).drop("__rank", "__new")
        return as_table(ranked, "silver-load"), columns


def _counted(buckets: list[Bucket], counts: dict[str, int], folder: tuple[date, str]) -> list[Bucket]:
    """Buckets as new bases in one folder; those without rows have none."""
    return [replace(b, base=(m := counts.get(b.name, 0)), added=0, live=m, folders=(folder,) if m else ()) for b in buckets]


def _last_bits(key: str, depth: Column) -> Column:
    """The last ``depth`` bits of the hash of the key."""
    return F.xxhash64(F.col(key)).bitwiseAND(F.expr("1L") * F.pow(F.lit(2), depth).cast("long") - 1)


def _last_written(rows: DataFrame, key: str) -> DataFrame:
    """Per key, the row of the newest commit."""
    return _first_ranked(rows, Window.partitionBy(key).orderBy(F.desc("__seq")))


@dataclass(frozen=True)
class Promotion:
    """What one run took into silver: versions, their rows, those rejected, and those that are current now."""

    versions: int = 0
    rows: int = 0
    rejected: int = 0
    current: int = 0


def promote_source(lake: Lake, source: str, key: str, at: datetime, placeholders: tuple[str, ...] = ("",), bucket_rows: int = BUCKET_ROWS) -> Promotion:
    """raw → bronze (new versions only, under their own names) → silver (newest row per key).

    A second run without new raw data promotes nothing. Each step derives
    what is due from what the next layer has, so a run that failed anywhere is made up for by the next. Rows without a usable key go
    to ``<source>_rejects``. A backlog is taken in steps of ``VERSIONS_PER_RUN`` versions, oldest first. What is there comes from one
    listing of each layer, what silver has from its commits.
    """
    silver, bronze = Silver(lake, source, bucket_rows), lake.listed_versions("bronze", source)
    state = silver.directory()
    new = sorted(lake.listed_versions("raw", source) - bronze - state.taken)
    for i in range(0, len(new), VERSIONS_PER_RUN):
        lake.copy_versions("raw", "bronze", source, new[i : i + VERSIONS_PER_RUN])
    bronze = lake.listed_versions("bronze", source) if new else bronze
    total = Promotion()
    due = sorted((bronze | set(new)) - state.taken)
    for i in range(0, len(due), VERSIONS_PER_RUN):
        step = due[i : i + VERSIONS_PER_RUN]
        held = [lake.version_path("bronze", source, day, version) for day, version in step if (day, version) in bronze]
        if not held:  # versions without a row have no file in bronze
            silver.merge(None, key, at, step, 0, state if i == 0 else None)
            total = replace(total, versions=total.versions + len(step))
            continue
        rows = lake._read_paths("bronze", source, held)
        usable = F.col(key).isNotNull() & ~F.col(key).cast("string").isin(*placeholders)
        n, rejected = rows.agg(F.count("*"), F.count_if(~usable)).first()
        if rejected:
            lake.write("silver", f"{source}_rejects", rows.where(~usable), at, f"{version_name(at)}-{step[-1][1]}")
        current = silver.merge(rows.where(usable), key, at, step, n - rejected, state if i == 0 else None)
        total = Promotion(total.versions + len(step), total.rows + n, total.rejected + rejected, total.current + current)
    return total


def lake_pipeline(lake: Lake, sources: dict[str, str], at: datetime, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Promote every source (name → key column); one source's failure does not stop the others.

    Returns a status row per source, with the whole text of an error.
    """
    rows = []
    for source, key in sources.items():
        try:
            done = promote_source(lake, source, key, at, bucket_rows=bucket_rows)
            rows.append((source, "promoted" if done.versions else "skipped", *astuple(done), None))
        except Exception as exc:  # noqa: BLE001 - reported in the status row
            rows.append((source, "failed", 0, 0, 0, 0, str(exc)))
    return lake.spark.createDataFrame(
        rows, "source string, status string, versions bigint, rows bigint, rejected bigint, current bigint, error string"
    )
