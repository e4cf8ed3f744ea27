"""Session builder and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lakeweave", **conf: str) -> SparkSession:
    """A session with the settings the library relies on: UTC and adaptive execution.

    On a cluster leave ``master`` unset: the submit settings decide, and shuffle
    parallelism starts high and is coalesced at run time by AQE.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Call-site capture for every column expression costs more than planning itself.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, never reused between calls."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame) -> DataFrame:
    """The frame computed once and stored in the shared checkpoint folder, for results read more than once.

    A reliable checkpoint survives lost executors, unlike a cached or local copy.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a folder or file."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, from its listing; none when there is no such folder."""
    system, folder = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern with ``*``, from a listing."""
    system, glob = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(glob) or [])


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all; an error if there is one of that name already."""
    jvm = spark.sparkContext._jvm
    system, target = _hadoop(spark, path)
    part = _hadoop(spark, f"{path}__new-{uuid.uuid4().hex[:12]}")[1]
    out = system.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # Without an option, this rename refuses to replace a file.
        context.rename(part, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as exc:
        system.delete(part, False)
        raise FileExistsError(path) if system.exists(target) else exc from None


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    system, source = _hadoop(spark, path)
    stream = system.open(source)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file; None for a folder or no file."""
    system, source = _hadoop(spark, path)
    if not system.exists(source):
        return None
    status = system.getFileStatus(source)
    return status.getLen() if status.isFile() else None


def file_bytes(spark: SparkSession, path: str, start: int, n: int) -> bytes:
    """Up to ``n`` bytes of a file from ``start`` on."""
    system, source = _hadoop(spark, path)
    stream = system.open(source)
    try:
        stream.seek(start)
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that the library wrote and no longer needs."""
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


def replace_folder(spark: SparkSession, new: str, dest: str) -> None:
    """Put a finished folder in the place of another. Until the new one is complete the old one stays as it is."""
    system, source = _hadoop(spark, new)
    target = _hadoop(spark, dest)[1]
    old = f"{dest}__old-{uuid.uuid4().hex[:12]}"
    if system.exists(target):
        system.rename(target, _hadoop(spark, old)[1])
    if not system.rename(source, target):
        raise OSError(f"cannot move {new} to {dest}")
    remove_folder(spark, old)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """The frame computed once and kept as a Parquet table in the shared folder: readers get columns and pushed filters."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists on its file system."""
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def or_none(spark: SparkSession, path: str, load):
    """The loaded DataFrame, or None when there is nothing at the path."""
    if not path_exists(spark, path):
        return None
    try:
        return load()
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
