"""Session defaults and the folder that every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_local_shared: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}


def build_session(master: str | None = None, app_name: str = "couriermart", **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    On a cluster leave ``master`` unset: the submit command names it, along with
    memory and shuffle settings.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    the driver is the executor, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = _local_shared.get(context.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="couriermart-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_shared[context.applicationId] = folder
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; no two calls return the same one."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this session has made. Frames that read them, and the
    stored mart and rollup, are gone with them: call it before the session stops."""
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor
    costs a re-read, and every reader sees the same rows in the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that have ended. It does so when the driver no longer holds their plans,
    for which the driver is asked to look now; otherwise the files of all steps of a long job add up on the disks."""
    spark._jvm.System.gc()


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists in the file system it names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def source_files(df: DataFrame) -> list[str]:
    """The files that ``df`` reads, in the form of ``_metadata.file_path``. Spark's scans hold this list on the driver anyway."""
    return [name.replace(":///", ":/", 1) for name in df.inputFiles()]


def as_paths(files: Iterable[str]) -> list[str]:
    """Files named as in ``_metadata.file_path``, where special characters are coded, as paths to read."""
    return [unquote(name) for name in files]


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by a listing of each of their folders."""
    spark = df.sparkSession
    files = set(as_paths(df.inputFiles()))
    total = 0
    for folder in {name.rsplit("/", 1)[0] for name in files}:
        location = spark._jvm.org.apache.hadoop.fs.Path(folder)
        for status in location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location):
            name = status.getPath().getName()
            total += status.getLen() if f"{folder}/{name}" in files else 0
    return total


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below ``path``, from the file system's own listing."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(location).getLength()
