"""Where jobs may put files that every executor has to see."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 256 * 1024**2
MOST_PARTITIONS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so the
    setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="caselake-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside the block.

    They hold for the whole session, so threads see each other's. Use it for
    sizes only, never for what decides which data a write replaces.
    """
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_sized(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Enough shuffle partitions for ``size`` bytes of rows, never fewer than the session has.

    Adaptive execution merges partitions that turn out small, but cannot split
    evenly large ones; so a default meant for small data must be raised first.
    The upper end keeps the number of shuffle blocks manageable.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-size // PARTITION_BYTES), MOST_PARTITIONS)
    return settings(spark, {"spark.sql.shuffle.partitions": str(max(now, wanted))})


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Later branches then share one computation, and a lost executor costs a
    re-read, not a recomputation. Parquet rather than ``checkpoint()``: the
    plan runs once (an RDD checkpoint evaluates its last stage twice) and
    readers keep column pruning. The files stay, as nobody knows when the
    last reader is done; :func:`remove_old_stages` clears them by age.
    """
    return _written(df, fresh_path(df.sparkSession, "stage"))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """:func:`stage` for results that are consumed inside the block; the files go with it."""
    path = fresh_path(df.sparkSession, "stage")
    try:
        yield _written(df, path)
    finally:
        remove_path(df.sparkSession, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, uri: str):
    """A Hadoop path and its file system; needs a classic session, which has a JVM beside it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, uri: str) -> None:
    path, files = _path(spark, uri)
    files.delete(path, True)


def remove_old(
    spark: SparkSession, folder: str, keep: Collection[str] = (), prefix: str = "", min_age_hours: float = 24.0
) -> list[str]:
    """Delete the entries of ``folder`` named ``prefix...`` that are older and not in ``keep``; returns what went.

    The minimum age protects jobs that still read such files: it has to be
    longer than any of them runs. The age is that of the newest entry inside.
    """
    parent, files = _path(spark, folder)
    if not files.exists(parent):
        return []
    kept = {_path(spark, k)[0].toUri().getPath() for k in keep}
    newest_allowed = time.time() * 1000 - min_age_hours * 3_600_000
    gone = []
    for entry in files.listStatus(parent):
        path = entry.getPath()
        inner = [e.getModificationTime() for e in files.listStatus(path)] if entry.isDirectory() else []
        newest = max([entry.getModificationTime(), *inner])
        if path.getName().startswith(prefix) and path.toUri().getPath() not in kept and newest <= newest_allowed:
            files.delete(path, True)
            gone.append(path.toString())
    return gone


def remove_old_stages(spark: SparkSession, min_age_hours: float = 24.0) -> list[str]:
    """Delete what :func:`stage` has left in the shared folder and no job can need any more."""
    return remove_old(spark, shared_dir(spark), prefix="stage-", min_age_hours=min_age_hours)


def size_in_bytes(staged_rows: DataFrame) -> int:
    """Bytes of the files behind a frame read by path, by the planner's statistics: no file is opened."""
    return int(str(staged_rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def folder_bytes(spark: SparkSession, uri: str) -> int:
    """Bytes of all files below ``uri``, as the file system counts them; 0 if it does not exist."""
    path, files = _path(spark, uri)
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return name


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables live in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex}"
    return create_database(spark, name, f"{shared_dir(spark)}/{name}")
