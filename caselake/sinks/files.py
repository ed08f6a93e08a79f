"""The files of a table: an inventory from listings and footers, a lease for writers, and replacement of single files."""

from __future__ import annotations

import json
import math
import re
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.session import _path, remove_path

REWRITE, LEASES = "_rewrite-", "_leases"
# A folder level of rewritten files that tells groups of rows apart and is left out when they move in.
GROUP = "__group"
LEASE_SECONDS, WAIT_SECONDS, POLL_SECONDS = 6 * 3600.0, 600.0, 0.5


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_location(spark: SparkSession, name: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return detail.first()["data_type"]


# ---- inventory --------------------------------------------------------------


def table_files(spark: SparkSession, name: str) -> DataFrame:
    """``path, size`` and the partition columns of each file below a table's location, by listing alone.

    Spark lists in parallel; no file is opened, as no content is selected.
    """
    own = spark.newSession()
    # Partition values stay text until they get the table's types.
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    listed = own.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table_location(spark, name))
    types = dict(spark.table(name).dtypes)
    parts = [
        (F.col(f"`{c}`") if c in listed.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in partition_columns(spark, name)
    ]
    return listed.select("path", F.col("length").alias("size"), *parts)


def table_rows(spark: SparkSession, name: str) -> DataFrame:
    """One row, column ``rows``: the sum of the row counts in the files' footers; no row is read."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = spark.table(name)
    return own.read.schema(table.schema).parquet(table_location(spark, name)).agg(F.count(F.lit(1)).alias("rows"))


# ---- lease ------------------------------------------------------------------


class LeaseError(RuntimeError):
    """Another writer holds the table, or took it over."""


class _Held(threading.local):
    def __init__(self) -> None:
        self.by_path: dict[str, Lease] = {}


_HELD = _Held()


class Lease:
    """The right to change one table, as a file that only one writer can create."""

    def __init__(self, spark: SparkSession, uri: str, owner: str, seconds: float) -> None:
        self._spark, self._uri, self.owner, self._seconds = spark, uri, owner, seconds
        self._token = uuid.uuid4().hex

    def _content(self) -> dict | None:
        """What the file says; nothing yet while its writer is at it, and None if there is no file."""
        try:
            return read_note(self._spark, self._uri)
        except Exception:
            path, files = _path(self._spark, self._uri)
            return {} if files.exists(path) else None

    def _until(self, found: dict) -> float:
        """When the lease ends; a file that its writer never finished counts from its birth."""
        if "until" in found:
            return found["until"]
        path, files = _path(self._spark, self._uri)
        try:
            return files.getFileStatus(path).getModificationTime() / 1000 + self._seconds
        except Exception:  # it has just gone
            return math.inf

    def _create(self) -> bool:
        path, files = _path(self._spark, self._uri)
        files.mkdirs(path.getParent())
        if files.getScheme() == "file":
            # Hadoop's local file system looks and creates in two steps, the operating system in one.
            if not self._spark._jvm.java.io.File(path.toUri().getPath()).createNewFile():
                return False
            out = files.create(path, True)
        else:
            try:
                out = files.create(path, False)
            except Exception as error:
                if "FileAlreadyExistsException" in str(error) or files.exists(path):
                    return False
                raise
        text = json.dumps({"token": self._token, "owner": self.owner, "until": time.time() + self._seconds})
        out.write(bytearray(text, "utf-8"))
        out.close()
        return True

    def _take_over(self, found: dict) -> None:
        """Move an expired lease out of the way; only one of several writers succeeds in that."""
        path, files = _path(self._spark, self._uri)
        aside, _ = _path(self._spark, f"{self._uri}.{found.get('token', 'x')}.expired")
        if files.rename(path, aside):
            files.delete(aside, False)

    def take(self, wait_seconds: float) -> None:
        deadline = time.time() + wait_seconds
        while not self._create():
            found = self._content()
            until = math.inf if found is None else self._until(found)
            if until < time.time():
                self._take_over(found)
            elif time.time() > deadline:
                owner = (found or {}).get("owner", "another writer")
                raise LeaseError(f"{owner} holds {self._uri}, since before {wait_seconds:.0f} seconds ago")
            else:
                time.sleep(POLL_SECONDS)

    def confirm(self) -> None:
        """Raise if the lease ran out and another writer has it; called before what readers see changes."""
        if (self._content() or {}).get("token") != self._token:
            raise LeaseError(f"{self.owner} lost {self._uri} to another writer; nothing was changed")

    def release(self) -> None:
        if (self._content() or {}).get("token") == self._token:
            remove_path(self._spark, self._uri)


@contextmanager
def lease(
    spark: SparkSession,
    name: str,
    owner: str | None = None,
    seconds: float = LEASE_SECONDS,
    wait_seconds: float = WAIT_SECONDS,
) -> Iterator[Lease]:
    """Hold table ``name`` (which need not exist yet) against other writers; in one thread it nests.

    Who comes second waits, and fails after ``wait_seconds`` with the owner's
    name. A lease that outlived ``seconds`` may be taken over; the slow owner
    notices before it changes anything. The file system has to create a file
    only if it is absent, as HDFS and local ones do.
    """
    database, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(database or "default").locationUri.rstrip("/")
    uri = f"{root}/{LEASES}/{table}"
    if uri in _HELD.by_path:
        yield _HELD.by_path[uri]
        return
    held = Lease(spark, uri, owner or f"{spark.sparkContext.applicationId}/{threading.current_thread().name}", seconds)
    held.take(wait_seconds)
    _HELD.by_path[uri] = held
    try:
        yield held
    finally:
        del _HELD.by_path[uri]
        held.release()


# ---- replacing single files -------------------------------------------------


def plain_paths(spark: SparkSession, uris: Sequence[str]) -> list[str]:
    """File paths as readers take them, from the encoded ones of ``_metadata.file_path``."""
    jvm = spark._jvm
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)).toString() for u in uris]


def read_files(spark: SparkSession, name: str, paths: Sequence[str]) -> DataFrame:
    """The rows of some files of table ``name``."""
    table = spark.table(name)
    if not paths:
        return table.limit(0)
    return spark.read.schema(table.schema).option("basePath", table_location(spark, name)).parquet(*paths)


def write_note(spark: SparkSession, uri: str, content: object) -> None:
    """``content`` as JSON in a file that is there whole or not at all."""
    path, files = _path(spark, uri)
    draft, _ = _path(spark, f"{uri}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(content), "utf-8"))
    out.close()
    files.delete(path, False)
    if not files.rename(draft, path):
        raise OSError(f"could not write {uri}")


def read_note(spark: SparkSession, uri: str) -> object | None:
    """What :func:`write_note` wrote, or None."""
    path, files = _path(spark, uri)
    if not files.exists(path):
        return None
    source = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def replace_files(df: DataFrame, name: str, old: Sequence[str], held: Lease, rebalance: bool = True) -> None:
    """Put the rows of ``df`` in the place of the files ``old`` of table ``name``; all other files stay as they are.

    The new files are written to a hidden folder of the table, which readers
    skip. A note of the old files then makes the replacement final: from here
    on :func:`finish_rewrites` completes it, in this run or in the next
    writer's. New files are moved in before old ones go. A reader that lists
    the table in between finds both; one that started earlier may miss a file
    and has to run again. Rows of different values in a column ``GROUP`` of
    ``df``, which is not stored, get files of their own.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, name)
    folders = [*parts, *(c for c in df.columns if c == GROUP)]
    work = f"{table_location(spark, name)}/{REWRITE}{uuid.uuid4().hex}"
    try:
        rows = df.hint("rebalance", *parts) if rebalance else df
        rows.write.partitionBy(*folders).parquet(f"{work}/new")
        held.confirm()
    except BaseException:
        remove_path(spark, work)
        raise
    write_note(spark, f"{work}/old.json", list(old))
    finish_rewrites(spark, name)


def finish_rewrites(spark: SparkSession, name: str) -> int:
    """Complete replacements that are final and drop those that are not; returns how many were completed.

    Only the holder of the table's lease may call it. Every step can be repeated.
    """
    where = table_location(spark, name)
    root, files = _path(spark, where)
    done = 0
    for entry in files.listStatus(root) if files.exists(root) else []:
        if not entry.getPath().getName().startswith(REWRITE):
            continue
        work = entry.getPath().toString()
        old = read_note(spark, f"{work}/old.json")
        if old is not None:
            _move_in(spark, f"{work}/new", where)
            for path in old:
                remove_path(spark, path)
            done += 1
        remove_path(spark, work)
    if done:
        if partition_columns(spark, name):
            spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    return done


def _move_in(spark: SparkSession, folder: str, where: str) -> None:
    root, files = _path(spark, folder)
    depth = len(root.toUri().getPath()) + 1
    each = files.listFiles(root, True) if files.exists(root) else None
    while each is not None and each.hasNext():
        path = each.next().getPath()
        inner = path.toUri().getPath()[depth:]
        if inner.startswith(("_SUCCESS", ".")):
            continue
        # A task names its files alike in every folder, so the group goes into the name.
        inner = re.sub(rf"{GROUP}=([^/]*)/", r"group-\1-", inner)
        target = spark._jvm.org.apache.hadoop.fs.Path(where, inner)
        files.mkdirs(target.getParent())
        if not files.rename(path, target):
            raise OSError(f"could not move {path.toString()} to {target.toString()}")
