"""Tables that survive a failed write, and sinks that can be resumed (K1, K2, K5, K6).

A table is a folder with data folders, each written once and never changed, and
``_versions/<number>``: small JSON files that list the data folders of a version
with its schema and observed size.  A write first fills a fresh data folder, then
commits by renaming one finished file to the next number; the rename fails where
that number exists (another writer was first), and the commit is tried again on
top of it.  Readers resolve the highest number, so they see one version whole,
whatever is being written or has died half-way.  The file system's rename must be
atomic, as HDFS's is.

Expired versions go after a commit, with the data that no kept version lists.
Folders of dead writers stay until :func:`remove_orphans`.

A ledger file per data folder and sink says which copies are done:
:func:`feed_sinks` gives each sink the folders it lacks, oldest first, never the
whole table again, and a rerun repeats only what failed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starforge.session import Size, observe_size, remember_size
from starforge.sinks.publish import SinkResult

KEEP = 2        # versions that stay readable


@dataclass(frozen=True)
class Version:
    number: int
    folders: list[str]      # relative to the table, oldest first
    counts: list[int]       # rows of each folder
    schema: str
    text_bytes: dict

    @property
    def rows(self) -> int:
        return sum(self.counts)


class _Files:
    """The few file operations needed, on the table's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        self.once = spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> dict[str, int]:
        """Names under a folder -> time of their last change (milliseconds)."""
        p = self.path(folder)
        if not self.fs.exists(p):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(p)}

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put a finished file under ``name``; False if there is one already."""
        draft = self.path(f"_drafts/{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.fs.mkdirs(self.path(name).getParent())
        try:
            self.context.rename(draft, self.path(name), self.once)
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
            self.fs.delete(draft, False)
            if self.fs.exists(self.path(name)):
                return False
            raise e

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n) for n in files.names("_versions") if n.isdigit())


def _version(files: _Files, number: int) -> Version:
    return Version(number=number, **json.loads(files.read(f"_versions/{number:010d}")))


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All readable versions, oldest first; none if the table was never committed."""
    files = _Files(spark, path)
    return [_version(files, n) for n in _numbers(files)]


def current(spark: SparkSession, path: str) -> Version | None:
    files = _Files(spark, path)
    numbers = _numbers(files)
    return _version(files, numbers[-1]) if numbers else None


def read_version(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """A version (the current one by default).  Schema and size come from the
    version file: no job, no footer is read."""
    version = version or current(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path}: no committed version")
    return remember_size(_read(spark, path, version, version.folders), Size(version.rows, version.text_bytes))


def _read(spark: SparkSession, path: str, version: Version, folders: list[str]) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(version.schema))).parquet(
        *[f"{path.rstrip('/')}/{f}" for f in folders])


def write_version(df: DataFrame, path: str, mode: str = "overwrite", sort_within: list[str] | None = None,
                  keep: int = KEEP) -> Version:
    """Write ``df`` and commit it as the next version: alone (``overwrite``) or
    beside the folders of the version before (``append``)."""
    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    spark = df.sparkSession
    files, folder = _Files(spark, path), f"data-{uuid.uuid4().hex}"
    seen, read = observe_size(df)
    if sort_within:
        seen = seen.sortWithinPartitions(*sort_within)
    seen.write.mode("error").parquet(f"{files.root}/{folder}")
    size = read()
    schema = df.schema.json()
    while True:
        numbers = _numbers(files)
        before = _version(files, numbers[-1]) if numbers else None
        counts, texts, folders = [size.rows], dict(size.text_bytes), [folder]
        if mode == "append" and before is not None:
            if StructType.fromJson(json.loads(before.schema)).names != df.schema.names:
                files.delete(folder)
                raise ValueError(f"{path}: other columns than version {before.number}")
            counts, folders = before.counts + counts, before.folders + folders
            texts = {c: n + before.text_bytes.get(c, 0) for c, n in texts.items()}
        body = {"folders": folders, "counts": counts, "schema": schema, "text_bytes": texts}
        number = numbers[-1] + 1 if numbers else 1
        if files.create(f"_versions/{number:010d}", json.dumps(body)):
            _expire(files, keep)
            return Version(number=number, **body)


def _expire(files: _Files, keep: int) -> None:
    """Remove all but the last ``keep`` versions, and data only they listed."""
    numbers = _numbers(files)
    old, kept = numbers[:-keep], numbers[-keep:]
    held = {f for n in kept for f in _version(files, n).folders}
    for n in old:
        gone = set(_version(files, n).folders) - held
        files.delete(f"_versions/{n:010d}")         # first: a version never lists missing data
        for f in gone:
            files.delete(f)


def remove_orphans(spark: SparkSession, path: str, older_than_seconds: float) -> list[str]:
    """Delete data folders that no version lists and that were last changed so
    long ago that no living writer can still mean to commit them."""
    files = _Files(spark, path)
    listed = {f for n in _numbers(files) for f in _version(files, n).folders}
    limit = (time.time() - older_than_seconds) * 1000
    gone = [n for n, at in files.names("").items() if n.startswith("data-") and n not in listed and at <= limit]
    for name in gone:
        files.delete(name)
    return sorted(gone)


def feed_sinks(spark: SparkSession, path: str, sinks: dict[str, Callable[[DataFrame, str], None]]) -> list[SinkResult]:
    """Give each sink the data folders of the current version it has not got,
    oldest first: the first with ``overwrite``, those appended since with
    ``append``.

    A success is entered in the ledger, so a rerun repeats only what failed; a
    sink that fails gets no later folder before the failed one.  A sink that
    dies between its write and the entry is called again."""
    files, version, out = _Files(spark, path), current(spark, path), []
    done = set(files.names("_ledger"))
    for name, write in sinks.items():
        rows, error = 0, None
        for k, (folder, n) in enumerate(zip(version.folders, version.counts) if version else ()):
            if f"{folder}-{name}" in done:
                continue
            try:
                write(_read(spark, path, version, [folder]), "append" if k else "overwrite")
            except Exception as e:  # noqa: BLE001 - reported
                error = str(e)
                break
            files.create(f"_ledger/{folder}-{name}", json.dumps({"version": version.number, "rows": n}))
            rows += n
        out.append(SinkResult(name, error is None, rows, error))
    return out


__all__ = ["KEEP", "Version", "current", "feed_sinks", "read_version", "remove_orphans",
           "versions", "write_version"]
