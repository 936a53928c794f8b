"""Session helpers: a sane local session for tests/bench, and the shared
scratch folder every lineage cut or round trip writes to.

On a cluster the scratch root is the folder named by the session's
checkpoint directory (``spark.checkpoint.dir``), which the cluster points
at shared storage.  Only when nothing is configured (local tests) do we
create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import weakref
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "starforge",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or attach to) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a local one only
    when the session names none (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    # the checkpoint dir itself is <dir>/<uuid>; scratch lives beside it
    path = f"{os.path.dirname(root) if '/' in root else root}/starforge-scratch/{name}-{uuid.uuid4().hex[:12]}"
    written = getattr(_scope, "paths", None)
    if written is not None:
        written.append(path)
    return path


_scope = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables that this thread names inside the block are removed
    (through the Hadoop file system) when it ends: nothing published may
    still read them by then.  Yields a function that takes a frame whose
    tables stay (those it reads are left to the enclosing block)."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    stay: set = set()

    def keep(df):
        files = df.inputFiles()
        stay.update(p for p in _scope.paths if any(f"/{os.path.basename(p)}/" in f for f in files))
        return df
    try:
        yield keep
    finally:
        paths, _scope.paths = _scope.paths, outer
        if outer is not None:
            outer += [p for p in paths if p in stay]
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            if path not in stay:
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(hadoop).delete(p, True)


@dataclass(frozen=True)
class Size:
    """Row count (or an upper bound of it) and the bytes that each text
    column holds over all rows (lower-case name -> bytes)."""
    rows: int
    text_bytes: dict


def observe_size(df):
    """``(df', read)``: after ``df'`` has been written, ``read()`` gives its
    :class:`Size`, observed during that write (no job of its own)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    obs = Observation(f"size_{uuid.uuid4().hex[:8]}")
    sums = [F.sum(F.octet_length(F.col(f"`{c}`"))).alias(f"bytes_{i}") for i, c in enumerate(texts)]
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"), *sums)

    def read() -> Size:
        got = obs.get
        return Size(int(got["rows"]), {c.lower(): int(got[f"bytes_{i}"] or 0) for i, c in enumerate(texts)})
    return seen, read


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict = {}                # session -> (writes under way, setting before them)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries begun inside the block remove their shuffle files when they
    end, not when the driver happens to collect its garbage.  Only for writes
    whose rows are read back from what was written: a frame that is executed
    again would shuffle again."""
    with _LOCK:
        n, before = _dropping.get(spark, (0, None))
        if n == 0:
            before = spark.conf.get(_DROP_SHUFFLES, "false")
            spark.conf.set(_DROP_SHUFFLES, "true")
        _dropping[spark] = (n + 1, before)
    try:
        yield
    finally:
        with _LOCK:
            n, before = _dropping.pop(spark)
            if n > 1:
                _dropping[spark] = (n - 1, before)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df, name: str, codec: str = "snappy"):
    """Write ``df`` once as Parquet under the shared scratch folder and
    return a DataFrame reading it back: a lineage cut that survives lost
    executors (the data lives in shared storage, not on a node).  The size
    is observed during the write and remembered on the result; the write's
    shuffle files go as soon as it ends.  ``codec`` "zstd" is for row-level
    tables only: the planner takes a file's size for that of its rows, so a
    key table packed too tightly would be broadcast."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen, read = observe_size(df)
    with shuffles_dropped(spark):
        seen.write.mode("overwrite").option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    remember_size(out, read())
    return out


# sizes (or proven upper bounds) known for DataFrame objects; entries vanish
# with their DataFrames
_KNOWN: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()
_LOCK = threading.Lock()            # jobs may be submitted from several threads


def remember_size(df, size: Size | None):
    """Record a size already known for ``df`` (nothing if None); returns ``df``.
    A frame that holds a subset of another's rows and columns may take over
    its size as an upper bound."""
    if size is not None:
        with _LOCK:
            _KNOWN[df] = size
    return df


def known_size(df) -> Size | None:
    with _LOCK:
        return _KNOWN.get(df)


# sizes of tables written by this process, with the files they hold for
_WRITTEN: dict[str, tuple[Size, frozenset]] = {}


def record_written(spark: SparkSession, path: str, size: Size, schema) -> None:
    """``schema``: of the rows written, so that listing the files reads no footer."""
    files = frozenset(spark.read.schema(schema).parquet(path).inputFiles())
    with _LOCK:
        _WRITTEN[path.rstrip("/")] = (size, files)


def forget_written(path: str) -> None:
    """Drop a size that no longer holds (the path was appended to)."""
    with _LOCK:
        _WRITTEN.pop(path.rstrip("/"), None)


def written_size(df, path: str) -> Size | None:
    """The size observed when this process wrote ``path``, provided that
    ``df`` reads exactly the files of that write: a table which anything
    else rewrote or appended to has an unknown size."""
    with _LOCK:
        size, files = _WRITTEN.get(path.rstrip("/"), (None, None))
    return size if size is not None and files == frozenset(df.inputFiles()) else None
