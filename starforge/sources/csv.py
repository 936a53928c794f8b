"""Delimited-text scans."""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             sep: str = ";", header: bool = True, infer: bool = False,
             mode: str = "PERMISSIVE") -> DataFrame:
    """Scan delimited text with a header.

    ``path`` may be a file, a directory or a glob (``.../telemetria_*``):
    every matching file becomes part of one table, and each file's header
    line is skipped.  With a fixed ``schema`` the columns are found by their
    header names: a file may hold more columns, in any order.  Only the
    header line is read for that; there is no inference pass and no type
    drift.  A name the header lacks raises, and so does (while scanning) a
    file of the glob whose header differs from the first one's.
    ``infer=True`` is the opt-in extra pass over the data.
    """
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("mode", mode).option("encoding", "UTF-8"))
    if schema is not None and header:
        names = header_names(spark, path, sep) or reader.csv(path).columns
        missing = [f.name for f in schema if f.name not in names]
        if missing:
            raise ValueError(f"{path}: no column {missing} in the header {names}")
        text = StructType([StructField(n, StringType()) for n in names])
        df = reader.schema(text).option("enforceSchema", False).csv(path)
        return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def header_names(spark: SparkSession, path: str | list[str], sep: str) -> list[str] | None:
    """Column names in the first line of the first file, read through the
    file system without a Spark job; None where that line is not plain text
    (compressed or quoted), which is left to the reader."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path if isinstance(path, str) else path[0])
    fs = at.getFileSystem(conf)
    found = sorted(fs.globStatus(at) or [], key=lambda s: s.getPath().toString())
    files = []
    for status in found:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        files += [s for s in inside if s.isFile() and s.getLen() and s.getPath().getName()[0] not in "._"]
        if files:
            break
    if not files:
        return None
    file = min(files, key=lambda s: s.getPath().toString()).getPath()
    if jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file) is not None:
        return None
    stream = fs.open(file)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    names = (line or "").removeprefix("\ufeff").split(sep)
    plain = all(n.strip() == n and n for n in names) and '"' not in line and len({n.lower() for n in names}) == len(names)
    return names if plain else None


HEADER_READERS = 16         # first lines read at a time


@dataclass(frozen=True)
class HeaderVariant:
    """One header among the files of a table."""
    names: tuple[str, ...]
    files: tuple[str, ...]
    missing: tuple[str, ...]        # columns of the schema it lacks
    extra: tuple[str, ...]          # columns it has beside the schema's


def data_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files that a scan of ``path`` (files, directories, globs) reads:
    not empty, not hidden."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for one in [path] if isinstance(path, str) else path:
        at = jvm.org.apache.hadoop.fs.Path(one)
        fs = at.getFileSystem(conf)
        for status in fs.globStatus(at) or []:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [s.getPath().toString() for s in inside
                    if s.isFile() and s.getLen() and s.getPath().getName()[0] not in "._"]
    return sorted(set(out))


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a (possibly compressed) text file, through the file
    system: the rest of the file is not read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(file)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").removeprefix("\ufeff")


def _matched(schema: StructType, names: tuple[str, ...], aliases: dict[str, str]) -> dict[str, int]:
    """Schema column -> position in a header: the same name, else an alias,
    else the same but for case and outer spaces."""
    plain = {n: n.strip().lower() for n in names}
    out = {}
    for want in schema.names:
        same = [i for i, n in enumerate(names) if n == want]
        same = same or [i for i, n in enumerate(names) if aliases.get(n) == want]
        same = same or [i for i, n in enumerate(names) if plain[n] == want.strip().lower()]
        if len(same) > 1:
            raise ValueError(f"column {want} stands {len(same)} times in the header {list(names)}")
        if same:
            out[want] = same[0]
    return out


def header_variants(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ";",
                    aliases: dict[str, str] | None = None) -> list[HeaderVariant]:
    """The catalogue of headers under ``path``: the first line of every file
    (``HEADER_READERS`` at a time, no Spark job), files grouped by it, in the
    order of their first files."""
    files = data_files(spark, path)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    groups: dict[tuple, list[str]] = defaultdict(list)
    for file, line in zip(files, lines):
        groups[tuple(next(csv.reader([line], delimiter=sep), []))].append(file)
    out = []
    for names, held in groups.items():
        at = _matched(schema, names, aliases or {})
        out.append(HeaderVariant(names, tuple(held), tuple(n for n in schema.names if n not in at),
                                 tuple(n for i, n in enumerate(names) if i not in at.values())))
    return out


def read_csv_variants(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ";",
                      required: list[str] = (), aliases: dict[str, str] | None = None,
                      mode: str = "PERMISSIVE") -> tuple[DataFrame, list[HeaderVariant]]:
    """Files whose headers differ as one table, and the catalogue of their
    headers.

    Files with one header are one scan, so the plan grows with the number of
    different headers, not of files.  Columns are found by name (``aliases``:
    header name -> schema name; else case and outer spaces may differ), those
    that a header lacks are typed NULLs and its extra ones are not read.  A
    header without a ``required`` column raises before anything is scanned,
    and so does one that names a column twice.  Without files the table is
    empty.
    """
    variants = header_variants(spark, path, schema, sep, aliases)
    for v in variants:
        lacking = [c for c in required if c in v.missing]
        if lacking:
            raise ValueError(f"no column {lacking} in the header {list(v.names)} of {list(v.files[:5])}"
                             f" ({len(v.files)} files)")
    reader = (spark.read.option("sep", sep).option("header", True).option("mode", mode)
              .option("encoding", "UTF-8"))
    scans = []
    for v in variants:
        at = _matched(schema, v.names, aliases or {})
        text = StructType([StructField(f"c{i}", StringType()) for i in range(len(v.names))])
        rows = reader.schema(text).csv(list(v.files))       # by position: the header is this group's own
        scans.append(rows.select(*[
            (F.col(f"c{at[f.name]}").try_cast(f.dataType) if f.name in at
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]))
    if not scans:
        return spark.createDataFrame([], schema), variants
    return reduce(DataFrame.unionAll, scans), variants


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    """Land a DataFrame as delimited text with a header (used to stage
    bronze extracts)."""
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)
