"""Surrogate keys.

A key numbered ``1..n`` in a total order is normally written as
``row_number().over(Window.orderBy(...))``, which moves every row into one
task.  ``dense_key`` computes the same numbers with the work spread over
all partitions:

1. identical rows are collapsed into one row with a count (partial
   aggregation, so a group of copies holding a third of the data costs
   no more than any other group) and the count is split into chunks of
   at most ``CHUNK`` rows;
2. the chunks are range-partitioned on the total order (every chunk is a
   distinct sort key, so even a hot group of copies is spread out), the
   copies are re-expanded inside their partition and sorted within the
   partition;
3. in the same pass every row records its partition id and its position
   inside the partition, and the rows are written once as a Parquet
   table under the session's shared checkpoint folder (this cuts the
   lineage: later passes read the same rows, and a lost executor cannot
   renumber anything);
4. one small aggregation over the partition-id column counts rows per
   partition; only these counts (one number per partition, bounded by the
   partition count, not by the data) reach the driver, where they become
   running offsets that are broadcast back; key = offset + position + 1.

Rows that are fully identical are interchangeable, so the result set is
exactly that of the global ``row_number`` over the same order.

When the rows carry a stable source identity (``tiebreak``: e.g. the file
and row index of the Parquet row they come from, see
:func:`with_row_identity`), that identity ends the sort key: the order is
then strict, copies are already distinct keys for the range partitioner,
and step 1 (a full shuffle of the input) is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.session import Size, ensure_checkpoint_dir, known_size, materialize, remember_size

CHUNK = 1 << 20
_POS_MASK = (1 << 33) - 1

# columns of a source-row identity (see with_row_identity)
ROW_ID = ["_rid_file", "_rid_row"]


def with_row_identity(df: DataFrame) -> DataFrame:
    """Add a stable identity of each source row: a 64-bit hash of its
    Parquet file path and its row index in that file.  Must be applied to
    a file scan (before any join); it is the same on every recomputation,
    so it is a safe final tie-breaker for :func:`dense_key`.  Two rows can
    only share it if their file hashes collide at the same index, which at
    worst leaves the order of those two rows open -- harmless, as then
    nothing after the identity decides anything."""
    return df.select("*", F.xxhash64(F.col("_metadata.file_path")).alias(ROW_ID[0]),
                     F.col("_metadata.row_index").alias(ROW_ID[1]))


def identity_of(df: DataFrame) -> list[str] | None:
    return ROW_ID if all(c in df.columns for c in ROW_ID) else None


def total_order(df: DataFrame, order_by: list[str] | None = None) -> list[str]:
    """``order_by`` followed by every other column in schema order."""
    first = list(order_by or [])
    return first + [c for c in df.columns if c not in first]


def _asc(names: list[str]) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def dense_key(df: DataFrame, name: str, order_by: list[str] | None = None,
              unique: bool = False, key_type: str = "bigint",
              num_partitions: int | None = None,
              tiebreak: list[str] | None = None, keep: list[str] | None = None,
              codec: str = "zstd") -> DataFrame:
    """Add ``name`` = 1..n following the total order ``order_by`` + all
    remaining columns (ascending, NULLs first).  ``unique=True`` skips the
    copy collapse when rows are known to be distinct; ``tiebreak`` names
    columns that end the sort key and make it strict (they are not part
    of the output).  Returns the key followed by the original columns, or
    those of ``keep`` (all of them decide the order).  ``codec``: of the rows
    written (see :func:`materialize`)."""
    ensure_checkpoint_dir(df.sparkSession)
    extra = list(tiebreak or [])
    cols = [c for c in df.columns if c not in extra]
    kept = cols if keep is None else keep
    order = total_order(df.select(*cols), order_by) + extra
    unique = unique or bool(extra)

    def _range(d: DataFrame, keys: list[Column]) -> DataFrame:
        if num_partitions:
            return d.repartitionByRange(num_partitions, *keys)
        return d.repartitionByRange(*keys)

    if unique:
        staged = _range(df, _asc(order)).withColumn("_sk_copy", F.lit(0).cast("bigint"))
    else:
        counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_sk_n"))
        chunked = counted.withColumn(
            "_sk_chunk",
            F.explode(F.sequence(F.lit(0).cast("bigint"),
                                 F.floor((F.col("_sk_n") - 1) / CHUNK).cast("bigint"))))
        ranged = _range(chunked, _asc(order) + [F.col("_sk_chunk").asc()])
        lo = F.col("_sk_chunk") * CHUNK
        hi = F.least(F.col("_sk_n"), (F.col("_sk_chunk") + 1) * CHUNK) - 1
        staged = (ranged.withColumn("_sk_copy", F.explode(F.sequence(lo, hi)))
                        .drop("_sk_n", "_sk_chunk"))

    ordered = staged.sortWithinPartitions(*_asc(order), F.col("_sk_copy").asc())
    placed = ordered.select(
        *kept, F.spark_partition_id().alias("_sk_p"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)).alias("_sk_pos"))
    stored = materialize(placed, "dense_key", codec)

    counts = sorted(tuple(r) for r in
                    stored.groupBy("_sk_p").agg(F.count(F.lit(1))).collect())
    rows, running = [], 0
    for pid, n in counts:
        if n > _POS_MASK:
            raise ValueError(f"partition {pid} holds {n} rows, more than a position can count")
        rows.append((pid, running))
        running += n
    spark = df.sparkSession
    offsets = spark.createDataFrame(rows, "_sk_p int, _sk_off bigint")
    keyed = stored.join(F.broadcast(offsets), "_sk_p", "inner")
    key = (F.col("_sk_off") + F.col("_sk_pos") + 1).cast(key_type)
    out = keyed.select(key.alias(name), *kept)
    return remember_size(out, Size(running, known_size(stored).text_bytes))


def surrogate_key(df: DataFrame, name: str, order_by: list[str],
                  unique: bool = True, key_type: str = "int") -> DataFrame:
    """Dimension key (W1): ``row_number`` over the natural key, computed
    with :func:`dense_key` so it never runs in a single task."""
    return dense_key(df, name, order_by=order_by, unique=unique, key_type=key_type, codec="snappy")
