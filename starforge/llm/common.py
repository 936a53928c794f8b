"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.session import materialize

WHITE = "[\\x20\\x09-\\x0D]+"        # separators of the white-space words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column can clash with the
    columns an operator adds."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: later steps
    survive lost executors without recomputing what is above."""
    return materialize(df, f"llm-{name}")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from (a NULL id counts as held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partition count that keeps about ``per_part`` rows in each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // per_part))


def release_memory() -> None:
    """Hand freed memory of a Python worker back to the machine: workers live on
    from stage to stage beside the executor's JVM."""
    import ctypes
    import gc

    import pyarrow
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU library
    if trim is not None:
        trim(0)
