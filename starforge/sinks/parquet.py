"""Parquet sinks (K1, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  sort_within: list[str] | None = None) -> None:
    """Write ``df`` as Parquet.  ``sort_within`` sorts each output file
    (no global sort, no single-partition exchange)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    df.write.mode(mode).parquet(path)
