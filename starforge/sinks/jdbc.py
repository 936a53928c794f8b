"""JDBC sinks (K3, K4).  Connection details always come from the caller;
nothing is hard-wired."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batchsize: int = 10_000,
               num_partitions: int | None = None, truncate: bool = True) -> None:
    """Write ``df`` to ``table``.  ``mode='overwrite'`` truncates instead of
    dropping (keeps the table's DDL and grants) unless ``truncate=False``;
    ``num_partitions`` caps the number of concurrent connections."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batchsize))
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
