"""Publishing a gold table to several sinks (K5) and guarded steps (K6).

The table is computed once: it is written to Parquet first, and every
other sink is fed from that Parquet copy, so all copies carry identical
rows and keys and the lineage is never recomputed per sink.  A failing
sink is reported; if the Parquet copy fails, no other sink is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from starforge.session import forget_written, observe_size, record_written
from starforge.sinks.jdbc import write_jdbc
from starforge.sinks.parquet import write_parquet


@dataclass
class SinkResult:
    sink: str
    ok: bool
    rows: int | None = None
    error: str | None = None


@dataclass
class JdbcTarget:
    url: str
    table: str
    mode: str = "overwrite"
    properties: dict = field(default_factory=dict)
    num_partitions: int | None = None       # most connections open at once


def publish(df: DataFrame, parquet_path: str, jdbc: JdbcTarget | None = None,
            parquet_mode: str = "overwrite",
            sort_within: list[str] | None = None) -> list[SinkResult]:
    """Write Parquet (observing the size during the write), then feed
    the JDBC table from the written Parquet."""
    results: list[SinkResult] = []
    observed, read = observe_size(df)
    forget_written(parquet_path)
    try:
        write_parquet(observed, parquet_path, parquet_mode, sort_within)
        size = read()
        if parquet_mode == "overwrite":
            record_written(df.sparkSession, parquet_path, size, df.schema)
        results.append(SinkResult("parquet", True, size.rows))
    except Exception as e:  # noqa: BLE001 - reported
        results.append(SinkResult("parquet", False, error=str(e)))
    if jdbc is not None and not results[0].ok:
        results.append(SinkResult("jdbc", False, error="not written: the Parquet copy failed"))
    elif jdbc is not None:
        try:
            source = df.sparkSession.read.parquet(parquet_path)
            write_jdbc(source, jdbc.url, jdbc.table, jdbc.mode, jdbc.properties,
                       num_partitions=jdbc.num_partitions)
            results.append(SinkResult("jdbc", True, results[0].rows))
        except Exception as e:  # noqa: BLE001
            results.append(SinkResult("jdbc", False, error=str(e)))
    return results


class StepFailed(RuntimeError):
    pass


def run_step(name: str, fn: Callable[[], object]):
    """Run one load step; a failure stops the run with the step's name
    instead of continuing into undefined inputs."""
    try:
        return fn()
    except Exception as e:
        raise StepFailed(f"step {name!r} failed: {e}") from e
