"""Sinks: Parquet, JDBC, and once-computed multi-sink publishing."""

from starforge.sinks.jdbc import write_jdbc
from starforge.sinks.parquet import write_parquet
from starforge.sinks.publish import (JdbcTarget, SinkResult, StepFailed,
                                     publish, run_step)
from starforge.sinks.versioned import (feed_sinks, read_version, remove_orphans,
                                       versions, write_version)

__all__ = ["feed_sinks", "read_version", "remove_orphans", "versions", "write_version", "JdbcTarget", "SinkResult", "StepFailed", "publish",
           "run_step", "write_jdbc", "write_parquet"]
