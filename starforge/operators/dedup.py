"""Distinct rows, one survivor per key, and per-client contract span
(A1-A3, A6).  All of them are hash aggregations with a partial
(map-side) step, so a hot key is pre-aggregated before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.session import known_size, remember_size


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_duplicates_all(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_one(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One deterministic survivor per ``keys``: the row that is smallest
    in ``order_by`` + remaining columns (ascending, NULLs first).

    Computed as ``min(struct(...))`` per key -- a partial aggregation, no
    sort and no window over a possibly huge key group.
    """
    order = list(order_by or [])
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(rest)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    out = agg.select(*keys, *[F.col(f"_best._v{i}").alias(c) for i, c in enumerate(rest)]) \
             .select(*df.columns)
    return remember_size(out, known_size(df))       # an upper bound: at most one row per input row


def contract_span(df: DataFrame, key: str = "cd_cliente", date: str = "dt_assinatura_contrato",
                  first: str = "dt_inicio_contrato", last: str = "dt_ultimo_contrato") -> DataFrame:
    """Per-key first/last date, one row per key (client-grain rollup)."""
    return df.groupBy(key).agg(F.min(date).alias(first), F.max(date).alias(last))


def attach_contract_span(df: DataFrame, key: str = "cd_cliente",
                         date: str = "dt_assinatura_contrato",
                         first: str = "dt_inicio_contrato",
                         last: str = "dt_ultimo_contrato") -> DataFrame:
    """Keep the row grain and add the key's first/last date to every row.

    Rolled up per key and joined back (one row per key on the right), not
    a window partitioned by key, so a client holding a large share of
    the rows is aggregated map-side.  The rollup is written once (its size
    observed during the write) and broadcast when that proves it small, so the rows themselves are not shuffled; beyond the bound it
    is a shuffle join that AQE can split on a hot key.
    """
    from starforge.operators.lookup import fits_broadcast
    from starforge.session import materialize
    span = materialize(contract_span(df, key, date, first, last), "contract_span")
    # grouped once more by the key: the planner then knows it to be unique,
    # and leaves the join out where neither date is read
    small = span.groupBy(F.col(key).alias("_span_key")).agg(F.min(first).alias(first), F.max(last).alias(last))
    small = F.broadcast(small) if fits_broadcast(span, span.columns) else small
    joined = df.join(small, F.col(key) == F.col("_span_key"), "left")
    return joined.select(*df.columns, first, last)
