"""Surrogate keys that last across runs.

A registry holds natural key -> surrogate key and only ever grows: a run numbers
the natural keys it has not seen, from the registry's largest number on, in their
own order.  Keys handed out never change and are never handed out again, whatever
a later run brings, and a rerun of the same rows adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.operators.keys import dense_key


def _same(left: DataFrame, right: DataFrame, natural: list[str]):
    cond = None
    for c in natural:
        c = left[c].eqNullSafe(right[f"_rg_{c}"])
        cond = c if cond is None else cond & c
    return cond


def _tagged(df: DataFrame, natural: list[str], *more: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"_rg_{c}") for c in natural], *more)


def unseen(rows: DataFrame, stored: DataFrame, natural: list[str]) -> DataFrame:
    """Rows whose natural key (NULLs are equal) is not in ``stored``."""
    other = _tagged(stored, natural)
    return rows.join(other, _same(rows, other, natural), "left_anti")


def new_keys(rows: DataFrame, registry: DataFrame | None, name: str, natural: list[str],
             key_type: str = "bigint") -> DataFrame:
    """Registry entries (natural columns, ``name``) for the natural keys of ``rows``
    that ``registry`` lacks: one each, numbered on from its largest key."""
    fresh = rows.select(*natural).distinct()
    start = 0
    if registry is not None:
        fresh = unseen(fresh, registry, natural)
        start = registry.agg(F.max(name)).first()[0] or 0
    keyed = dense_key(fresh, "_rg_key", order_by=natural, unique=True)
    return keyed.select(*natural, (F.col("_rg_key") + start).cast(key_type).alias(name))


def with_registered_keys(rows: DataFrame, registry: DataFrame, name: str, natural: list[str]) -> DataFrame:
    """``rows`` with their key in front (rows the registry lacks are dropped)."""
    other = _tagged(registry, natural, name)
    return rows.join(other, _same(rows, other, natural)).select(name, *[rows[c] for c in rows.columns])
