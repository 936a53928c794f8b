"""Dimension lookups and join-based filters.

A lookup returns the fact's own columns plus the requested dimension
columns only (never ``dim.*``), so duplicate names cannot become
ambiguous later.  A side is hinted for broadcast only if its size is
known -- rows and text bytes observed while it was written -- and within
``max_rows`` and ``BROADCAST_MAX_BYTES``; otherwise the join is left to
the planner and AQE (shuffle join with skew splitting, or a runtime
broadcast when the measured size is small).  Planning starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.session import known_size

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 << 20
# types that take at most 16 bytes beside their 8-byte slot of a row
_FIXED = {"boolean", "byte", "short", "integer", "date", "float", "long", "double", "timestamp",
          "timestamp_ntz", "decimal", "void"}

KeyPair = tuple["str | Column", str]


def bytes_bound(dim: DataFrame, columns: Sequence[str]) -> int | None:
    """Upper bound of the bytes that ``columns`` of ``dim`` take as rows in
    memory, from the size observed when it was written; None if unknown."""
    size = known_size(dim)
    if size is None:
        return None
    types = {f.name.lower(): f.dataType.typeName() for f in dim.schema.fields}
    total = size.rows * (24 + 24 * len(columns))       # row header, slots, padding of text to words
    for c in {c.lower() for c in columns}:
        if types.get(c) not in _FIXED:
            if c not in size.text_bytes:
                return None
            total += size.text_bytes[c]
    return total


def fits_broadcast(dim: DataFrame, columns: Sequence[str], max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    total = bytes_bound(dim, columns)
    return total is not None and known_size(dim).rows <= max_rows and total <= max_bytes


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint ``dim`` for broadcast only if its size is proven small."""
    return F.broadcast(dim) if fits_broadcast(dim, dim.columns, max_rows, max_bytes) else dim


def _fact_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _prepare(dim: DataFrame, on: Sequence[KeyPair], take: Sequence[str], tag: str):
    dim_keys = [d for _, d in on]
    renamed = {d: f"_{tag}_k{i}" for i, d in enumerate(dim_keys)}
    cols = [F.col(d).alias(renamed[d]) for d in dim_keys]
    cols += [F.col(t) for t in take]          # a key may also be taken under its own name
    small = dim.select(*cols)
    cond = None
    for f, d in on:
        c = _fact_col(f) == F.col(renamed[d])
        cond = c if cond is None else cond & c
    return small, cond, list(renamed.values())


def _hinted(small: DataFrame, dim: DataFrame, on: Sequence[KeyPair], take: Sequence[str],
            broadcast: bool | str, max_rows: int) -> DataFrame:
    if broadcast == "auto":
        broadcast = fits_broadcast(dim, [d for _, d in on] + list(take), max_rows)
    return F.broadcast(small) if broadcast else small


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[KeyPair], take: Sequence[str],
           how: str = "inner", broadcast: bool | str = "auto",
           max_rows: int = BROADCAST_MAX_ROWS, tag: str = "lk") -> DataFrame:
    """Equi-join ``fact`` to ``dim`` on ``[(fact_col_or_expr, dim_col), ...]``
    and return the fact's columns plus ``take`` (dimension columns).

    ``broadcast``: True = hint (caller vouches for the size), "auto" = hint
    only if :func:`fits_broadcast`, False = leave it to the planner.
    """
    small, cond, tmp = _prepare(dim, on, take, tag)
    small = _hinted(small, dim, on, take, broadcast, max_rows)
    joined = fact.join(small, cond, how)
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *take)


def require_in(fact: DataFrame, dim: DataFrame, on: Sequence[KeyPair],
               broadcast: bool | str = "auto", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Existence filter: keep fact rows whose key occurs in ``dim``
    (``left_semi``; never multiplies rows)."""
    small, cond, _ = _prepare(dim, on, [], "rq")
    small = _hinted(small, dim, on, [], broadcast, max_rows)
    return fact.join(small, cond, "left_semi")


def rejects(fact: DataFrame, dim: DataFrame, on: Sequence[KeyPair],
            broadcast: bool | str = "auto", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Audit of an inner lookup: fact rows it would drop (NULL or unknown
    key), as a ``left_anti`` join."""
    small, cond, _ = _prepare(dim, on, [], "rj")
    small = _hinted(small, dim, on, [], broadcast, max_rows)
    return fact.join(small, cond, "left_anti")


def role_join(fact: DataFrame, dim: DataFrame, key: str, value: str,
              roles: dict[str, "str | Column"], how: str = "inner",
              broadcast: bool | str = "auto") -> DataFrame:
    """Role-playing dimension: join one dimension once per role.

    ``roles`` maps the output column name to the fact column (or
    expression) playing that role; each role takes ``value`` from ``dim``
    matched on ``key``.  Every role selects the same two dimension
    columns, so the dimension is scanned/broadcast once and reused.
    """
    small = dim.select(key, value)
    hint = fits_broadcast(dim, [key, value]) if broadcast == "auto" else bool(broadcast)
    out = fact
    for i, (alias, fcol) in enumerate(roles.items()):
        d = small.select(F.col(key).alias(f"_rl{i}_k"), F.col(value).alias(alias))
        d = F.broadcast(d) if hint else d
        out = out.join(d, _fact_col(fcol) == F.col(f"_rl{i}_k"), how).drop(f"_rl{i}_k")
    return out


def enrich(fact: DataFrame, mapping: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """USING-join enrichment (J2, J7): ``fact.join(mapping, on, how)``."""
    return fact.join(mapping, on, how)
