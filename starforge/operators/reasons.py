"""Why a row is dropped: a chain of lookups in one pass.

Each lookup is a left join that sets a bit where the key is NULL or unknown,
instead of an inner join that drops the row.  The rows are written once, with
the count of each bit observed in that write, and read back as the fact's rows
(no bit) and the quarantine (any bit).  A row that fails several lookups names
them all.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starforge.operators.lookup import KeyPair, fits_broadcast
from starforge.session import materialize

MASK = "_failed"


@dataclass(frozen=True)
class Lookup:
    """A lookup into ``dim`` (unique on its keys): ``take`` maps the names of
    new columns to columns of the dimension; none only tests existence."""
    reason: str
    dim: DataFrame
    on: Sequence[KeyPair]
    take: dict[str, str] = field(default_factory=dict)


def lookup_with_reasons(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """``fact``, the taken columns, and a bit mask of the lookups that failed."""
    out, mask = fact, F.lit(0)
    for k, x in enumerate(lookups):
        keys = [F.col(d).alias(f"_rs{k}_{i}") for i, (_, d) in enumerate(x.on)]
        side = x.dim.select(*keys, *[F.col(c).alias(n) for n, c in x.take.items()], F.lit(True).alias(f"_rs{k}"))
        if fits_broadcast(x.dim, [d for _, d in x.on] + list(x.take.values())):
            side = F.broadcast(side)
        cond = None
        for i, (f, _) in enumerate(x.on):
            same = (F.col(f) if isinstance(f, str) else f) == F.col(f"_rs{k}_{i}")
            cond = same if cond is None else cond & same
        out = out.join(side, cond, "left").drop(*[f"_rs{k}_{i}" for i in range(len(x.on))])
        mask = mask + F.when(F.col(f"_rs{k}").isNull(), F.lit(1 << k)).otherwise(0)
    return out.withColumn(MASK, mask.cast("int")).drop(*[f"_rs{k}" for k in range(len(lookups))])


def reasons_of(lookups: Sequence[Lookup]) -> Column:
    """The failed lookups of a row, in their order."""
    named = [F.when(F.col(MASK).bitwiseAND(1 << k) != 0, F.lit(x.reason)) for k, x in enumerate(lookups)]
    return F.array_compact(F.array(*named))


@dataclass(frozen=True)
class Checked:
    kept: DataFrame
    quarantine: DataFrame       # the fact's own columns and ``reasons``
    rows: int
    failed: dict[str, int]      # per lookup; a row may count for several
    rejected: int


def split_by_reasons(fact: DataFrame, lookups: Sequence[Lookup], name: str = "checked") -> Checked:
    """Run all lookups once and split the written rows."""
    marked = lookup_with_reasons(fact, lookups)
    seen = Observation(f"reasons_{uuid.uuid4().hex[:8]}")
    bit = lambda k: F.sum(F.when(F.col(MASK).bitwiseAND(1 << k) != 0, 1).otherwise(0))      # noqa: E731
    written = materialize(marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col(MASK) != 0, 1).otherwise(0)).alias("rejected"),
        *[bit(k).alias(f"bit_{k}") for k in range(len(lookups))]), name, codec="zstd")
    got = seen.get
    return Checked(
        kept=written.filter(F.col(MASK) == 0).drop(MASK),
        quarantine=written.filter(F.col(MASK) != 0).select(
            *[F.col(f"`{c}`") for c in fact.columns], reasons_of(lookups).alias("reasons")),
        rows=int(got["rows"]), failed={x.reason: int(got[f"bit_{k}"] or 0) for k, x in enumerate(lookups)},
        rejected=int(got["rejected"] or 0))
