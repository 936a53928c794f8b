"""Lookups whose fact side has hot keys while both sides are too large to
broadcast (J2, J5, J10).

AQE splits a hot shuffle partition only where both sides come straight from
their shuffle; a side that is an aggregate is not split.  Here the keys that
hold ``share`` of the fact's rows or more are found first by the built-in
frequent-items sketch (one partial aggregation, bounded by ``SKETCH_ITEMS``
counters a task), and the fact is read in two parts: rows of a hot or NULL key
meet the few dimension rows of those keys as a broadcast, so they are not
shuffled at all; the rest is a shuffle join without hot keys.

The sketch decides only how rows travel: whatever it reports, the result is
that of the plain join.  The hot dimension rows are written once with their size
observed; beyond the broadcast bound (many rows for one key) they are left to a
shuffle join of two scanned tables, which AQE can split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.operators.lookup import KeyPair, fits_broadcast, lookup
from starforge.session import known_size, materialize

HOT_SHARE = 0.01            # a key with this share of the rows is hot: 100 keys at most
SKETCH_ITEMS = 16_384


def hot_keys(df: DataFrame, key: "str | Column", share: float = HOT_SHARE) -> list:
    """The values (NULL left out) that stand in about ``share`` of the rows
    of ``df`` or more, by one job with a mergeable sketch."""
    key = F.col(key) if isinstance(key, str) else key
    most = math.ceil(1 / share)
    seen = df.select(key.alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(SKETCH_ITEMS, most)})").alias("top")).first()
    return [t[0] for t in seen["top"] or [] if t[0] is not None and t[1] >= share * seen["n"]]


def lookup_split(fact: DataFrame, dim: DataFrame, on: KeyPair, take: Sequence[str], how: str = "inner",
                 share: float = HOT_SHARE, tag: str = "lk") -> DataFrame:
    """:func:`lookup` on one key (``how`` inner or left) with the fact's hot
    and NULL keys kept out of the shuffle.  The fact is read three times (the
    sketch reads its key alone), so it should be a table at rest."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    of_fact, of_dim = on
    key = F.col(of_fact) if isinstance(of_fact, str) else of_fact
    values = hot_keys(fact, key, share)
    is_hot = F.coalesce(key.isin(values), F.lit(True)) if values else key.isNull()
    few = materialize(dim.filter(F.col(of_dim).isin(values) if values else F.lit(False)).select(
        *dict.fromkeys([of_dim, *take])), "hot_dim")
    hint = fits_broadcast(few, few.columns)
    hot = lookup(fact.filter(is_hot), few, [on], take, how, broadcast=hint, tag=tag)
    rest = lookup(fact.filter(~is_hot), dim, [on], take, how, broadcast="auto", tag=tag)
    return hot.unionAll(rest)


def known_large(dim: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the size of ``dim`` is known and beyond the broadcast bound."""
    return known_size(dim) is not None and not fits_broadcast(dim, columns)
