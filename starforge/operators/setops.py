"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def observed_dates(*sources: tuple[DataFrame, str], name: str = "DATA") -> DataFrame:
    """Distinct non-NULL dates observed in several columns (SQL UNION).

    Each branch projects one column, so the scans read only that column;
    the NULL filter is pushed below the union into every scan and the
    distinct is partially aggregated per branch before the shuffle.
    """
    branches = [df.select(F.col(c).cast("date").alias(name)) for df, c in sources]
    return reduce(DataFrame.union, branches).distinct().filter(F.col(name).isNotNull())


def union_by_name(branches: list[DataFrame], schema: StructType | None = None) -> DataFrame:
    """Union by column name.  With ``schema`` every branch is first cast to
    it and missing columns become typed NULLs, so branch types can never
    drift (no untyped NULL columns)."""
    if schema is not None:
        fixed = []
        for b in branches:
            have = set(b.columns)
            fixed.append(b.select(*[
                (F.col(f.name).cast(f.dataType) if f.name in have
                 else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields]))
        branches = fixed
    return reduce(lambda a, b: a.unionByName(b), branches)
