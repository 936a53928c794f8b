"""Projection and column shaping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def col(name: str) -> Column:
    """Column by name, quoted so names with spaces or dots resolve."""
    return F.col(f"`{name}`")


def rename_project(df: DataFrame, mapping: Mapping[str, "str | Column"]) -> DataFrame:
    """``{output_name: source_name_or_expression}`` -> one projection."""
    cols = []
    for out, src in mapping.items():
        c = col(src) if isinstance(src, str) else src
        cols.append(c.alias(out))
    return df.select(*cols)


def to_gold_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Select ``names`` (resolved case-insensitively against ``df``) and
    output them with exactly that spelling."""
    lower = {c.lower(): c for c in df.columns}
    return df.select(*[col(lower[n.lower()]).alias(n) for n in names])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant discriminator or unit measure column."""
    return df.withColumn(name, F.lit(value))


def null_col(name: str, dtype: "DataType | str") -> Column:
    """Typed NULL placeholder used to align union branches."""
    return F.lit(None).cast(dtype).alias(name)


def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Replace (or add) a column, matching an existing one case-insensitively."""
    lower = {c.lower(): c for c in df.columns}
    return df.withColumn(lower.get(name.lower(), name), expr)
