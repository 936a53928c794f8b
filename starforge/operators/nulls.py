"""Null policies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starforge.schemas import MISSING_SCORE, UNKNOWN_TEXT


def fill_unknown(df: DataFrame, cols: list[str], value: str = UNKNOWN_TEXT) -> DataFrame:
    """Missing text -> a placeholder string."""
    return df.na.fill({c: value for c in cols})


def fill_missing_score(df: DataFrame, cols: list[str], value: int = MISSING_SCORE) -> DataFrame:
    """Missing numeric score -> sentinel.  Scores are typed double by the
    fixed silver schema, so the sentinel is never skipped the way a
    numeric fill skips a text-typed column."""
    return df.na.fill(value, subset=cols)


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing measure after an outer join -> 0."""
    return df.na.fill(0, subset=cols)
