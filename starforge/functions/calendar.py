"""Calendar attributes (C8-C11), all built-in and codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col) -> Column:
    """Smart integer key ``yyyyMMdd`` computed arithmetically (no string)."""
    d = _c(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(col) -> Column:
    """English month name, e.g. ``March``."""
    return F.date_format(_c(col), "MMMM")


def quarter_label(col) -> Column:
    """``Q1`` .. ``Q4``."""
    return F.concat(F.lit("Q"), F.quarter(_c(col)).cast("string"))


def calendar_attributes(col) -> list[Column]:
    """SK_TEMPO, DATA, ANO, MES, NOME_MES, TRIMESTRE for a date column."""
    d = _c(col)
    return [
        date_key(d).alias("SK_TEMPO"),
        d.alias("DATA"),
        F.year(d).alias("ANO"),
        F.month(d).alias("MES"),
        month_name(d).alias("NOME_MES"),
        quarter_label(d).alias("TRIMESTRE"),
    ]
