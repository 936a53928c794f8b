"""ANSI-safe parsing of raw extract text.

Spark 4 runs with ANSI on: a plain ``cast`` or ``to_date`` of bad text
aborts the job.  The extracts do contain bad text, and the source
semantics are "bad text becomes NULL", so every parser here is a
``try_*`` built-in and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the date patterns used by the extracts
ISO_DATE = "yyyy-MM-dd"
ISO_T_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"
# US answers carry a meridiem; the extract mixes 12-hour clock values
# ("1:05:00 PM") with 24-hour ones ("13:05:00 PM"), so both are tried
US_MERIDIEM_12H = "M/d/yyyy h:mm:ss a"
US_MERIDIEM_24H = "M/d/yyyy H:mm:ss a"
# texts of ISO_DATE on which the cast agrees with the pattern (which reads the
# year of an era, so not the year 0, and takes longer years with a sign)
_PLAIN_ISO = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decimal_comma(col) -> Column:
    """Decimal-comma text -> double: every ',' becomes '.', then a safe cast.
    ``'12,5'`` -> 12.5, ``' 7,0 '`` -> 7.0, ``'1.234,56'`` / ``'abc'`` -> NULL."""
    return F.replace(_c(col).cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def to_double(col) -> Column:
    return _c(col).cast("string").try_cast("double")


def to_int(col) -> Column:
    """Text -> int through double, so ``'7.0'`` -> 7 (a direct safe cast to
    int would reject it); non-numbers -> NULL."""
    return _c(col).cast("string").try_cast("double").try_cast("int")


def to_long(col) -> Column:
    """Text -> bigint, exact to 19 digits: whole numbers directly, ``'7.0'``
    through a decimal (a double would merge ids above 2^53); else NULL."""
    text = _c(col).cast("string")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,9)").try_cast("bigint"))


def parse_date(col, fmt: str | None = None) -> Column:
    """Text -> date.  With a pattern the whole text must match it
    (trailing time text -> NULL); without one, the default ISO forms are
    accepted, including a trailing time.  Plain ``yyyy-MM-dd`` text takes the
    cast, which costs a fraction of a formatter; all else the pattern."""
    c = _c(col)
    if fmt is None:
        return F.try_to_date(c.cast("string"))
    if fmt == ISO_DATE:
        text = c.cast("string")
        return F.when(text.rlike(_PLAIN_ISO), text.try_cast("date")).otherwise(
            F.try_to_date(text, fmt))
    return F.try_to_date(c.cast("string"), fmt)


def parse_ts_date(col, fmt: str = ISO_T_TIMESTAMP) -> Column:
    """Timestamp text with a pattern -> date."""
    return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt)).cast("date")


def parse_date_us(col) -> Column:
    """US month/day/year date-time with meridiem -> date; accepts both the
    12-hour and the 24-hour clock reading of the hour field."""
    c = _c(col).cast("string")
    return F.coalesce(
        F.try_to_timestamp(c, F.lit(US_MERIDIEM_12H)),
        F.try_to_timestamp(c, F.lit(US_MERIDIEM_24H)),
    ).cast("date")


def as_date(col) -> Column:
    """Date, timestamp or ISO text -> date (the un-patterned ``to_date``);
    a date passes through unchanged, a timestamp is truncated."""
    return F.try_to_date(_c(col))


def resolution_days(end, start) -> Column:
    """Whole days from ``start`` to ``end``; NULL if either is NULL."""
    return F.datediff(_c(end), _c(start))
