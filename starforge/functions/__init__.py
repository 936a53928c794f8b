"""Scalar column functions: ANSI-safe parsers and calendar attributes."""

from starforge.functions.calendar import (calendar_attributes, date_key,
                                          month_name, quarter_label)
from starforge.functions.parsing import (as_date, decimal_comma, parse_date,
                                         parse_date_us, parse_ts_date,
                                         resolution_days, to_double, to_int,
                                         to_long)

__all__ = [
    "as_date", "calendar_attributes", "date_key", "decimal_comma", "month_name",
    "parse_date", "parse_date_us", "parse_ts_date", "quarter_label",
    "resolution_days", "to_double", "to_int", "to_long",
]
