from .columns import (
    decode_code,
    decode_yyyymmdd,
    month_of,
    parse_decimal_comma,
    parse_int,
    year_of,
    year_start,
)
from .predicates import (
    any_flag,
    code_range,
    exclude_value,
    has_code,
    in_years,
    since,
    year_to_date,
)

__all__ = [
    "any_flag",
    "code_range",
    "decode_code",
    "decode_yyyymmdd",
    "exclude_value",
    "has_code",
    "in_years",
    "month_of",
    "parse_decimal_comma",
    "parse_int",
    "since",
    "year_of",
    "year_start",
    "year_to_date",
]
