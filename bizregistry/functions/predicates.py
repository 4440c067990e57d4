"""Row predicates. Each compares the bare column with a constant, so the scan can use it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _col, year_start


def since(col: Column | str, day: date | str) -> Column:
    """On or after ``day``; NULL dates drop out."""
    return _col(col) >= F.lit(day).cast("date")


def in_years(col: Column | str, first: int, last: int) -> Column:
    """``year(col) BETWEEN first AND last`` as a date range.

    A function over the column hides it from Parquet statistics, a range does not.
    """
    c = _col(col)
    return (c >= F.lit(date(first, 1, 1))) & (c < F.lit(date(last + 1, 1, 1)))


def exclude_value(col: Column | str, value: object) -> Column:
    """Different from ``value``; NULL drops out, as in SQL."""
    return _col(col) != F.lit(value)


def code_range(col: Column | str, low: Column | int, high: Column | int) -> Column:
    """In the half-open range [low, high)."""
    c = _col(col)
    return (c >= low) & (c < high)


def any_flag(cols: Sequence[Column | str], value: str = "S") -> Column:
    """At least one of the flag columns is set."""
    return reduce(or_, (_col(c) == value for c in cols))


def has_code(col: Column | str, code: object) -> Column:
    """Equal to ``code``. On the right side of a left join it drops unmatched rows too."""
    return _col(col) == F.lit(code)


def year_to_date(col: Column | str, as_of: Column | date | str) -> Column:
    """On or after 1 January of the year of ``as_of``."""
    return _col(col) >= year_start(as_of)
