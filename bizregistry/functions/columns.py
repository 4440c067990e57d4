"""Column -> Column expressions. All built-in, so they stay in whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_yyyymmdd(col: Column | str) -> Column:
    """Integer ``yyyyMMdd`` to date; 0 and impossible dates give NULL.

    Same result as ``try_to_date(cast(col AS string), 'yyyyMMdd')``, but by integer
    arithmetic: the formatter costs microseconds per value (an exception for each bad one),
    this costs nanoseconds. A day beyond the end of its month lands in the next one, which
    gives it away. ``make_date`` only sees checked parts, so ANSI mode has nothing to raise.

    The expression is kept short because a table has several such columns, and the JVM does
    not compile generated methods of more than 8000 bytes.
    """
    c = _col(col)
    digits = F.abs(c.cast("bigint"))
    year = F.call_function("div", c, F.lit(10000)).cast("int")
    month = (F.call_function("div", digits, F.lit(100)) % 100).cast("int")
    day = (digits % 100).cast("int")
    date_ = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    plausible = (
        digits.between(10000101, 99991231) & month.between(1, 12) & day.between(1, 31)
    )
    return F.when(plausible, F.when(F.month(date_) == month, date_))


def parse_decimal_comma(col: Column | str) -> Column:
    """Text with a decimal comma to double; text that is no number gives NULL."""
    return F.replace(_col(col), F.lit(","), F.lit(".")).try_cast("double")


def parse_int(col: Column | str) -> Column:
    """Text to int; text that is no plain number gives NULL.

    What a typed CSV column does, but without an exception for each value that does not fit,
    which for a column that mostly holds other text costs more than the rest of its row.
    Only numbers of ten digits are left to fail in the cast.
    """
    c = _col(col)
    return F.when(c.rlike("^[+-]?0*[0-9]{1,10}$"), c.try_cast("int"))


def decode_code(col: Column | str, mapping: Mapping[int, str]) -> Column:
    """Label of an integer code; NULL and unlisted codes give NULL.

    The mapping is a handful of constants, so it is an expression and not a join.
    """
    c = _col(col)
    (code, label), *rest = mapping.items()
    label_of = F.when(c == code, F.lit(label))
    for code, label in rest:
        label_of = label_of.when(c == code, F.lit(label))
    return label_of


def year_of(col: Column | str) -> Column:
    return F.year(_col(col)).cast("bigint")


def month_of(col: Column | str) -> Column:
    return F.month(_col(col)).cast("bigint")


def year_start(as_of: Column | date | str) -> Column:
    """1 January of the year of ``as_of``. Constant-folded for a literal ``as_of``."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.trunc(day.cast("date"), "YEAR")


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
