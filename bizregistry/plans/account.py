"""What parsing loses: values that became NULL, and records of the wrong length."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bizregistry.functions import decode_yyyymmdd, parse_decimal_comma, parse_int
from bizregistry.sources import Family
from bizregistry.sources.delimited import DELIMITER, csv_options

# Holds the record where a field did not fit its type, or their number was another.
RECORD = "_record"
ACCOUNT = "table string, measure string, column string, n bigint"


# Column of the flags of a row's losses, a bit each.
LOST = "_lost"


def flagged(
    df: DataFrame,
    family: Family,
    *,
    dates: tuple[str, ...] = (),
    decimals: tuple[str, ...] = (),
    wide: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Rows as read, with a bit in ``LOST`` for each thing that a row lost, and the bits' names.

    ``df`` has the columns of ``family.wide`` and ``RECORD``, which is dropped. There are bits for
    records of more or fewer fields than the schema has, ``odd_records``, and for each column that
    can lose values: text in a number's place, dates that do not exist, numbers that are none. Empty
    fields, and 0 for no date, are no losses.
    """
    schema = family.wide
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields)
    options = csv_options(header=False, escape=family.escape)
    # Only a few records are parsed again, those that did not fit.
    fields = F.when(F.col(RECORD).isNotNull(), F.from_csv(RECORD, F.lit(texts), options))
    unquoted = F.regexp_replace(RECORD, '"[^"]*"', "")
    found = 1 + F.length(unquoted) - F.length(F.replace(unquoted, F.lit(DELIMITER)))
    lost: dict[str, Column] = {"odd_records": found != len(schema)}
    for field in schema.fields:
        name = field.name
        if not isinstance(field.dataType, StringType):
            lost[f"lost {name}"] = F.col(name).isNull() & F.col("_fields")[name].isNotNull()
        elif name in family.text and not wide:
            lost[f"lost {name}"] = F.col(name).isNotNull() & parse_int(name).isNull()
        if name in dates:
            undated = (F.col(name) != 0) & decode_yyyymmdd(name).isNull()
            lost[f"lost {name}"] = lost[f"lost {name}"] | F.coalesce(undated, F.lit(False))
        if name in decimals:
            lost[f"lost {name}"] = F.col(name).isNotNull() & parse_decimal_comma(name).isNull()
    bits = F.lit(0).cast("bigint")
    for at, condition in enumerate(lost.values()):
        bits = bits.bitwiseOR(F.when(condition, F.lit(1 << at)).otherwise(0).cast("bigint"))
    flags = df.withColumn("_fields", fields).withColumn(LOST, bits)
    return flags.drop("_fields", RECORD), list(lost)


def counted(df: DataFrame, names: list[str]) -> tuple[DataFrame, Observation]:
    """Rows without ``LOST``, whose bits are counted while they pass: no second scan.

    Counts are exact where no shuffle follows: a task of the last stage counts once, however
    often it is tried, and the sampling of a range partitioning would count its input twice.
    """
    observation = Observation()
    bits = [F.col(LOST).bitwiseAND(F.lit(1 << at)) != 0 for at in range(len(names))]
    passing = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(bit).alias(name) for bit, name in zip(bits, names)),
    )
    return passing.drop(LOST), observation


def account_rows(table: str, counts: Mapping[str, int]) -> list[tuple[str, str, str | None, int]]:
    """Rows of ``ACCOUNT``: rows and odd records, and columns that lost values."""
    rows: list[tuple[str, str, str | None, int]] = []
    for name, n in counts.items():
        measure, _, column = name.partition(" ")
        if n or not column:
            rows.append((table, measure, column or None, n))
    return rows
