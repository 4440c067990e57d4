"""Counts of openings, means by label, and top entries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .joins import Lookup, attach


# Members of one row of a set: the bits of a long.
_WORD_BITS = 6


def distinct_sets(df: DataFrame, by: Sequence[Column | str], value: str) -> DataFrame:
    """The distinct values of a column by groups, as sets that merge: ``by, word, rest, bits``.

    Integers, and text of exactly eight digits, which company numbers are, go into ``bits``: a row
    holds up to 64 neighbouring numbers. Other text, longer, shorter or with letters, is kept as it is,
    in ``rest``, a row for each value. NULL is in no set, but its group has a row. Sets merge by
    ``merge_sets``, in any order and as often as one likes, and ``count_sets`` counts them exactly.
    """
    column, kind = F.col(value), df.schema[value].dataType
    if isinstance(kind, IntegralType):
        number, rest = column.cast("bigint"), F.lit(None).cast("string")
    else:
        text = column.cast("string")
        plain = text.rlike("^[0-9]{8}$")
        number = F.when(plain, text.try_cast("bigint"))
        rest = F.when(~plain, text)
    place = number.bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int")
    bit = F.when(number.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    bits = F.coalesce(bit, F.when(rest.isNotNull(), F.lit(1)), F.lit(0)).cast("bigint")
    word = F.shiftright(number, _WORD_BITS)
    grouped = df.groupBy(*by, word.alias("word"), rest.alias("rest"))
    return grouped.agg(F.bit_or(bits).alias("bits"))


def merge_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Unions of sets that fall into one group of ``by``."""
    return sets.groupBy(*by, "word", "rest").agg(F.bit_or("bits").alias("bits"))


def count_sets(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Sizes of merged sets."""
    return sets.groupBy(*by).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))


def _is_small(table: DataFrame) -> bool:
    """Would the planner broadcast the table, by what it knows of its size?"""
    most = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= most


def opening_counts(
    df: DataFrame,
    *,
    keys: Mapping[str, Column],
    lookups: Sequence[Lookup] = (),
    count: str,
    distinct: bool = False,
    name: str = "qtd_empresas",
) -> DataFrame:
    """Count rows, or distinct values of ``count``, by ``keys`` and the lookups' columns.

    A plain count is taken by the lookup *codes* first and added up by label afterwards:
    only the few counted groups meet the code tables, so neither a large code table nor a
    hot or NULL code makes the fact rows shuffle for a label.

    Distinct counts cannot be added up. While all code tables with labels are small enough to be
    broadcast, labels come first, which costs no shuffle; the planner then counts in two steps,
    by group and value and then by group, which spreads one hot group over many tasks. Where one
    is larger, the values are gathered into mergeable sets by code, these meet the code tables, and
    sets of one label are merged. Both ways are exact, and give the same.
    """
    labels = [c for lookup in lookups for c in lookup.columns]
    if distinct:
        # A lookup without columns can only repeat rows, which a distinct count never sees.
        labelled = [lookup for lookup in lookups if lookup.columns]
        if all(_is_small(lookup.table) for lookup in labelled):
            for lookup in labelled:
                df = attach(df, lookup)
            grouped = df.groupBy(*_aliased(keys), *labels)
            return grouped.agg(F.countDistinct(count).alias(name))
        codes = list(dict.fromkeys(lookup.on for lookup in labelled))
        sets = distinct_sets(df, [*_aliased(keys), *codes], count)
        for lookup in labelled:
            sets = attach(sets, lookup)
        return count_sets(merge_sets(sets, [*keys, *labels]), [*keys, *labels], name)
    codes = list(dict.fromkeys(lookup.on for lookup in lookups))
    counted = df.groupBy(*_aliased(keys), *codes).agg(F.count(count).alias(name))
    if not lookups:
        return counted
    for lookup in lookups:
        counted = attach(counted, lookup)
    return counted.groupBy(*keys, *labels).agg(F.sum(name).alias(name))


def average_by(
    df: DataFrame, *, by: Sequence[str], value: str, name: str, lookup: Lookup | None = None
) -> DataFrame:
    """Mean of ``value`` by the columns ``by``, ignoring NULL values.

    With a ``lookup`` the sums and counts are taken by its code first, and only those meet
    the code table, whose columns may be among ``by``.
    """
    if lookup is None:
        return df.groupBy(*by).agg(F.avg(value).alias(name))
    codes = list(dict.fromkeys([*(c for c in by if c not in lookup.columns), lookup.on]))
    sums = df.groupBy(*codes).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    # A group without values has no mean; ANSI mode would raise on its division by zero.
    mean = F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))
    return attach(sums, lookup).groupBy(*by).agg(mean.alias(name))


def top_n(df: DataFrame, by: str, n: int = 1, *, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the highest ``by``; ties go to the lowest ``tie_break``.

    Each task keeps its own ``n`` best rows; there is no full sort.
    """
    return df.orderBy(F.desc_nulls_last(by), *map(F.asc_nulls_last, tie_break)).limit(n)


def _aliased(keys: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in keys.items()]
