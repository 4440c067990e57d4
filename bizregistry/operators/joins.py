"""Left joins of code tables and company tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A table to be left-joined on one key.

    ``columns`` are taken from ``table``; with none, the join only multiplies rows when the
    table has duplicate keys.
    """

    table: DataFrame
    on: str
    key: str | None = None
    columns: Sequence[str] = ()


def attach(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Left join that keeps every row of ``df`` and adds the lookup's columns.

    No broadcast hint: a hint skips the size check. Without one the planner broadcasts a
    table it knows to be under ``spark.sql.autoBroadcastJoinThreshold``, as code tables are,
    and adaptive execution does so for one that turns out to be; anything larger is shuffled,
    and a hot key split by adaptive execution.
    """
    key = lookup.key or lookup.on
    alias = f"_key_{key}"
    right = lookup.table.select(F.col(key).alias(alias), *lookup.columns)
    return df.join(right, F.col(lookup.on) == F.col(alias), "left").drop(alias)
