from .aggregates import (
    average_by,
    count_sets,
    distinct_sets,
    merge_sets,
    opening_counts,
    top_n,
)
from .joins import Lookup, attach
from .sinks import overwrite_partitions, overwrite_table, recover_table

__all__ = [
    "Lookup",
    "attach",
    "average_by",
    "count_sets",
    "distinct_sets",
    "merge_sets",
    "opening_counts",
    "overwrite_partitions",
    "overwrite_table",
    "recover_table",
    "top_n",
]
