"""Generic DataFrame -> DataFrame operators (joins, windows, ordering, sets, upsert, checks)."""

from sluice.operators.joins import attach_dimension, missing_keys
from sluice.operators.windows import top_n_per_group
from sluice.operators.ordering import page, take_sorted
from sluice.operators.sets import union_all, union_counts
from sluice.operators.upsert import dedup_last, upsert

__all__ = [
    "attach_dimension", "missing_keys", "top_n_per_group", "page",
    "take_sorted", "union_all", "union_counts", "dedup_last", "upsert",
]
