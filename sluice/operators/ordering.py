"""Sorted samples and pages.

``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every task keeps its own
top ``n`` and only those reach the final merge, so no global sort of the input is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def take_sorted(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows under ``order`` (a sampling/report operator: the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column | str], offset: int, size: int) -> DataFrame:
    """Rows ``offset .. offset+size-1`` under a total ``order`` (LIMIT/OFFSET paging).

    Each task keeps its first ``offset + size`` rows, so deep pages grow expensive; walk a
    large table with ``page_after`` instead."""
    return df.orderBy(*order).offset(offset).limit(size)


def page_after(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Keyset paging: the ``size`` rows with the smallest ``key`` greater than ``after``
    (``None`` = first page).  The bound is a filter that reaches the scan (row groups
    below it are skipped), and each task keeps only ``size`` rows, however deep the page."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(F.col(key)).limit(size)


def sort_for_files(df: DataFrame, order: list[Column | str], files: int | None = None) -> DataFrame:
    """Range-partition into ``files`` slices (by default the session's shuffle partitions) and sort
    inside each: a sorted file set without a single-task global sort.

    Range partitioning sends equal keys to one slice, so a key value holding a third of
    the rows would be one huge slice.  A hash of the whole row is appended as the last
    sort key: it only orders rows whose keys tie, and lets the range bounds cut through a
    hot key.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns]).alias("__tie")
    keyed = df.withColumn("__tie", spread)
    ordered = [*order, F.col("__tie")]
    sliced = keyed.repartitionByRange(files, *ordered) if files else keyed.repartitionByRange(*ordered)
    return sliced.sortWithinPartitions(*ordered).drop("__tie")
