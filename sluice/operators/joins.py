"""Joins against dimensions, and key checks.

No hints are given: Catalyst broadcasts a side below the session's auto-broadcast threshold, AQE
does so from sizes seen at run time and splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     how: str = "inner", drop_keys: tuple[str, ...] = ()) -> DataFrame:
    """Equi-join a fact table to a dimension; drop the listed key columns afterwards.

    ``how='inner'`` drops facts whose key has no dimension row, ``'left'`` keeps them with
    nulls.
    """
    joined = facts.join(dim, facts[fact_key] == dim[dim_key], how)
    return joined.drop(*drop_keys) if drop_keys else joined


def missing_keys(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``expected`` (distinct on ``keys``) absent from ``present``: empty = subset."""
    return (expected.select(*keys).distinct()
            .join(present.select(*keys).distinct(), on=keys, how="left_anti"))
