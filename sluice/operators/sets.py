"""Union of many relations and its completeness check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: list[DataFrame], source_col: str | None = None) -> DataFrame:
    """Union by column name; ``source_col`` tags each row with the index of its input."""
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    if source_col:
        dfs = [df.withColumn(source_col, F.lit(i)) for i, df in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_counts(union: DataFrame, source_col: str) -> DataFrame:
    """Rows per input of a tagged union, in one pass (the union-completeness check)."""
    return union.groupBy(source_col).agg(F.count(F.lit(1)).alias("n_rows"))
