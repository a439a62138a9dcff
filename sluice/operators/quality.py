"""Data checks, each one aggregate pass (no driver loops over rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_rate): share of null values per column, in one pass."""
    cols = columns or df.columns
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_rate)")


def rows_per_source_match(counts: DataFrame, expected: DataFrame, source_col: str, broken_only: bool = True) -> DataFrame:
    """Sources whose row count in a union differs from the count of the input itself
    (empty = the union kept every row), or all sources.  Both sides are (source, n_rows) aggregates."""
    same = F.col("u.n_rows").eqNullSafe(F.col("e.n_rows"))
    return (counts.alias("u").join(expected.alias("e"), source_col, "full_outer")
            .filter(~same if broken_only else F.lit(True))
            .select(source_col, F.col("u.n_rows").alias("in_union"),
                    F.col("e.n_rows").alias("in_input")))
