"""Top-n rows per group.

``row_number() <= n`` over a total order is the shape Catalyst turns into
``WindowGroupLimit``: a partial limit runs *before* the shuffle, so each map task sends at
most ``n`` rows per group and a hot group cannot flood one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, by: list[str], order: list[Column], n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each ``by`` group under ``order``.

    ``order`` must be a total order for a deterministic result; ties beyond it are broken
    arbitrarily.  ``rank_col`` keeps the 1-based position as a column.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    name = rank_col or "__rn"
    ranked = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return ranked if rank_col else ranked.drop(name)
