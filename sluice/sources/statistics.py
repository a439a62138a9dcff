"""Minimum, maximum and row count of Parquet folders from the files' footers.

The vectorised Parquet source answers such aggregates from column statistics when they are pushed down, without
reading a row.  That needs the newer file source, so a session of its own carries the two settings; group by
partition columns only.  Numbers and dates are pushed; a time belongs in as microseconds (``unix_micros``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_bounds(spark: SparkSession, root: str, columns: list[str], by: list[str]) -> DataFrame:
    """Per folder (values of ``by``): ``n_rows``, and ``min_<c>`` and ``max_<c>`` of every column."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = own.read.parquet(root).groupBy(*by)
    return found.agg(F.count(F.lit(1)).alias("n_rows"), *[f(c).alias(f"{n}_{c}") for c in columns
                                                          for n, f in (("min", F.min), ("max", F.max))])
