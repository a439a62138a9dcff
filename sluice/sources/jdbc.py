"""Database tables over JDBC.

A partitioned read splits ``[lower, upper]`` of a numeric column into ``num_partitions``
ranges, each read by its own task, instead of one cursor paging with OFFSET (which rereads
every skipped row).  The driver class must be on the classpath; nothing here starts a
database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table_jdbc(spark: SparkSession, url: str, table: str,
                    properties: dict | None = None, column: str | None = None,
                    lower: int | None = None, upper: int | None = None,
                    num_partitions: int = 1, fetch_size: int = 10_000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if column is not None:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)
