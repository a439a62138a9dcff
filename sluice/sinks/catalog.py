"""Catalog tables (session catalog / metastore): create, append, reset, replace.

A table's files live under the warehouse folder the cluster configures.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def reset_table(spark: SparkSession, name: str, database: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` + ``DROP TABLE IF EXISTS``; returns the full name."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return name


def create_table(df: DataFrame, name: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> None:
    """Create a table from a query (an empty frame gives an empty table with its schema)."""
    writer = df.writeTo(name).using(fmt)
    if partition_by:
        from pyspark.sql import functions as F
        writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
    writer.create()


def create_table_with_defaults(spark: SparkSession, name: str, columns: dict[str, str], defaults: dict[str, str],
                               fmt: str = "parquet") -> None:
    """Create an empty table from ``{column: type}`` with default expressions (SQL text, e.g. ``current_date()``) for some."""
    parts = [f"`{c}` {kind}" + (f" DEFAULT {defaults[c]}" if c in defaults else "") for c, kind in columns.items()]
    spark.sql(f"CREATE TABLE {name} ({', '.join(parts)}) USING {fmt}")


def insert_values(spark: SparkSession, name: str, columns: list[str], rows: list[tuple[str, ...]]) -> None:
    """``INSERT ... VALUES`` of literal rows (SQL literals as text, e.g. ``timestamp_ntz'2021-04-01 10:00:00'``) into a
    subset of the columns; the others get their defaults.  For a few rows written by hand, not for data."""
    values = ", ".join("(" + ", ".join(row) + ")" for row in rows)
    spark.sql(f"INSERT INTO {name} ({', '.join(f'`{c}`' for c in columns)}) VALUES {values}")


def insert_columns(df: DataFrame, name: str) -> None:
    """Append by name; table columns that ``df`` lacks get their defaults."""
    view = f"insert_{uuid.uuid4().hex}"
    df.createTempView(view)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    try:
        df.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def append_table(df: DataFrame, name: str) -> None:
    """Append by position into an existing table (columns in table order)."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def replace_table(spark: SparkSession, name: str,
                  transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet") -> None:
    """Replace a table with a transformed copy of itself (e.g. outliers filtered out).

    A table cannot be overwritten while it is read, so the copy is written as a new table
    first.  The old table is then renamed aside, the new one renamed in, and only then the old
    one dropped: after a failure in between the data are still there under the name, under
    ``<name>__old`` or both.
    """
    staging, old = f"{name}__replacing", f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    transform(spark.table(name)).writeTo(staging).using(fmt).create()
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")
