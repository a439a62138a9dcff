"""Shared helpers of the text operators: staged tables, column names, the test fold.

A staged table is written as Parquet under the shared folder of ``spark.checkpoint.dir`` and
read back: the lineage ends there, so a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.session import scratch_path

ROW_GROUP_BYTES = 32 << 20  # what a writing task buffers: rows here can be wide (texts, ids)


#: Arrow batches between the JVM and Python workers while a table is staged: texts are wide, so few rows make a batch.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounded Arrow batches for the jobs run inside; the session's own settings come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in BATCH_CONF}
    try:
        for key, value in BATCH_CONF.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage(df: DataFrame, name: str, compression: str = "snappy",
          partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch root and read it back."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", compression).option("parquet.block.size", ROW_GROUP_BYTES)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with small_batches(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (operators keep clashing extra columns)."""
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def shield(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(``docs`` with columns of these names renamed, function that picks its columns under their own names): for
    operators that add columns of these names."""
    aside = {c: fresh_name(docs, f"_own_{c}") for c in docs.columns if c.lower() in names}
    columns = docs.columns

    def restore(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(aside.get(c, c)).alias(c) for c in columns])
    return docs.withColumnsRenamed(aside), restore


def held_out(col: str = "doc_id") -> Column:
    """True where crc32 of the id, written as text, is divisible by 5 (test fold)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
