"""Dense serial ids: 1, 2, 3, ... in a total order, without a window over all rows.

Rows are range partitioned and sorted, numbered inside their partition, and staged; the rows per partition are
summed up front to back (one number per partition reaches the driver), and each partition's sum is added to its numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path


def with_serial(df: DataFrame, order: list[str | Column], col: str = "id", first: int = 1) -> DataFrame:
    """``df`` plus a bigint column ``col``: ``first``, ``first + 1``, ... by ``order``.  Rows equal in ``order`` get
    neighbouring numbers in any order, the same ones whenever the result is read.  An empty frame gives none."""
    spark = df.sparkSession
    path = scratch_path(spark, "serial")
    # the id of a row holds its partition above bit 33 and its place in the partition below
    df.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("__place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("__place", 33)
    offsets, before = [], first
    for number, rows in sorted(placed.groupBy(part.alias("p")).count().collect()):  # a row per shuffle partition
        offsets.append((number, before))
        before += rows
    table = F.broadcast(spark.createDataFrame(offsets, "__part long, __before long"))
    inside = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(table, part == F.col("__part")) \
        .select(*df.columns, (inside + F.col("__before")).alias(col))


def append_serial(target: DataFrame, batch: DataFrame, order: list[str | Column], col: str = "id") -> DataFrame:
    """``batch`` numbered on from the greatest id of ``target`` (1 for an empty one)."""
    last = target.agg(F.max(col)).first()[0]
    return with_serial(batch, order, col, (last or 0) + 1)
