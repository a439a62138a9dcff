"""A keyed table stored by key bucket, and a merge that rewrites only the buckets its batch hits.

A row's bucket comes from the MD5 of its key, so it stays the same across versions and engines.  Choose the number of
buckets so that one is written by a few tasks, and a daily batch hits few of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.upsert import upsert
from sluice.session import scratch_path

BUCKET = "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """0 .. buckets - 1 from the key columns, as text, null as an empty one."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def _write(rows: DataFrame, path: str) -> None:
    (rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))


def create_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Store a table by key bucket (one folder each)."""
    _write(df.withColumn(BUCKET, bucket_of(keys, buckets)), path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The stored table without its bucket column."""
    return spark.read.parquet(path).drop(BUCKET)


def merge_buckets(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], seq: str, buckets: int) -> list[int]:
    """``upsert`` of ``batch`` into the table at ``path``; returns the buckets written (at most ``buckets`` numbers).

    Only the folders of buckets that the batch hits are read (a partition filter) and written (dynamic overwrite).  The merged
    rows are staged before the first old file goes, so a failed commit loses nothing: they can be written again."""
    placed = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    hit = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())
    if not hit:
        return []
    target = spark.read.parquet(path).where(F.col(BUCKET).isin(hit))
    staged = scratch_path(spark, "merged-buckets")
    upsert(target, placed, [BUCKET, *keys], seq).write.partitionBy(BUCKET).parquet(staged)
    _write(spark.read.schema(target.schema).parquet(staged), path)
    return hit
