"""Small files of partitioned Parquet folders: find them by their sizes and rewrite only the folders that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path


def folder_files(spark: SparkSession, root: str, by: list[str]) -> DataFrame:
    """One row per file: the folder's values of ``by``, path, size, rows (``_metadata`` columns only)."""
    rows = spark.read.parquet(root).select(*by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    return rows.groupBy(*by, "file", "size").agg(F.count(F.lit(1)).alias("n_rows"))


def compact_folders(spark: SparkSession, root: str, by: list[str], target_bytes: int) -> DataFrame:
    """Rewrite the folders of ``root`` that hold two or more files below half of ``target_bytes``, as files of about that size;
    returns the folders rewritten (``by``, ``files`` before, ``bytes``, ``parts``).

    Sizes come from one pass over file metadata.  A folder's rows are spread over ``parts = ceil(bytes / target)`` writers by
    the hash of the row, so a large folder is not one task's work; the rows are staged first, so a failed commit loses nothing.
    Other folders keep their files."""
    sizes = folder_files(spark, root, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
        F.count_if(F.col("size") * 2 < target_bytes).alias("small"))
    plan_path = scratch_path(spark, "compact-plan")
    sizes.where("small >= 2").select(*by, "files", "bytes", F.greatest(
        F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("int").alias("parts")).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    if plan.isEmpty():
        return plan
    table = spark.read.parquet(root)
    same = [table[c].eqNullSafe(plan[c]) for c in by]
    columns = table.columns
    # the filter makes Spark prune the other folders at run time
    rows = table.join(plan.where("parts > 0"), same).select(*[table[c] for c in columns], "parts")
    spread = rows.withColumn("__part", F.pmod(F.xxhash64(*columns), F.col("parts")).cast("int"))
    staged = scratch_path(spark, "compacted")
    spread.repartition(*by, "__part").drop("parts", "__part").write.partitionBy(*by).parquet(staged)
    # the staged files are of the wanted size already: each is copied by one task
    back = spark.read.schema(table.schema).parquet(staged).withColumn("__file", F.col("_metadata.file_path"))
    (back.repartition(*by, "__file").drop("__file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(root))
    return plan
