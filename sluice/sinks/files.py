"""File sinks.  Writes go through Spark's commit protocol, so a failed or retried task
leaves no partial output visible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One header CSV folder per report (``<folder>/<name>.csv``), overwritten."""
    out = {}
    for name, df in reports.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        df.write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out


def write_parquet(df: DataFrame, path: str, files: int | None = None,
                  by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Parquet in ``files`` files, round robin (even sizes whatever the key skew).  With
    ``by`` the rows are hash-partitioned on those columns instead, so one key lands in one
    file – use it only for keys without heavy hitters."""
    out = df
    if files is not None:
        out = df.repartition(files, *by) if by else df.repartition(files)
    out.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet",
                      header: bool = True, sort_within: list[Column | str] | None = None,
                      rows_per_file: int | None = None, clustered: bool = False) -> None:
    """One folder per value of ``by`` (e.g. year=2020/month=1), dynamic overwrite: only the
    partitions present in ``df`` are replaced.  Rows are clustered by ``by`` first (few, large
    files per folder) with a *rebalance*: AQE splits a hot value over several tasks and
    merges small ones, so a month holding a third of the rows is not written by one task.
    ``clustered`` says that the rows come by folder already (as read from files of one folder each) and need no shuffle.
    ``sort_within`` (names or expressions such as ``F.desc("x")``) sorts each file; ``rows_per_file`` bounds a
    file's rows."""
    out = df if clustered else df.hint("rebalance", *by)
    if sort_within:
        out = out.sortWithinPartitions(*by, *sort_within)
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(*by).format(fmt))
    if fmt == "csv":
        writer = writer.option("header", header)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)


def append_csv(df: DataFrame, path: str, stamp_col: str | None = "load_date",
               header: bool = False, load: int | None = None) -> None:
    """Append rows to a CSV set, stamped with the load date.  ``load`` (a number that grows from load to load)
    is written as a last column ``load_seq``: part files have random names, so only it tells which
    load came last."""
    out = df.withColumn(stamp_col, F.current_date()) if stamp_col else df
    if load is not None:
        out = out.withColumn("load_seq", F.lit(load).cast("bigint"))
    out.write.mode("append").option("header", header).csv(path)


def write_monthly_files(df: DataFrame, folder: str, prefix: str, year: str, month: str) -> None:
    """CSV files named ``<prefix>_<yyyy-MM>_<n>.csv``, month columns dropped.  Spark writes one folder per month;
    its part files then get their names (a rename per file on the driver, no data)."""
    spark = df.sparkSession
    key = F.format_string("%04d-%02d", F.col(year), F.col(month))
    staging = f"{folder.rstrip('/')}/_staging"
    write_partitioned(df.withColumn("__ym", key).drop(year, month), staging, ["__ym"], fmt="csv")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(staging)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for month_dir in fs.listStatus(root):
        name = month_dir.getPath().getName()
        if not name.startswith("__ym="):
            continue
        parts = [f.getPath() for f in fs.listStatus(month_dir.getPath()) if f.getPath().getName().endswith(".csv")]
        for n, part in enumerate(parts):
            target = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{prefix}_{name.split('=')[1]}_{n}.csv")
            if not fs.rename(part, target):
                raise OSError(f"cannot rename {part} to {target}")


def export_csv(df: DataFrame, path: str) -> None:
    """Whole relation -> header CSV folder (no paging, no row cap)."""
    df.write.mode("overwrite").option("header", True).csv(path)
