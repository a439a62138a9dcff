"""File sinks: file counts, dynamic partition overwrite, report folders."""

import os

from pyspark.sql import functions as F

from sluice.sinks.files import write_parquet, write_partitioned, write_reports
from sluice.sources.files import read_reports


def _parquet_files(path):
    return [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_write_parquet_in_n_files(spark, tmp_path):
    out = str(tmp_path / "p")
    write_parquet(spark.range(1000), out, files=5)
    assert len(_parquet_files(out)) == 5
    assert spark.read.parquet(out).count() == 1000


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmp_path):
    out = str(tmp_path / "by_month")
    first = spark.range(30).select((F.col("id") % 3 + 1).alias("month"), "id")
    write_partitioned(first, out, ["month"])
    second = spark.createDataFrame([(2, 100)], "month long, id long")
    write_partitioned(second, out, ["month"])
    got = {(r.month, r.n) for r in spark.read.parquet(out).groupBy("month")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(1, 10), (2, 1), (3, 10)}


def test_reports_round_trip_by_folder_name(spark, tmp_path):
    out = str(tmp_path / "reports")
    write_reports({"a": spark.range(3), "b": spark.range(2)}, out)
    back = read_reports(spark, out)
    assert {k: v.count() for k, v in back.items()} == {"a": 3, "b": 2}


def test_replace_table_keeps_a_copy_until_the_swap(spark):
    from sluice.sinks import catalog
    name = catalog.reset_table(spark, "swap_me", "sluice_test")
    catalog.create_table(spark.range(10).toDF("x"), name)
    catalog.append_table(spark.range(5).toDF("x"), name)
    catalog.replace_table(spark, name, lambda df: df.where("x < 3"))
    assert spark.table(name).count() == 6
    assert [t.name for t in spark.catalog.listTables("sluice_test")] == ["swap_me"]
    catalog.reset_table(spark, name)


def test_monthly_files_carry_the_month_in_their_name(spark, tmp_path):
    from sluice.sinks.files import write_monthly_files
    df = spark.createDataFrame([(1, 2020, 1), (2, 2020, 1), (3, 2021, 12)], "x int, y int, m int")
    write_monthly_files(df, str(tmp_path / "out"), "yellow", "y", "m")
    names = {f[:14] for f in os.listdir(tmp_path / "out") if f.endswith(".csv")}
    assert names == {"yellow_2020-01", "yellow_2021-12"}
