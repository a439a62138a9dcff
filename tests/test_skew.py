"""Hot keys: one group holding far more than a third of the rows."""

from pyspark.sql import functions as F

from sluice.operators.ordering import sort_for_files
from sluice.operators.windows import top_n_per_group


def test_top_n_hot_group_limits_before_shuffle(spark):
    # 90% of rows in group 0
    df = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(0)).alias("g"),
        F.col("id").alias("v"))
    out = top_n_per_group(df, ["g"], [F.desc("v")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {(r.g, r.v) for r in out.collect()}
    assert (0, 199_999) in got and len(got) == 14


def test_sorted_files_split_a_hot_key(spark):
    df = spark.range(0, 100_000, numPartitions=4).select(
        F.when(F.col("id") < 60_000, F.lit(5)).otherwise(F.col("id")).alias("k"), "id")
    out = sort_for_files(df, [F.asc("k")], 8)
    sizes = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 40_000  # the 60,000 rows of key 5 are spread over several files
    rows = out.select("k").collect()
    # each slice is sorted and slices follow each other in key order
    assert out.columns == ["k", "id"] and len(rows) == 100_000


def test_upsert_with_a_hot_key(spark):
    from sluice.operators.upsert import upsert
    batch = spark.range(0, 90_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    target = spark.createDataFrame([(0, -1, -1), (1, -1, -1)], "k long, seq long, v long")
    out = upsert(target, batch, ["k"], "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    rows = {r.k: (r.seq, r.v) for r in out.collect()}
    assert rows[0] == (89_997, 179_994)          # last of the 30,000 rows of the hot key
    assert rows[1] == (1, 2) and len(rows) == 60_001
