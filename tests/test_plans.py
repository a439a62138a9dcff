"""Plan shape: filters reach the scan, top-1 uses a partial group limit before the
shuffle, small dimensions are broadcast after the size check, no Python UDF anywhere."""

from sluice.plans import registry

SF = "/root/testdata/sf0.001"


LAZY = ["top_artists_by_country", "top_songs_by_country", "totals_by_country", "genres_by_country",
        "repeat_number_ones_window", "multi_country_number_ones", "daily_pickup_stats", "trips_with_zone",
        "trips_kept_months", "time_bounds_before", "missing_months", "upsert_last_wins", "orders_page",
        "sales_messages", "sales_decoded", "event_props", "event_prop_counts", "chart_rows"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_artists_partial_group_limit(spark):
    plan = registry.top_artists_by_country(spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


def test_no_python_udfs(spark):
    for name, q in registry.QUERIES.items():
        if name not in LAZY:
            continue
        plan = q(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name


def test_zone_join_is_broadcast_and_pushed(spark):
    plan = _plan(registry.trips_with_zone(spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters" in plan


def test_cluster_settings_scale():
    from sluice.session import cluster_settings
    tb = 1024 ** 4
    parts = int(cluster_settings(10 * tb, 8000)["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts * 200 * 1024 ** 2 >= 10 * tb
    assert int(cluster_settings(1000 * tb, 8000)["spark.sql.shuffle.partitions"]) <= 100_000
    assert cluster_settings(10, 8)["spark.sql.shuffle.partitions"] == "8"


def test_totals_read_only_their_columns(spark):
    plan = _plan(registry.totals_by_country(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "p_brand" not in plan and "l_linenumber" not in plan


def test_appended_rows_are_seen(spark, tmp_path):
    from sluice.plans import relations as rel
    path = str(tmp_path / "events.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.limit(5).write.parquet(path)
    assert rel.table(spark, str(tmp_path), "events").count() == 5
    events.limit(7).write.mode("append").parquet(path)
    assert rel.table(spark, str(tmp_path), "events").count() == 12
    assert registry.event_props(spark, str(tmp_path)).count() == 12


def test_upsert_reads_the_batch_once(spark):
    from sluice.operators.upsert import upsert
    batch = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey")
    target = spark.createDataFrame([(1, 1)], "o_custkey long, o_orderkey long")
    assert _plan(upsert(target, batch, ["o_custkey"], "o_orderkey")).count("FileScan parquet") == 1


def test_country_join_is_broadcast(spark):
    from sluice.plans import charts as ch
    from sluice.plans import relations as rel
    data = ch.prepare_charts(rel.charts(spark, SF), rel.country_aliases(spark, SF))
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [country" in plan


def test_split_by_month_then_union_equals_input(spark):
    from pyspark.sql import functions as F
    from sluice.operators.sets import union_all
    from sluice.plans import relations as rel
    trips = rel.trips(spark, SF).withColumn("ym", F.date_format("pickup_ts", "yyyy-MM"))
    months = [r.ym for r in trips.select("ym").distinct().collect()]
    back = union_all([trips.filter(F.col("ym") == m) for m in months])
    assert back.exceptAll(trips).count() == 0 and trips.exceptAll(back).count() == 0


def test_scratch_goes_under_the_session_checkpoint_dir(spark):
    from sluice.session import scratch_path
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/x-") and a != b
