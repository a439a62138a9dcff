"""Jobs that write the trips or the chart rows several times join them once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans import jobs, registry
from sluice.plans import relations as rel
from sluice.plans import trips as tr
from sluice.sinks import files


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Own tables: orders over 14 months, two line items each; an order twice, line items without one, nulls."""
    root = str(tmp_path_factory.mktemp("own"))
    day = dt.datetime(1996, 1, 1)
    dates = [day + dt.timedelta(days=5 * i) for i in range(85)]
    orders = [(i, i % 7, 10.0 * i, d) for i, d in enumerate(dates)] + [(3, 2, 5.0, dates[3])]
    lines = [(i, i % 5, i % 3, n, float(n), 100.0 + i, 0.05, day + dt.timedelta(days=5 * i + 2 * n)) for i in range(85) for n in (1, 2)]
    lines += [(90, 1, 1, 1, 1.0, 2.0, 0.1, day), (999, 1, 1, 1, 1.0, 2.0, 0.1, day), (4, None, None, 3, None, None, None, None)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
        "customer": ([(i, i % 3) for i in range(7)], "c_custkey long, c_nationkey int"),
        "part": ([(i, f"a b{i}", "Brand", "Type", 24 + i) for i in range(5)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(0, "S0", 0, 1.0), (1, "S1", 1, -1.0), (2, "S2", 2, 3.0), (2, "S2 again", 2, 3.0)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "N0", 0), (1, "N1", 1), (2, "N2", 4)], "n_nationkey int, n_name string, n_regionkey int"),
        "events": ([(i, day + dt.timedelta(hours=i), "sale", '{"k": 1}') for i in range(30)],
                   "event_id long, ts timestamp_ntz, event_type string, props string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def _joins(df) -> bool:
    return "Join" in df._jdf.queryExecution().optimizedPlan().toString()


def _watch(monkeypatch, module, name):
    """Whether each frame that goes through ``module.name`` would be joined when it is written."""
    seen, inner = [], getattr(module, name)

    def watched(df, *args, **kwargs):
        seen.append(_joins(df))
        return inner(df, *args, **kwargs)
    monkeypatch.setattr(module, name, watched)
    return seen


def _same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_drifted_months(spark, sf, monkeypatch):
    seen = _watch(monkeypatch, jobs, "write_partitioned")
    got = jobs.drifted_months(spark, sf)
    assert seen == [False] * 3
    wanted = rel.trips(spark, sf).withColumn("passenger_count", F.when(F.col("file_month") > 4, F.col("passenger_count")))
    assert _same(got, wanted)


def test_checked_writes(spark, sf, monkeypatch):
    seen = _watch(monkeypatch, jobs, "write_checked")
    got = {r["check"]: (r.n_rows, r.n_bad) for r in jobs.checked_writes(spark, sf).collect()}
    assert seen == [True, False, False, False, False]
    charts = rel.charts(spark, sf)
    bad = charts.where("name is null").count()
    assert bad > 0 and got["null names"] == got["null names, refused"] == (charts.count(), bad)
    assert got["union"] == (rel.trips(spark, sf).count(), 0)
    assert got["stream rejects"] == (60, 30)


def test_monthly_files(spark, sf, monkeypatch):
    seen = _watch(monkeypatch, registry, "write_monthly_files")
    root = registry._monthly_files(spark, sf)
    assert seen == [True, False]
    green = registry.with_file_month(registry.read_monthly(
        spark, root, "green_tripdata_*.csv", schema=registry.StructType.fromDDL(registry.TRIP_CSV_SCHEMA))).drop("source_file")
    assert green.count() > 0
    assert _same(green, rel.trips(spark, sf).where("dayofmonth(pickup_ts) = 1").select(green.columns))


@pytest.mark.parametrize("most", [tr.ZONES_AT_ONCE, 2])
def test_cleaned_trips_are_not_shuffled(spark, sf, monkeypatch, most):
    """With few zones; with many they are clustered again.  A zone listed twice gives its trips twice, as a left join does."""
    plans, inner = [], files.write_partitioned

    def watched(df, path, by, *args, **kwargs):
        if path.endswith("/trips"):
            plans.append((kwargs.get("clustered", False), path))
        return inner(df, path, by, *args, **kwargs)
    monkeypatch.setattr(files, "write_partitioned", watched)
    monkeypatch.setattr(tr, "ZONES_AT_ONCE", most)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    order = registry.trips_job_order(spark, sf).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    assert [clustered for clustered, _ in plans] == [most > 2]
    clean = tr.attach_zone(registry.clean_trips(spark, sf), rel.zones(spark, sf))
    wanted = clean.groupBy(F.year("pickup_ts").alias("year"), F.month("pickup_ts").alias("month")).count().collect()
    assert sorted(map(tuple, order)) == sorted((*r, 0) for r in wanted)
    assert _same(registry.trips_job_stats(spark, sf), registry.daily_pickup_stats(spark, sf))
    back = spark.read.parquet(plans[0][1])
    columns = [c for c in clean.columns if c in back.columns]
    assert _same(back.select(columns), clean.select(columns))
