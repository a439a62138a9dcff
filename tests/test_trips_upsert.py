"""Trips cleaning, durations, headerless CSV + upsert fixtures."""

import datetime as dt

from pyspark.sql.types import StructType

from sluice.operators.upsert import upsert
from sluice.plans import trips as tr
from sluice.sources.files import read_csv, with_file_order
from sluice.sinks.files import append_csv

TRIP_SCHEMA = ("pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, passenger_count int, "
               "trip_distance double, tip_amount double, pu_location bigint, "
               "do_location bigint, file_year int, file_month int")


def _trip(spark, rows, month=(2020, 1)):
    return spark.createDataFrame([(*r, *month) for r in rows], TRIP_SCHEMA)


def test_trip_seconds(spark):
    df = _trip(spark, [(dt.datetime(2020, 1, 1, 0, 28, 15), dt.datetime(2020, 1, 1, 0, 33, 3),
                        1, None, None, 1, 2)])
    assert tr.with_trip_seconds(df).first().trip_duration_sec == 288


def test_month_filter_drops_trip_into_next_month(spark):
    df = _trip(spark, [
        (dt.datetime(2020, 1, 31, 23, 50), dt.datetime(2020, 2, 1, 0, 5), 1, None, None, 1, 2),
        (dt.datetime(2020, 1, 31, 23, 50), dt.datetime(2020, 1, 31, 23, 59, 59), 1, None, None, 1, 2),
    ])
    kept = tr.within_month(df).collect()
    assert len(kept) == 1 and kept[0].dropoff_ts.second == 59
    assert tr.outliers(df).first().broken_bound == "end"


def test_permissive_read_nulls_bad_fields(spark, tmp_path):
    p = tmp_path / "trips.csv"
    p.write_text("fare_amount,store_and_fwd_flag,n\n7.5,N,1\n8,1.0,2\n")
    schema = StructType.fromDDL("fare_amount int, store_and_fwd_flag double, n int")
    rows = read_csv(spark, str(p), schema=schema, capture_bad=True).orderBy("n").collect()
    assert rows[0].fare_amount is None and rows[0].store_and_fwd_flag is None and rows[0].n == 1
    assert rows[0]._corrupt_record is not None
    assert rows[1].fare_amount == 8 and rows[1]._corrupt_record is None


def test_file_month_decides_not_the_row(spark, tmp_path):
    """A file of January 2020 with rows of 2008 and of February: both go, whatever their own month."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "yellow_tripdata_2020-01.csv").write_text(
        "pickup_ts,dropoff_ts,passenger_count,trip_distance,tip_amount,pu_location,do_location\n"
        "2008-12-31 23:00:00,2008-12-31 23:10:00,1,1.0,0.0,1,2\n"
        "2020-02-15 10:00:00,2020-02-15 10:05:00,1,1.0,0.0,1,2\n"
        "2020-01-15 10:00:00,2020-01-15 10:10:00,1,1.0,0.0,1,2\n"
        "2020-01-15 10:00:00,2020-01-15 10:30:00,1,2.0,0.5,1,2\n")
    (tmp_path / "zones.csv").write_text("location_id;borough;zone\n1;B;Z\n")
    schema = StructType.fromDDL(TRIP_SCHEMA.split(", file_year")[0])
    out = str(tmp_path / "out")
    tr.run_job(spark, str(tmp_path / "in"), str(tmp_path / "zones.csv"), out, schema, stat_files=3, rows_per_file=10)
    back = spark.read.parquet(f"{out}/trips")
    assert {(r.year, r.month) for r in back.collect()} == {(2020, 1)}
    assert [r.trip_duration_sec for r in back.collect()] == [1800, 600]  # longest first within the file
    from sluice.sources.files import read_monthly, with_file_month
    raw = with_file_month(read_monthly(spark, str(tmp_path / "in"), "*.csv", schema=schema))
    assert sorted(r.broken_bound for r in tr.outliers(raw).collect()) == ["end", "start"]
    assert [r.in_bounds for r in tr.time_bounds(raw).collect()] == [False]
    assert [r.in_bounds for r in tr.time_bounds(tr.within_month(raw)).collect()] == [True]


def test_means_are_plain_averages(spark):
    at = dt.datetime(2020, 1, 5, 10)
    nan = float("nan")
    df = _trip(spark, [(at, at, 1, 0.004, None, 1, 2), (at, at, 1, 0.004, 2.0, 1, 2), (at, at, 1, nan, 1.0, 9, 2)])
    got = {r.pu_location: (r.avg_trip_distance, r.avg_tip_amount) for r in tr.daily_stats(df).collect()}
    assert got[1] == (0.004, 2.0) and got[9][0] != got[9][0]


# (id, name, date) in file order; several dates, the last row of each wins.
DAILY_ROWS = """31,Ada,2025-03-01
57,Ben,2025-03-02
12,Cleo,2025-03-01
88,Dan,2025-03-03
40,Eve,2025-03-02
"""


def test_upsert_last_row_in_file_wins(spark, tmp_path):
    p = tmp_path / "daily.csv"
    p.write_text(DAILY_ROWS)
    schema = StructType.fromDDL("id decimal(3,0), name string, date date")
    batch = with_file_order(read_csv(spark, str(p), schema=schema, header=False))
    target = spark.createDataFrame([], "id decimal(3,0), name string, date date")
    out = upsert(target, batch, ["date"], "file_seq").collect()
    assert sorted((r.date.day, int(r.id), r.name) for r in out) == [(1, 12, "Cleo"), (2, 40, "Eve"), (3, 88, "Dan")]
    # applied twice = once
    again = upsert(spark.createDataFrame(out, target.schema), batch, ["date"], "file_seq")
    assert sorted(again.collect()) == sorted(out)


def test_later_append_wins_whatever_the_file_names(spark, tmp_path):
    for trial in range(4):
        out = str(tmp_path / f"daily{trial}")
        for load in range(3):
            append_csv(spark.createDataFrame([(1, f"load {load}")], "id int, name string"), out, load=load)
        back = read_csv(spark, out, header=False, schema=StructType.fromDDL(
            "id int, name string, load_date date, load_seq bigint"))
        batch = with_file_order(back, load_col="load_seq")
        target = spark.createDataFrame([(1, "old")], "id int, name string")
        assert [r.name for r in upsert(target, batch, ["id"], "file_seq").collect()] == ["load 2"]


def test_upsert_refuses_null_sequences(spark):
    import pytest
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b", None), (2, "c", None)], "k int, v string, s int")
    with pytest.raises(Exception, match="null sequence"):
        upsert(target, batch, ["k"], "s").collect()


def test_upsert_refuses_duplicate_target_keys(spark):
    import pytest
    target = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    batch = spark.createDataFrame([(1, "c", 1)], "k int, v string, s int")
    with pytest.raises(Exception, match="duplicate keys"):
        upsert(target, batch, ["k"], "s").collect()
    assert upsert(target, batch, ["k"], "s", check_target=False).count() == 1


def test_upsert_keeps_untouched_and_inserts_new(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, s int")
    got = sorted(tuple(r) for r in upsert(target, batch, ["k"], "s").collect())
    assert got == [(1, "a"), (2, "y"), (3, "z")]


def test_append_csv_stamps_load_date(spark, tmp_path):
    out = str(tmp_path / "daily")
    append_csv(spark.createDataFrame([(1, "a")], "id int, name string"), out)
    append_csv(spark.createDataFrame([(2, "b")], "id int, name string"), out)
    back = read_csv(spark, out, header=False).collect()
    assert len(back) == 2 and all(r._c2 == str(dt.date.today()) for r in back)


def test_monthly_files_by_name_pattern(spark, tmp_path):
    from sluice.sources.files import empty_like, read_monthly, with_file_month
    root = tmp_path / "data"
    root.mkdir()
    for name, n in [("yellow_tripdata_2021-04.csv", 2), ("yellow_tripdata_2021-05.csv", 3),
                    ("green_tripdata_2021-04.csv", 7)]:
        (root / name).write_text("a,b\n" + "".join(f"{i},x\n" for i in range(n)))
    df = with_file_month(read_monthly(spark, str(root), "*yellow*"))
    got = sorted((r.file_year, r.file_month, r["count"]) for r in
                 df.groupBy("file_year", "file_month").count().collect())
    assert got == [(2021, 4, 2), (2021, 5, 3)]
    assert empty_like(spark, df).unionByName(df).count() == 5


def test_union_checks_and_missing_keys(spark):
    from sluice.operators.joins import missing_keys
    from sluice.operators.quality import rows_per_source_match
    from sluice.operators.sets import union_all, union_counts
    parts = [spark.range(3), spark.range(5)]
    u = union_all(parts, source_col="src")
    counts = union_counts(u, "src")
    expected = spark.createDataFrame([(0, 3), (1, 5)], "src int, n_rows long")
    assert rows_per_source_match(counts, expected, "src").count() == 0
    wrong = spark.createDataFrame([(0, 3), (1, 4)], "src int, n_rows long")
    assert [tuple(r) for r in rows_per_source_match(counts, wrong, "src").collect()] == [(1, 5, 4)]
    have = spark.createDataFrame([(2020, 1)], "year int, month int")
    want = spark.createDataFrame([(2020, 1), (2020, 2)], "year int, month int")
    assert [tuple(r) for r in missing_keys(want, have, ["year", "month"]).collect()] == [(2020, 2)]


def test_keyset_pages_cover_table_once(spark):
    from sluice.operators.ordering import page, page_after
    df = spark.range(0, 1000, numPartitions=4).selectExpr("id * 3 as k")
    seen, after = [], None
    while True:
        rows = [r.k for r in page_after(df, "k", after, 128).collect()]
        if not rows:
            break
        seen += rows
        after = rows[-1]
    assert seen == [i * 3 for i in range(1000)]
    assert [r.k for r in page(df, ["k"], 256, 128).collect()] == seen[256:384]
