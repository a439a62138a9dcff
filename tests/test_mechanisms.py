"""Restarts, serial ids, bucket merges, checked writes, compaction, drifted schemas, pruning and footers."""

import datetime as dt
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.serial import append_serial, with_serial
from sluice.operators.upsert import upsert
from sluice.plans import trips as tr
from sluice.sinks import catalog
from sluice.sinks.buckets import bucket_of, create_buckets, merge_buckets, read_buckets
from sluice.sinks.checked import CheckFailed, write_checked
from sluice.sinks.compact import compact_folders, folder_files
from sluice.sources.files import read_drifted
from sluice.sources.statistics import footer_bounds
from sluice.streaming import sales as st

START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31, 23, 59, 59)


def plan(df):
    return df._jdf.queryExecution().toString()


def sales(spark, n=200):
    return spark.createDataFrame([(f"p{i % 3}", dt.datetime(2024, 1 + i % 12, 1 + i % 28, i % 24)) for i in range(n)],
                                 "product string, ts timestamp_ntz")


# -- stream ----------------------------------------------------------------------------------


def topic_of(spark, path, bad=0):
    st.sales_messages(sales(spark), START, END).repartition(4).write.json(path)
    if bad:
        spark.createDataFrame([("no json", 0)] * bad, "value string, partition int").coalesce(1).write.mode("append").json(path)


@pytest.mark.parametrize("fail_at", [0, 1, 3])
def test_restart_after_a_failed_batch(spark, tmp_path, fail_at):
    topic, sink, check = (str(tmp_path / x) for x in ("topic", "sink", "check"))
    topic_of(spark, topic)
    lost = []

    def fail(batch_id, counts):
        if batch_id == fail_at and len(lost) < 2:  # the replay fails once more
            lost.append(counts["rows"])
            raise RuntimeError("lost")
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="lost"):
            st.run_sales_sink(st.sales_source(spark, "json", topic, max_files_per_trigger=1), sink, check, after_write=fail)
    st.run_sales_sink(st.sales_source(spark, "json", topic, max_files_per_trigger=1), sink, check, after_write=fail)
    rows = st.read_sink(spark, sink)
    assert rows.select("batch_id").distinct().count() == 4 and lost[0] == lost[1] > 0
    assert rows.select("id").distinct().count() == rows.count() == 200
    good, _ = st.decode_sales(st.sales_messages(sales(spark), START, END))
    assert rows.select("product", "date", "partition").exceptAll(good).isEmpty()


def test_reject_limit_fails_the_query(spark, tmp_path):
    topic, sink, check = (str(tmp_path / x) for x in ("topic", "sink", "check"))
    topic_of(spark, topic, bad=60)
    with pytest.raises(StreamingQueryException, match="60 rejects"):
        st.run_sales_sink(st.sales_source(spark, "json", topic), sink, check, max_reject_rate=0.1)
    counts = {}
    st.run_sales_sink(st.sales_source(spark, "json", topic), sink, check, max_reject_rate=0.5, after_write=counts.__setitem__)
    assert counts == {0: {"rows": 260, "rejects": 60}}


def test_listener_reports_rates(spark, tmp_path):
    topic, sink, check = (str(tmp_path / x) for x in ("topic", "sink", "check"))
    topic_of(spark, topic, bad=7)
    listener = st.RateListener()
    spark.streams.addListener(listener)
    try:
        st.run_sales_sink(st.RateListener.observed(st.sales_source(spark, "json", topic)), sink, check)
        for _ in range(100):
            if listener.batches:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [b[1:] for b in listener.batches if b[2]] == [(0, 207, 7)]


def test_routed_stream_publishes_once(spark, tmp_path):
    rows, topic, check = (str(tmp_path / x) for x in ("rows", "topic", "check"))
    data = sales(spark)
    for part in range(3):
        data.where(F.month("ts") % 3 == part).coalesce(1).write.mode("append").parquet(rows)

    def run():
        st.run_message_stream(st.sales_rows_source(spark, rows, data.schema, max_files_per_trigger=1), START, END, check, "json", path=topic)
        return spark.read.schema(st.MESSAGE_SCHEMA).json(topic)
    want = st.sales_messages(data, START, END)
    assert sorted(run().collect()) == sorted(want.collect())
    assert sorted(run().collect()) == sorted(want.collect())
    data.limit(5).coalesce(1).write.mode("append").parquet(rows)
    assert run().count() == 205


# -- serial ids ------------------------------------------------------------------------------


def test_serial_ids_are_dense_and_go_on(spark):
    data = spark.createDataFrame([(i * 7919 % 1000, i) for i in range(1000)], "k int, v int").repartition(7)
    first = with_serial(data.where("k < 600"), ["k"])
    assert [r.k for r in first.orderBy("id").collect()] == list(range(600))
    assert [r.id for r in first.orderBy("id").collect()] == list(range(1, 601))
    more = append_serial(first, data.where("k >= 600"), [F.desc("k")])
    assert [(r.id, r.k) for r in more.orderBy("id").collect()] == [(601 + i, 999 - i) for i in range(400)]
    assert "Window" not in plan(more) and "SinglePartition" not in plan(more)


def test_serial_ids_of_ties_and_nothing(spark):
    same = spark.createDataFrame([(1,)] * 50, "k int").repartition(5)
    numbered = with_serial(same, ["k"])
    assert sorted(r.id for r in numbered.collect()) == list(range(1, 51))
    assert with_serial(same.where("k > 1"), ["k"]).collect() == []
    assert append_serial(numbered.limit(0), same, ["k"]).agg(F.max("id")).first()[0] == 50


# -- bucket merge ----------------------------------------------------------------------------


def files_of(spark, path):
    return {(r.bucket, r.f) for r in spark.read.parquet(path).select("bucket", F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_merge_rewrites_only_hit_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.createDataFrame([(i, f"v{i}", None if i % 5 else i) for i in range(500)], "k long, v string, n long")
    batch = spark.createDataFrame([(3, "a", 1, 1), (3, "b", None, 2), (9_000, "new", 5, 1), (None, "null", 0, 1)],
                                  "k long, v string, n long, seq long")
    create_buckets(target, path, ["k"], 64)
    before = files_of(spark, path)
    want = sorted(map(str, upsert(target, batch, ["k"], "seq").collect()))
    hit = merge_buckets(spark, path, batch, ["k"], "seq", 64)
    assert sorted(map(str, read_buckets(spark, path).select("k", "v", "n").collect())) == want
    after = files_of(spark, path)
    assert {b for b, _ in before ^ after} == set(hit) and 1 < len(hit) <= 3 and len(before & after) > 40
    assert merge_buckets(spark, path, batch.limit(0), ["k"], "seq", 64) == []


def test_merge_reads_only_hit_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    create_buckets(spark.range(1000).withColumnRenamed("id", "k"), path, ["k"], 32)
    found = plan(spark.read.parquet(path).where(F.col("bucket").isin([3, 4])))
    assert "PartitionFilters: [bucket" in found
    rows = spark.range(10).select(bucket_of(["id"], 8).alias("b")).collect()
    assert all(0 <= r.b < 8 for r in rows) and len({r.b for r in rows}) > 2


# -- checked writes --------------------------------------------------------------------------


def test_checked_write_counts_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "x") for i in range(100)], "a int, b string").repartition(4)
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch
    rates = write_checked(df.mapInArrow(counted, df.schema), lambda d: d.write.parquet(str(tmp_path / "w")), {"b": 0.25, "*": 0.0})
    assert rates == {"rows": 100, "rejects": 0.0, "nulls": {"a": 0.0, "b": 0.25}} and calls.value == 100
    with pytest.raises(CheckFailed, match="nulls of b: 0.25") as failed:
        write_checked(df, lambda d: d.write.parquet(str(tmp_path / "x")), {"b": 0.2})
    assert failed.value.rates["rows"] == 100
    with pytest.raises(CheckFailed, match="rejects: 0.5"):
        write_checked(df, lambda d: d.write.parquet(str(tmp_path / "y")), {"*": 0.1}, rejected=F.col("a") < 50)
    with pytest.raises(CheckFailed, match="100 written, 101 expected"):
        write_checked(df, lambda d: d.write.parquet(str(tmp_path / "z")), expected_rows=101)
    assert write_checked(df.limit(0), lambda d: d.write.parquet(str(tmp_path / "e")))["nulls"]["a"] == 0.0


def test_column_defaults(spark):
    name = catalog.reset_table(spark, "defaults_t", "sluice_test")
    catalog.create_table_with_defaults(spark, name, {"a": "int", "made": "date", "who": "string"}, {"made": "current_date()", "who": "'me'"})
    catalog.insert_columns(spark.createDataFrame([(1,), (2,)], "a int"), name)
    catalog.insert_values(spark, name, ["a", "who"], [("3", "'you'"), ("4", "DEFAULT")])
    rows = spark.table(name).orderBy("a").collect()
    assert [(r.a, r.who) for r in rows] == [(1, "me"), (2, "me"), (3, "you"), (4, "me")]
    assert all(abs((r.made - dt.datetime.now(dt.timezone.utc).date()).days) <= 1 for r in rows)
    catalog.reset_table(spark, name)


# -- folders ---------------------------------------------------------------------------------


def test_month_folders_are_pruned_at_run_time(spark, tmp_path):
    root, months = str(tmp_path / "t"), str(tmp_path / "m")
    spark.range(240).selectExpr("id", "cast(2000 + id % 5 as int) year", "cast(1 + id % 12 as int) month") \
        .write.partitionBy("year", "month").parquet(root)
    spark.createDataFrame([(2001, 2), (2003, 7), (2001, 2), (None, 1)], "year int, month int").write.parquet(months)
    kept = tr.keep_month_folders(spark.read.parquet(root), spark.read.parquet(months))
    assert "dynamicpruning" in plan(kept)
    got = kept.withColumn("f", F.col("id")).collect()
    assert {(r.year, r.month) for r in got} == {(2001, 2), (2003, 7)} and len(got) == 8


def test_bounds_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id * 3 as x", "cast(id % 4 as int) g").write.partitionBy("g").parquet(root)
    found = footer_bounds(spark, root, ["x"], ["g"])
    assert "PushedAggregation: [COUNT(*), MIN(x), MAX(x)]" in plan(found)
    assert sorted(map(tuple, found.collect())) == [(g, 250, 3 * g, 3 * (996 + g)) for g in range(4)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_drifted_files_read_as_one(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.5)], "a int, tip double").write.mode("append").parquet(root)
    spark.createDataFrame([(2, 3.5, "x")], "a int, tip_amount double, more string").write.mode("append").parquet(root)
    spark.createDataFrame([(3,)], "a int").write.mode("append").parquet(root)
    schema = StructType.fromDDL("a bigint, tip_amount double, never date")
    rows = read_drifted(spark, root, schema, {"tip": "tip_amount"})
    assert rows.schema == schema
    assert sorted(map(tuple, rows.collect())) == [(1, 2.5, None), (2, 3.5, None), (3, None, None)]


def test_compaction_leaves_other_folders_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    data = spark.range(3000).selectExpr("id", "cast(id % 3 as int) g", "repeat(cast(id as string), 5) t")
    data.where("g = 0").coalesce(1).write.mode("append").partitionBy("g").parquet(root)
    for part in range(4):
        data.where(f"g > 0 and id % 4 = {part}").coalesce(1).write.mode("append").partitionBy("g").parquet(root)
    before = {(r.g, r.file): r.n_rows for r in folder_files(spark, root, ["g"]).collect()}
    done = compact_folders(spark, root, ["g"], 1 << 20).collect()
    after = {(r.g, r.file): r.n_rows for r in folder_files(spark, root, ["g"]).collect()}
    assert sorted((r.g, r.files, r.parts) for r in done) == [(1, 4, 1), (2, 4, 1)]
    assert [k for k in before if k[0] == 0] == [k for k in after if k[0] == 0] and len(after) == 3 and len(before) == 9
    assert sorted(map(tuple, spark.read.parquet(root).select(*data.columns).collect())) == sorted(map(tuple, data.collect()))
    assert compact_folders(spark, root, ["g"], 1 << 20).collect() == []
