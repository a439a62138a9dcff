"""Sales stream: routing, decode with rejects, replay-safe sink, stream = batch."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.streaming import sales as st

START = dt.datetime(2024, 1, 1, 0, 0, 0)
END = dt.datetime(2024, 12, 31, 23, 59, 59)


def test_partition_by_mid_year(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 7, 1, 12)), ("b", dt.datetime(2024, 7, 2, 0, 0, 1))],
                               "product string, ts timestamp_ntz")
    got = {r.value: r.partition for r in st.sales_messages(df, START, END).collect()}
    assert got == {'{"product":"a","date":"2024-07-01"}': 0,
                   '{"product":"b","date":"2024-07-02"}': 1}


def test_decode_routes_bad_rows(spark):
    msgs = spark.createDataFrame([('{"product":"a","date":"2024-01-05"}', 0),
                                  ("not json", 1), ('{"product":"b","date":"x"}', 1)],
                                 "value string, partition int")
    good, bad = st.decode_sales(msgs)
    assert [(r.product, r.date) for r in good.collect()] == [("a", dt.date(2024, 1, 5))]
    assert bad.count() == 2


def test_sink_rerun_adds_nothing_and_equals_batch(spark, tmp_path):
    events = spark.createDataFrame(
        [(f"p{i % 3}", dt.datetime(2024, 1 + i % 12, 1 + i % 28, i % 24)) for i in range(300)],
        "product string, ts timestamp_ntz")
    msgs = st.sales_messages(events, START, END)
    topic = str(tmp_path / "topic")
    msgs.repartition(3).write.json(topic)
    spark.createDataFrame([("garbage", 0)], "value string, partition int").write.mode("append").json(topic)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    for _ in range(2):
        st.run_sales_sink(st.sales_source(spark, "json", topic, max_files_per_trigger=1), sink, ck)
    out = st.read_sink(spark, sink)
    assert out.count() == 300
    assert out.select("id").distinct().count() == 300
    batch_good, _ = st.decode_sales(msgs)
    assert out.select("product", "date", "partition").exceptAll(batch_good).count() == 0
    assert st.read_rejects(spark, sink).collect()[0].value == "garbage"
    assert out.filter(F.col("created_at") != F.current_date()).count() == 0


def test_clean_stream_has_no_rejects(spark, tmp_path):
    events = spark.createDataFrame([("a", dt.datetime(2024, 2, 1))], "product string, ts timestamp_ntz")
    topic, sink = str(tmp_path / "topic"), str(tmp_path / "sink")
    st.sales_messages(events, START, END).write.json(topic)
    st.run_sales_sink(st.sales_source(spark, "json", topic), sink, str(tmp_path / "ck"))
    assert st.read_rejects(spark, sink).collect() == [] and st.read_sink(spark, sink).count() == 1


def test_period_is_part_of_the_query(spark):
    events = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2024, 1, 2, 7))],
                                   "product string, ts timestamp_ntz")
    got = {r.value[12]: r.partition for r in st.sales_messages(events, *st.period_bounds(events)).collect()}
    assert got == {"a": 0, "b": 1}
    none = events.where("product = 'x'")
    assert st.sales_messages(none, *st.period_bounds(none)).collect() == []


def test_publish_messages_to_files_by_partition(spark, tmp_path):
    events = spark.createDataFrame([("a", dt.datetime(2024, 2, 1)), ("b", dt.datetime(2024, 11, 1))],
                                   "product string, ts timestamp_ntz")
    out = str(tmp_path / "topic")
    st.publish_messages(st.sales_messages(events, START, END), fmt="json", path=out)
    back = {(r.partition, r.value) for r in spark.read.json(out).collect()}
    assert back == {(0, '{"product":"a","date":"2024-02-01"}'),
                    (1, '{"product":"b","date":"2024-11-01"}')}


def test_continuous_trigger_processes_and_stops(spark, tmp_path):
    events = spark.createDataFrame([(f"p{i}", dt.datetime(2024, 3, 1 + i)) for i in range(5)],
                                   "product string, ts timestamp_ntz")
    topic = str(tmp_path / "topic")
    st.sales_messages(events, START, END).write.json(topic)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    q = st.run_sales_sink(st.sales_source(spark, "json", topic), sink, ck,
                          available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert st.read_sink(spark, sink).count() == 5
