"""Registered queries of jobs that write, fail, restart, merge and check: ``(spark, sf_dir) -> DataFrame``.

Each works on whole driver tables and returns what its job left behind, so that the oracle can compare it.
Tables are written to fresh folders under the session's checkpoint dir.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.time import year_month
from sluice.operators.joins import missing_keys
from sluice.operators.ordering import take_sorted
from sluice.operators.serial import append_serial, with_serial
from sluice.operators.sets import union_all
from sluice.operators.upsert import dedup_last
from sluice.plans import charts as ch
from sluice.plans import relations as rel
from sluice.plans import trips as tr
from sluice.session import scratch_path
from sluice.sinks import catalog
from sluice.sinks.buckets import create_buckets, merge_buckets
from sluice.sinks.checked import CheckFailed, write_checked
from sluice.sinks.compact import compact_folders, folder_files
from sluice.sinks.files import export_csv, write_partitioned
from sluice.sources.files import read_drifted, read_reports
from sluice.sources.statistics import footer_bounds
from sluice.streaming import sales as st

TRIP_COLS = ["pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "tip_amount", "pu_location", "do_location"]


# -- sales stream ----------------------------------------------------------------------------


def _published_in_loads(spark, sf_dir, topic: str, loads: int = 3) -> None:
    """Sales messages published by several loads, so that the topic holds several files per partition."""
    events = rel.sales_events(spark, sf_dir)
    start, end = st.period_bounds(events)
    sales = events.withColumnRenamed("event_type", "product")
    for load in range(loads):
        st.publish_messages(st.sales_messages(sales.where(F.col("event_id") % loads == load), start, end), "json", topic)


def sales_sink_restart(spark, sf_dir):
    """The sink over several micro-batches, one of which fails after its write and before its progress is kept; the
    query is started again from the same checkpoint and replays that batch.  Rows of the sink; ``rows_of_id`` is 1."""
    root = scratch_path(spark, "sales-restart")
    _published_in_loads(spark, sf_dir, f"{root}/topic")
    files = spark.read.schema(st.MESSAGE_SCHEMA).json(f"{root}/topic").select("_metadata.file_path").distinct().count()
    lost: list[int] = []

    def fail_once(batch_id: int, counts: dict) -> None:
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise RuntimeError("the sink's process is lost after the write of batch 1")
    for _ in range(2):
        stream = st.sales_source(spark, "json", f"{root}/topic", max_files_per_trigger=max(1, files // 4))
        try:
            st.run_sales_sink(stream, f"{root}/sink", f"{root}/checkpoint", after_write=fail_once)
        except StreamingQueryException:
            if lost != [1]:
                raise
    rows = st.read_sink(spark, f"{root}/sink")
    ids = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    batches = rows.select(F.count_distinct("batch_id").alias("n")).scalar()
    return rows.join(ids, "id").select("product", "date", "partition", "rows_of_id", (batches >= 3).alias("several_batches"),
                                       F.lit(len(lost)).alias("failures"))


def sales_routed_stream(spark, sf_dir):
    """The producer as a stream: event files in, routed message files out through the sink's commit log; the second
    start finds nothing new.  The topic read back."""
    root = scratch_path(spark, "sales-routed")
    events = rel.sales_events(spark, sf_dir)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    start = dt.datetime.combine(first.date(), dt.time())
    end = dt.datetime.combine(last.date(), dt.time(23, 59, 59))
    export = events.withColumnRenamed("event_type", "product")
    for load in range(3):
        export.where(F.col("event_id") % 3 == load).write.mode("append").parquet(f"{root}/sales")
    for _ in range(2):
        sales = st.sales_rows_source(spark, f"{root}/sales", export.schema, max_files_per_trigger=2)
        st.run_message_stream(sales, start, end, f"{root}/checkpoint", "json", path=f"{root}/topic")
    return spark.read.schema(st.MESSAGE_SCHEMA).json(f"{root}/topic").select("value", "partition")


def sales_serial_ids(spark, sf_dir):
    """Dense ids in the order of time, the second half of the period loaded after, and numbered on from, the first."""
    root = scratch_path(spark, "sales-serial")
    events = rel.sales_events(spark, sf_dir)
    start, end = st.period_bounds(events)
    halves = events.withColumn("half", st.choose_partition(F.col("ts"), start, end))
    with_serial(halves.where("half = 0"), ["ts", "event_id"]).write.parquet(root)
    append_serial(spark.read.parquet(root), halves.where("half = 1"), ["ts", "event_id"]).write.mode("append").parquet(root)
    return spark.read.parquet(root).select("event_id", "half", "id")


def checked_writes(spark, sf_dir):
    """What checks in the writing pass report: rows and null names of the chart rows, the same from the error of a limit, the rows
    of a union against its inputs, and rows and rejects per stream sink."""
    root = scratch_path(spark, "checked")

    def parquet(name: str):
        return lambda df: df.write.option("compression", "zstd").parquet(f"{root}/{name}")
    rates = write_checked(rel.charts(spark, sf_dir), parquet("charts"), {"name": 1.0, "date": 0.0})
    found = [("null names", rates["rows"], round(rates["rows"] * rates["nulls"]["name"]))]
    try:
        write_checked(spark.read.parquet(f"{root}/charts"), parquet("refused"), {"name": 0.0})
    except CheckFailed as exc:
        found.append(("null names, refused", exc.rates["rows"], round(exc.rates["rows"] * exc.rates["nulls"]["name"])))
    trips = rel.staged_trips(spark, sf_dir)
    halves = [write_checked(trips.where(part), parquet(f"half-{n}"))
              for n, part in enumerate(("file_month <= 6", "file_month > 6"))]
    both = union_all([spark.read.parquet(f"{root}/half-{n}") for n in range(2)])
    whole = write_checked(both, parquet("both"), expected_rows=sum(h["rows"] for h in halves))
    found.append(("union", whole["rows"], 0))

    foreign = rel.table(spark, sf_dir, "events").select(F.col("props").alias("value"), F.lit(0).alias("partition"))
    foreign.write.json(f"{root}/topic")
    _published_in_loads(spark, sf_dir, f"{root}/messages")
    spark.read.schema(st.MESSAGE_SCHEMA).json(f"{root}/messages").write.mode("append").json(f"{root}/topic")
    seen: dict[int, dict] = {}
    st.run_sales_sink(st.sales_source(spark, "json", f"{root}/topic"), f"{root}/sink", f"{root}/checkpoint",
                      max_reject_rate=0.9, after_write=seen.__setitem__)
    found.append(("stream rejects", sum(c["rows"] for c in seen.values()), sum(c["rejects"] for c in seen.values())))
    return spark.createDataFrame(found, "check string, n_rows long, n_bad long")


# -- keyed merge -----------------------------------------------------------------------------

BUCKETS = 256


def upsert_buckets(spark, sf_dir):
    """Latest order per customer, stored by key bucket; the orders of the last day are merged into the buckets they hit.
    ``rewritten`` tells rows in files that the merge wrote."""
    path, before = scratch_path(spark, "bucketed"), scratch_path(spark, "bucketed-files")
    orders = rel.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    last = orders.select(F.max("o_orderdate").alias("d")).scalar()
    create_buckets(dedup_last(orders.where(F.col("o_orderdate") < last), ["o_custkey"], "o_orderkey"), path, ["o_custkey"], BUCKETS)
    spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct().write.parquet(before)
    merge_buckets(spark, path, orders.where(F.col("o_orderdate") == last), ["o_custkey"], "o_orderkey", BUCKETS)
    rows = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    old = spark.read.parquet(before).withColumn("old", F.lit(True))
    return rows.join(old, "file", "left").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "bucket",
                                                 F.col("old").isNull().alias("rewritten"))


def table_defaults(spark, sf_dir):
    """A catalog table with column defaults, filled from the events by a column subset and from literal rows."""
    name = catalog.reset_table(spark, f"sales_{uuid.uuid4().hex[:12]}", "sluice_work")
    catalog.create_table_with_defaults(
        spark, name, {"id": "bigint", "product": "string", "sold_at": "timestamp_ntz", "created_at": "date", "origin": "string"},
        {"created_at": "current_date()", "origin": "'import'"})
    catalog.insert_columns(rel.sales_events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("product"), F.col("ts").alias("sold_at")), name)
    catalog.insert_values(spark, name, ["id", "product", "sold_at", "origin"], [
        ("-1", "'refund'", "timestamp_ntz'2024-04-01 10:00:00'", "'by hand'"),
        ("-2", "'refund'", "timestamp_ntz'2024-04-01 10:00:01.5'", "DEFAULT")])
    root = scratch_path(spark, "defaults")
    spark.table(name).write.parquet(root)
    catalog.reset_table(spark, name)
    return spark.read.parquet(root).select(
        "id", "product", "sold_at", "origin", (F.datediff(F.current_date(), "created_at") <= 1).alias("created_now"))


# -- month folders ---------------------------------------------------------------------------


def trips_kept_folders(spark, sf_dir):
    """``trips_kept_months`` over folders by drop-off month: the months that have a file select the folders to read."""
    root, listed = scratch_path(spark, "trips-by-dropoff"), scratch_path(spark, "listed-months")
    trips = rel.trips(spark, sf_dir)
    tr.file_months(trips).write.parquet(listed)
    write_partitioned(tr.with_year_month(trips.select(*TRIP_COLS), tr.DROPOFF), root, ["year", "month"])
    return tr.keep_month_folders(spark.read.parquet(root), spark.read.parquet(listed)).select(*TRIP_COLS)


def time_bounds_footers(spark, sf_dir):
    """First pick-up, last drop-off and rows per file month, answered from the footers of Parquet files by month."""
    root, out = scratch_path(spark, "trips-footers"), scratch_path(spark, "footer-bounds")
    trips = rel.trips(spark, sf_dir)
    micros = trips.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in (tr.PICKUP, tr.DROPOFF)})
    write_partitioned(micros, root, [tr.FILE_YEAR, tr.FILE_MONTH])
    bounds = footer_bounds(spark, root, [tr.PICKUP, tr.DROPOFF], [tr.FILE_YEAR, tr.FILE_MONTH])
    bounds.select(tr.FILE_YEAR, tr.FILE_MONTH, *[F.timestamp_micros(f"{n}_{c}").cast("timestamp_ntz").alias(name) for n, c, name in (
        ("min", tr.PICKUP, "min_pickup"), ("max", tr.DROPOFF, "max_dropoff"))], "n_rows").write.parquet(out)
    return spark.read.parquet(out)


def drifted_months(spark, sf_dir):
    """Months of three schemas read as one set: up to April without passengers and under an older column name, up to
    August as now, then with a column more."""
    root = scratch_path(spark, "trips-drifted")
    trips = rel.staged_trips(spark, sf_dir)
    by = [tr.FILE_YEAR, tr.FILE_MONTH]
    write_partitioned(trips.where("file_month <= 4").drop("passenger_count").withColumnRenamed("tip_amount", "tip"), root, by)
    write_partitioned(trips.where("file_month between 5 and 8"), root, by)
    write_partitioned(trips.where("file_month > 8").withColumn("airport_fee", F.lit(1.5)), root, by)
    schema = StructType([f for f in trips.schema.fields])
    return read_drifted(spark, root, schema, {"tip": "tip_amount"})


def partition_replaced(spark, sf_dir):
    """Folders by file year and month; a second load replaces those of 1997 and leaves the others alone."""
    root = scratch_path(spark, "trips-replaced")
    trips, by = rel.staged_trips(spark, sf_dir), [tr.FILE_YEAR, tr.FILE_MONTH]
    write_partitioned(trips, root, by)
    write_partitioned(tr.within_month(trips.where("file_year = 1997")).withColumn("tip_amount", F.lit(0.0)), root, by)
    return spark.read.schema(trips.schema).parquet(root)


def compacted_folders(spark, sf_dir):
    """Months of the first quarter loaded in three parts, so that their folders hold small files; those folders are rewritten, the
    others keep their files.  One row per folder."""
    root, old = scratch_path(spark, "trips-small"), scratch_path(spark, "trips-small-files")
    trips, by = rel.staged_trips(spark, sf_dir), [tr.FILE_YEAR, tr.FILE_MONTH]
    write_partitioned(trips.where("file_month > 3"), root, by)
    for load in range(3):
        trips.where((F.col("file_month") <= 3) & (F.pmod(F.col("do_location"), F.lit(3)) == load)).hint("rebalance", *by) \
            .write.mode("append").partitionBy(*by).parquet(root)
    folder_files(spark, root, by).write.parquet(old)
    compact_folders(spark, root, by, 32 << 20)
    before = spark.read.parquet(old).withColumn("was", F.lit(1))
    both = folder_files(spark, root, by).withColumn("is", F.lit(1)).join(before.select(*by, "file", "was"), [*by, "file"], "full")
    return both.groupBy(*by).agg(F.sum("n_rows").alias("n_trips"), (F.count("is") < F.count("was")).alias("fewer_files"),
                                 (F.count_if(F.col("is").isNull() | F.col("was").isNull()) == 0).alias("untouched"))


# -- reports and data checks -------------------------------------------------------------------


def report_contents(spark, sf_dir):
    """The whole charts job; every line of the six report folders as text, its fields separated by ``|``."""
    root = scratch_path(spark, "charts-contents")
    export_csv(rel.charts(spark, sf_dir), f"{root}/charts")
    export_csv(rel.country_aliases(spark, sf_dir), f"{root}/aliases")
    ch.run_job(spark, f"{root}/charts", f"{root}/aliases", f"{root}/reports")
    return union_all([df.select(F.lit(name).alias("report"), F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in df.columns]).alias("line"))
                      for name, df in sorted(read_reports(spark, f"{root}/reports").items())])


def month_containment(spark, sf_dir):
    """Months in which trips end and for which no file exists, and months with a file in which no trip of it both starts and ends."""
    trips = rel.trips(spark, sf_dir)
    files, ends = tr.file_months(trips), tr.months_present(trips, tr.DROPOFF)
    no_file = missing_keys(ends, files, ["year", "month"]).withColumn("lacks", F.lit("file"))
    return no_file.unionByName(tr.missing_months(trips, tr.within_month(trips)).withColumn("lacks", F.lit("trips")))


def trips_by_pickup_month(spark, sf_dir):
    """Trips per month of their pick-up, as ``yyyy-MM``."""
    return rel.trips(spark, sf_dir).groupBy(year_month(tr.PICKUP).alias("pickup_month")).agg(F.count(F.lit(1)).alias("n_trips"))


def first_outlier(spark, sf_dir):
    """The first trip outside its file's month (a peek at the rows a filter finds), by time, then the rest of the row."""
    found = tr.outliers(rel.trips(spark, sf_dir))
    return take_sorted(found.select(*TRIP_COLS, "broken_bound"), [*TRIP_COLS], 1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    sales_sink_restart, sales_routed_stream, sales_serial_ids, checked_writes, upsert_buckets, table_defaults, trips_kept_folders,
    time_bounds_footers, drifted_months, partition_replaced, compacted_folders, report_contents, month_containment,
    trips_by_pickup_month, first_outlier)}
