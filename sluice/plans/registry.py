"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole driver tables.

Charts (W2), trips (W1), file sources/sinks, catalog tables (W3), upsert (W5), the sales stream (W4).
Queries that write tables as part of their work use fresh folders under the session's checkpoint dir.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.records import decode_json
from sluice.operators.joins import missing_keys
from sluice.operators.ordering import page
from sluice.operators.quality import null_rates, rows_per_source_match
from sluice.operators.sets import union_all, union_counts
from sluice.operators.upsert import dedup_last, upsert
from sluice.plans import charts as ch
from sluice.plans import jobs
from sluice.plans import relations as rel
from sluice.plans import trips as tr
from sluice.plans.charts import type_charts
from sluice.session import scratch_path
from sluice.sinks import catalog
from sluice.sinks.files import (append_csv, export_csv, write_monthly_files, write_parquet,
                                write_partitioned, write_reports)
from sluice.sources.files import (empty_like, read_csv, read_monthly, read_reports, with_file_month,
                                  with_file_order)
from sluice.streaming import sales as st


def chart_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned chart rows with their country (the input of every report)."""
    return ch.prepare_charts(rel.charts(spark, sf_dir), rel.country_aliases(spark, sf_dir))


def chart_rows(spark, sf_dir):
    """The cleaned rows themselves: names present, country found, duration in minutes."""
    return chart_data(spark, sf_dir).select("date", "country_name", "position", "track_id", "name",
                                            F.round("duration_minutes", 6).alias("duration_minutes"))


def report_folders(spark, sf_dir):
    """The whole charts job: rows exported as CSV, six reports written as CSV folders, read back by
    name; one row per report with its row count."""
    root = scratch_path(spark, "charts-job")
    export_csv(rel.charts(spark, sf_dir), f"{root}/charts")
    export_csv(rel.country_aliases(spark, sf_dir), f"{root}/aliases")
    ch.run_job(spark, f"{root}/charts", f"{root}/aliases", f"{root}/reports")
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
              for name, df in sorted(read_reports(spark, f"{root}/reports").items())]
    return union_all(counts)


def top_artists_by_country(spark, sf_dir):
    return ch.top_artists_by_country(chart_data(spark, sf_dir))


def top_songs_by_country(spark, sf_dir):
    return ch.top_songs_by_country(chart_data(spark, sf_dir))


def totals_by_country(spark, sf_dir):
    return ch.totals_by_country(chart_data(spark, sf_dir))


def genres_by_country(spark, sf_dir):
    return ch.genres_by_country(chart_data(spark, sf_dir))


def genres_by_country_legacy(spark, sf_dir):
    return ch.genres_by_country(chart_data(spark, sf_dir), legacy=True)


def repeat_number_ones_window(spark, sf_dir):
    return ch.repeat_number_ones(chart_data(spark, sf_dir), "window")


def repeat_number_ones_count(spark, sf_dir):
    return ch.repeat_number_ones(chart_data(spark, sf_dir), "count")


def multi_country_number_ones(spark, sf_dir):
    return ch.multi_country_number_ones(chart_data(spark, sf_dir))


def multi_country_number_ones_distinct(spark, sf_dir):
    return ch.multi_country_number_ones(chart_data(spark, sf_dir), distinct=True)


# -- trips (W1) ---------------------------------------------------------------------------


SAMPLE_ROWS = 1000
TRIP_COLS = ["pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "tip_amount", "pu_location",
             "do_location"]
TRIP_CSV_SCHEMA = ("pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, passenger_count int, "
                   "trip_distance double, tip_amount double, pu_location bigint, "
                   "do_location bigint")


def clean_trips(spark, sf_dir):
    return tr.within_month(rel.trips(spark, sf_dir))


def _rounded(stats: DataFrame) -> DataFrame:
    """Means rounded for comparison (the order of a floating-point sum is not fixed)."""
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_trip_distance", "avg_tip_amount")})


def daily_pickup_stats(spark, sf_dir):
    return _rounded(tr.daily_stats(clean_trips(spark, sf_dir), "pickup"))


def daily_dropoff_stats(spark, sf_dir):
    return _rounded(tr.daily_stats(clean_trips(spark, sf_dir), "dropoff"))


def trips_within_month(spark, sf_dir):
    return clean_trips(spark, sf_dir)


def trips_out_of_range(spark, sf_dir):
    return tr.outliers(rel.trips(spark, sf_dir))


def trips_kept_months(spark, sf_dir):
    """Trips that end in a month some file exists for."""
    trips = rel.trips(spark, sf_dir)
    return tr.keep_months(trips, tr.file_months(trips), tr.DROPOFF).select(*TRIP_COLS)


def trip_seconds_sorted_sample(spark, sf_dir):
    clean = clean_trips(spark, sf_dir).select(*TRIP_COLS)
    return tr.sorted_sample(tr.with_trip_seconds(clean), SAMPLE_ROWS)


def trips_with_zone(spark, sf_dir):
    return tr.attach_zone(clean_trips(spark, sf_dir).select(*TRIP_COLS), rel.zones(spark, sf_dir))


def time_bounds_before(spark, sf_dir):
    """Bounds of every file as it came: false where it holds other dates."""
    return tr.time_bounds(rel.trips(spark, sf_dir))


def time_bounds_by_month(spark, sf_dir):
    """Bounds of every file after cleaning: all true."""
    return tr.time_bounds(clean_trips(spark, sf_dir))


def months_present(spark, sf_dir):
    return tr.months_present(rel.trips(spark, sf_dir))


def missing_months(spark, sf_dir):
    """Months in which trips end, but which have no file."""
    trips = rel.trips(spark, sf_dir)
    return missing_keys(tr.months_present(trips, tr.DROPOFF), tr.file_months(trips), ["year", "month"])


def _monthly_files(spark, sf_dir) -> str:
    """Trips as monthly CSV files named by month, among other files of the same folder (those of the first day, from the files
    just written: the trips are joined once)."""
    root = scratch_path(spark, "monthly-csv")
    write_monthly_files(rel.trips(spark, sf_dir), root, "yellow_tripdata", tr.FILE_YEAR, tr.FILE_MONTH)
    decoy = _read_yellow(spark, root).drop("source_file").where(F.dayofmonth(tr.PICKUP) == 1)
    write_monthly_files(decoy, root, "green_tripdata", tr.FILE_YEAR, tr.FILE_MONTH)
    return root


def _read_yellow(spark, root: str) -> DataFrame:
    return with_file_month(read_monthly(spark, root, "yellow_tripdata_*.csv",
                                        schema=StructType.fromDDL(TRIP_CSV_SCHEMA)))


def file_months(spark, sf_dir):
    """Monthly CSV files selected by a part of their name, read as one set; the month comes
    from each file's name."""
    back = _read_yellow(spark, _monthly_files(spark, sf_dir))
    return back.groupBy("file_year", "file_month").agg(F.count(F.lit(1)).alias("n_trips"))


def input_files(spark, sf_dir):
    """Number of months that came as files, against the months the data should have."""
    back = _read_yellow(spark, _monthly_files(spark, sf_dir))
    found = back.agg(F.count_distinct(F.regexp_extract("source_file", r"_(\d{4}-\d{2})_", 1)).alias("n"))
    wanted = rel.trips(spark, sf_dir).agg(F.count_distinct("file_year", "file_month").alias("n"))
    return found.select(F.lit("files").alias("side"), "n").unionAll(
        wanted.select(F.lit("expected").alias("side"), "n"))


def trips_job_stats(spark, sf_dir):
    """The whole taxi job over monthly files; its pick-up stats read back."""
    root = _monthly_files(spark, sf_dir)
    zones, out = scratch_path(spark, "zones"), scratch_path(spark, "trips-job")
    rel.zones(spark, sf_dir).write.option("header", True).option("sep", ";").csv(zones)
    tr.run_job(spark, root, zones, out, StructType.fromDDL(TRIP_CSV_SCHEMA), pattern="yellow_tripdata_*.csv")
    return _rounded(spark.read.parquet(f"{out}/pickup_stats"))


def trips_job_order(spark, sf_dir):
    """The trips written by the taxi job: rows per month and how many of them stand behind a trip they
    should precede in their file (0)."""
    root = _monthly_files(spark, sf_dir)
    zones, out = scratch_path(spark, "zones"), scratch_path(spark, "trips-job")
    rel.zones(spark, sf_dir).write.option("header", True).option("sep", ";").csv(zones)
    tr.run_job(spark, root, zones, out, StructType.fromDDL(TRIP_CSV_SCHEMA), pattern="yellow_tripdata_*.csv",
               rows_per_file=500_000)
    back = spark.read.parquet(f"{out}/trips").select(
        "year", "month", "pickup_ts", "trip_duration_sec", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    before = Window.partitionBy("file").orderBy("block", "pos")  # a file holds at most rows_per_file rows
    back = back.withColumn("p", F.lag("pickup_ts").over(before)).withColumn("s", F.lag("trip_duration_sec").over(before))
    wrong = (F.col("p") > F.col("pickup_ts")) | (
        (F.col("p") == F.col("pickup_ts")) & (F.col("s") < F.col("trip_duration_sec")))
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_trips"),
                                             F.count_if(F.coalesce(wrong, F.lit(False))).alias("misplaced"))


def corrupt_rows(spark, sf_dir):
    """Order lines exported as CSV with text in a numeric field of some; read with a declared schema, the raw
    line of each bad row captured, its bad field null."""
    root = scratch_path(spark, "bad-csv")
    li = rel.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_partkey").cast("string")).alias("l_partkey"))
    export_csv(li, root)
    back = read_csv(spark, root, capture_bad=True, schema=StructType.fromDDL(
        "l_orderkey bigint, l_linenumber int, l_partkey bigint"))
    return back.select("l_orderkey", "l_linenumber", "l_partkey", F.col("_corrupt_record").alias("raw"))


def empty_then_filled(spark, sf_dir):
    """An empty relation with the trips' schema, the trips added to it by name."""
    trips = rel.trips(spark, sf_dir)
    return empty_like(spark, trips).unionByName(trips)


def partitioned_roundtrip(spark, sf_dir):
    """Clean trips written as year=/month= Parquet partitions and read back whole."""
    root = scratch_path(spark, "trips-by-month")
    write_partitioned(tr.with_year_month(clean_trips(spark, sf_dir).select(*TRIP_COLS)), root, ["year", "month"])
    return spark.read.parquet(root)


def monthly_union(spark, sf_dir):
    """Rows of every input of a union (one folder per file year, read as one set), counted in one pass."""
    root = scratch_path(spark, "trips-by-year")
    write_partitioned(rel.trips(spark, sf_dir).withColumnRenamed("file_year", "source_year"), root, ["source_year"])
    return union_counts(spark.read.parquet(root), "source_year")


def union_complete(spark, sf_dir):
    """Rows of every input of a union, in the union and in the input itself: that of a plain union, which keeps them, and of one
    that drops repeated rows."""
    trips = rel.trips(spark, sf_dir).drop("pickup_ts", "dropoff_ts", "tip_amount", "trip_distance", "pu_location", "do_location")
    halves = [trips.where("file_month <= 6"), trips.where("file_month > 6")]
    inputs = union_counts(union_all(halves, source_col="input"), "input")
    plain = union_counts(union_all(halves, source_col="input"), "input")
    distinct = union_counts(union_all(halves, source_col="input").distinct(), "input")
    return union_all([rows_per_source_match(counts, inputs, "input", broken_only=False).withColumn("kind", F.lit(kind))
                      for kind, counts in (("all", plain), ("distinct", distinct))])


def catalog_tables(spark, sf_dir):
    """Create, append, replace and reset on the session catalog: monthly trips gathered in a table, outliers
    then filtered out of it; rows by file month."""
    name = catalog.reset_table(spark, f"trips_{uuid.uuid4().hex[:12]}", "sluice_work")
    trips = rel.staged_trips(spark, sf_dir)
    catalog.create_table(trips.where("file_month <= 6"), name)
    catalog.append_table(trips.where("file_month > 6"), name)
    catalog.replace_table(spark, name, tr.within_month)
    root = scratch_path(spark, "catalog-result")
    spark.table(name).groupBy("file_year", "file_month").agg(F.count(F.lit(1)).alias("n_trips")).write.parquet(root)
    catalog.reset_table(spark, name)
    return spark.read.parquet(root)


def _charts_csv(spark, sf_dir):
    root = scratch_path(spark, "charts-csv")
    export_csv(rel.charts(spark, sf_dir), root)
    return read_csv(spark, root)


def csv_roundtrip(spark, sf_dir):
    """Chart rows -> header CSV -> read back as all strings -> typed at ingest."""
    return type_charts(_charts_csv(spark, sf_dir))


def null_rates_typed_charts(spark, sf_dir):
    """Null rate per column after the typed CSV ingest (a data check)."""
    return null_rates(type_charts(_charts_csv(spark, sf_dir)))


# -- keyed upsert (W5), paging ---------------------------------------------------------------

UPSERT_SPLIT = "1998-01-01"
ORDER_COLS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def upsert_last_wins(spark, sf_dir):
    """Latest order per customer: a target built from orders before the split date, then
    the later orders applied as one batch (key o_custkey, sequence o_orderkey)."""
    orders = rel.table(spark, sf_dir, "orders").select(*ORDER_COLS)
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    target = dedup_last(orders.filter(F.col("o_orderdate") < split), ["o_custkey"], "o_orderkey")
    batch = orders.filter(F.col("o_orderdate") >= split)
    return upsert(target, batch, ["o_custkey"], "o_orderkey")


def daily_csv_upsert(spark, sf_dir):
    """The daily job: a table of the latest order per customer before the split date, and one dated, headerless CSV load per
    later year, each written in falling order of o_orderkey; the loads are read back by position and upserted, the last
    row in file order of the last load winning."""
    root = scratch_path(spark, "daily-csv")
    orders = rel.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    target = dedup_last(orders.where(F.col("o_orderdate") < split), ["o_custkey"], "o_orderkey").drop("o_orderdate")
    later = orders.where(F.col("o_orderdate") >= split).withColumn("load", F.least(F.year("o_orderdate"), F.lit(2001)))
    for load in range(1998, 2002):
        rows = later.where(F.col("load") == load).orderBy(F.desc("o_orderkey"))
        append_csv(rows.select("o_custkey", "o_orderkey", "o_totalprice"), root, load=load)
    back = with_file_order(read_csv(spark, root, header=False, schema=StructType.fromDDL(
        "o_custkey bigint, o_orderkey bigint, o_totalprice double, load_date date, load_seq bigint")),
        load_col="load_seq")
    return upsert(target, back, ["o_custkey"], "file_seq")


PAGE_OFFSET, PAGE_SIZE = 2000, 1000


def orders_page(spark, sf_dir):
    return page(rel.table(spark, sf_dir, "orders"), ["o_orderkey"], PAGE_OFFSET, PAGE_SIZE)


# -- sales stream (W4) ---------------------------------------------------------------------


def _messages(spark, sf_dir):
    events = rel.sales_events(spark, sf_dir)
    start, end = st.period_bounds(events)
    return st.sales_messages(events.withColumnRenamed("event_type", "product"), start, end)


def sales_messages(spark, sf_dir):
    return _messages(spark, sf_dir)


def _drained(spark, sf_dir, messages: DataFrame) -> str:
    """Messages published as files per target partition, drained by the streaming sink; its root."""
    root = scratch_path(spark, "sales")
    st.publish_messages(messages, "json", f"{root}/topic")
    st.run_sales_sink(st.sales_source(spark, "json", f"{root}/topic"), f"{root}/sink", f"{root}/checkpoint")
    return f"{root}/sink"


def sales_sink(spark, sf_dir):
    """The sink table after a restart from the checkpoint and a replay of its first batch: rows with their
    load date; ``rows_of_id`` is 1 for a unique id."""
    root = scratch_path(spark, "sales")
    messages = _messages(spark, sf_dir)
    st.publish_messages(messages, "json", f"{root}/topic")
    for _ in range(2):  # the second run finds nothing new
        st.run_sales_sink(st.sales_source(spark, "json", f"{root}/topic"), f"{root}/sink", f"{root}/checkpoint")
    replay = spark.read.schema(st.MESSAGE_SCHEMA).json(f"{root}/topic")
    st.write_batch(f"{root}/sink")(replay, 0)  # the same batch again, as after a failure
    rows = st.read_sink(spark, f"{root}/sink")
    ids = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    return rows.join(ids, "id").select(
        "product", "date", "partition", (F.datediff(F.current_date(), "created_at") <= 1).alias("loaded_now"),
        "rows_of_id")


def sales_rejects(spark, sf_dir):
    """A topic shared with another producer: besides the sales messages it carries each
    event's ``props`` record (no product, no date).  The stream sink keeps the sales rows
    and diverts the foreign records to its reject output, which is read back here."""
    foreign = rel.table(spark, sf_dir, "events").select(
        F.col("props").alias("value"), F.lit(0).alias("partition"))
    sink = _drained(spark, sf_dir, _messages(spark, sf_dir).unionByName(foreign))
    return st.read_rejects(spark, sink).select("value", "partition")


def sales_clean_rejects(spark, sf_dir):
    """Rejects per partition of a stream without bad rows: none, next to the rows kept."""
    sink = _drained(spark, sf_dir, _messages(spark, sf_dir))
    good = st.read_sink(spark, sink).select("partition", F.lit(0).alias("bad"))
    bad = st.read_rejects(spark, sink).select("partition", F.lit(1).alias("bad"))
    return good.unionAll(bad).groupBy("partition").agg(F.count_if(F.col("bad") == 0).alias("kept"),
                                                       F.count_if(F.col("bad") == 1).alias("rejected"))


def sales_decoded(spark, sf_dir):
    """Batch decode of the messages (the stream's per-batch logic on the whole set)."""
    good, _ = st.decode_sales(_messages(spark, sf_dir))
    return good


# -- more sources and sinks ----------------------------------------------------------------


def zone_lookup_csv(spark, sf_dir):
    """Zone lookup exported as a ';'-separated CSV with header, read back as strings."""
    root = scratch_path(spark, "zones-csv")
    rel.zones(spark, sf_dir).write.option("header", True).option("sep", ";").csv(root)
    return read_csv(spark, root, sep=";")


def daily_pickup_parquet(spark, sf_dir):
    """Daily pick-up stats written as 20 Parquet files (round robin) and read back, with the number of files
    each row's set has."""
    root = scratch_path(spark, "pickup-stats")
    write_parquet(daily_pickup_stats(spark, sf_dir), root, files=20)
    back = spark.read.parquet(root)
    files = back.select(F.count_distinct("_metadata.file_path").alias("n")).scalar()
    return back.withColumn("n_files", files)


def sorted_trip_files(spark, sf_dir):
    """Clean trips with durations written as a sorted file set (pick-up ascending, duration
    descending: range partitions, each sorted) and read back."""
    root = scratch_path(spark, "sorted-trips")
    tr.sort_trips(tr.with_trip_seconds(clean_trips(spark, sf_dir).select(*TRIP_COLS))).write.parquet(root)
    return spark.read.parquet(root)


# -- legacy list split on the flagship; JSON decode of event properties -------------------


def top_artists_by_country_legacy(spark, sf_dir):
    """The flagship with the original job's list split (items keep leading blanks)."""
    return ch.top_artists_by_country(chart_data(spark, sf_dir), legacy=True)


def event_props(spark, sf_dir):
    """``props`` JSON text of every event decoded into typed fields (bad text -> null)."""
    events = rel.table(spark, sf_dir, "events").select("event_id", "props")
    return events.select("event_id", decode_json("props", "k int").alias("p")) \
        .select("event_id", F.col("p.k").alias("k"))


def event_prop_counts(spark, sf_dir):
    """Events whose ``props`` map holds a given entry kind (a predicate on a map element), counted by value."""
    events = rel.table(spark, sf_dir, "events").select("event_type", F.from_json(
        "props", "map<string,string>").alias("props"))
    return events.where(F.element_at("props", "k").cast("int") >= 50) \
        .groupBy(F.col("props")["k"].cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))


def order_priority_counts(spark, sf_dir):
    """Orders per priority."""
    return rel.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_artists_by_country": top_artists_by_country,
    "top_songs_by_country": top_songs_by_country,
    "totals_by_country": totals_by_country,
    "genres_by_country": genres_by_country,
    "genres_by_country_legacy": genres_by_country_legacy,
    "repeat_number_ones_window": repeat_number_ones_window,
    "repeat_number_ones_count": repeat_number_ones_count,
    "multi_country_number_ones": multi_country_number_ones,
    "multi_country_number_ones_distinct": multi_country_number_ones_distinct,
    "daily_pickup_stats": daily_pickup_stats,
    "daily_dropoff_stats": daily_dropoff_stats,
    "trips_within_month": trips_within_month,
    "trips_out_of_range": trips_out_of_range,
    "trips_kept_months": trips_kept_months,
    "trip_seconds_sorted_sample": trip_seconds_sorted_sample,
    "trips_with_zone": trips_with_zone,
    "time_bounds_by_month": time_bounds_by_month,
    "months_present": months_present,
    "missing_months": missing_months,
    "file_months": file_months,
    "partitioned_roundtrip": partitioned_roundtrip,
    "monthly_union": monthly_union,
    "csv_roundtrip": csv_roundtrip,
    "null_rates": null_rates_typed_charts,
    "upsert_last_wins": upsert_last_wins,
    "orders_page": orders_page,
    "sales_messages": sales_messages,
    "sales_sink": sales_sink,
    "sales_decoded": sales_decoded,
    "sales_rejects": sales_rejects,
    "zone_lookup_csv": zone_lookup_csv,
    "daily_pickup_parquet": daily_pickup_parquet,
    "sorted_trip_files": sorted_trip_files,
    "top_artists_by_country_legacy": top_artists_by_country_legacy,
    "event_props": event_props,
    "event_prop_counts": event_prop_counts,
    "order_priority_counts": order_priority_counts,
    "chart_rows": chart_rows,
    "report_folders": report_folders,
    "time_bounds_before": time_bounds_before,
    "input_files": input_files,
    "trips_job_stats": trips_job_stats,
    "trips_job_order": trips_job_order,
    "corrupt_rows": corrupt_rows,
    "empty_then_filled": empty_then_filled,
    "union_complete": union_complete,
    "catalog_tables": catalog_tables,
    "daily_csv_upsert": daily_csv_upsert,
    "sales_clean_rejects": sales_clean_rejects,
}
QUERIES |= jobs.QUERIES
