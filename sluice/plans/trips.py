"""Taxi-trip jobs (W1): month cleaning, durations, daily location stats, zone join.

A trip belongs to the month of the *file* it came in (``file_year``, ``file_month``, see
``with_file_month``).  Cleaning keeps trips that start on or after that month's first instant and end no
later than 23:59:59 of its last day: a monthly file may hold trips of any other date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import day_of, month_of, month_end, month_start, seconds_between
from sluice.operators.joins import attach_dimension, missing_keys
from sluice.operators.ordering import take_sorted

PICKUP, DROPOFF = "pickup_ts", "dropoff_ts"
ZONES_AT_ONCE = 500_000  # a zone lookup of so many rows (some 60 MB) is broadcast
SORTED_BYTES = 16 << 20  # of staged trips that one task sorts: some million rows, 200 MB in memory
FILE_YEAR, FILE_MONTH = "file_year", "file_month"


def _file_month() -> F.Column:
    return month_of(FILE_YEAR, FILE_MONTH)


def within_month(df: DataFrame) -> DataFrame:
    """Trips inside the month of their file."""
    return df.filter((F.col(PICKUP) >= month_start(_file_month()))
                     & (F.col(DROPOFF) <= month_end(_file_month())))


def outliers(df: DataFrame) -> DataFrame:
    """Trips outside the month of their file, with the bound they break (``start`` first)."""
    early = F.col(PICKUP) < month_start(_file_month())
    late = F.col(DROPOFF) > month_end(_file_month())
    return (df.filter(early | late)
            .withColumn("broken_bound", F.when(early, F.lit("start")).otherwise(F.lit("end"))))


def with_trip_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_sec", seconds_between(PICKUP, DROPOFF))


def trip_order() -> list[F.Column]:
    """Pick-up ascending, then duration descending."""
    return [F.asc(PICKUP), F.desc("trip_duration_sec")]


def sort_trips(df: DataFrame, files: int | None = None) -> DataFrame:
    """Trips by pick-up ascending, duration descending, as a sorted file set: range partitions (as many
    as the session shuffles to unless ``files`` says otherwise), each sorted inside; file order is
    trip order, and no single task sorts everything."""
    from sluice.operators.ordering import sort_for_files
    return sort_for_files(df, trip_order(), files)


def sorted_sample(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` trips by pick-up ascending, duration descending (rest of the row breaks
    ties, so the sample is deterministic)."""
    rest = [F.asc(c) for c in df.columns if c not in (PICKUP, "trip_duration_sec")]
    return take_sorted(df, [*trip_order(), *rest], n)


def daily_stats(trips: DataFrame, side: str = "pickup") -> DataFrame:
    """Per location and day: passenger sum, mean distance, mean tip (plain averages).

    ``side='pickup'`` groups by pick-up location and day, ``'dropoff'`` by drop-off.
    Hash aggregate with partial aggregation before the shuffle.
    """
    if side == "pickup":
        loc, ts, day_name = "pu_location", PICKUP, "pickup_date"
    elif side == "dropoff":
        loc, ts, day_name = "do_location", DROPOFF, "dropoff_date"
    else:
        raise ValueError(side)
    return (trips.groupBy(F.col(loc), day_of(ts).alias(day_name))
            .agg(F.sum("passenger_count").alias("passenger_sum"),
                 F.avg("trip_distance").alias("avg_trip_distance"),
                 F.avg("tip_amount").alias("avg_tip_amount")))


def attach_zone(trips: DataFrame, zones: DataFrame, side: str = "pickup") -> DataFrame:
    """Left join of the zone lookup on the pick-up (or drop-off) location; the lookup key
    is dropped, unmatched trips keep null zone fields."""
    loc = "pu_location" if side == "pickup" else "do_location"
    return attach_dimension(trips, zones, loc, "location_id", "left", drop_keys=("location_id",))


def with_year_month(df: DataFrame, ts: str = PICKUP) -> DataFrame:
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def time_bounds(df: DataFrame) -> DataFrame:
    """Per file month: first pick-up, last drop-off, and whether both lie inside the month (false before
    cleaning where a file holds other dates, true after it)."""
    return (df.groupBy(FILE_YEAR, FILE_MONTH)
            .agg(F.min(PICKUP).alias("min_pickup"), F.max(DROPOFF).alias("max_dropoff"))
            .select(FILE_YEAR, FILE_MONTH, "min_pickup", "max_dropoff",
                    ((F.col("min_pickup") >= month_start(_file_month()))
                     & (F.col("max_dropoff") <= month_end(_file_month()))).alias("in_bounds")))


def months_present(df: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Distinct (year, month) of a timestamp column."""
    return (df.select(F.year(ts).alias("year"), F.month(ts).alias("month")).distinct()
            .orderBy("year", "month"))


def file_months(df: DataFrame) -> DataFrame:
    """Distinct (year, month) of the files."""
    return df.select(F.col(FILE_YEAR).alias("year"), F.col(FILE_MONTH).alias("month")).distinct()


def missing_months(files: DataFrame, rows: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Months that have a file but no row of that month (empty: all expected months are there)."""
    return missing_keys(file_months(files), months_present(rows, ts), ["year", "month"])


def keep_months(df: DataFrame, months: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Rows whose month is among ``months`` (columns ``year``, ``month``): a left-semi join."""
    wanted = months.select(F.col("year").alias("__year"), F.col("month").alias("__month")).distinct()
    return df.join(wanted, (F.year(ts) == F.col("__year")) & (F.month(ts) == F.col("__month")), "left_semi")


def keep_month_folders(folders: DataFrame, months: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """As ``keep_months``, over rows stored in folders by ``year`` and ``month``: the month set is joined on the partition columns,
    so Spark prunes the folders to read at run time (dynamic partition pruning, given a filter on the months' side)."""
    wanted = months.groupBy(F.col("year").alias("__year"), F.col("month").alias("__month")) \
        .agg(F.count(F.lit(1)).alias("__n")).where("__n > 0")
    return folders.join(wanted, (F.col(year) == F.col("__year")) & (F.col(month) == F.col("__month")), "left_semi")


def run_job(spark, trips_folder: str, zones_csv: str, out_folder: str, schema,
            pattern: str = "*.csv", stat_files: int | None = None,
            rows_per_file: int | None = None) -> None:
    """The whole taxi job over a folder of monthly CSVs (one read, not one per file, and
    one CSV parse: the cleaned trips are staged as Parquet first).

    A file's month comes from its name (``..._yyyy-MM...csv``).  Writes ``pickup_stats`` /
    ``dropoff_stats`` (Parquet; ``stat_files`` files each if given, else as many as the data make) and the
    cleaned trips with their zone as ``year=/month=`` partitions, each file sorted by pick-up
    ascending and duration descending, of at most ``rows_per_file`` rows if given.  The cleaned trips of a
    file are trips of its month, so they come by folder and are written without a shuffle, unless the zones are too many
    to be broadcast.
    """
    from sluice.session import scratch_path, settings
    from sluice.sinks.files import write_parquet, write_partitioned
    from sluice.sources.files import read_csv, read_monthly, with_file_month

    staged = scratch_path(spark, "trips-clean")
    filed = with_file_month(read_monthly(spark, trips_folder, pattern, schema=schema)).drop("source_file")
    with_trip_seconds(within_month(filed)).drop(FILE_YEAR, FILE_MONTH) \
        .write.option("compression", "zstd").parquet(staged)
    trips = spark.read.parquet(staged)
    write_parquet(daily_stats(trips, "pickup"), f"{out_folder}/pickup_stats", files=stat_files)
    write_parquet(daily_stats(trips, "dropoff"), f"{out_folder}/dropoff_stats", files=stat_files)
    zones = read_csv(spark, zones_csv, sep=";").withColumn(
        "location_id", F.col("location_id").cast("bigint"))
    few = zones.limit(ZONES_AT_ONCE + 1).count() <= ZONES_AT_ONCE
    zoned = attach_zone(trips, F.broadcast(zones) if few else zones)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(SORTED_BYTES)}):
        write_partitioned(with_year_month(zoned), f"{out_folder}/trips", ["year", "month"], sort_within=trip_order(),
                          rows_per_file=rows_per_file, clustered=few)
