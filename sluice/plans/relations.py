"""Relations the workloads run on, derived from the driver's TPC-H-like tables.

* charts (C): one row per line item - the order's customer nation is the country, the line
  number the chart position, the quantity the streams, the part the track.  Parts of size 25
  or 50 have no name (rows the cleaning must drop).
* aliases: one per nation; nations of region 4 are spelled in a way that no chart row uses, so their
  chart rows find no country.
* trips (T): one row per line item - order date = pick-up, ship date = drop-off, supplier = pick-up
  location, part = drop-off location.  A trip is filed three days after its pick-up, so a monthly file
  holds trips that start before its month and trips that end after it.
* zones: supplier with its nation; suppliers with a negative balance are listed under a
  location id that no trip uses, so their trips find no zone.
* sales events (E): ``events`` - event type as product.

Every table is read whole, and nothing is kept between queries: a query's plan starts at the base
tables (or at trips that the query itself staged from them), reads only the columns it needs and sees rows appended meanwhile.  Joins run fact-first (line
items, orders, customer, part); Catalyst and AQE choose broadcast or sort-merge and split skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

FILING_DAYS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _quoted_list(*items) -> F.Column:
    """``['a', 'b']`` text from columns."""
    parts = []
    for i, item in enumerate(items):
        if i:
            parts.append(F.lit("', '"))
        parts.append(item)
    return F.concat(F.lit("['"), *parts, F.lit("']"))


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed chart rows: date, country, position, streams, track_id, artists,
    artist_genres, duration, explicit, name."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                               "p_size")
    genres = F.concat(F.lit("['"), F.lower("p_type"), F.lit("','"),
                      F.replace(F.col("p_name"), F.lit(" "), F.lit("','")), F.lit("']"))
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .join(cust, orders.o_custkey == cust.c_custkey)
            .join(part, li.l_partkey == part.p_partkey)
            .select(
                F.to_date("o_orderdate").alias("date"),
                F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("country"),
                F.col("l_linenumber").alias("position"),
                F.col("l_quantity").cast("bigint").alias("streams"),
                F.col("l_partkey").cast("string").alias("track_id"),
                _quoted_list(F.col("p_brand"), F.col("p_type")).alias("artists"),
                genres.alias("artist_genres"),
                (F.col("p_size") * 10000).alias("duration"),
                (F.col("p_size") > 25).alias("explicit"),
                F.when(F.col("p_size") % 25 != 0, F.col("p_name")).alias("name"),
            ))


def country_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alias, country - one alias per nation."""
    prefix = F.when(F.col("n_regionkey") == 4, F.lit("region-4-")).otherwise(F.lit("n"))
    return table(spark, sf_dir, "nation").select(
        F.concat(prefix, F.col("n_nationkey").cast("string")).alias("alias"),
        F.col("n_name").alias("country"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip rows with the year and month of the file they were filed in."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # tip in cents computed exactly (decimal), kept as double like every money column
    tip = F.round(F.col("l_extendedprice").cast("decimal(12,2)")
                  * F.col("l_discount").cast("decimal(4,2)"), 2).cast("double")
    filed = F.date_add(F.to_date("o_orderdate"), FILING_DAYS)
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .select(
                F.col("o_orderdate").alias("pickup_ts"),
                F.col("l_shipdate").alias("dropoff_ts"),
                F.col("l_quantity").cast("int").alias("passenger_count"),
                F.col("l_extendedprice").alias("trip_distance"),
                tip.alias("tip_amount"),
                F.col("l_suppkey").alias("pu_location"),
                F.col("l_partkey").alias("do_location"),
                F.year(filed).alias("file_year"),
                F.month(filed).alias("file_month"),
            ))


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips`` as rows of one Parquet folder, for jobs that write them several times: the line items are shuffled for the
    join once, not once per write."""
    path = scratch_path(spark, "trips-staged")
    trips(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id, borough, zone."""
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    location = F.when(F.col("s_acctbal") < 0, -F.col("s_suppkey") - 1).otherwise(F.col("s_suppkey"))
    return (supp.join(nation, supp.s_nationkey == nation.n_nationkey)
            .select(location.alias("location_id"),
                    F.col("n_name").alias("borough"),
                    F.col("s_name").alias("zone")))


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
