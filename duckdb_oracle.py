"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics in DuckDB's own idiom, not from the Spark code: each query rebuilds its relation
from the driver's tables (views ``region nation customer supplier part orders lineitem events``)
and computes the result in plain SQL.  Means are plain averages; both sides round the result to
six places, as the order of a floating-point sum is not fixed.
"""

from __future__ import annotations

# -- relations ------------------------------------------------------------------------
CHARTS = r"""
charts AS (
  SELECT o.o_orderdate::DATE AS date,
         format('n{}', c.c_nationkey) AS country,
         l.l_linenumber AS position,
         l.l_quantity::BIGINT AS streams,
         l.l_partkey::VARCHAR AS track_id,
         format('[''{}'', ''{}'']', p.p_brand, p.p_type) AS artists,
         '[''' || array_to_string(list_prepend(lower(p.p_type), string_split(p.p_name, ' ')), ''',''') || ''']'
           AS artist_genres,
         p.p_size * 10000 AS duration,
         p.p_size > 25 AS explicit,
         CASE WHEN p.p_size IN (25, 50) THEN NULL ELSE p.p_name END AS name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
data AS (
  SELECT ch.* EXCLUDE (country, duration), ch.duration / 60000.0 AS duration_minutes, n.n_name AS country_name
  FROM charts ch JOIN nation n ON ch.country = format('n{}', n.n_nationkey) AND n.n_regionkey <> 4
  WHERE ch.name IS NOT NULL
)"""

TRIPS = r"""
trips AS (
  SELECT o.o_orderdate AS pickup_ts,
         l.l_shipdate AS dropoff_ts,
         l.l_quantity::INTEGER AS passenger_count,
         l.l_extendedprice AS trip_distance,
         round(l.l_extendedprice::DECIMAL(12,2) * l.l_discount::DECIMAL(4,2), 2)::DOUBLE AS tip_amount,
         l.l_suppkey AS pu_location,
         l.l_partkey AS do_location,
         year(o.o_orderdate + INTERVAL 3 DAY)::INTEGER AS file_year,
         month(o.o_orderdate + INTERVAL 3 DAY)::INTEGER AS file_month
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
dated AS (
  SELECT *, make_date(file_year, file_month, 1)::TIMESTAMP AS opens,
         make_date(file_year, file_month, 1)::TIMESTAMP + INTERVAL 1 MONTH AS closes
  FROM trips
),
clean_trips AS (
  SELECT * EXCLUDE (opens, closes) FROM dated WHERE pickup_ts >= opens AND dropoff_ts < closes
)"""

ZONES = r"""
zones AS (
  SELECT if(s.s_acctbal < 0, -s.s_suppkey - 1, s.s_suppkey) AS location_id, n.n_name AS borough, s.s_name AS zone
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

TRIP_COLS = "pickup_ts, dropoff_ts, passenger_count, trip_distance, tip_amount, pu_location, do_location"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


# -- charts reports ---------------------------------------------------------------------
def _items(column: str, legacy: bool) -> str:
    """A list text as one row per item: the default split, or the original job's."""
    if legacy:
        return rf"unnest(string_split_regex(regexp_replace({column}, '[\[\]'']', '', 'g'), ',s*'))"
    return rf"""unnest(list_filter(list_transform(string_split(translate({column}, '[]''"', ''), ','),
                                          lambda x: ltrim(x)), lambda x: x <> ''))"""


def _top_artists(legacy: bool) -> str:
    return _with(CHARTS) + f"""
SELECT country_name, artist, total_streams FROM (
  SELECT country_name, artist, sum(streams)::BIGINT AS total_streams
  FROM (SELECT country_name, streams, {_items('artists', legacy)} AS artist FROM data)
  GROUP BY ALL)
QUALIFY rank() OVER (PARTITION BY country_name ORDER BY total_streams DESC, artist) = 1
"""


def _genres(legacy: bool) -> str:
    return _with(CHARTS) + f"""
SELECT country_name, genre, count(*) AS genre_count
FROM (SELECT country_name, {_items('artist_genres', legacy)} AS genre FROM data)
GROUP BY ALL
"""


_REPORTS = {
    "total_and_max_streams_by_country": "SELECT count(DISTINCT country_name) FROM data",
    "top_genres_by_country": f"SELECT count(*) FROM (SELECT DISTINCT country_name, {_items('artist_genres', False)} FROM data)",
    "top_songs_by_countries": "SELECT count(DISTINCT country_name) FROM data",
    "top_artists_by_country": "SELECT count(DISTINCT country_name) FROM data",
    "top_songs_more_than_1_time": "SELECT count(*) FROM repeated",
    "top_songs_in_more_than_1_country":
        "SELECT count(*) FROM (SELECT 1 FROM data WHERE position = 1 GROUP BY name, artists HAVING count(*) > 1)",
}

_REPEATED = r"""
ones AS (SELECT name, artists, count(*) AS n FROM data WHERE position = 1 GROUP BY ALL),
repeated AS (
  SELECT o.name, o.artists FROM ones o
  WHERE o.n > 1 OR EXISTS (SELECT 1 FROM ones p WHERE p.name = o.name AND p.artists < o.artists))"""

SQL: dict[str, str] = {
    "top_artists_by_country": _top_artists(False),
    "top_artists_by_country_legacy": _top_artists(True),
    "top_songs_by_country": _with(CHARTS) + r"""
SELECT country_name, arg_min(name, (position, -epoch(date), track_id, name)) AS name
FROM data GROUP BY country_name
""",
    "totals_by_country": _with(CHARTS) + r"""
SELECT country_name, sum(streams)::BIGINT AS total_streams, max(streams) AS max_stream, count(*) AS count_songs
FROM data GROUP BY country_name
""",
    "genres_by_country": _genres(False),
    "genres_by_country_legacy": _genres(True),
    "repeat_number_ones_window": _with(CHARTS, _REPEATED) + "SELECT name, artists FROM repeated",
    "repeat_number_ones_count": _with(CHARTS, _REPEATED) + "SELECT name, artists FROM ones WHERE n > 1",
    "multi_country_number_ones": _with(CHARTS) + r"""
SELECT name, artists, count(country_name) AS total_countries
FROM data WHERE position = 1 GROUP BY ALL HAVING count(*) > 1
""",
    "multi_country_number_ones_distinct": _with(CHARTS) + r"""
SELECT name, artists, len(list_distinct(list(country_name))) AS total_countries
FROM data WHERE position = 1 GROUP BY ALL HAVING len(list_distinct(list(country_name))) > 1
""",
    "chart_rows": _with(CHARTS) + r"""
SELECT date, country_name, position, track_id, name, round(duration_minutes::DOUBLE, 6) AS duration_minutes FROM data
""",
    "report_folders": _with(CHARTS, _REPEATED) + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS report, ({sql}) AS n_rows" for name, sql in _REPORTS.items()),
    "csv_roundtrip": _with(CHARTS) + "SELECT * FROM charts",
    "null_rates": _with(CHARTS) + r"""
SELECT column_name, (total - present) / total AS null_rate FROM (
  SELECT unnest(['date', 'country', 'position', 'streams', 'track_id', 'artists', 'artist_genres', 'duration',
                 'explicit', 'name']) AS column_name,
         unnest([count(date), count(country), count(position), count(streams), count(track_id), count(artists),
                 count(artist_genres), count(duration), count(explicit), count(name)]) AS present,
         count(*) AS total
  FROM charts)
""",
}

# -- trips ------------------------------------------------------------------------------
_STATS = r"""sum(passenger_count)::BIGINT AS passenger_sum,
       round(avg(trip_distance), 6) AS avg_trip_distance, round(avg(tip_amount), 6) AS avg_tip_amount
FROM clean_trips GROUP BY ALL
"""
_BOUNDS = r"""
SELECT file_year, file_month, min(pickup_ts) AS min_pickup, max(dropoff_ts) AS max_dropoff,
       min(pickup_ts) >= min(make_date(file_year, file_month, 1))
       AND max(dropoff_ts) < min(make_date(file_year, file_month, 1))::TIMESTAMP + INTERVAL 1 MONTH AS in_bounds
"""
_SECONDS = "date_diff('second', pickup_ts, dropoff_ts) AS trip_duration_sec"

SQL.update({
    "daily_pickup_stats": _with(TRIPS) + "SELECT pu_location, pickup_ts::DATE AS pickup_date, " + _STATS,
    "daily_dropoff_stats": _with(TRIPS) + "SELECT do_location, dropoff_ts::DATE AS dropoff_date, " + _STATS,
    "daily_pickup_parquet": _with(TRIPS) + "SELECT 20::BIGINT AS n_files, pu_location, pickup_ts::DATE AS pickup_date, "
                            + _STATS,
    "trips_job_stats": _with(TRIPS) + "SELECT pu_location, pickup_ts::DATE AS pickup_date, " + _STATS,
    "trips_job_order": _with(TRIPS) + r"""
SELECT year(pickup_ts)::INTEGER AS year, month(pickup_ts)::INTEGER AS month, count(*) AS n_trips,
       0::BIGINT AS misplaced
FROM clean_trips GROUP BY ALL
""",
    "trips_within_month": _with(TRIPS) + "SELECT * FROM clean_trips",
    "trips_out_of_range": _with(TRIPS) + r"""
SELECT * EXCLUDE (opens, closes), if(pickup_ts < opens, 'start', 'end') AS broken_bound
FROM dated WHERE NOT (pickup_ts >= opens AND dropoff_ts < closes)
""",
    "trips_kept_months": _with(TRIPS) + f"""
SELECT {TRIP_COLS} FROM trips
WHERE strftime(dropoff_ts, '%Y-%m') IN (SELECT printf('%04d-%02d', file_year, file_month) FROM trips)
""",
    "trip_seconds_sorted_sample": _with(TRIPS) + f"""
SELECT {TRIP_COLS}, {_SECONDS} FROM clean_trips
ORDER BY pickup_ts, trip_duration_sec DESC, dropoff_ts, passenger_count, trip_distance,
         tip_amount, pu_location, do_location
LIMIT 1000
""",
    "sorted_trip_files": _with(TRIPS) + f"SELECT {TRIP_COLS}, {_SECONDS} FROM clean_trips",
    "trips_with_zone": _with(TRIPS, ZONES) + f"""
SELECT {TRIP_COLS}, z.borough, z.zone
FROM clean_trips t LEFT JOIN zones z ON t.pu_location = z.location_id
""",
    "time_bounds_before": _with(TRIPS) + _BOUNDS + "FROM trips GROUP BY file_year, file_month",
    "time_bounds_by_month": _with(TRIPS) + _BOUNDS + "FROM clean_trips GROUP BY file_year, file_month",
    "months_present": _with(TRIPS) + r"""
SELECT DISTINCT year(pickup_ts)::INTEGER AS year, month(pickup_ts)::INTEGER AS month FROM trips
""",
    "missing_months": _with(TRIPS) + r"""
SELECT year(dropoff_ts)::INTEGER AS year, month(dropoff_ts)::INTEGER AS month FROM trips
EXCEPT
SELECT file_year, file_month FROM trips
""",
    "file_months": _with(TRIPS) + "SELECT file_year, file_month, count(*) AS n_trips FROM trips GROUP BY ALL",
    "input_files": _with(TRIPS) + r"""
SELECT unnest(['files', 'expected']) AS side, count(DISTINCT file_year * 100 + file_month) AS n FROM trips
""",
    "empty_then_filled": _with(TRIPS) + "SELECT * FROM trips",
    "partitioned_roundtrip": _with(TRIPS) + f"""
SELECT {TRIP_COLS}, year(pickup_ts)::INTEGER AS year, month(pickup_ts)::INTEGER AS month FROM clean_trips
""",
    "monthly_union": _with(TRIPS) + "SELECT file_year AS source_year, count(*) AS n_rows FROM trips GROUP BY ALL",
    "union_complete": _with(TRIPS) + r"""
SELECT (file_month > 6)::INTEGER AS input, count(*) AS in_union, count(*) AS in_input, 'all' AS kind FROM trips GROUP BY ALL
UNION ALL
SELECT (file_month > 6)::INTEGER, count(DISTINCT (passenger_count, file_year, file_month)), count(*), 'distinct'
FROM trips GROUP BY ALL
""",
    "catalog_tables": _with(TRIPS) + "SELECT file_year, file_month, count(*) AS n_trips FROM clean_trips GROUP BY ALL",
    "corrupt_rows": r"""
SELECT l_orderkey, l_linenumber, if(l_linenumber = 3, NULL, l_partkey) AS l_partkey,
       if(l_linenumber = 3, concat_ws(',', l_orderkey, l_linenumber, 'n/a'), NULL) AS raw
FROM lineitem
""",
    "zone_lookup_csv": _with(ZONES) + "SELECT location_id::VARCHAR AS location_id, borough, zone FROM zones",
})

# -- upsert, paging, counts ---------------------------------------------------------------
SQL.update({
    "upsert_last_wins": r"""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey
                     ORDER BY o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' DESC, o_orderkey DESC) = 1
""",
    "daily_csv_upsert": r"""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, if(o_orderdate < TIMESTAMP '1998-01-01', 0, least(year(o_orderdate), 2001)) AS load FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY load DESC, if(load = 0, -o_orderkey, o_orderkey)) = 1
""",
    "orders_page": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 2000",
    "order_priority_counts": "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY ALL",
    "event_props": "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "event_prop_counts": r"""
SELECT (props->>'$.k')::INTEGER AS k, count(*) AS n_events FROM events
WHERE (props->>'$.k')::INTEGER >= 50 GROUP BY ALL
""",
})

# -- sales stream -------------------------------------------------------------------------
_SALES = r"""
period AS (
  SELECT min(ts)::DATE::TIMESTAMP AS t0, max(ts)::DATE::TIMESTAMP + INTERVAL 86399 SECOND AS t1 FROM events
),
msgs AS (
  SELECT format('{{"product":"{}","date":"{}"}}', event_type, ts::DATE) AS value,
         if(2 * epoch_us(ts) > (SELECT epoch_us(t0) + epoch_us(t1) FROM period), 1, 0)::INTEGER AS partition,
         event_type AS product, ts::DATE AS date
  FROM events
)"""

SQL.update({
    "sales_messages": _with(_SALES) + "SELECT value, partition FROM msgs",
    "sales_sink": _with(_SALES) + "SELECT product, date, partition, true AS loaded_now, 1::BIGINT AS rows_of_id FROM msgs",
    "sales_decoded": _with(_SALES) + "SELECT product, date, partition FROM msgs",
    "sales_rejects": "SELECT props AS value, 0 AS partition FROM events",
    "sales_clean_rejects": _with(_SALES) + "SELECT partition, count(*) AS kept, 0::BIGINT AS rejected FROM msgs GROUP BY ALL",
})

# -- jobs: restarts, merges, folders, checks ------------------------------------------------
_REPORT_LINES = {
    "total_and_max_streams_by_country":
        "SELECT concat_ws('|', country_name, sum(streams)::BIGINT, max(streams), count(*)) FROM data GROUP BY country_name",
    "top_genres_by_country": f"""SELECT concat_ws('|', country_name, genre, count(*)) FROM (
      SELECT country_name, {_items('artist_genres', False)} AS genre FROM data) GROUP BY country_name, genre""",
    "top_songs_by_countries": """SELECT concat_ws('|', country_name, arg_min(name, (position, -epoch(date), track_id, name)))
      FROM data GROUP BY country_name""",
    "top_artists_by_country": f"""SELECT concat_ws('|', country_name, artist, n) FROM (
      SELECT country_name, artist, sum(streams)::BIGINT AS n FROM (
        SELECT country_name, streams, {_items('artists', False)} AS artist FROM data) GROUP BY country_name, artist
      QUALIFY rank() OVER (PARTITION BY country_name ORDER BY n DESC, artist) = 1)""",
    "top_songs_more_than_1_time": "SELECT concat_ws('|', name, artists) FROM repeated",
    "top_songs_in_more_than_1_country": """SELECT concat_ws('|', name, artists, count(*)) FROM data
      WHERE position = 1 GROUP BY name, artists HAVING count(*) > 1""",
}

SQL.update({
    "sales_sink_restart": _with(_SALES) + """
SELECT product, date, partition, 1::BIGINT AS rows_of_id, true AS several_batches, 1::INTEGER AS failures FROM msgs""",
    "sales_routed_stream": _with(_SALES) + "SELECT value, partition FROM msgs",
    "sales_serial_ids": r"""
WITH halves AS (
  SELECT event_id, ts, (ts - (SELECT min(ts)::DATE FROM events) > ((SELECT max(ts)::DATE - min(ts)::DATE FROM events) * 86400 + 86399)
                        * INTERVAL 500000 MICROSECOND)::INTEGER AS half
  FROM events)
SELECT event_id, half, row_number() OVER (ORDER BY half, ts, event_id) AS id FROM halves
""",
    "checked_writes": _with(CHARTS) + r"""
SELECT unnest(['null names', 'null names, refused']) AS "check", count(*) AS n_rows, count(*) - count(name) AS n_bad FROM charts
UNION ALL SELECT 'union', count(*), 0 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
UNION ALL SELECT 'stream rejects', 2 * count(*), count(*) FROM events
""",
    "upsert_buckets": r"""
WITH placed AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderdate = max(o_orderdate) OVER () AS is_new,
         (('0x' || substr(md5(o_custkey::VARCHAR), 1, 8))::BIGINT % 256)::INTEGER AS bucket
  FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, bucket,
       bucket IN (SELECT bucket FROM placed WHERE is_new) AS rewritten
FROM placed QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY is_new DESC, o_orderkey DESC) = 1
""",
    "table_defaults": r"""
SELECT event_id AS id, event_type AS product, ts AS sold_at, 'import' AS origin, true AS created_now FROM events
UNION ALL SELECT -1, 'refund', TIMESTAMP '2024-04-01 10:00:00', 'by hand', true
UNION ALL SELECT -2, 'refund', TIMESTAMP '2024-04-01 10:00:01.5', 'import', true
""",
    "trips_kept_folders": SQL["trips_kept_months"],
    "time_bounds_footers": _with(TRIPS) + r"""
SELECT file_year, file_month, min(pickup_ts) AS min_pickup, max(dropoff_ts) AS max_dropoff, count(*) AS n_rows
FROM trips GROUP BY ALL
""",
    "drifted_months": _with(TRIPS) + r"""
SELECT * REPLACE (if(file_month <= 4, NULL, passenger_count) AS passenger_count) FROM trips
""",
    "partition_replaced": _with(TRIPS) + r"""
SELECT * FROM trips WHERE file_year <> 1997
UNION ALL SELECT * REPLACE (0.0::DOUBLE AS tip_amount) FROM clean_trips WHERE file_year = 1997
""",
    "compacted_folders": _with(TRIPS) + r"""
SELECT file_year, file_month, count(*) AS n_trips,
       file_month <= 3 AND count(DISTINCT do_location % 3) > 1 AS fewer_files,
       NOT (file_month <= 3 AND count(DISTINCT do_location % 3) > 1) AS untouched
FROM trips GROUP BY file_year, file_month
""",
    "report_contents": _with(CHARTS, _REPEATED) + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS report, * FROM ({sql}) AS t(line)" for name, sql in _REPORT_LINES.items()),
    "month_containment": _with(TRIPS) + r"""
(SELECT year(dropoff_ts)::INTEGER AS year, month(dropoff_ts)::INTEGER AS month, 'file' AS lacks FROM trips
 EXCEPT SELECT file_year, file_month, 'file' FROM trips)
UNION ALL
(SELECT file_year, file_month, 'trips' FROM trips
 EXCEPT SELECT year(pickup_ts)::INTEGER, month(pickup_ts)::INTEGER, 'trips' FROM clean_trips)
""",
    "trips_by_pickup_month": _with(TRIPS) + "SELECT strftime(pickup_ts, '%Y-%m') AS pickup_month, count(*) AS n_trips FROM trips GROUP BY ALL",
    "first_outlier": _with(TRIPS) + f"""
SELECT {TRIP_COLS}, if(pickup_ts < opens, 'start', 'end') AS broken_bound
FROM dated WHERE NOT (pickup_ts >= opens AND dropoff_ts < closes)
ORDER BY ALL LIMIT 1
""",
})
