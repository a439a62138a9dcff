"""End-to-end jobs on CSV inputs exported from the driver tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.plans import charts as ch
from sluice.plans import registry
from sluice.plans import relations as rel
from sluice.plans import trips as tr
from sluice.sinks.files import export_csv
from sluice.sources.files import read_csv

SF = "/root/testdata/sf0.001"


def test_charts_job_writes_six_reports(spark, tmp_path):
    charts_csv, aliases_csv = str(tmp_path / "charts"), str(tmp_path / "aliases")
    export_csv(rel.charts(spark, SF), charts_csv)
    export_csv(rel.country_aliases(spark, SF), aliases_csv)
    out = ch.run_job(spark, charts_csv, aliases_csv, str(tmp_path / "prepared"))
    assert sorted(out) == sorted(["total_and_max_streams_by_country", "top_genres_by_country",
                                  "top_songs_by_countries", "top_artists_by_country",
                                  "top_songs_more_than_1_time",
                                  "top_songs_in_more_than_1_country"])
    from sluice.sources.files import read_reports
    reports = read_reports(spark, str(tmp_path / "prepared"))
    assert sorted(reports) == sorted(out)
    assert reports["total_and_max_streams_by_country"].columns == [
        "country_name", "total_streams", "max_stream", "count_songs"]
    back = read_csv(spark, out["top_artists_by_country"]).withColumn(
        "total_streams", F.col("total_streams").cast("bigint"))
    expected = registry.top_artists_by_country(spark, SF)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, expected.collect()))


def test_trips_job(spark, tmp_path):
    src = registry._monthly_files(spark, SF)
    zones_csv = str(tmp_path / "zones")
    rel.zones(spark, SF).write.option("header", True).option("sep", ";").csv(zones_csv)
    schema = StructType.fromDDL(registry.TRIP_CSV_SCHEMA)
    out = str(tmp_path / "out")
    tr.run_job(spark, src, zones_csv, out, schema, pattern="yellow_tripdata_*.csv", stat_files=20)
    stats = spark.read.parquet(f"{out}/pickup_stats")
    assert stats.count() == registry.daily_pickup_stats(spark, SF).count()
    assert len(stats.inputFiles()) <= 20
    parts = spark.read.parquet(f"{out}/trips")
    assert parts.count() == registry.trips_within_month(spark, SF).count()
    assert {"borough", "zone", "year", "month", "trip_duration_sec"} <= set(parts.columns)
