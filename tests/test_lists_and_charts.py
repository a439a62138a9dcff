"""Small cases with hand-computed results for the chart operators (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.functions.lists import parse_list_text
from sluice.plans import charts as ch


def _lists(spark, legacy):
    df = spark.createDataFrame([("['pop', 'rap']",), ("['rock','soul']",), ("[]",), (None,)],
                               "g string")
    rows = df.select(F.explode(parse_list_text("g", legacy)).alias("x")).collect()
    return [r.x for r in rows]


def test_list_split_default(spark):
    assert sorted(_lists(spark, False)) == ["pop", "rap", "rock", "soul"]


def test_list_split_legacy(spark):
    assert sorted(_lists(spark, True)) == sorted(["pop", " rap", "rock", "oul", ""])


def test_apostrophes_and_quotes(spark):
    df = spark.createDataFrame([("""["Guns N' Roses", 'Slash']""",)], "a string")
    got = df.select(parse_list_text("a").alias("x")).first().x
    assert got == ["Guns N Roses", "Slash"]


def _chart_rows(spark, rows):
    schema = ("date date, country string, position int, streams bigint, track_id string, "
              "artists string, artist_genres string, duration int, explicit boolean, name string")
    return spark.createDataFrame(rows, schema)


def _aliases(spark):
    return spark.createDataFrame([("de", "Germany"), ("global", "Global")],
                                 "alias string, country string")


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_max_streams_numeric_and_unmatched_alias(spark):
    charts = _chart_rows(spark, [
        (D1, "de", 1, 900, "t1", "['A']", "[]", 60000, False, "S1"),
        (D1, "de", 2, 1000, "t2", "['A']", "[]", 60000, False, "S2"),
        (D1, "de", 10, 99, "t3", "['B']", "[]", 60000, False, "S3"),
        (D1, "xx", 1, 5, "t4", "['C']", "[]", 60000, False, "S4"),
        (D1, "de", 3, 5, "t5", "['C']", "[]", 60000, False, None),
    ])
    data = ch.prepare_charts(charts, _aliases(spark))
    assert data.count() == 3  # xx has no alias, null name dropped
    row = ch.totals_by_country(data).first()
    assert (row.country_name, row.total_streams, row.max_stream, row.count_songs) == (
        "Germany", 1999, 1000, 3)
    assert "duration" not in data.columns and "duration_minutes" in data.columns


def test_position_order_numeric(spark):
    charts = _chart_rows(spark, [
        (D1, "de", 10, 1, "t1", "['A']", "[]", 1, False, "ten"),
        (D1, "de", 2, 1, "t2", "['A']", "[]", 1, False, "two"),
        (D1, "de", 1, 1, "t3", "['A']", "[]", 1, False, "one"),
    ])
    data = ch.prepare_charts(charts, _aliases(spark))
    assert [tuple(r) for r in ch.top_songs_by_country(data).collect()] == [("Germany", "one")]


def test_repeat_number_ones_two_forms(spark):
    charts = _chart_rows(spark, [
        (D1, "de", 1, 1, "t1", "A", "[]", 1, False, "S1"),
        (D2, "de", 1, 1, "t1", "A", "[]", 1, False, "S1"),
        (D1, "global", 1, 1, "t1", "B", "[]", 1, False, "S1"),
    ])
    data = ch.prepare_charts(charts, _aliases(spark))
    count_form = [tuple(r) for r in ch.repeat_number_ones(data, "count").collect()]
    window_form = [tuple(r) for r in ch.repeat_number_ones(data, "window").collect()]
    assert count_form == [("S1", "A")]
    assert window_form == [("S1", "A"), ("S1", "B")]


def test_multi_country_count_vs_distinct(spark):
    charts = _chart_rows(spark, [
        (D1, "de", 1, 1, "t1", "A", "[]", 1, False, "S1"),
        (D2, "de", 1, 1, "t1", "A", "[]", 1, False, "S1"),
    ])
    data = ch.prepare_charts(charts, _aliases(spark))
    assert [tuple(r) for r in ch.multi_country_number_ones(data).collect()] == [("S1", "A", 2)]
    assert ch.multi_country_number_ones(data, distinct=True).count() == 0


def test_type_charts_from_strings(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "de", "1", "12", "t", "['A']", "[]", "1000", "True", "n"),
         ("2024-01-02", "de", "x", "7.5", "t", "['A']", "[]", "1000", "false", "n")],
        ",".join(f"{c} string" for c in ch.CHART_COLUMNS))
    rows = ch.type_charts(raw).collect()
    assert rows[0].position == 1 and rows[0].streams == 12 and rows[0].explicit is True
    assert rows[1].position is None and rows[1].streams is None and rows[1].explicit is False


def test_row_explode_matches_array_form(spark):
    from sluice.functions.lists import explode_list_rows
    df = spark.createDataFrame([(1, "['pop', 'rap']"), (2, "['rock','soul']"), (3, "[]"), (4, None)],
                               "id int, g string")
    for legacy in (False, True):
        rows = sorted((r.id, r.x) for r in explode_list_rows(df, "g", "x", ["id"], legacy).collect())
        want = sorted((r.id, r.x) for r in df.select("id", F.explode(parse_list_text("g", legacy)).alias("x")).collect())
        assert rows == want
