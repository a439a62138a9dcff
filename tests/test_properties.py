"""Operators against brute-force Python models on random inputs (hypothesis).

Inputs are drawn with few distinct keys, so hot keys and ties are the common case.
"""

import datetime as dt
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.lists import parse_list_text
from sluice.operators.upsert import upsert
from sluice.operators.windows import top_n_per_group
from sluice.plans import charts as ch

SETTINGS = settings(max_examples=12, deadline=None)

rows_kv = st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=0, max_size=40)


@SETTINGS
@given(rows=rows_kv, n=st.integers(1, 3))
def test_top_n_matches_sorting(spark, rows, n):
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    got = sorted(tuple(r) for r in top_n_per_group(df, ["k"], [F.desc("v"), F.asc("id")], n).collect())
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    want = sorted(r for g in groups.values() for r in sorted(g, key=lambda r: (-r[1], r[2]))[:n])
    assert got == want


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 5), st.integers(0, 9), max_size=6),
       batch=st.lists(st.tuples(st.integers(0, 7), st.integers(0, 9)), max_size=20))
def test_upsert_matches_dict_model(spark, target, batch):
    t = spark.createDataFrame(sorted(target.items()), "k int, v int")
    b = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "k int, v int, s int")
    got = sorted(tuple(r) for r in upsert(t, b, ["k"], "s").collect())
    model = dict(target)
    for k, v in batch:
        model[k] = v
    assert got == sorted(model.items())


words = st.text(alphabet="abs r'\"", min_size=0, max_size=5)


@SETTINGS
@given(items=st.lists(words, max_size=4), spaced=st.booleans())
def test_list_parse_matches_model(spark, items, spaced):
    text = "[" + (", " if spaced else ",").join(f"'{w}'" for w in items) + "]"
    got = spark.createDataFrame([(text,)], "t string").select(parse_list_text("t").alias("x")).first().x
    stripped = re.sub(r"""[\[\]'"]""", "", text)
    want = [p for p in re.split(r",\s*", stripped) if p != ""]
    assert got == want


chart_rows = st.lists(st.tuples(st.sampled_from(["S1", "S2"]), st.sampled_from(["A", "B", "C"]),
                                st.integers(0, 3), st.sampled_from(["de", "global"])),
                      max_size=25)


@SETTINGS
@given(rows=chart_rows)
def test_repeat_number_ones_window_matches_numbering(spark, rows):
    schema = ("date date, country string, position int, streams bigint, track_id string, "
              "artists string, artist_genres string, duration int, explicit boolean, name string")
    charts = spark.createDataFrame(
        [(dt.date(2024, 1, 1 + d), c, 1, 1, "t", a, "[]", 1, False, nm) for nm, a, d, c in rows], schema)
    aliases = spark.createDataFrame([("de", "Germany"), ("global", "Global")], "alias string, country string")
    data = ch.prepare_charts(charts, aliases)
    got = sorted(tuple(r) for r in ch.repeat_number_ones(data, "window").collect())
    names = {"de": "Germany", "global": "Global"}
    by_name = defaultdict(list)
    for nm, a, d, c in rows:
        by_name[nm].append((a, d, names[c]))
    max_rank = {}
    for nm, lst in by_name.items():
        for rank, (a, _, _) in enumerate(sorted(lst), start=1):
            max_rank[(nm, a)] = max(max_rank.get((nm, a), 0), rank)
    assert got == sorted(k for k, r in max_rank.items() if r > 1)
