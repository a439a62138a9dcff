"""Importance resampling: features, ratios and selection against brute force; held-out separation."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm.quality import BUCKETS, _count_models, clean_floor, features, kth_largest, log_ratios, resample

SF = "/root/testdata/sf0.01"


def test_features_are_words_and_pairs():
    def bag(text):
        feats, offsets = features(pa.array([text]))
        assert offsets.tolist() == [0, len(feats)]
        return sorted(feats.tolist())
    assert bag("The cat") == bag("the  CAt\n") == bag(" the cat ")
    assert bag("the CAT") != bag("the cat")  # all upper case is told apart
    assert bag("the cat") != bag("cat the")
    assert len(bag("a b c d")) == 7 and len(bag("end.")) == 3 and bag("") == bag("  ") == []
    assert len(bag("x" * 100_000)) == 1
    feats, offsets = features(pa.array(["a b", None, "", "c", "a b"]))
    assert np.diff(offsets).tolist() == [3, 0, 0, 1, 3] and feats[:3].tolist() == feats[-3:].tolist()


def test_log_ratios():
    raw, target = np.array([90, 10, 0, 0]), np.array([45, 0, 0, 0])
    got = log_ratios(raw, target, smoothing=1.0)
    p_raw = (raw + 1) / 104
    p_target = (target + p_raw * 4) / 49
    assert np.allclose(got, np.log(p_target / p_raw)) and got[0] > 0 > got[1]


def test_kth_largest(spark):
    rng = np.random.default_rng(2)
    values = np.r_[rng.normal(size=500), [0.0, -0.0, 1e300, -1e300, 5e-324], np.repeat(0.25, 40)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(4)
    down = np.sort(values)[::-1]
    for k in (1, 2, 100, 260, len(values)):
        assert kth_largest(df, "x", k) == down[k - 1]
    assert kth_largest(df, "x", 0) is None and kth_largest(df, "x", len(values) + 1) is None


def test_separates_labelled_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = resample(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").collect()
    unseen = [r for r in got if r.doc_id % 2]  # rows whose label was not used
    good = [r.sampled for r in unseen if r.quality == 1]
    bad = [r.sampled for r in unseen if r.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.35


def test_sample_size_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a = resample(docs, labels, share=0.5)
    rows = a.collect()
    texts = sum(bool(r.text and r.text.strip()) for r in rows)
    assert len(rows) == docs.count() and sum(r.sampled for r in rows) == math.ceil(0.5 * texts)
    again = {r.doc_id: r.gumbel_key for r in resample(docs.repartition(7), labels, share=0.5).collect()}
    assert all(np.isclose(again[r.doc_id], r.gumbel_key) for r in rows if r.gumbel_key is not None)


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "good words here", 0, "a"), (2, None, 0, "b"), (3, "", 1, None), (4, "!!! ###", 0, "c"),
         (None, "good words here", 0, "d"), (1, "good words here", 0, "a")],
        "doc_id long, text string, sampled int, quality string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = resample(docs, labels, share=1.0)
    assert out.columns == ["doc_id", "text", "quality", "log_ratio", "gumbel_key", "sampled"]
    assert sorted((str(r.doc_id), r.sampled) for r in out.collect()) == \
        [("1", True), ("1", True), ("2", False), ("3", False), ("4", True), ("None", True)]
    assert [r.sampled for r in resample(docs, labels.where("doc_id < 0")).where("doc_id = 4").collect()] == [True]
    assert resample(docs.where("doc_id > 9"), labels).collect() == []


def test_models_count_a_text_once(spark):
    rows = [(i, f"text {i % 40} of {i % 40 * 7}") for i in range(200)] + [(None, "text 3 of 21"), (7, None), (7, "")]
    good = [0, 40, 41, 3]  # texts 0 (twice), 1 and 3
    raw, target = _count_models(spark.createDataFrame(rows, "id long, text string").repartition(5), np.array(good), BUCKETS)
    texts = sorted({t for _, t in rows if t})
    assert raw.tolist() == np.bincount(features(pa.array(texts))[0], minlength=BUCKETS).tolist()
    chosen = sorted({t for i, t in rows if i in good})
    assert target.tolist() == np.bincount(features(pa.array(chosen))[0], minlength=BUCKETS).tolist()


def test_clean_floor(spark):
    def floor(good, bad):
        rows = [(float(x), True) for x in good] + [(float(x), False) for x in bad]
        return clean_floor(spark.createDataFrame(rows, "ratio double, good boolean"), 0.02)
    assert -0.1 < floor([0.1, 0.2, 0.3], [-0.2, -0.1]) < 0.1 and floor([0.1], [0.5]) <= 0.1
    assert floor([0.1], []) is None and floor([], [0.1]) is None
    assert floor(np.arange(100) / 100, [0.5] * 50) <= 0.02  # no more than the slack goes


def test_the_mix_of_rows_decides_not_that_of_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    for kind in (1, 0):
        one = min(i for i, q in quality.items() if q == kind and len(texts[i]) > 100)
        copies = spark.createDataFrame([(i, texts[one]) for i in range(10**6, 10**6 + 500)], docs.schema)
        rows = resample(docs.unionAll(copies), labels.where(F.col("doc_id") != one)).collect()
        kept = {r.doc_id for r in rows if r.sampled}
        assert np.mean([i in kept for i in range(10**6, 10**6 + 500)]) == kind
        assert np.mean([i in kept for i, q in quality.items() if q == 1]) >= 0.97
        assert np.mean([i in kept for i, q in quality.items() if q == 0]) <= 0.35
    good, bad = (sorted(i for i, q in quality.items() if q == kind) for kind in (1, 0))
    even = labels.where(F.col("doc_id").isin(good[:len(bad)] + bad))  # half good
    clean = docs.where(F.col("doc_id").isin(good + bad[:10]))
    kept = {r.doc_id for r in resample(clean, even).where("sampled").collect()}
    assert np.mean([i in kept for i in good]) >= 0.9


def brute_noise(doc_id, text):
    def mix(x):
        x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD % 2**64
        x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 % 2**64
        return x ^ x >> 33
    bits = mix((mix(doc_id) + len(text.encode())) % 2**64) >> 11
    return -math.log(-math.log((bits + 0.5) / 2.0**53))


def test_resample_is_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{w}" for w in rng.zipf(1.5, rng.integers(3, 30)) % 50 + (40 if i % 2 else 0)) for i in range(80)}
    texts |= {100 + i: texts[i] for i in range(10)} | {200: None, 201: "", 202: " \n"}
    quality = {i: i % 2 for i in range(30)} | {300: 1, 40: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in resample(docs, spark.createDataFrame(list(quality.items()), "doc_id long, quality int"), share=0.4,
                                         sharpness=3.0).collect()}

    def count(rows):
        return sum(np.bincount(features(pa.array([t]))[0], minlength=BUCKETS) for t in sorted(rows))
    full = {i: t for i, t in texts.items() if t and t.strip()}
    raw, target = count(set(full.values())), count({full[i] for i, q in quality.items() if q and i in full})
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    logs = np.log((target + p_raw * BUCKETS) / (target.sum() + BUCKETS) / p_raw)
    ratio = {i: logs[features(pa.array([t]))[0]].mean() for i, t in full.items()}
    keys = {i: 3 * ratio[i] + brute_noise(i, full[i]) for i in full}
    best = sorted(keys, key=keys.get, reverse=True)[:math.ceil(0.4 * len(keys))]
    assert got.keys() == texts.keys() and {i for i, r in got.items() if r.sampled} == set(best)
    for i, r in got.items():
        assert (r.log_ratio is None) == (i not in full) and (i not in full or np.allclose(
            [r.log_ratio, r.gumbel_key], [ratio[i], keys[i]], atol=1e-4))


def test_inclusion_follows_the_weights(spark):
    """Among many rows a row of weight w is above a floor t with probability 1 - exp(-w exp(-t))."""
    texts = {0: "plain good words of prose", 1: "click here to win now"}
    docs = spark.createDataFrame([(i, texts[i % 2]) for i in range(20_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    rows = resample(docs, labels, share=0.3, sharpness=0.2).toPandas()
    share, ratio = rows.groupby(rows.doc_id % 2)["sampled"].mean(), rows.groupby(rows.doc_id % 2)["log_ratio"].mean()
    assert 0.0 < share[1] < share[0] < 1.0 and rows["sampled"].sum() == 6_000
    odds = math.log(1 - share[0]) / math.log(1 - share[1])
    assert np.isclose(odds, math.exp(0.2 * (ratio[0] - ratio[1])), rtol=0.15)
