"""Language ID: held-out accuracy, the back-off against brute force, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from sluice.llm.langid import (LENGTHS, fit_language_model, grams_of, identify_language, letter_words,
                               predict_language)
from sluice.llm.textcols import WordTable

SF = "/root/testdata/sf0.01"


def test_words_of_a_column():
    words = letter_words(pa.array(["Ab c1D, é!", None, "", "42 -", "x"]))
    got = [[w for w in np.array(words.strings(), dtype=object)[words.codes[a:b]] if w]
           for a, b in zip(words.offsets, words.offsets[1:])]
    assert got == [["ab", "c", "d", "é"], [], [], [], ["x"]]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify_language(docs).select("doc_id", "lang", "held_out", "lang_pred", "lang_score").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.lang_score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def slow_score(train, word):
    """{lang: log frequency} straight from the definition."""
    langs = sorted({lang for lang, _ in train})
    for n in (0, *LENGTHS):
        counts = {lang: Counter() for lang in langs}
        for lang, text in train:
            for w in text.split():
                counts[lang].update([w] if n == 0 else grams_of(w, n))
        total = Counter()
        for c in counts.values():
            for key, k in c.items():
                if k >= 2:
                    total[key] = 1
        keys = [k for k in ([word] if n == 0 else grams_of(word, n)) if total[k]]
        if keys:
            return [sum(math.log((counts[x][k] + 0.1) / (sum(counts[x].values()) + 1)) for k in keys)
                    / len(keys) for x in langs]
    return [0.0] * len(langs)


def test_back_off_matches_definition(spark):
    train = [("aa", "foo bar foo bar baz"), ("bb", "fox bar fox qux qux quux"), ("bb", "baz baz zo")]
    model = fit_language_model(spark.createDataFrame(train, "lang string, text string"))
    assert model.langs == ["aa", "bb"]
    for word in ("foo", "bar", "baz", "food", "quxx", "barbar", "zz", "o", "#", "wholly"):
        assert np.allclose(model.word_score(word), slow_score(train, word), atol=1e-4), word


def test_edge_cases(spark):
    rows = [(1, "hello there world hello there", "en", "x", 1.0), (2, "hallo welt hallo welt", "de", "y", 2.0),
            (3, None, "en", None, None), (4, "", None, "z", 0.0), (5, "12 34 !?", "de", "q", 0.0),
            (6, "hello", None, "s", 0.0), (6, "hello", None, "s", 0.0), (None, "welt", None, "s", 0.0),
            (7, "hallo " * 50_000, None, "s", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, lang_score double")
    model = fit_language_model(docs)
    out = predict_language(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score"]
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in out.collect()}
    assert [got[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert got[6][0] == "en" and got[None][0] == "de" and got[7] == ("de", 1.0)
    assert out.count() == len(rows)
    none = docs.where("doc_id < 0")
    assert identify_language(none).collect() == []
    unlabelled = identify_language(docs.where("lang is null")).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]


def test_model_limits_keep_the_commonest(spark):
    rows = [("en", " ".join(f"w{chr(97 + i)}" for i in range(20) for _ in range(20 - i)))]
    model = fit_language_model(spark.createDataFrame(rows, "lang string, text string"), max_words=5)
    assert sorted(k for n, k in model.keys if n == 0) == ["wa", "wb", "wc", "wd", "we"]
    table = WordTable(model.word_score, limit=3)
    assert np.allclose(table(["wa", "zz", "wb", "wa"])[0], table(["wa"])[0])


def test_model_limits_at_ties(spark):
    words = [f"w{a}{b}" for a in "abcd" for b in "abcde"]
    rows = [("en", " ".join(words * 3)), ("de", " ".join(words[:4] * 5 + words[4:] * 2))]
    model = fit_language_model(spark.createDataFrame(rows[:1], "lang string, text string"), max_words=5)
    kept = [k for n, k in model.keys if n == 0]
    assert len(kept) == 5 and set(kept) <= set(words)
    again = fit_language_model(spark.createDataFrame(rows[:1] * 2, "lang string, text string"), max_words=5)
    assert kept == [k for n, k in again.keys if n == 0]  # the same ones, whatever the count
    for limit in (3, 4, 5, 19, 20, 30):
        model = fit_language_model(spark.createDataFrame(rows[1:], "lang string, text string"), max_words=limit)
        kept = {k for n, k in model.keys if n == 0}
        assert len(kept) == min(limit, 20) and (limit < 4 or kept >= set(words[:4])) and (limit > 3 or kept < set(words[:4]))


def test_predictions_match_definition(spark):
    train = [("aa", "foo bar foo bar baz zap"), ("bb", "fox bar fox qux qux quux"), ("bb", "baz baz zo")]
    texts = ["Foo BAR!", "fox fox zebra", "zzz qu", "7", "", "bar", "quuxfoo " * 3, "ba\nz0zap"]
    model = fit_language_model(spark.createDataFrame(train, "lang string, text string"))
    out = predict_language(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, known="seen")
    vocabulary = {"foo", "bar", "fox", "qux", "baz"}
    for r in out.collect():
        words = "".join(c.lower() if c.isalpha() else " " for c in r.text).split()
        if not words:
            assert (r.lang_pred, r.lang_score, r.seen) == ("und", 0.0, 0.0)
            continue
        total = np.sum([slow_score(train, w) for w in words], axis=0)
        share = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert r.lang_pred == ["aa", "bb"][int(total.argmax())] or np.isclose(*total)
        assert np.isclose(r.lang_score, share.max(), atol=1e-4)
        assert np.isclose(r.seen, np.mean([w in vocabulary for w in words]))


def test_stretches_hash_like_strings():
    from sluice.llm.textcols import Characters
    words = ["", "a", "grüße", "日本語", "\U0001f600x", "a" * 3000]
    chars = Characters(words)
    whole = chars.whole(7)
    for i, w in enumerate(words):
        assert Characters(["zz", w]).whole(7)[1] == whole[i]
        if 0 < len(w) < 9:
            assert Characters([f"q{w}q"]).stretches(np.array([1]), len(w), 7)[0] == whole[i]
            assert chars.text(chars.starts[i:i + 1], len(w)) == [w]
    assert len(set(whole.tolist())) == len(words)
