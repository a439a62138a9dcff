"""The pipeline stage by stage against plain Python models of each decision."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm.staging import stage
from tests.llm.test_linechunks import slow_dedup
from tests.llm.test_packing import slow_best_fit
from tests.llm.test_simhash import slow_fingerprint, slow_groups

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnsRenamed({})
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF), "test-" + name.replace(" ", "-")))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_quality_keeps_good_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(texts(steps[1]))
    assert np.mean([i in kept for i, q in labels.items() if q == 1]) >= 0.99
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) <= 0.25
    before = texts(steps[0])
    assert all(before[i] == t for i, t in texts(steps[1]).items())


def test_language_keeps_texts_with_letters(steps):
    before, after = texts(steps[1]), texts(steps[2])
    assert set(after) <= set(before) and all(before[i] == t for i, t in after.items())
    lost = [before[i] for i in set(before) - set(after)]
    assert all(not re.search(r"[^\W\d_]", t or "") for t in lost) or len(lost) <= 0.01 * len(before)


def test_lines_match_brute_force(steps):
    want = slow_dedup(texts(steps[2]))
    want = {i: t for i, (t, gone) in want.items() if not gone or t.strip(" ")}
    assert texts(steps[3]) == want
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_near_duplicates_match_brute_force(steps):
    before = sorted(texts(steps[3]).items())
    low = slow_groups([slow_fingerprint(t) for _, t in before])
    assert texts(steps[4]) == {i: t for k, (i, t) in enumerate(before) if low[k] == k}


def test_packing_holds_all_that_is_left(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    rows = steps[5].collect()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, dtype="<u4").tolist())
    left = texts(steps[4])
    assert set(got) == set(left)
    for i in list(left)[::25]:
        assert got[i] == library.encode(left[i], add_special_tokens=False).ids + [1]
    assert len({r.sequence_id for r in rows}) == len(slow_best_fit([r.length for r in rows], 4096))


def test_edge_rows_and_clashing_columns(spark, tmp_path):
    words = "of the and to in that was for with from this".split()
    good = [" ".join(np.random.default_rng(i).permutation(words * 3)) for i in range(12)]
    rows = [(i, t, "en", "s", len(t), True, "x", 1, 2.0) for i, t in enumerate(good)]
    rows += [(50, None, "en", "s", 0, None, "x", 1, 2.0), (51, "", None, None, 0, True, "x", 1, 2.0),
             (None, good[0], "en", "s", 9, True, "x", 1, 2.0), rows[3]]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, sampled boolean, "
              "lang_pred string, removed_lines int, log_ratio double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, str(tmp_path)), "edge")
        if name != "best-fit packing":
            assert after.columns == docs.columns
            assert all(r.lang_pred == "x" and r.removed_lines == 1 and r.log_ratio == 2.0 for r in after.collect())
            assert {r.doc_id for r in after.collect()} >= set(range(1, 12))
        assert step(spark, docs.where("doc_id > 900"), str(tmp_path)).collect() == []


def test_long_texts_of_unlearned_languages_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kind = docs.schema
    others = ["tämä on pitkä suomenkielinen teksti joka kertoo metsistä järvistä ja kesäisistä illoista " * 200,
              "to jest długi tekst napisany po polsku o lasach jeziorach oraz o zimie " * 200, "xqzk vbnm wrtp lkjh zzgh " * 500]
    rows = [tuple({"doc_id": 10**9 + i, "text": t, "lang": None, "source": "s", "n_chars": len(t)}[c] for c in kind.names)
            for i, t in enumerate(others)]
    kept = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(rows, kind)), SF)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert not ids & {10**9 + i for i in range(3)} and clean <= ids


def test_exact_copies_leave_one_document(spark):
    rng = np.random.default_rng(4)
    texts = ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 10**6, 12)) for _ in range(n)) for n in (1, 3, 35, 1, 3, 35, 3, 3)]
    rows = [(10 * i + c, t, "en", "s", len(t)) for i, t in enumerate(texts) for c in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(corpus_pipeline.lines(spark, docs, SF), "copies")
    left = corpus_pipeline.near_duplicates(spark, out, SF).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(10 * i, t) for i, t in enumerate(texts)]
