"""Toxicity: chain sums against enumeration, span offsets, held-out accuracy."""

import itertools
import zlib

import numpy as np
import pyarrow as pa

from sluice.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(1)
    for width in (1, 2, 5):
        emit, trans, first = rng.normal(size=(3, 7)) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
        length = np.array([width, 1, max(1, width - 1)])
        allowed = np.ones((3, 7, 2))
        allowed[0, 0, 1] = 0
        for mask in (None, allowed):
            got, log_z, pairs = tox.forward_backward(emit, length, trans, first, mask)
            want_pairs = np.zeros((2, 2))
            for c in range(3):
                n, z, ones = int(length[c]), 0.0, np.zeros(7)
                joint = np.zeros((2, 2))
                for tags in itertools.product((0, 1), repeat=n):
                    if mask is not None and not all(mask[c, t, g] for t, g in enumerate(tags)):
                        continue
                    w = np.exp(first[tags[0]] + sum(emit[c, t] * g for t, g in enumerate(tags))
                               + sum(trans[a, b] for a, b in zip(tags, tags[1:])))
                    z += w
                    ones[:n] += w * np.array(tags)
                    for a, b in zip(tags, tags[1:]):
                        joint[a, b] += w
                assert np.isclose(log_z[c], np.log(z)) and np.allclose(got[c], ones / z)
                want_pairs += joint / z
            assert np.allclose(pairs, want_pairs)


def test_chains_cover_every_token():
    offsets = np.array([0, 0, 5, 5 + 64, 5 + 64 + 200, 269])
    doc, start, length = tox._chains(offsets)
    tokens = np.concatenate([np.arange(s, s + n) for s, n in zip(start, length)])
    assert tokens.tolist() == list(range(269)) and length.max() == tox.CHAIN and doc.tolist() == [1, 2, 3, 3, 3, 3]


def test_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = tox.toxicity(docs.select("doc_id", "text"), labels).join(labels, "doc_id", "left").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        for s in r.spans:
            assert r.text[s.start:s.end].isalpha() and s.marginal >= 0.5
    held = [r for r in got if r.held_out and r.toxic is not None]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits >= 0.85 * sum(r.toxic for r in held) and hits >= 0.95 * sum(r.predicted for r in held)
    spans = [r.text[s.start:s.end].lower() for r in got for s in r.spans]
    assert "idiot" in spans and len(spans) > 500


def test_edge_cases(spark):
    text = ["you vile scum " + w for w in "abcdefgh"] + ["fine words here " + w for w in "abcdefghijklmnopqrstuv"]
    rows = [(i, t, 0.0, "x") for i, t in enumerate(text)] + [
        (100, None, 0.0, "x"), (101, "", 0.0, "x"), (102, "12 !", 0.0, "x"), (None, "scum", 0.0, "x"),
        (0, text[0], 0.0, "x"), (103, "fine " * 30_000, 0.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, spans string")
    labels = spark.createDataFrame([(i, int(i < 8)) for i in range(30)] + [(None, 1), (100, None)],
                                   "doc_id long, toxic int")
    out = tox.toxicity(docs, labels)
    assert out.columns == ["doc_id", "text", "held_out", "score", "predicted", "spans"]
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].spans == [] and by_id[i].predicted == 0 for i in (100, 101, 102, 103))
    assert tox.toxicity(docs.where("doc_id > 500"), labels).collect() == []
    assert {r.predicted for r in tox.toxicity(docs, labels.where("toxic = 0")).collect()} == {0}


def test_features_of_short_words():
    assert tox.word_features("a")[1:] == [0] * 5 and len(set(tox.word_features("scumbag"))) == 6
    crf = tox.Crf(np.zeros(tox.BUCKETS), -2.0, np.zeros((2, 2)), np.zeros(2), np.zeros(3))
    uniq, codes, offsets, m = tox.token_marginals(crf, pa.array(["a b", None, "c"]))
    assert offsets.tolist() == [0, 2, 2, 3] and np.allclose(m, 1 / (1 + np.exp(2)))


def slow_document(crf, text):
    """(score, spans) of a text, chain by chain, with plain products of the two tags' messages."""
    import regex
    words = [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"\p{L}+", text)]
    marginals = []
    for at in range(0, len(words), tox.CHAIN):
        psi = [np.array([1.0, np.exp(crf.word_scores([w])[0])]) for _, _, w in words[at:at + tox.CHAIN]]
        move, ahead = np.exp(crf.trans), [np.exp(crf.first) * psi[0]]
        for p in psi[1:]:
            ahead.append((ahead[-1] @ move) * p)
            ahead[-1] /= ahead[-1].sum()
        back = [np.ones(2)]
        for p in psi[:0:-1]:
            back.append(move @ (p * back[-1]))
            back[-1] /= back[-1].sum()
        for a, b in zip(ahead, back[::-1]):
            marginals.append((a * b)[1] / (a * b).sum())
    top = min(max(max(marginals, default=6e-6), 6e-6), 1 - 6e-6)
    x = crf.curve @ [1, np.log(top / (1 - top)), np.log1p(sum(m for m in marginals if m >= 0.1))]
    return 1 / (1 + np.exp(-x)), [(s, e) for (s, e, _), m in zip(words, marginals) if m >= 0.5], marginals


def test_scores_and_spans_match_brute_force(spark):
    rng = np.random.default_rng(6)
    crf = tox.Crf(rng.normal(size=tox.BUCKETS), -1.0, rng.normal(size=(2, 2)), rng.normal(size=2), np.array([-1.0, 0.4, 0.7]))
    vocabulary = ["you", "Über", "scum", "ßßß", "fine", "日本", "x", "idiots", "wholesome", "naïve"]
    texts = [" ".join(rng.choice(vocabulary, n)) + "!1 " for n in (1, 2, 5, 63, 64, 65, 128, 300)] + ["", "12 ..", "a,b;c"]
    out = tox.score_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), crf).collect()
    for r in out:
        score, spans, marginals = slow_document(crf, texts[r.doc_id])
        assert np.isclose(r.score, score, atol=1e-4) and r.predicted == int(r.score >= 0.5)
        near = [abs(m - 0.5) < 1e-4 for m in marginals]
        assert any(near) or [(s.start, s.end) for s in r.spans] == spans
    assert sum(len(r.spans) for r in out) > 50
