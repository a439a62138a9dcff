"""Periodic runs against a brute-force search of all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sluice.llm import periodic
from sluice.llm.queries import op13_periodic_runs


def slow_runs(words):
    """Sorted (start, length, period): every lag, maximal stretches, smallest period of each."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j + q - i
                if length >= max(6, 4 * q):
                    found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_row(doc_id, words):
    runs = slow_runs(words)
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    best = (None,) * 4
    if runs:
        from fractions import Fraction
        s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    return (doc_id, len(runs), *best, runs, " ".join(w for i, w in enumerate(words) if i not in gone))


def fast_rows(df):
    return [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, [tuple(x) for x in r.runs], r.collapsed)
            for r in df.collect()]


def texts():
    rng = random.Random(9)
    out = ["", " ", "a", "a a a a a a", "a a a a a", "b\ta\na\x0ba\x0ca\ra a c", "a b a b a b a b", "a b a b a b a", "x\x00 x\x00 x\x00 x\x00 x\x00 x\x00"]
    for k in range(160):
        words = [rng.choice("abcdefghij"[:rng.choice([2, 3, 10])]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            q = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 32, 40, 70])
            unit = [rng.choice([f"w{i}" for i in range(rng.choice([2, 3, 50]))]) for _ in range(q)]
            if rng.random() < 0.4:  # a unit with periodic parts of its own
                unit = (unit[:3] * q)[:q - 1] + ["z"]
            n = rng.choice([3 * q, 4 * q - 1, 4 * q, 4 * q + 1, 6 * q + 2])
            at = rng.randint(0, len(words))
            words[at:at] = (unit * (n // max(len(unit), 1) + 1))[:n]
        out.append(" ".join(words))
    out.append(" ".join(str(i % 700) for i in range(2800)) + " end")
    out.append(" ".join(str(i % 700) for i in range(2799)))
    return out


def test_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a " * 7), (None, None), (3, "q " * 30), (3, "q " * 30)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, runs string, start int, period int")
    want = [slow_row(i, [w for w in (t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ")
                         .replace("\r", " ").split(" ") if w]) for i, t in rows]
    assert sorted(fast_rows(periodic.periodic_runs(df.repartition(3))), key=str) == sorted(want, key=str)
    assert sum(len(w[6]) for w in want) > 150 and any(w[4] and w[4] > 32 for w in want)


def test_slices_of_one_text_give_the_same(spark, monkeypatch):
    import pyarrow as pa
    whole = periodic._slice_runs(pa.array(range(len(texts()))), pa.array(texts()))
    single = [periodic._slice_runs(pa.array([i]), pa.array([t])).to_pylist()[0] for i, t in enumerate(texts())]
    assert whole.to_pylist() == single


def test_synchronising_set_is_consistent_and_dense():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 3, 4000)
    codes[1000:1300] = codes[2000:2300]
    codes[3000:3200] = 1
    tau = 16
    ids = periodic._mix(codes.astype(np.uint64))
    for width in (1, 2, 4, 8):
        ids = periodic._mix(ids[:-width] + np.uint64(3) * periodic._mix(ids[width:]))
    _, regions = periodic._small_periods(codes)
    flat = periodic._periodic_windows(len(codes), tau, regions)[:len(ids)]
    at = periodic.synchronising_set(ids, tau, flat)
    chosen = np.zeros(len(codes), bool)
    chosen[at] = True
    equal = [k for k in range(300 - 2 * tau + 1)]
    assert all(chosen[1000 + k] == chosen[2000 + k] for k in equal)
    for i in range(len(codes) - 3 * tau):
        assert chosen[i:i + tau].any() or flat[i:i + 2 * tau].all()
    assert not chosen[3000:3200 - 2 * tau].any()


def test_long_texts(spark):
    rng = random.Random(2)
    unit = [rng.choice("abcdefgh") for _ in range(9000)]
    words = [str(i) for i in range(50)] + unit * 5 + ["tail"] + ["z"] * 100_000
    got = fast_rows(periodic.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")))[0]
    assert (50, 45_000, 9000) in got[6] and (45_051, 100_000, 1) in got[6]
    assert got[2:6] == (45_051, 100_000, 1, 100_000_000)


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_matches_brute_force(spark, sf):
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        row = slow_row(r.doc_id, words)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in row[6])
        want.append((*row[:6], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(row[7].encode()).hexdigest()))
    assert sorted(map(tuple, op13_periodic_runs(spark, sf).collect())) == sorted(want)
    assert sum(w[1] > 0 for w in want) >= 10
