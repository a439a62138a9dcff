"""Exact dedup against a plain Python model; the filter's two passes."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from sluice.llm import exactcopies as ec

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_copies(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha256) of (doc_id, text) rows."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def cases():
    rng = random.Random(5)
    texts = [None, "", "a", "A", "É", "é", "İ", "i", " a", "x" * 300_000, "X" * 300_000] + [f"text {i}" for i in range(300)]
    rows = [(i, rng.choice(texts)) for i in range(600)]
    rows += [(1000 + i, "Hot TEXT" if i % 2 else "hot text") for i in range(400)]  # one group of 40 %
    return rows + [(None, "a"), (None, "only null"), (None, "only null"), (5, "twice"), (5, "twice"), (5, "TWICE")]


def test_matches_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame([(*r, "x", True, b"") for r in rows],
                               "doc_id long, text string, row string, maybe boolean, digest binary")
    assert got(ec.exact_copies(df.repartition(7))) == slow_copies(rows)


def test_full_filter_stays_exact(spark):
    rows = [(i, f"t{i % 70_000}") for i in range(100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ec.exact_copies(df, max_bits=16)) == slow_copies(rows)


def test_copies_dropped_whole(spark):
    rows = cases()
    df = spark.createDataFrame([(i, t, f"s{k}", k) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, digest string, _last long").repartition(5)
    kept = ec.drop_copies(df)
    assert kept.columns == df.columns
    want = sorted((str(i), sha) for i, _, _, k, sha in slow_copies(rows) if k)
    left = kept.collect()
    assert sorted((str(r.doc_id), ec.digest((r.text or "").encode()).hex()) for r in left) == want
    whole = {(i, t, f"s{k}", k) for k, (i, t) in enumerate(rows)}
    assert all(tuple(r) in whole for r in left)
    assert ec.drop_copies(df.where("doc_id < 0")).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ec.exact_copies(df).collect() == []


def test_filter_clears_most_single_rows_and_no_copy(spark):
    ids = [ec.digest(str(i).encode()) for i in range(20_000)]
    copies = ids[:500]
    bits = ec.filter_bits(len(ids) + len(copies))
    df = spark.createDataFrame([(d,) for d in ids + copies], "digest binary").repartition(6)
    twice = np.frombuffer(ec.repeat_filter(df, bits), dtype=np.uint8)
    cells = ec._cells(ids, bits)
    flagged = (twice[cells >> 3] & ec._bit(cells) > 0).all(axis=1)
    assert flagged[:500].all()
    assert flagged[500:].mean() < 0.01
    assert all(len(set(row)) == ec.PROBES for row in cells.tolist())


def test_tasks_count_like_one(spark):
    rng = np.random.default_rng(3)
    ids = [bytes(x) for x in rng.integers(0, 256, (3000, 32), dtype=np.uint8)]
    ids += ids[::7]
    one = list(ec._count_cells(iter([pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["digest"])]), 16))
    whole = np.zeros(1 << 13, dtype=np.uint8)
    for batch in one:
        for segment, twice in zip(batch.column("segment").to_pylist(), batch.column("twice").to_pylist()):
            whole[segment * 4096:(segment + 1) * 4096] = np.frombuffer(twice, dtype=np.uint8)
    df = spark.createDataFrame([(d,) for d in ids], "digest binary").repartition(9)
    assert ec.repeat_filter(df, 16) == whole.tobytes()
