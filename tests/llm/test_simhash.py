"""SimHash classes against all-pairs brute force."""

import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F, types as T

from sluice.llm.simhash import fingerprint, near_links, segments, simhash_dedup, simhash_groups
from sluice.llm.components import connected_components


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(
        rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or \
        ([b" ".join(words)] if words else [])
    bits = Counter(b for g in grams for b in range(64) if xxhash.xxh64(g, seed=42).intdigest() >> b & 1)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def slow_groups(fps, max_bits=3):
    """{position: smallest position reachable} by all pairs."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= max_bits and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


SCHEMA = "doc_id long, text string, fp string, node string, component string"


def test_fingerprint_definition():
    rng = random.Random(3)
    vocab = ["Alpha", "beta", "ÉTÉ", "été", "x", "\x1c", "a b", "Zz9"]
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = "".join(rng.choice(vocab) + rng.choice([" ", "\n", "\t ", "\x0b", "\r\n"])
                    for _ in range(n))
        assert fingerprint(t) == slow_fingerprint(t)
    assert fingerprint(None) == fingerprint("") == fingerprint(" \n") == 0
    long = "one two three four " * 60_000
    assert fingerprint(long) == slow_fingerprint("one two three four " * 60_000)


def test_segments_cover_the_bits():
    for k in range(8):
        segs = segments((1 << 64) - 1, k)
        assert sorted(b for s in segs for b in s) == list(range(64)) and len(segs) == k // 2 + 1


def test_groups_match_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    texts = [None, "", "  ", "one", "One", "one two", "The end"]
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    want = slow_groups(fps)
    assert len(got) == len(texts)
    for i in got:
        assert got[i].fingerprint == f"{fps[i]:016x}" and got[i].component_id == want[i]


@pytest.mark.parametrize("bucket_rows", [3, 512])
def test_links_connect_all_near_fingerprints(spark, bucket_rows):
    """Dense clouds of fingerprints, so that long buckets are refined several times."""
    rng = random.Random(bucket_rows)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            f = centre
            for _ in range(rng.randint(0, 6)):
                f ^= 1 << rng.choice([1, 5, 9, 17, 22, 30, 33, 40, 47, 50, 58, 63])
            fps.add(f)
    fps = sorted(fps | {0, 1, 3, 7, 15, (1 << 64) - 1})
    low = slow_groups(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    reps = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, node long")
    comps = {r.node: r.component for r in
             connected_components(near_links(reps, 3, bucket_rows)).collect()}
    assert [comps.get(i, i) for i in range(len(fps))] == low


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "q r s"),
                                (9, None)], "doc_id long, text string")
    got = sorted(simhash_groups(df).collect(), key=str)
    ids = Counter((r.doc_id, r.component_id) for r in got)
    assert ids == {(None, 5): 1, (5, 5): 2, (None, None): 1, (9, 9): 1}
    one = simhash_dedup(df.withColumn("row", F.lit("x")))
    assert one.columns == ["doc_id", "text", "row"]
    assert sorted((str(r.doc_id), r.text) for r in one.collect()) == \
        [("5", "a b c d"), ("9", None), ("None", "q r s")]
    empty = spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string"))
    assert simhash_groups(empty).collect() == [] and simhash_dedup(empty).collect() == []


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1500)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1500)}
