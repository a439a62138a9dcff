"""The Merkle manifest against a plain recursive model: roots, witnesses, tampering."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sluice.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(root, siblings of each node upwards as (side, digest))"""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, members = [], []
        for k in range(0, len(nodes), 2):
            pair = nodes[k:k + 2]
            for side in range(len(pair)):
                for i in under[k + side]:
                    paths[i].append("=" if len(pair) == 1 else "<" + pair[0] if side else ">" + pair[1])
            up.append(h(*pair))
            members.append(sum(under[k:k + 2], []))
        nodes, under = up, members
    return nodes[0], paths


def slow_manifest(rows):
    """{(doc_id, lang, leaf): sorted [(subroot, root, witness)]} of (doc_id, lang, leaf) rows"""
    langs = sorted({r[1] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    each = []
    for lang in langs:
        own = sorted((r for r in rows if r[1] == lang), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        each.append((own, *climb([r[2] for r in own])))
    root, above = climb([subroot for _, subroot, _ in each])
    out = []
    for (own, subroot, paths), more in zip(each, above):
        out += [(*r, subroot, root, p + more) for r, p in zip(own, paths)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, list(r.witness)) for r in df.collect()), key=str)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 3 % 10_007, lang, h(str(rng.random()))))
    return rows


@pytest.mark.parametrize("bits", [1, 2, 3, 12])
def test_matches_brute_force(spark, bits):
    rows = rows_of({None: 3, "": 1, "de": 2, "en": 37, "fr": 8, "zh": 17, "ü": 5})
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(5)
    assert got(merkle.merkle_manifest(df, block_bits=bits)) == slow_manifest(rows)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2}, {"en": 300}, {"en": 4, "de": 256}, {f"l{i}": 1 for i in range(40)}])
def test_sizes(spark, sizes):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(3)
    assert got(merkle.merkle_manifest(df, block_bits=2)) == slow_manifest(rows)


def test_ties_nulls_and_other_columns(spark):
    rows = rows_of({"en": 9, None: 4})
    rows += [(None, "en", h("a")), (None, None, h("b")), rows[2], rows[2], (rows[3][0], "en", h("other")), (None, "en", h("a"))]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, lang string, leaf string, _group long")
    out = merkle.merkle_manifest(df.repartition(4), block_bits=2)
    assert out.columns == ["doc_id", "lang", "leaf", "_group", "subroot", "root", "witness"]
    assert sorted(r._group for r in out.collect()) == list(range(len(rows)))
    assert got(out) == slow_manifest(rows)
    with pytest.raises(ValueError, match="root"):
        merkle.merkle_manifest(df.withColumnRenamed("_group", "root"))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, leaf string")
    assert merkle.merkle_manifest(df).collect() == []


def test_leaf_and_fold(spark):
    rows = [(1, "s", None, 5, "tëxt"), (None, None, "en", None, None), (3, "", "en", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    found = df.select(merkle.leaf([F.col(c) for c in df.columns]).alias("leaf")).collect()
    assert [r.leaf for r in found] == [h(*map(field, r)) for r in rows]
    path = [">" + h("r"), "=", "<" + h("l")]
    one = spark.createDataFrame([(h("x"), path)], "leaf string, witness array<string>") \
        .select(merkle.fold(F.col("leaf"), F.col("witness")).alias("f"), merkle.siblings(F.col("witness")).alias("s")).first()
    assert one.f == h(h("l"), h(h(h("x"), h("r")))) and one.s == h("r") + h("l")


def test_witnesses_grow_while_leaves_arrive():
    trees = merkle.OpenTrees()
    for k in range(7):
        trees.append(h(str(k)))
        assert [x[0] for x in trees.open] == [b for b in (2, 1, 0) if (k + 1) >> b & 1]
    root, witnesses = trees.close(0)
    assert (root, witnesses) == climb([h(str(k)) for k in range(7)])
