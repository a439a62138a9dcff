"""Top-k search against brute force."""

import numpy as np
import pytest

from sluice.llm.topk import Asked, SortedLists, nra, qualified, top_k


def brute(rows, queries, k, factor=64):
    def ints(v):
        return [int(np.floor(factor * float(np.float32(x)))) for x in v]

    def fine(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)
    out = []
    for qi, qv in queries:
        if qi is None or not fine(qv):
            continue
        q = ints(qv)
        scored = sorted((-sum(a * b for a, b in zip(q, ints(v))), i) for i, v in rows
                        if i is not None and i != qi and fine(v))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,dim,first", [(5, 3, 1), (300, 4, 16), (400, 32, 50), (64, 1, 8)])
def test_bounds_keep_the_best(n, dim, first):
    rng = np.random.default_rng(n)
    x = rng.integers(-40, 41, (n, dim)).astype(np.int64)
    x[: n // 3] = x[0]  # many ties
    q = rng.integers(-40, 41, (9, dim)).astype(np.int64)
    q[0] = 0
    skip = rng.random((n, 9)) < 0.05
    for i, rows in enumerate(nra(SortedLists(x), q, 7, skip, first_depth=first)):
        scores = x @ q[i]
        allowed = np.flatnonzero(~skip[:, i])
        kth = np.sort(scores[allowed])[::-1][:7][-1] if len(allowed) else 0
        must = allowed[scores[allowed] >= kth] if len(allowed) >= 7 else allowed
        assert set(must.tolist()) <= set(rows.tolist()) and not skip[rows, i].any()


def test_stops_early_on_steep_lists():
    x = np.zeros((4000, 8), dtype=np.int64)
    x[:30] = 60
    rows = nra(SortedLists(x), np.full((1, 8), 50), 20, np.zeros((4000, 1), bool), first_depth=64)[0]
    assert rows.tolist() == list(range(30))


@pytest.mark.parametrize("block_rows", [37, 4096])
def test_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 0.2, (260, 16)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(400, None), (420, [float("nan")] * 16), (440, [None] * 16), (460, [0.0] * 16), (480, [float("inf")] * 16),
             (None, [0.1] * 16), (500, [1e6] * 16)]
    df = spark.createDataFrame([(i, v, "z", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, block string, rank int")
    got = top_k(df.repartition(3), df.where("vec_id % 20 = 0"), k=20, block_rows=block_rows, query_rows=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = brute(rows, [(i, v) for i, v in rows if i is not None and i % 20 == 0], 20)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_edge_tables(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert top_k(empty, empty).collect() == []
    one = spark.createDataFrame([(20, [1.0])], schema)
    assert top_k(one, one).collect() == [] and top_k(empty, one).collect() == []
    twice = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (3, [0.5]), (3, [0.5])], schema)
    assert sorted(tuple(r) for r in top_k(twice, twice.where("vec_id = 20")).collect()) == \
        [(20, 1, 3, 2048), (20, 2, 3, 2048)]


def test_vectors_of_other_lengths_take_no_part(spark):
    rows = [(20, [1.0, 0.5]), (1, [0.5, 0.5]), (2, []), (3, [1.0]), (40, [1.0, 2.0, 3.0]), (60, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = top_k(df, df.where("vec_id % 20 = 0")).collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, 64 * 32 + 32 * 32)]


def test_nothing_is_made_per_pair_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 0.2, (240, 8)).astype(np.float32)
    x = x[np.argsort(x[:, 0])]  # later blocks are better for some queries
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    compared = []
    kind = type(df)
    run = kind.mapInArrow

    def counted(self, *args, **more):
        if "x" in self.columns:  # rows with a block's vectors
            compared.append(self.count())
        return run(self, *args, **more)
    monkeypatch.setattr(kind, "mapInArrow", counted)
    got = top_k(df, df.where("vec_id % 2 = 0"), k=5, block_rows=3, query_rows=1)
    got = sorted(tuple(r) for r in got.collect())
    monkeypatch.undo()
    assert got == brute(rows, [r for r in rows if r[0] % 2 == 0], 5)
    assert compared and max(compared) < 0.6 * 80 * 120


def test_best_of_blocks_before_is_a_floor():
    rng = np.random.default_rng(8)
    x, q = rng.integers(-60, 61, (900, 16)), rng.integers(-60, 61, (40, 16))
    ids = rng.permutation(1800)[:900]
    asked = Asked(ids[:40], q, 7)
    for at in range(0, 900, 300):
        part = slice(at, at + 300)
        asked.meet(SortedLists(x[part]), ids[part], np.argsort(ids[part], kind="stable"))
    for i in range(40):
        scores = x @ q[i]
        want = [c for c in np.lexsort((ids, -scores)) if ids[c] != ids[i]][:7]
        mine = asked.best[0] == i
        assert asked.best[1][mine].tolist() == ids[want].tolist() and asked.best[2][mine].tolist() == scores[want].tolist()
    none = (np.zeros(0, np.int64),) * 2
    found, rows = qualified(SortedLists(x), q, 7, none, np.full(40, 10.0**6), first_depth=16)
    assert len(found) == len(rows) == 0
