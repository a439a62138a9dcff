"""Cover-tree classes against brute-force cosines."""

import numpy as np
import pytest

from sluice.llm.covertree import (Cells, Net, Subtree, _distances, _stars, _unit, cell_pairs, dual_traversal, greedy_net,
                                  near_vectors, spread_directions)


def cloud(rng, n, dim, copies, spread):
    base = rng.normal(size=(n, dim))
    near = base[rng.integers(0, n, copies)] + spread * rng.normal(size=(copies, dim))
    return np.concatenate([base, near * rng.uniform(0.1, 9, (copies, 1))]).astype(np.float32)


@pytest.mark.parametrize("dim,spread", [(3, 0.05), (8, 0.1), (64, 0.04)])
def test_traversal_finds_all_pairs(dim, spread):
    rng = np.random.default_rng(dim)
    tau = np.sqrt(0.1)
    a, b = cloud(rng, 150, dim, 200, spread), cloud(rng, 120, dim, 60, spread)
    b[:40] = a[:40] + 0.01
    left, right = (Subtree(x.astype(float), tau) for x in (a, b))
    right = Subtree.load(right.dump(b.astype(float)))
    i, j = dual_traversal(left, right, tau)
    got = set(zip(i.tolist(), j.tolist()))
    assert len(got) == len(i)
    want = set(zip(*(x.tolist() for x in np.nonzero(left.x @ right.x.T >= 0.95))))
    assert want <= got and want


def test_covering_radii_hold():
    rng = np.random.default_rng(4)
    tree = Subtree(cloud(rng, 80, 6, 80, 0.1).astype(float), 0.3)
    below = {i: {int(r)} for i, r in enumerate(tree.levels[-1][0])}
    assert sorted(tree.levels[-1][0].tolist()) == list(range(160))
    for level in range(len(tree.levels) - 1, -1, -1):
        rows, up, radii = tree.levels[level]
        for i, r in enumerate(rows.tolist()):
            assert r in below[i]  # nested: a node is among its own descendants
            assert max(np.linalg.norm(tree.x[m] - tree.x[r]) for m in below[i]) <= radii[i] + 1e-6
        if level:
            above = {}
            for i, parent in enumerate(up.tolist()):
                above.setdefault(parent, set()).update(below[i])
            below = above


def test_greedy_net_covers():
    x = np.eye(5)[[0, 1, 0, 2, 1]]
    centres, owner = greedy_net(x, 0.5)
    assert centres.tolist() == [0, 1, 3] and owner.tolist() == [0, 1, 0, 2, 1]


def brute(rows, cosine):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in ok])
    near = x @ x.T >= cosine
    ids = [i for i, _ in ok]
    links = {i: int(near[k].sum()) - 1 for k, i in enumerate(ids)}
    low = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for k, i in enumerate(ids):
            m = min(low[ids[j]] for j in np.flatnonzero(near[k]))
            if m < low[i]:
                low[i], changed = m, True
    return {i: (links.get(i, 0), low[i]) for i, _ in rows}


@pytest.mark.parametrize("block_rows", [50, 2048])
def test_classes_match_brute_force(spark, block_rows):
    rng = np.random.default_rng(9)
    x = cloud(rng, 120, 16, 150, 0.05)
    x = np.concatenate([x, x[:30], np.repeat(x[5:6], 90, axis=0)])  # exact copies, a hot one
    rows = [(i * 3, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [float("inf")] + [1.0] * 15),
             (5004, [None] + [1.0] * 15), (5005, [0.0] * 16)]
    df = spark.createDataFrame([(i, v, 1, "k") for i, v in rows],
                               "vec_id long, embedding array<float>, v int, component_id string")
    out = near_vectors(df.repartition(6), block_rows=block_rows, fanout=4, sample_rows=64)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    want = brute(rows, 0.95)
    assert got == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


def test_net_prunes_pairs_of_cells_level_by_level(spark):
    rng = np.random.default_rng(2)
    middles = np.repeat(rng.normal(size=(60, 4)), 50, axis=0)
    x = _unit(rng.permutation(middles + 0.02 * rng.normal(size=middles.shape)))
    tau, block_rows = float(np.sqrt(0.1)), 60
    net = Net(x[:600], tau, 4, 12)
    assert net.depth > 2 and len(set(map(tuple, net.paths))) == len(net.paths)
    d = _distances(x, net.x)
    leaf = d.argmin(axis=1)
    far = np.take_along_axis(d, net.up[leaf], axis=1)
    found = {k: (int((leaf == k).sum()), far[leaf == k].max(axis=0).tolist()) for k in np.unique(leaf).tolist()}
    cells = Cells(net, found, block_rows)
    cell = cells.cell[leaf]
    assert {c: int((cell == c).sum()) for c in set(cell.tolist())} == cells.rows
    for c in cells.rows:  # every cell's ball covers its rows
        assert _distances(x[cell == c], cells.x[c:c + 1]).max() <= cells.radius[c] + 1e-6
    pairs = [(r.a, r.b) for r in cell_pairs(spark, cells, tau).collect()]
    got = {tuple(sorted(p)) for p in pairs}
    assert len(got) == len(pairs)
    i, j = np.nonzero(x @ x.T >= 0.95)
    assert {tuple(sorted(p)) for p in zip(cell[i].tolist(), cell[j].tolist())} <= got
    n = len(cells.rows)
    assert n > 20 and len(got) < 0.5 * n * (n + 1) / 2


def test_one_dense_leaf_is_cut_into_blocks(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(100, 8)), np.ones((300, 8)) + 0.001 * rng.normal(size=(300, 8))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=40, sample_rows=50)
    assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == brute(rows, 0.95)


def test_edge_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert near_vectors(spark.createDataFrame([], schema)).collect() == []
    only = near_vectors(spark.createDataFrame([(3, None), (None, [1.0, 0.0])], schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in only) == [("3", 0, True), ("None", 0, True)]
    same = near_vectors(spark.createDataFrame([(7, [1.0, 2.0]), (7, [1.0, 2.0]), (9, [2.0, 4.0])], schema)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in same) == [(7, 2, 7), (7, 2, 7), (9, 2, 7)]


def test_vectors_of_other_lengths_link_with_nothing(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.1]), (3, [1.0, 2.0]), (4, [1.0, 2.0, 3.0, 4.0]), (5, []), (6, [1.0, 2.0])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), sample_rows=1).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [
        (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 1, 3)]
    rows.append((7, [1.0, 2.0, 3.0]))
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), sample_rows=1).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [
        (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 2, 1)]


def test_a_block_travels_once_per_pair_of_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = cloud(rng, 300, 64, 100, 0.04)
    x = np.concatenate([x, x[:1] + 0.001 * rng.normal(size=(60, 64))]).astype(np.float32)  # a large group of near copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    compared = []
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kind = type(df)
    run = kind.mapInArrow

    def counted(self, *args, **more):
        trees = sum(c.endswith("tree") for c in self.columns)
        if trees:
            compared.append(trees * self.count())
        return run(self, *args, **more)
    monkeypatch.setattr(kind, "mapInArrow", counted)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df, block_rows=4, sample_rows=64).collect()}
    monkeypatch.undo()
    assert got == brute(rows, 0.95)
    assert compared and max(compared) < 115 * 116 / 4  # at least 115 blocks: half of their pairs, were they all compared


def test_products_keep_what_the_steps_keep():
    rng = np.random.default_rng(5)
    tau = float(np.sqrt(0.1))
    for dim in (2, 16, 40):
        a, b = (_unit(cloud(rng, 200, dim, 200, 0.05).astype(float)) for _ in range(2))
        b[:100] = a[:100] + 0.02
        basis = spread_directions(a)
        assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]))
        left, right = (Subtree.load(Subtree(x, tau).dump(x), basis) for x in (a, b))
        got = set(zip(*(x.tolist() for x in dual_traversal(left, right, tau))))
        assert set(zip(*(x.tolist() for x in np.nonzero(left.x @ right.x.T >= 0.95)))) <= got
        assert len(got) < 0.5 * 160000 or dim == 2
    links = np.array([[0, 1], [3, 2], [2, 5], [5, 3], [7, 6], [6, 1]])
    nodes, low = _stars(links[:, 0], links[:, 1], 9)
    assert dict(zip(nodes.tolist(), low.tolist())) == {1: 0, 3: 2, 5: 2, 6: 0, 7: 0}
