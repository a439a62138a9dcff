"""Embedding near-dedup by dual traversal of a cover tree.

Vectors are scaled to length one (double precision); cosine >= c is distance <= sqrt(2 - 2c).  The tree has a
root of radius 2, which covers everything, and below it nested levels of halving radii
1, 1/2, 1/4 ...: every node is a vector, is its own first child, and every vector under it lies
within its recorded covering radius (the true largest distance, not the nominal one).

The tree is built in three steps.  Its upper levels (`Net`) are fitted on a bounded sample: greedy nets of halving radii, at most
``fanout`` centres under a node (a level that needs more centres repeats its radius below), split as long as a node
stands for more than ``block_rows`` rows.  All vectors go to their nearest leaf of the net, which gives the true covering radius of
every node; small nodes are closed or bundled with their siblings, and the rows of a leaf that is still
too large are cut by their distance to it (a histogram; equal distances by hash).  Each block so made, of
about ``block_rows`` rows, grows its lower levels in one task.

The traversal starts at the root paired with itself.  Each step is a join of the pairs that are left with the children of
both sides, pruned by covering radii; pairs of leaves become pairs of their blocks, pruned by the blocks' own balls.  Blocks are
dealt to tiles; a task holds the blocks of one tile while those of another pass by, so that a block travels once per pair of tiles, not
once per pair of blocks.  The two subtrees of a pair of blocks are traversed together: node
pairs further apart than the threshold and both covering radii are dropped, the others expand to their
children, down to single vectors, whose cosine is compared in double precision.  While most pairs are left, a level is compared as a
matrix product in single precision; that of the vectors themselves takes the directions in which the sample spreads most and,
for all others, the product of the lengths left, which the cosine cannot exceed.

Exact copies are collapsed to one vector with a count before the tree.  A pair of blocks returns the
number of links by vector and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm.components import connected_components
from sluice.llm.staging import stage
from sluice.llm.textcols import free_memory, giving_back

_SLACK = 1e-6  # added to every bound, far above rounding in double precision


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def plain_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(``(id, v)``: ids as bigints, vectors as they are in single precision and as doubles otherwise, their column type)."""
    single = vectors.select(vector_col).dtypes[0][1] == "array<float>"
    kind = "array<float>" if single else "array<double>"
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v")), kind


def list_facts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row of a column of lists its length (0 if null) and whether it is a list of finite numbers; and all numbers in order, as
    doubles."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    ends = np.cumsum(lengths)
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])  # a null among the numbers is read as NaN
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return lengths, known & (odd[ends] == odd[ends - lengths]), values


def commonest_length(rows: DataFrame, length: Column) -> int:
    """The length most rows have (the smaller at a tie; 0 without rows): a histogram of lengths, of which one row is
    read."""
    lengths = rows.groupBy(length.alias("length")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), "length").limit(1).collect()
    return first[0]["length"] if first else 0


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    top = np.abs(x).max(axis=1, keepdims=True) if x.size else np.ones((len(x), 1))
    x = x / top  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def true_cells(mask: np.ndarray) -> np.ndarray:
    """Flat places of the true cells of a contiguous array with few of them: eight cells are looked at at once."""
    flat = mask.reshape(-1)
    whole = len(flat) & ~7
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).reshape(-1)
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def greedy_net(x: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows chosen as centres, nearest centre by row): centres are taken in row order, each one more than
    ``radius`` from those before; at most ``most`` of them."""
    centres: list[int] = []
    best = np.full(len(x), np.inf)
    owner = np.zeros(len(x), dtype=np.int64)
    for at in range(0, len(x), 128):
        left = at + np.flatnonzero(best[at:at + 128] > radius)
        if not len(left) or (most is not None and len(centres) >= most):
            continue
        for i, d in zip(left.tolist(), _distances(x[left], x)):
            if best[i] <= radius or (most is not None and len(centres) >= most):
                continue
            closer = d < best
            best[closer], owner[closer] = d[closer], len(centres)
            centres.append(i)
    return np.array(centres, dtype=np.int64), owner


_DIRECTIONS = 15  # of a vector that are compared before all of it


def spread_directions(x: np.ndarray) -> np.ndarray:
    """Orthonormal columns: the directions in which the rows are longest."""
    if not len(x):
        return np.eye(x.shape[1])[:, :_DIRECTIONS]
    return np.linalg.svd(x, full_matrices=False)[2][:_DIRECTIONS].T


class Subtree:
    """Levels below a block: per level the centre rows, their parents' positions one level up, and covering
    radii.  The last level holds every vector."""

    def __init__(self, raw: np.ndarray, tau: float) -> None:
        self.x = x = _unit(raw)
        self._sketch()
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, parent, radius
        radius = 1.0
        groups = [np.arange(len(x))]
        parents = [0]
        while True:
            rows, up, radii, below, of = [], [], [], [], []
            for g, members in enumerate(groups):
                if len(members) == 1:
                    rows.append(members[0])
                    up.append(parents[g])
                    radii.append(0.0)
                    of.append(len(rows) - 1)
                    below.append(members)
                    continue
                if radius < tau / 4:
                    centres, owner = np.arange(len(members)), np.arange(len(members))
                else:
                    centres, owner = greedy_net(x[members], radius)
                held = np.bincount(owner, minlength=len(centres))
                for c, at in enumerate(centres.tolist()):
                    if held[c] == 1:
                        rows.append(members[at])
                        up.append(parents[g])
                        radii.append(0.0)
                        of.append(len(rows) - 1)
                        below.append(members[at:at + 1])
                        continue
                    mine = members[owner == c] if len(centres) < len(members) else members[at:at + 1]
                    mine = np.concatenate([[members[at]], mine[mine != members[at]]])
                    d = _distances(x[mine], x[mine[:1]])[:, 0]
                    rows.append(mine[0])
                    up.append(parents[g])
                    radii.append(d.max() if len(mine) > 1 else 0.0)
                    of.append(len(rows) - 1)
                    below.append(mine)
            self.levels.append((np.array(rows), np.array(up), np.array(radii)))
            if all(len(m) == 1 for m in below):
                break
            groups, parents = below, of
            radius /= 2

    def dump(self, raw: np.ndarray) -> bytes:
        """The tree with its unscaled vectors, in single precision where that is exact."""
        single = raw.astype(np.float32)
        levels = [(rows.astype(np.int32), up.astype(np.int32), radii) for rows, up, radii in self.levels]
        return pickle.dumps((single if (single == raw).all() else raw, levels), protocol=5)

    @classmethod
    def load(cls, blob: bytes, basis: np.ndarray | None = None) -> "Subtree":
        """``basis``: orthonormal columns, the directions to compare first (by default the first components)."""
        tree = cls.__new__(cls)
        raw, tree.levels = pickle.loads(blob)
        tree.x = _unit(raw.astype(np.float64))
        tree._sketch(basis)
        return tree

    def _sketch(self, basis: np.ndarray | None = None) -> None:
        """By vector, in single precision, its share in some directions and the length of the rest."""
        y = self.x[:, :_DIRECTIONS] if basis is None else self.x @ basis
        rest = np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1, keepdims=True)))
        self.sketch = np.concatenate([y, rest], axis=1).astype(np.float32)

    def children(self, level: int) -> list[np.ndarray]:
        """Positions at ``level`` by parent position one level up."""
        up = self.levels[level][1]
        order = np.argsort(up, kind="stable")
        n = len(self.levels[level - 1][0])
        return np.split(order, np.searchsorted(up[order], np.arange(1, n)))


def _expand(first: np.ndarray, second: np.ndarray, left: list[np.ndarray],
            right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n_left = np.array([len(c) for c in left])[first]
    n_right = np.array([len(c) for c in right])[second]
    pair = np.repeat(np.arange(len(first)), n_left * n_right)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n_left * n_right) - n_left * n_right, n_left * n_right)
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    start_l = np.cumsum([0, *map(len, left)])[:-1]
    start_r = np.cumsum([0, *map(len, right)])[:-1]
    a = flat_l[start_l[first[pair]] + k // n_right[pair]]
    b = flat_r[start_r[second[pair]] + k % n_right[pair]]
    return a, b


_SINGLE_SLACK = 1e-5  # of a cosine in single precision
_STRIP = 256  # rows of a matrix product at a time
_PAIR_COST = 16  # cells of a product that take as long as a pair of its own


def _level(tree: Subtree, level: int) -> tuple[np.ndarray, np.ndarray]:
    rows, _, radius = tree.levels[min(level, len(tree.levels) - 1)]
    return rows, radius


def _dense(a: Subtree, b: Subtree, level: int, tau: float, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of nodes of a level that are near enough, by products in single precision."""
    (rows_a, rad_a), (rows_b, rad_b) = _level(a, level), _level(b, level)
    left, right = (a.sketch[rows_a], b.sketch[rows_b]) if last else (t.x[rows].astype(np.float32) for t, rows in ((a, rows_a), (b, rows_b)))
    right = np.ascontiguousarray(right.T)
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(rows_a), _STRIP):
        dots = left[at:at + _STRIP] @ right
        if last:
            near = dots >= np.float32(1.0 - tau * tau / 2 - _SINGLE_SLACK)
        else:
            reach = np.minimum(2.0, tau + rad_a[at:at + _STRIP, None] + rad_b[None, :] + _SLACK).astype(np.float32)
            near = dots >= np.float32(1.0 - _SINGLE_SLACK) - reach * reach / 2
        found.append(at * len(rows_b) + true_cells(near))
    places = np.concatenate(found)
    return places // len(rows_b), places % len(rows_b)


def dual_traversal(a: Subtree, b: Subtree, tau: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate row pairs of two subtrees: all pairs within ``tau`` are among them."""
    depth = max(len(a.levels), len(b.levels))
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(a.x) * len(b.x) == 0:
        return none
    pairs: tuple[np.ndarray, np.ndarray] | None = None  # positions at the level; None: (nearly) all
    for level in range(depth):
        last = level == depth - 1
        (rows_a, rad_a), (rows_b, rad_b) = _level(a, level), _level(b, level)
        if pairs is None:
            if not last and len(rows_a) * len(rows_b) > len(a.x) * len(b.x) / 8:
                continue  # as dear as the vectors themselves
            pairs = _dense(a, b, level, tau, last)
        else:
            below = [t.children(level) if level < len(t.levels) else [np.array([i]) for i in range(len(rows))]
                     for t, rows in ((a, rows_a), (b, rows_b))]
            held = [np.array([len(c) for c in kids])[side] for kids, side in zip(below, pairs)]
            if (held[0] * held[1]).sum() * _PAIR_COST > len(rows_a) * len(rows_b):
                pairs = _dense(a, b, level, tau, last)
            else:
                first, second = _expand(*pairs, *below)
                keep = np.zeros(len(first), dtype=bool)
                for at in range(0, len(first), 1 << 14):  # bounded memory
                    s = slice(at, at + (1 << 14))
                    dots = np.einsum("ij,ij->i", a.x[rows_a[first[s]]], b.x[rows_b[second[s]]])
                    d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
                    keep[s] = d <= tau + rad_a[first[s]] + rad_b[second[s]] + _SLACK
                pairs = first[keep], second[keep]
        if not len(pairs[0]):
            return none
    return rows_a[pairs[0]], rows_b[pairs[1]]


_BINS = 64  # of the distance to the leaf's centre, 0 to 2


class Net:
    """The upper levels of the tree.  Node 0 is the root; every node's centre is a vector of the sample and the first centre among its
    children (nested), so each centre belongs to one leaf.  ``paths`` lists by leaf the nodes from the root down to it."""

    def __init__(self, x: np.ndarray, tau: float, fanout: int, leaf_rows: int) -> None:
        self.centre, self.kids = [0] * bool(len(x)), [[]] * bool(len(x))
        self.paths: list[list[int]] = []
        work = [([0], np.arange(len(x)), 1.0)] if len(x) else []
        while work:
            path, members, radius = work.pop()
            centres, owner = np.zeros(1, np.int64), np.zeros(len(members), np.int64)
            if len(members) > leaf_rows:
                while radius >= tau / 4 and len(centres) == 1:
                    centres, owner = greedy_net(x[members], radius, fanout)
                    if len(centres) < fanout:
                        radius /= 2
            if len(centres) == 1:
                self.paths.append(path)
                continue
            kids = list(range(len(self.centre), len(self.centre) + len(centres)))
            self.kids[path[-1]] = kids
            self.centre += members[centres].tolist()
            self.kids += [[] for _ in kids]
            for c in reversed(range(len(centres))):
                mine = members[owner == c]
                mine = np.concatenate([members[centres[c:c + 1]], mine[mine != members[centres[c]]]])
                work.append(([*path, kids[c]], mine, radius))
        self.depth = max(map(len, self.paths), default=0)
        leaf_of = {self.centre[path[-1]]: leaf for leaf, path in enumerate(self.paths)}
        #: by leaf and level the leaf that has the centre of its node on that level (below the leaf's own level: itself)
        self.up = np.array([[leaf_of[self.centre[path[min(level, len(path) - 1)]]] for level in range(self.depth)]
                            for path in self.paths], dtype=np.int64).reshape(len(self.paths), self.depth)
        self.x = x[[self.centre[path[-1]] for path in self.paths]] if len(x) else np.zeros((0, x.shape[1]))


class Cells:
    """The net with its small nodes closed: ``kids`` by node (a cell has itself alone), ``x`` and ``radius`` by node, ``cell`` by
    leaf of the net, ``rows`` by cell."""

    def __init__(self, net: Net, found: dict[int, tuple[int, list[float]]], block_rows: int) -> None:
        """``found``: by leaf its number of rows and their largest distance to the centre of each level."""
        nodes = len(net.centre)
        rows, radius = np.zeros(nodes, np.int64), np.zeros(nodes)
        leaves: list[list[int]] = [[] for _ in range(nodes)]
        self.x = np.zeros((nodes, net.x.shape[1]))
        for leaf, path in enumerate(net.paths):
            n, far = found.get(leaf, (0, [0.0] * net.depth))
            for level, node in enumerate(path):
                rows[node] += n
                radius[node] = max(radius[node], far[level])
                leaves[node].append(leaf)
                self.x[node] = net.x[net.up[leaf, level]]
        self.radius = radius
        self.kids: dict[int, list[int]] = {}
        self.rows: dict[int, int] = {}
        self.cell = np.zeros(len(net.paths), dtype=np.int64)
        self.depth = 0
        work = [(0, 0)] if nodes else []
        while work:
            node, depth = work.pop()
            self.depth = max(self.depth, depth)
            if rows[node] <= block_rows or not net.kids[node]:
                self._close(node, [node], rows, leaves)
                continue
            small = [k for k in net.kids[node] if 0 < rows[k] <= block_rows]
            large = [k for k in net.kids[node] if rows[k] > block_rows]
            self.kids[node] = list(large)
            while small:
                held = 0
                bundle = []
                while small and held + rows[small[0]] <= block_rows:
                    held += rows[small[0]]
                    bundle.append(small.pop(0))
                name = bundle[0] if len(bundle) == 1 else len(self.x)
                if len(bundle) > 1:  # a node of its own about its first member's centre
                    reach = _distances(self.x[bundle[:1]], self.x[bundle])[0] + self.radius[bundle]
                    self.x = np.concatenate([self.x, self.x[bundle[:1]]])
                    self.radius = np.append(self.radius, reach.max() + _SLACK)
                self._close(name, bundle, rows, leaves)
                self.kids[node].append(name)
                self.depth = max(self.depth, depth + 1)
            work += [(k, depth + 1) for k in large]

    def _close(self, name: int, members: list[int], rows: np.ndarray, leaves: list[list[int]]) -> None:
        self.kids[name] = [name]
        self.rows[name] = int(sum(rows[m] for m in members))
        for m in members:
            self.cell[leaves[m]] = name

    def blocks(self, sizes: dict[tuple[int, int], int], block_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """(first block, number of blocks) by cell and bin of the distance to its centre; ``sizes`` has the bins of cells with more
        than ``block_rows`` rows.  Neighbouring bins share a block; a bin with more rows gets several."""
        first = np.zeros((len(self.x), _BINS + 1), dtype=np.int64)
        parts = np.ones((len(self.x), _BINS + 1), dtype=np.int64)
        block = -1
        for cell, total in sorted(self.rows.items()):
            if total <= block_rows:
                block += 1
                first[cell] = block
                continue
            held = block_rows  # every cell starts a block
            for b in range(_BINS + 1):
                n = sizes.get((cell, b), 0)
                if not n:
                    continue
                if held + n > block_rows:
                    block, held = block + 1, 0
                first[cell, b], parts[cell, b] = block, max(1, -(-n // block_rows))
                held += n
                if parts[cell, b] > 1:
                    block, held = block + parts[cell, b] - 1, block_rows
        return first, parts


def cell_pairs(spark: SparkSession, cells: Cells, tau: float) -> DataFrame:
    """Pairs of cells (``a``, ``b``; each pair once, a cell with itself included) that can hold a pair within ``tau``: from the root
    down, one join with the children of both sides and one pruning by covering radii per level."""
    x, radius = cells.x, cells.radius

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in range(2))
            keep = np.zeros(len(a), dtype=bool)
            for at in range(0, len(a), 1 << 14):  # bounded memory
                s = slice(at, at + (1 << 14))
                d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", x[a[s]], x[b[s]])))
                keep[s] = d <= tau + radius[a[s]] + radius[b[s]] + _SLACK
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    kids = spark.createDataFrame([(n, k) for n, ks in cells.kids.items() for k in ks], "node long, kid long")
    left, right = kids.toDF("a", "next_a"), kids.toDF("b", "next_b")
    pairs = spark.createDataFrame([(0, 0)] if cells.kids else [], "a long, b long")
    for level in range(cells.depth):
        pairs = pairs.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("next_a") <= F.col("next_b"))) \
            .select(F.col("next_a").alias("a"), F.col("next_b").alias("b")).mapInArrow(giving_back(near), "a long, b long")
        if level % 3 == 2:
            pairs = stage(pairs, "cell-pairs")
    return pairs


def _grow_block(key: tuple, batches: Iterator[pa.RecordBatch], tau: float, kind: str) -> Iterator[pa.RecordBatch]:
    """The rows of one block -> one row with its subtree, centre and covering radius."""
    rows = pa.Table.from_batches(list(batches)).sort_by("id")
    raw = np.stack([np.frombuffer(x.as_buffer(), dtype=kind) for x in rows.column("x")]).astype(np.float64)
    tree = Subtree(raw, tau)
    centre = tree.x.mean(axis=0)
    norm = np.sqrt((centre * centre).sum())
    centre = centre / norm if norm > 1e-9 else tree.x[0]
    radius = float(_distances(tree.x, centre[None, :]).max())
    yield pa.RecordBatch.from_arrays(
        [pa.array([rows.column("cell")[0].as_py()], pa.int64()), pa.array([key[0].as_py()], pa.int64()),
         pa.array([centre.astype("<f8").tobytes()], pa.binary()), pa.array([radius]),
         pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())),
         pa.array([rows.column("copies").to_pylist()], pa.list_(pa.int64())),
         pa.array([tree.dump(raw)], pa.binary())],
        names=["cell", "block", "centre", "radius", "ids", "copies", "tree"])


def _stars(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the nodes 0 to n - 1 -> (nodes, smallest node reachable) of those that reach a smaller one."""
    low = np.arange(n)
    while len(u):
        np.minimum.at(low, np.maximum(low[u], low[v]), np.minimum(low[u], low[v]))
        while (low[low] != low).any():
            low = low[low]
        apart = low[u] != low[v]
        u, v = u[apart], v[apart]
    nodes = np.flatnonzero(low != np.arange(n))
    return nodes, low[nodes]


class Held(NamedTuple):
    number: int
    ids: np.ndarray
    copies: np.ndarray
    tree: Subtree


def _links(a: Held, b: Held, cosine: float, tau: float) -> tuple[np.ndarray, ...] | None:
    """Of a pair of blocks: (vector, other, links, whether it is a link): link counts by vector and a spanning forest of the links."""
    i, j = dual_traversal(a.tree, b.tree, tau)
    if a.number == b.number:
        i, j = i[i < j], j[i < j]
    sure = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 14):  # bounded memory
        s = slice(at, at + (1 << 14))
        sure[s] = np.einsum("ij,ij->i", a.tree.x[i[s]], b.tree.x[j[s]]) >= cosine
    i, j = i[sure].astype(np.int64), j[sure].astype(np.int64)
    if not len(i):
        return None
    ids = a.ids if a.number == b.number else np.concatenate([a.ids, b.ids])
    j_at = j if a.number == b.number else len(a.ids) + j
    counts = np.bincount(i, weights=b.copies[j], minlength=len(ids)) + np.bincount(j_at, weights=a.copies[i], minlength=len(ids))
    found = np.flatnonzero(counts)
    u, v = _stars(i, j_at, len(ids))
    return (np.concatenate([ids[found], ids[u]]), np.concatenate([np.full(len(found), -1), ids[v]]),
            np.concatenate([counts[found].astype(np.int64), np.zeros(len(u), np.int64)]),
            np.concatenate([np.zeros(len(found), bool), np.ones(len(u), bool)]))


def _compare(batches: Iterator[pa.RecordBatch], cosine: float, tau: float, basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (job, others, block, ids, copies, tree), by job the blocks to hold (``others`` null) before those that pass by and are
    compared with the held ``others`` -> link counts by vector (``other`` null) and a spanning forest of the links."""
    job, held = None, {}
    for batch in batches:
        for row in range(batch.num_rows):
            if job != (now := batch.column(0)[row].as_py()):
                job, held = now, {}
            others = batch.column(1)[row].as_py()
            mine = Held(batch.column(2)[row].as_py(), batch.column(3)[row].values.to_numpy(), batch.column(4)[row].values.to_numpy(),
                        Subtree.load(batch.column(5)[row].as_py(), basis))
            if others is None:
                held[mine.number] = mine
                continue
            found = [x for other in sorted(others) if (x := _links(held[other], mine, cosine, tau))]
            if found:
                node, other, links, linked = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(other, mask=~linked), pa.array(links)],
                                                 names=["node", "other", "links"])


_TILE = 64  # blocks that a task holds at most


def _jobs(blocks: DataFrame, pairs: DataFrame, n_blocks: int, cores: int) -> DataFrame:
    """Pairs of blocks dealt to pairs of tiles, some for each core: rows for ``_compare``, every job in a partition of its own."""
    tiles = max(1, round((6 * cores) ** 0.5))
    tile = max(1, min(_TILE, -(-n_blocks // tiles)))
    tiles = max(1, -(-n_blocks // tile))
    numbered = pairs.withColumn("job", F.floor(F.col("a_block") / tile) * tiles + F.floor(F.col("b_block") / tile))
    numbered = stage(numbered, "block-pairs")
    needed = numbered.select("job", F.col("a_block").alias("block"), F.lit(None).cast("array<long>").alias("others")).distinct().unionAll(
        numbered.groupBy("job", F.col("b_block").alias("block")).agg(F.collect_list("a_block").alias("others"))
        .select("job", "block", "others"))
    # twice as many ranges as jobs: each job has its own, where hashes would put some jobs together
    return needed.join(blocks.select("block", "ids", "copies", "tree"), "block").withColumn("passing", F.col("others").isNotNull()) \
        .repartitionByRange(tiles * (tiles + 1), "job").sortWithinPartitions("job", "passing", "block") \
        .select("job", "others", "block", "ids", "copies", "tree")


def near_vectors(vectors: DataFrame, cosine: float = 0.95, fanout: int = 16, sample_rows: int = 4096,
                 block_rows: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Classes of vectors linked by a cosine of at least ``cosine``.

    One row per input row: ``vec_id``, ``n_links`` (other rows linked directly, exact copies included),
    ``component_id`` (smallest vec_id reachable, itself included), ``kept`` (vec_id = component_id).  Null and zero vectors and
    those with null or non-finite components link with nothing and are their own component; so do vectors of
    another length than the commonest one (at a tie, the smaller length is the commonest), empty ones among them.  Repeated rows link like any others; a null vec_id is kept as a
    row of its own without links.  An empty table gives an empty result."""
    if not 0 < cosine <= 1 or fanout < 2:
        raise ValueError("cosine must lie in (0, 1], fanout must be at least 2")
    tau = float(np.sqrt(2.0 - 2.0 * cosine))
    plain, listed = plain_vectors(vectors, id_col, vector_col)
    kind = "<f4" if listed == "array<float>" else "<f8"

    odd = F.array(*[F.lit(x) for x in (float("inf"), float("-inf"), float("nan"))]).cast(listed)
    finite = ~F.arrays_overlap("v", odd)  # null where a component is null
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & ((F.array_max("v") != 0) | (F.array_min("v") != 0)), F.lit(False))
    rows = stage(plain.select(F.col("id").alias("vec_id"), "v").withColumn("ok", usable), "vectors")
    length = commonest_length(rows.where("ok"), F.size("v"))
    rows = rows.withColumn("ok", F.col("ok") & F.coalesce(F.size("v") == length, F.lit(False)))
    one = stage(rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
                "distinct-vectors")

    sample = one.select("id", "v").orderBy(F.xxhash64("id")).limit(sample_rows).toArrow()  # bounded
    x = _unit(_matrix(sample.column("v").combine_chunks())) if sample.num_rows else np.zeros((0, 1))
    total = one.count()
    net = Net(x, tau, fanout, max(1, block_rows * len(x) // max(1, total)))
    basis = spread_directions(x)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounded memory
                part = batch.slice(at, 256)
                raw = _matrix(part.column(2))
                d = _distances(_unit(raw), net.x)
                leaf = d.argmin(axis=1)
                far = np.take_along_axis(d, net.up[leaf], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), pa.array(d[np.arange(len(d)), leaf]),
                     pa.array(list(far), pa.list_(pa.float64())), part.column(0), part.column(1),
                     pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary())],
                    names=["leaf", "d", "far", "id", "copies", "x"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, cosine, tau, basis)

    placed = stage(one.select("id", "copies", "v").mapInArrow(
        giving_back(assign), "leaf long, d double, far array<double>, id long, copies long, x binary")
        .withColumn("bin", F.least(F.lit(_BINS), F.floor(F.col("d") * (_BINS / 2))).cast("int")), "placed")
    furthest = [F.max(F.get("far", F.lit(level))).alias(f"far_{level}") for level in range(net.depth)]
    found = {r[0]: (r[1], list(r[2:])) for r in
             placed.groupBy("leaf").agg(F.count("*").alias("n"), *furthest).collect()}  # at most a row per sampled vector
    cells = Cells(net, found, block_rows)
    large = [leaf for leaf, (n, _) in found.items() if n > block_rows]
    sizes = {(int(cells.cell[r["leaf"]]), r["bin"]): r["count"] for r in
             placed.where(F.col("leaf").isin(large)).groupBy("leaf", "bin").count().collect()}  # bounded
    first, parts = cells.blocks(sizes, block_rows)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, at, ids = (batch.column(i).to_numpy() for i in range(3))
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            cell = cells.cell[leaf]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[cell, at] + spread % parts[cell, at]), pa.array(cell), *(batch.column(i) for i in (2, 3, 4))],
                names=["block", "cell", "id", "copies", "x"])

    def grow(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grow_block(key, batches, tau, kind)
        free_memory()

    # a block holds about block_rows rows whatever the cell holds, and however many partitions there are
    blocks = stage(placed.select("leaf", "bin", "id", "copies", "x")
                   .mapInArrow(giving_back(number), "block long, cell long, id long, copies long, x binary")
                   .groupBy("block").applyInArrow(grow, "cell long, block long, centre binary, radius double, "
                                                        "ids array<long>, copies array<long>, tree binary"), "blocks")
    pairs = _block_pairs(blocks, cell_pairs(vectors.sparkSession, cells, tau), tau)
    last = blocks.agg(F.max("block")).first()[0]
    jobs = _jobs(blocks, pairs, (-1 if last is None else last) + 1, vectors.sparkSession.sparkContext.defaultParallelism)
    found = stage(jobs.mapInArrow(giving_back(compare), "node long, other long, links long"), "vector-links")

    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("other is not null").select("node", "other"))
    named = stage(one.join(counts, one.id == counts.node, "left").drop("node")
                  .join(comps, one.id == comps.node, "left")
                  .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("component", "id").alias("component_id"), F.lit(True).alias("ok")),
                  "vector-classes")
    out = rows.join(named, ["ok", "v"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _block_pairs(blocks: DataFrame, pairs: DataFrame, tau: float) -> DataFrame:
    """The pairs of cells that are left, joined with the blocks of both, and kept if the blocks' covering balls come near enough."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.stack([np.frombuffer(v, dtype="<f8") for v in batch.column(i).to_pylist()])
                    for i in (1, 4))
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", a, b)))
            bound = tau + batch.column(2).to_numpy() + batch.column(5).to_numpy() + _SLACK
            keep = pa.array(d <= bound)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(3).filter(keep)],
                                             names=["a_block", "b_block"])

    nodes = blocks.select("cell", "block", "centre", "radius")
    a = nodes.select(*[F.col(c).alias(f"a_{c}") for c in nodes.columns])
    b = nodes.select(*[F.col(c).alias(f"b_{c}") for c in nodes.columns])
    both = pairs.join(a, F.col("a") == F.col("a_cell")).join(b, F.col("b") == F.col("b_cell")).where(
        (F.col("a") != F.col("b")) | (F.col("a_block") <= F.col("b_block")))
    return both.select("a_block", "a_centre", "a_radius", "b_block", "b_centre", "b_radius").mapInArrow(
        giving_back(near), "a_block long, b_block long")
