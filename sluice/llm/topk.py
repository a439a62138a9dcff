"""Exact top-k by inner product with no-random-access aggregation.

Candidates are cut into blocks.  A block keeps one list per dimension, sorted by value; a query reads a list from the
high end where its own component is positive and from the low end where it is negative, so that
contributions only fall.  All lists are read to a common depth that doubles from round to round.  After
a round every candidate has

* a lower bound: its contributions read so far, plus the least contribution of each list not read to it;
* an upper bound: its contributions read so far, plus the last contribution read of each such list.

A candidate none of whose entries was read has the sum of the last contributions as its upper bound, which no other
candidate's is below: a round in which that sum reaches the query's floor drops nothing and is passed over.  So is one that
leaves most candidates of a few queries of the block.  A query stops when few candidates have an upper bound that reaches its floor,
the k-th lower bound of the block or the k-th best score of the blocks before.  What is left gets its final
score and joins the query's best k so far.

A task holds a tile of the queries and a stripe of the blocks passes by, one block at a time: blocks travel once per tile of
queries, queries once per stripe, and nothing is made per pair of both.  A partial top-k per query over the stripes gives the result.

Bounds of all queries of a block come from matrix products: which entries were read depends on the
sign of the query's component only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sluice.llm.covertree import commonest_length, list_facts, plain_vectors, true_cells
from sluice.llm.staging import small_batches, stage
from sluice.llm.textcols import giving_back


def _fine(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row (id, v) the length of its vector, and whether it takes part; all components of all rows."""
    lengths, finite, values = list_facts(batch.column(1))
    return lengths, finite & (lengths > 0) & batch.column(0).is_valid().to_numpy(zero_copy_only=False), values


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, fine, _ = _fine(batch)
        yield pa.RecordBatch.from_arrays([pa.array(lengths[fine].astype(np.int32))], names=["length"])


def quantized(vectors: DataFrame, factor: float, id_col: str, vector_col: str, length: int) -> DataFrame:
    """``(id, v)``: floor(factor * component) of vectors of ``length`` components; rows with a null id or vector, an empty one, or one
    with null or non-finite components, do not take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, fine, values = _fine(batch)
            fine &= lengths == length
            x = np.floor(values[np.repeat(fine, lengths)] * factor)
            whole = np.clip(x, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
            whole[x >= 2.0**63] = np.iinfo(np.int64).max
            ends = pa.array(np.arange(0, len(whole) + 1, max(1, length), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), pa.ListArray.from_arrays(ends, pa.array(whole))], names=["id", "v"])
    return plain_vectors(vectors, id_col, vector_col)[0].mapInArrow(run, "id long, v array<long>")


def _blocks(block_rows: int):
    """Rows (id, v) -> blocks (ids, matrix): a partition's rows in runs of ``block_rows``, in the narrowest integers that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        held = 0

        def block(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            width = next(w for w in (1, 2, 4, 8) if w == 8 or np.abs(x).max(initial=0) < 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(ids[0])]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([x.astype(f"<i{width}").tobytes()], pa.binary()), pa.array([width], pa.int32())],
                names=["first", "ids", "x", "width"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column(0).to_numpy())
            rows.append(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))
            held += batch.num_rows
            if held >= block_rows:
                all_ids, all_rows = np.concatenate(ids), np.concatenate(rows)
                full = held - held % block_rows
                for at in range(0, full, block_rows):
                    yield block(all_ids[at:at + block_rows], all_rows[at:at + block_rows])
                ids, rows, held = [all_ids[full:]], [all_rows[full:]], held - full
        if held:
            yield block(np.concatenate(ids), np.concatenate(rows))
    return run


def _matrix(raw: bytes, n: int, width: int) -> np.ndarray:
    """Rows of a block as 64-bit integers."""
    return np.frombuffer(raw, dtype=f"<i{width}").reshape(n, -1).astype(np.int64)


class SortedLists:
    """The sorted lists of one block, and what a query has of them when they are read to a depth: a matrix (dimensions, from the high
    end and then from the low end, by candidates) whose product with the query's positive and negative components gives bounds."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        most = float(np.abs(x).max(initial=0))
        self.peak = most * max(1, x.shape[1])
        self.sorted = np.sort(np.ascontiguousarray(x.T.astype(np.float32 if most < 2**24 else np.int64)), axis=1)  # ascending
        self._made: dict[tuple, np.ndarray] = {}

    def _once(self, key: tuple, make: Callable[[], np.ndarray]) -> np.ndarray:
        if key not in self._made:
            self._made[key] = make()
        return self._made[key]

    def rows(self, kind: type) -> np.ndarray:
        return self._once(("rows", kind), lambda: self.x.astype(kind))

    def whole(self, kind: type) -> np.ndarray:
        return self._once(("whole", kind), lambda: np.ascontiguousarray(self.rows(kind).T))

    def ends(self, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """The last entry read of each list, from the high end and from the low end."""
        return self.sorted[:, len(self.x) - depth, None].astype(kind), self.sorted[:, depth - 1, None].astype(kind)

    def upper(self, depth: int, kind: type) -> np.ndarray:
        """Entries read, or the last one read."""
        x, (high, low) = self.whole(kind), self.ends(depth, kind)
        return self._once(("upper", depth, kind), lambda: np.concatenate([np.maximum(x, high), np.minimum(x, low)]))

    def lower(self, depth: int, kind: type) -> np.ndarray:
        """Entries read, or the least contribution of the list."""
        x, (high, low), (top, bottom) = self.whole(kind), self.ends(depth, kind), self.ends(1, kind)
        return self._once(("lower", depth, kind), lambda: np.concatenate([np.where(x >= high, x, bottom), np.where(x <= low, x, top)]))


_PROBE = 16  # queries of a block that try a round first


def exact_kind(lists: SortedLists, queries: np.ndarray) -> type:
    """Numbers in which products of a block and queries and their sums stay exact integers."""
    peak = lists.peak * float(np.abs(queries).max(initial=0))
    return np.float32 if peak < 2**22 else np.float64 if peak < 2**52 else np.int64


def qualified(lists: SortedLists, queries: np.ndarray, k: int, skip: tuple[np.ndarray, np.ndarray], floor: np.ndarray,
              first_depth: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that can be among the query's ``k`` best, ties included; all of them are among those returned.
    ``skip``: (queries, candidates) that are not compared; ``floor``: by query a score that ``k`` other candidates reach, or -inf."""
    n = len(lists.x)
    kind = np.float32 if exact_kind(lists, queries) is np.float32 else np.float64
    signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(kind)
    floor = floor.astype(kind)
    enough = n - np.bincount(skip[0], minlength=len(queries)) >= k
    few = max(4 * k, n // 32)

    def left(some: np.ndarray, depth: int) -> np.ndarray:
        """Flat places (query of ``some``, candidate) of what is left after a round."""
        place = np.full(len(queries), -1)
        place[some] = np.arange(len(some))
        mine = place[skip[0]] >= 0
        out = (place[skip[0][mine]], skip[1][mine])
        upper = queries[some].astype(kind) @ lists.whole(kind) if depth == n else signed[some] @ lists.upper(depth, kind)
        upper[out] = -np.inf
        mask = upper >= floor[some][:, None]
        mask[out] = False
        at = true_cells(mask)
        many = np.flatnonzero((np.bincount(at // n, minlength=len(some)) > few) & enough[some])
        if len(many):
            lower = upper[many]
            if depth < n:
                lower = signed[some[many]] @ lists.lower(depth, kind)
                place = np.full(len(some), -1)
                place[many] = np.arange(len(many))
                mine = place[out[0]] >= 0
                lower[place[out[0][mine]], out[1][mine]] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
            mask[many] &= upper[many] >= kth[:, None]
            at = true_cells(mask)
        return at

    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_queries = np.arange(len(queries))
    depth = min(first_depth, n)
    while len(open_queries) and n:
        trying = open_queries
        if depth < n:
            unread = (signed @ np.concatenate(lists.ends(depth, kind)))[open_queries, 0]
            trying = open_queries[(floor[open_queries] > unread) | (floor[open_queries] == -np.inf)]
            if len(trying) > 2 * _PROBE:
                probe = trying[:: len(trying) // _PROBE][:_PROBE]
                if len(left(probe, depth)) > len(probe) * few:
                    trying = trying[:0]
        if len(trying):
            at = left(trying, depth)
            stop = (np.bincount(at // n, minlength=len(trying)) <= few) | (depth == n)
            at = at[stop[at // n]]
            found.append((trying[at // n], at % n))
            open_queries = np.setdiff1d(open_queries, trying[stop], assume_unique=True)
        depth = min(2 * depth, n)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def nra(lists: SortedLists, queries: np.ndarray, k: int, skip: np.ndarray,
        first_depth: int = 256) -> list[np.ndarray]:
    """Per query, the candidates (rows) that can be among its k best; contains all of them, ties included.
    ``skip`` marks (candidate, query) pairs that are not compared."""
    rows, of = np.nonzero(skip)
    q, row = qualified(lists, queries, k, (of, rows), np.full(len(queries), -np.inf), first_depth)
    return [np.sort(row[q == i]) for i in range(len(queries))]


class Asked:
    """A block of queries with the best of the candidates met so far (by query, score and id)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int) -> None:
        self.ids, self.x, self.k = ids, x, k
        self.floor = np.full(len(ids), -np.inf)
        self.best = (np.zeros(0, np.int64),) * 3  # query, candidate's id, score

    def meet(self, lists: SortedLists, ids: np.ndarray, order: np.ndarray) -> None:
        """``order`` sorts ``ids``."""
        ranked = ids[order]
        start, end = np.searchsorted(ranked, self.ids), np.searchsorted(ranked, self.ids, side="right")
        own = np.flatnonzero(end > start)
        same = [order[start[i]:end[i]] for i in own]
        skip = (np.repeat(own, [len(x) for x in same]), np.concatenate([order[:0], *same]))
        q, row = qualified(lists, self.x, self.k, skip, self.floor)
        kind = exact_kind(lists, self.x)
        scores = np.concatenate([np.zeros(0, np.int64), *(  # final scores of what can still qualify; bounded memory
            np.einsum("ij,ij->i", lists.rows(kind)[row[at:at + (1 << 14)]], self.x[q[at:at + (1 << 14)]].astype(kind)).astype(np.int64)
            for at in range(0, len(q), 1 << 14))])
        good = scores >= self.floor[q]
        q, row, scores = q[good], row[good], scores[good]
        if not len(q):
            return
        met = np.zeros(len(self.ids), dtype=bool)
        met[q] = True
        old = met[self.best[0]]
        q, vec, scores = (np.concatenate([a[old], b]) for a, b in zip(self.best, (q, ids[row], scores)))
        first = np.lexsort((vec, -scores, q))
        q, vec, scores = q[first], vec[first], scores[first]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        full = rank == self.k - 1
        self.floor[q[full]] = scores[full]
        top = rank < self.k
        self.best = tuple(np.concatenate([a[~old], b[top]]) for a, b in zip(self.best, (q, vec, scores)))


def _meet(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (job, kind, number, ids, x, width), by job the blocks of queries (kind 0) before those of candidates -> best k by query."""
    job = None
    asked: dict[int, Asked] = {}

    def best() -> Iterator[pa.RecordBatch]:
        for number, some in asked.items():
            q, vec, scores = some.best
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(q), number, dtype=np.int64)), pa.array(q.astype(np.int32)), pa.array(some.ids[q]),
                 pa.array(vec), pa.array(scores)], names=["q_block", "q_row", "query_id", "vec_id", "score"])

    for batch in batches:
        for row in range(batch.num_rows):
            if job != (now := batch.column(0)[row].as_py()):
                yield from best()
                job, asked = now, {}
            ids = batch.column(3)[row].values.to_numpy()
            x = _matrix(batch.column(4)[row].as_py(), len(ids), batch.column(5)[row].as_py())
            if batch.column(1)[row].as_py() == 0:
                asked[batch.column(2)[row].as_py()] = Asked(ids, x, k)
                continue
            lists, order = SortedLists(x), np.argsort(ids, kind="stable")
            for some in asked.values():
                some.meet(lists, ids, order)
    yield from best()


_TILE = 256  # blocks of queries in a task at most


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """The ``k`` highest integer inner products of each query with all ``vectors`` but those of its own id.

    ``query_id, rank, vec_id, score``: rank from 1, ties to the smaller vec_id, fewer than ``k`` rows if there are fewer
    candidates.  Components become floor(factor * x).  Rows with null or non-finite components (or a null
    id) take part neither as query nor as candidate; zero vectors do.  Repeated candidate rows count each;
    equal query rows are asked once.  Only vectors of the commonest length among the candidates (at a tie, the smaller one) take part."""
    spark = vectors.sparkSession
    with small_batches(spark):
        length = commonest_length(plain_vectors(vectors, id_col, vector_col)[0].mapInArrow(_lengths, "length int"), F.col("length"))
    shape = "first long, ids array<long>, x binary, width int"
    blocks = stage(quantized(vectors, factor, id_col, vector_col, length).mapInArrow(_blocks(block_rows), shape)
                   .withColumn("block", F.monotonically_increasing_id()), "topk-blocks")
    asked = stage(quantized(queries, factor, id_col, vector_col, length).dropDuplicates(["id", "v"]).mapInArrow(_blocks(query_rows), shape)
                  .withColumn("block", F.monotonically_increasing_id()), "topk-queries")
    # the query set against all rows: tiles of query blocks, each of which all stripes of candidate blocks meet
    n_blocks, n_asked, tasks = blocks.count(), asked.count(), 3 * spark.sparkContext.defaultParallelism
    per_tile = max(1, min(_TILE, -(-n_asked // tasks)))
    tiles = max(1, -(-n_asked // per_tile))
    stripes = max(1, min(n_blocks, -(-tasks // tiles)))
    held = _numbered(asked).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).select(
        (F.floor(F.col("block") / per_tile) * stripes + F.col("stripe")).cast("long").alias("job"), F.lit(0).alias("kind"),
        F.col("block").cast("long").alias("block"), "ids", "x", "width")
    passing = _numbered(blocks).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        (F.col("tile") * stripes + F.col("block") % stripes).cast("long").alias("job"), F.lit(1).alias("kind"),
        F.col("block").cast("long").alias("block"), "ids", "x", "width")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _meet(batches, k)

    # twice as many ranges as jobs: each job has its own, where hashes would put some jobs together
    found = stage(held.unionAll(passing).repartitionByRange(2 * tiles * stripes, "job").sortWithinPartitions("job", "kind", "block")
                  .mapInArrow(giving_back(compare), "q_block long, q_row int, query_id long, vec_id long, score long"), "topk-found")
    order = Window.partitionBy("q_block", "q_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks numbered from 0: their order among ids of blocks (one small row each)."""
    numbers = blocks.select("block").withColumn(
        "number", F.row_number().over(Window.orderBy("block")) - 1)
    return blocks.join(numbers, "block").select(F.col("number").alias("block"), "ids", "x", "width")
