"""Best-fit-decreasing packing of token sequences, exact over the whole corpus.

Best fit decreasing only looks at lengths, and there are at most ``capacity`` of them.  So the
corpus is reduced to a histogram of lengths; the plan is made from it with open bins of equal
remaining capacity held as ranges of bins, and a segment tree over remaining capacities that
finds the tightest bin for a length in logarithmic time.  It places the bins exactly as a
pass over single documents in descending length would (the tightest open bin takes further
documents of the same length until it is full, because then it stays the tightest).  Each
piece then looks its place up by (length, rank among pieces of this length); ranks come from
per-part counts, so no task holds a hot length.

Only the histogram and the plan pass through the driver: both are bounded by ``capacity``.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sluice.llm.staging import stage
from sluice.llm.textcols import slices
from sluice.llm.wordbpe import WordBpe


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which have open bins."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << (capacity + 1 - 1).bit_length()
        self.some = bytearray(2 * self.leaves)

    def set(self, capacity: int, some: bool) -> None:
        at = capacity + self.leaves
        self.some[at] = some
        while at > 1:
            at >>= 1
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest remaining capacity >= size that has an open bin."""
        at = size + self.leaves
        if self.some[at]:
            return size
        while at > 1:  # climb until a right sibling has something, then go down leftmost
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


class Run(NamedTuple):
    """Pieces ``rank .. rank + count - 1`` of one size, ``per_bin`` to a bin from ``bin`` on,
    the first of each bin at ``offset``."""
    size: int
    rank: int
    count: int
    bin: int
    per_bin: int
    offset: int


def best_fit_plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Best-fit-decreasing placement of ``histogram[size]`` pieces of each size; the runs and
    the number of bins."""
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining -> (first, n)
    runs: list[Run] = []
    bins = 0

    def add(remaining: int, first: int, n: int) -> None:
        if remaining and n:
            open_bins[remaining].append((first, n))
            tree.set(remaining, True)

    for size in sorted(histogram, reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} does not fit a bin of {capacity}")
        rank, left = 0, histogram[size]
        while left:
            remaining = tree.tightest(size)
            if remaining is None:
                remaining = capacity
                n = -(-left // (capacity // size))
                first, bins = bins, bins + n
            else:
                first, n = open_bins[remaining].pop()
                if not open_bins[remaining]:
                    tree.set(remaining, False)
            fit = remaining // size
            full = min(n, left // fit)
            for used, per_bin in ((full, fit), (1, left - full * fit if full < n else 0)):
                if used and per_bin:
                    runs.append(Run(size, rank, used * per_bin, first, per_bin,
                                    capacity - remaining))
                    rank, left = rank + used * per_bin, left - used * per_bin
                    add(remaining - per_bin * size, first, used)
                    first, n = first + used, n - used
            add(remaining, first, n)
    return runs, bins


_RANK_BITS = 44


def pack(items: DataFrame, size: str, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` (bigint, from 0) and ``offset`` (bigint) to ``items``: places of best fit
    decreasing in sequences of ``capacity``.  ``size`` must be 1..capacity in every row.
    Ties in size are packed in the staged row order.  An empty table gives an empty result."""
    part, row = "_pack_part", "_pack_row"
    items = stage(items.withColumn(part, F.spark_partition_id())
                  .withColumn(row, F.monotonically_increasing_id()), "pack-items")
    counts = stage(items.groupBy(F.col(size).cast("long").alias("size"), F.col(part).alias("part"))
                   .agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n"))
                 .collect()}  # at most `capacity` rows
    runs, _ = best_fit_plan(histogram, capacity)
    plan = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)
    keys = (plan[:, 0] << _RANK_BITS) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(i).to_numpy() for i in (1, 2))
            at = np.searchsorted(keys, (sizes << _RANK_BITS) + ranks, side="right") - 1
            run = plan[at]
            step = ranks - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(run[:, 3] + step // run[:, 4]),
                 pa.array(run[:, 5] + step % run[:, 4] * sizes)],
                names=[row, "sequence_id", "offset"])

    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part", "size").orderBy(row)
    ranked = items.select(F.col(size).cast("long").alias("size"), F.col(part).alias("part"), row) \
        .withColumn("rn", F.row_number().over(within) - 1).join(starts, ["size", "part"])
    placed = ranked.select(row, "size", (F.col("start") + F.col("rn")).cast("long").alias("rank")) \
        .mapInArrow(place, f"{row} long, sequence_id long, offset long")
    return items.join(placed, row).drop(part, row)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Token pieces of ``documents``-like rows: ids of the tokenizer file (no special tokens),
    then ``end_id``; more than ``capacity`` ids are cut into pieces of ``capacity``.

    ``doc_id, piece, start, length, ids_crc32, ids``; ``ids`` holds little-endian unsigned 32-bit
    integers and ``ids_crc32`` is their unsigned crc32.  A null text counts as empty: one piece of
    ``end_id`` alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe.load(tokenizer)
        for whole in batches:
            for batch in slices(whole, 1):
                ids, ends = encoder.encode_column(batch.column(1))
                n_docs = len(ends) - 1
                ids = np.insert(ids, ends[1:], end_id).astype("<u4")
                ends = ends + np.arange(n_docs + 1)
                sizes = np.diff(ends)
                n_pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(n_docs), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                # pieces lie one after another: Arrow gets the buffer (pa.array never releases memoryviews or what they show)
                at = 4 * np.append(ends[doc] + start, ends[-1])
                raw = memoryview(ids.view(np.uint8))
                crcs = [zlib.crc32(raw[a:b]) for a, b in pairwise(at.tolist())]
                cut = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(at), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crcs, pa.int64()), cut.cast(pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096,
                   end_id: int = 1) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as best fit decreasing
    finds: the columns of ``pieces`` plus ``sequence_id`` and ``offset``.  Offsets are gapless from 0
    in every sequence.  Repeated rows are packed as often as they occur; a null doc_id stays null;
    extra columns are ignored."""
    return pack(pieces(docs, tokenizer, capacity, end_id), "length", capacity)
