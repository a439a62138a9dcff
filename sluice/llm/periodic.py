"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words with smallest period q (words q apart are equal) of length at least
``max(6, 4 * q)``.  Every text is searched whole, and texts of one slice together: their words become codes
in one long sequence with a code of its own between texts, so no run crosses it.

* **Highly periodic regions** (q <= ``SMALL``) are found directly, as stretches of equality at lag q.
* **Larger periods** come from positions chosen at the dyadic scales tau = 8, 16, ...: every window of tau words
  has a hash, and position i is in the synchronising set where the least hash among the windows i .. i + tau
  stands at either end; windows inside a highly periodic region take no part.  The choice depends on the
  2 * tau words from i on (the context) only, and any tau neighbouring positions hold one unless the region is
  highly periodic.  So in a run with tau <= q < 2 * tau some chosen i has an equal context at i + q, and it is the
  next equal one: a nearer one would give the run a smaller period.  Neighbouring equal contexts therefore propose
  all periods that the direct search omits, and nearly nothing in plain prose.
* A proposed period is checked word by word, to both sides of its position, and kept if it is long enough
  and no smaller period gives the same stretch.

Contexts are compared by 64-bit hashes (two different ones in a slice agree with a probability of about 1e-8; every
run found is checked).  Work is one pass without a shuffle; a slice holds ``SLICE_BYTES`` of text, or one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sluice.llm.textcols import slices, texts_of

SMALL = 8
LEAST_LENGTH, LEAST_EXPONENT = 6, 4


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, equal, False]))
    return edges[::2], edges[1::2]


def _window_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of x[i : i + size] for every i with a whole window."""
    blocks = -(-len(x) // size)
    padded = np.full(blocks * size, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - size + 1
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def _extend(codes: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch with period q around ``at`` (words at and at + q are equal): its start and end."""
    size = 4 * q
    low, high = at, at + 1
    while high + q < len(codes):
        differ = codes[high:high + size][:len(codes) - high - q] != codes[high + q:high + q + size]
        if differ.any():
            high += int(differ.argmax())
            break
        high += len(differ)
        size *= 2
    size = 4 * q
    while low > 0:
        first = max(0, low - size)
        differ = codes[first:low] != codes[first + q:low + q]
        if differ.any():
            low -= int(differ[::-1].argmax())
            break
        low, size = first, size * 2
    return low, high + q


_Regions = list[tuple[int, np.ndarray, np.ndarray]]  # period, starts, ends


def _small_periods(codes: np.ndarray) -> tuple[list[np.ndarray], _Regions]:
    """Runs (start, end, period) with a period up to ``SMALL``; and for each such period the stretches of at least three
    periods and ``SMALL`` words, the highly periodic regions."""
    runs, regions = [], []
    for q in range(1, min(SMALL, len(codes) - 1) + 1):
        start, end = _stretches(codes[q:] == codes[:-q])
        end = end + q
        region = end - start >= max(SMALL, 3 * q)
        regions.append((q, start[region], end[region]))
        long = end - start >= max(LEAST_LENGTH, LEAST_EXPONENT * q)
        runs.append(np.stack([start[long], end[long], np.full(long.sum(), q)], axis=1))
    return runs, regions


def _periodic_windows(n: int, tau: int, regions: _Regions) -> np.ndarray:
    """Which of n positions start a window of ``tau`` words with a period of at most a third of it (and ``SMALL``)."""
    delta = np.zeros(n + 1, dtype=np.int32)
    for q, start, end in regions:
        if 3 * q <= tau:
            inside = end - start >= tau
            np.add.at(delta, start[inside], 1)
            np.add.at(delta, end[inside] - tau + 1, -1)
    return np.cumsum(delta[:-1]) > 0


def synchronising_set(ids: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """Positions chosen at a scale, given the hash of every window of ``tau`` words and which windows take no part."""
    top = np.iinfo(np.uint64).max
    keys = np.where(periodic, top, np.minimum(ids, top - np.uint64(1)))
    if len(keys) <= tau:
        return np.empty(0, dtype=np.int64)
    least = _window_min(keys, tau + 1)
    return np.flatnonzero((least < top) & ((least == keys[:len(least)]) | (least == keys[tau:])))


def _proposals(codes: np.ndarray, lengths: np.ndarray, regions: _Regions) -> Iterator[tuple[int, int]]:
    """(position, period) pairs from neighbouring equal contexts, scale by scale.  Texts too short for a scale are left
    out of it; a window that reaches beyond its text holds the code after it, so it equals no other."""
    ids, width = _mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    place, owner = np.arange(len(codes)), np.repeat(np.arange(len(lengths)), lengths + 1)
    while len(lengths) and LEAST_EXPONENT * max(width, SMALL) <= lengths.max():
        long = lengths[owner] >= LEAST_EXPONENT * max(width, SMALL)
        if 2 * long.sum() < len(long):
            ids, place, owner = ids[long[:len(ids)]], place[long], owner[long]
        if width >= SMALL:
            periodic = _periodic_windows(len(codes), width, regions)[place[:len(ids)]]
            at = synchronising_set(ids, width, periodic)
            context = _mix(ids[at] + np.uint64(3) * _mix(ids[at + width]))
            order = np.argsort(context, kind="stable")
            same = context[order[1:]] == context[order[:-1]]
            here, there = place[at[order[:-1][same]]], place[at[order[1:][same]]]
            near = (there - here > SMALL) & (there - here >= width) & (there - here < 2 * width)
            yield from zip(here[near].tolist(), (there - here)[near].tolist())
        if len(ids) <= width:
            return
        ids = _mix(ids[:-width] + np.uint64(3) * _mix(ids[width:]))
        width *= 2


def find_runs(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period, of a sequence of texts of the given lengths, each
    followed by a code that occurs nowhere else."""
    runs, regions = _small_periods(codes)
    checked: dict[int, tuple[int, int]] = {}  # by period: the stretch found last
    for at, q in sorted(_proposals(codes, lengths, regions)):
        low, high = checked.get(q, (0, 0))
        if low <= at and at + q < high or codes[at] != codes[at + q]:
            continue
        checked[q] = low, high = _extend(codes, at, q)
        if high - low >= LEAST_EXPONENT * q:
            runs.append(np.array([[low, high, q]]))
    every = np.concatenate([np.empty((0, 3), dtype=np.int64), *runs]).astype(np.int64)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    multiple = np.r_[False, (every[1:, :2] == every[:-1, :2]).all(axis=1)][:len(every)]
    every = every[~multiple]  # a multiple of the smallest period gives the same stretch
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _word_lists(texts: pa.Array) -> pa.ListArray:
    """Words between blanks and the control characters 9 to 13."""
    words = pc.ascii_split_whitespace(texts)
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    keep = np.asarray(pc.not_equal(flat, "").to_numpy(zero_copy_only=False))
    before = np.r_[0, np.cumsum(keep)]
    at = before[offsets - offsets[0]]
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat.filter(pa.array(keep)))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed)`` of every row of ``docs``.

    ``runs``: array of (start, length, period) by start, then period; the single columns hold the run of the
    greatest length / period (ties: smallest start, then period), null without one.  ``collapsed``: the words
    outside the repetitions (of each run all but its first period go), joined by one blank.  A null text counts
    as empty and has no runs.  Rows with equal or null ids are rows of their own; other columns, whatever their names, are
    not read; an empty table gives an empty result.  ``repeat_some``: repeat parts of some texts first (``_repeat_part``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                yield _slice_runs(batch.column(0), texts_of(batch.column(1)))
    ids = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(run, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, {_RUNS}")


_RUNS = ("n_runs long, start long, length long, period long, exponent_milli long, "
         "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
_ITEM = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _slice_runs(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    lists = _word_lists(texts)
    coded = lists.flatten().dictionary_encode()
    ends = lists.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(ends)
    starts = ends[:-1] + np.arange(len(lengths))  # one separator before each later text
    codes = np.empty(int(ends[-1]) + len(lengths), dtype=np.int64)
    between = np.zeros(len(codes), dtype=bool)
    between[starts + lengths] = True
    codes[between] = len(coded.dictionary) + np.arange(len(lengths))
    codes[~between] = coded.indices.to_numpy(zero_copy_only=False)

    found = find_runs(codes, lengths)
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    start, length, period = found[:, 0] - starts[owner], found[:, 1] - found[:, 0], found[:, 2]
    counts = np.bincount(owner, minlength=len(lengths))
    cuts = np.r_[0, np.cumsum(counts)]
    # equal fractions are equal doubles, and different ones differ, as words of a text stay below 2 ** 26
    by_rank = np.lexsort((period, start, -(length / period), owner))
    some = counts > 0
    best = by_rank[cuts[:-1][some]]

    def column(values: np.ndarray) -> pa.Array:
        out = np.zeros(len(lengths), dtype=np.int64)
        out[some] = values
        return pa.array(out, mask=~some)

    gone = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(gone, found[:, 0] + period, 1)
    np.add.at(gone, found[:, 1], -1)
    keep = (np.cumsum(gone[:-1]) == 0) & ~between
    sizes = np.r_[0, np.cumsum(keep)]
    left = pa.ListArray.from_arrays(pa.array(sizes[np.r_[starts, len(codes)]].astype(np.int32)),
                                    coded.dictionary.take(pa.array(codes[keep])))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(counts.astype(np.int64)), column(start[best]), column(length[best]), column(period[best]),
         column(1000 * length[best] // period[best]),
         pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(
             [pa.array(x.astype(np.int64)) for x in (start, length, period)], fields=list(_ITEM))),
         pc.binary_join(left, " ")],
        names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])
