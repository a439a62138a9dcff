"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into ``s`` segments, ``s`` being the smallest even split for
which ``max_bits`` differing bits leave one segment with at most one of them (2 segments for
3 bits).  Every segment is indexed under its one-wildcard variants (one bit position
deleted); two fingerprints whose segment differs in at most one bit share a variant, so an
equality grouping by (segment, position, rest) finds every link, and the bit distance of
the whole fingerprints verifies it.

Buckets are read as sorted runs with bounded memory.  A run longer than ``bucket_rows`` is
not compared at once: its members are indexed again under the one-wildcard variants of the
smaller segments of the bits that are still free, and so on.  After the last refinement at
most 11 bits are free, so a bucket of distinct fingerprints cannot exceed 2048 rows.  Each
bucket yields a spanning forest of its links, never all its pairs.

Definitions: text lower-cased A-Z only; words are ``[^\\x20\\x09-\\x0D]+``; shingles of three
words with repeats, joined by one space (fewer words: the whole sequence); no words or a
null text: fingerprint zero, which links like any other.  A bit is set if set in over half of
the shingles' unsigned XXH64 (UTF-8, seed 42).  Ties (exactly half) give 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import Forest, connected_components
from sluice.llm.staging import fresh_name, stage
from sluice.llm.textcols import slices

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_SLICE = 1 << 16  # shingles per counting step: memory stays bounded on very long texts


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        return _hash(b" ".join(words))
    n = len(words) - shingle + 1
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SLICE):
        part = words[at:min(n, at + _SLICE) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        h = np.fromiter(map(_hash, grams), dtype="<u8", count=len(part) - shingle + 1)
        votes += _bit_counts(h)
    bits = (votes * 2 > n).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit 0, 1, ... 63 set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, row: str | None = None) -> DataFrame:
    """``(doc_id, fp)`` of every row, and ``row``: a column to carry along (null without one).  ``fp`` holds the
    fingerprint's bits as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                fp = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), batch.column(2)],
                                                 names=["doc_id", "fp", "row"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (F.col(row) if row else F.lit(None)).cast("long").alias("row")) \
        .mapInArrow(run, "doc_id long, fp long, row long")


def segments(free: int, max_bits: int) -> list[list[int]]:
    """Cut the free bit positions into the fewest even segments of which one must differ by at
    most one bit when the whole differs by at most ``max_bits``."""
    bits = [b for b in range(64) if free >> b & 1]
    parts = min(max_bits // 2 + 1, len(bits))
    return [bits[i * len(bits) // parts:(i + 1) * len(bits) // parts] for i in range(parts)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs share a bucket; a collision only adds a candidate."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_INDEX = "bucket long, fp long, node long, free long"


def _index(batch: pa.RecordBatch, max_bits: int) -> Iterator[pa.RecordBatch]:
    """One row per one-wildcard segment variant of each row's free bits."""
    bucket, fp, node, free = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64)
                              for i in range(4))
    for mask in np.unique(free).tolist():
        own = free == np.uint64(mask)
        b, f, n = bucket[own], fp[own], node[own]
        for bits in segments(mask, max_bits):
            seg_mask = sum(1 << x for x in bits)
            rest = np.full(len(f), mask & ~seg_mask, dtype=np.uint64)
            for pos in bits:
                seg = f & np.uint64(seg_mask & ~(1 << pos))
                key = _mix(_mix(b + np.uint64(pos + 1)) ^ seg)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (key, f, n, rest)],
                    names=["bucket", "fp", "node", "free"])


_FOUND = "hot boolean, bucket long, fp long, node long, free long"
_LAST_BITS = 11


def _scan(batches: Iterator[pa.RecordBatch], max_bits: int,
          bucket_rows: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket -> verified links (hot = false: bucket holds the other node)
    and the rows of buckets too long to compare (hot = true), passed on as they stream by."""
    held: list[np.ndarray] = []  # rows of the run that may go on in the next batch
    hot_key = None

    def emit(links: list[tuple[int, int]], hot: np.ndarray) -> pa.RecordBatch:
        a = np.array([x for x, _ in links], dtype=np.int64)
        b = np.array([y for _, y in links], dtype=np.int64)
        nothing = np.zeros(len(a), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.r_[np.zeros(len(a), bool), np.ones(hot.shape[1], bool)]),
             pa.array(np.r_[b, hot[0]]), pa.array(np.r_[nothing, hot[1]]),
             pa.array(np.r_[a, hot[2]]), pa.array(np.r_[nothing, hot[3]])],
            names=["hot", "bucket", "fp", "node", "free"])

    def links_of(rows: np.ndarray) -> list[tuple[int, int]]:
        key, fp, node = rows[0], rows[1].view(np.uint64), rows[2]
        forest, lag = Forest(), 1
        at = np.flatnonzero(key[1:] == key[:-1])
        while len(at):
            near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
            for x, y in np.unique(np.stack([node[near], node[near + lag]], 1), axis=0).tolist():
                forest.link(x, y)
            lag += 1
            at = at[at + lag < len(key)]
            at = at[key[at] == key[at + lag]]
        return list(zip(*forest.stars()))

    empty = np.empty((4, 0), dtype=np.int64)
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        if not rows.shape[1]:
            continue
        hot = [empty]
        if hot_key is not None:  # the rest of a run already found too long
            n = int(np.searchsorted(rows[0] != hot_key, True)) if (rows[0] != hot_key).any() \
                else rows.shape[1]
            hot.append(rows[:, :n])
            rows = rows[:, n:]
            if not rows.shape[1]:
                yield emit([], np.concatenate(hot, axis=1))
                continue
            hot_key = None
        rows = np.concatenate([*held, rows], axis=1)
        starts = np.r_[0, np.flatnonzero(np.diff(rows[0])) + 1]
        sizes = np.diff(np.r_[starts, rows.shape[1]])
        small_bits = np.bitwise_count(rows[3][starts].view(np.uint64)) <= _LAST_BITS
        long = (sizes > bucket_rows) & ~small_bits
        if long[-1]:
            hot_key = rows[0][-1]
            held = []
        else:
            held = [rows[:, starts[-1]:]]
        too_long = np.repeat(long, sizes)
        hot.append(rows[:, too_long])
        done = ~too_long
        done[starts[-1]:] = False
        yield emit(links_of(rows[:, done]), np.concatenate(hot, axis=1))
    if held:
        yield emit(links_of(held[0]), empty)


def near_links(reps: DataFrame, max_bits: int = 3, bucket_rows: int = 512) -> DataFrame:
    """Links between distinct fingerprints of ``(fp, node)`` that suffice to connect all pairs
    within ``max_bits`` bits: ``(u, v)`` by node."""
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be 0 to 15")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _index(batch, max_bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, max_bits, bucket_rows)

    rows = reps.select(F.lit(0).cast("long").alias("bucket"), "fp", "node",
                       F.lit(-1).cast("long").alias("free"))
    links = None
    while True:
        found = rows.mapInArrow(index, _INDEX).repartition("bucket") \
            .sortWithinPartitions("bucket").mapInArrow(scan, _FOUND)
        found = stage(found, "simhash-buckets")
        part = found.where("not hot").select(F.col("node").alias("u"), F.col("bucket").alias("v"))
        links = part if links is None else links.unionAll(part)
        rows = found.where("hot").drop("hot")
        if rows.isEmpty():
            return links


def _classes(fps: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """``(fp, component)`` for the fingerprints of ``(doc_id, fp)``: the class's smallest node."""
    # a fingerprint's node is its smallest id; one without any id gets a number above all ids
    reps = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).select(
        "fp", F.coalesce("rep", F.lit(1 << 62) + F.shiftrightunsigned("fp", 2)).alias("node")),
        "simhash-reps")
    comps = connected_components(near_links(reps, max_bits, bucket_rows))
    return stage(reps.join(comps, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component")), "simhash-named")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                   bucket_rows: int = 512) -> DataFrame:
    """Near-duplicate classes of ``documents``-like rows (``doc_id``, ``text``).

    Returns one row per input row: ``doc_id``, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``, the smallest doc_id reachable over links of at most ``max_bits``
    differing bits.  A null doc_id is kept as a row and takes part in links; a component
    whose ids are all null has a null id.  Extra columns are ignored; repeated rows give
    repeated result rows; an empty table gives an empty result.  Ids must lie below 2**62.
    """
    fps = stage(fingerprints(docs, shingle), "simhash")
    return fps.join(_classes(fps, max_bits, bucket_rows), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component") < F.lit(1 << 62), F.col("component")).alias("component_id"))


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_rows: int = 512) -> DataFrame:
    """One row of each class of ``simhash_groups``, with all its columns: the one with the smallest doc_id
    (null ids last; among equal ids, repeated rows included, the first in the staged row order)."""
    row = fresh_name(docs, "_row")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows", compression="zstd")
    fps = stage(fingerprints(rows, shingle, row), "simhash")
    named = fps.join(_classes(fps, max_bits, bucket_rows), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    winners = stage(named.groupBy("component").agg(first.alias("first")).select(F.col("first.row").alias(row)),
                    "simhash-winners")
    return rows.join(winners, row, "left_semi").drop(row)
