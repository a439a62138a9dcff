"""Exact dedup of texts by two-pass Bloom filtering.

Texts are equal when they are the same after lower-casing A-Z only.  Every row's normalised text gets its
SHA-256 digest, staged next to its id (some 50 bytes a row, whatever the text).

* Pass 1 builds a Bloom filter that counts to two: each digest owns ``PROBES`` cells, and a cell remembers
  whether one or more rows hit it.  Tasks count into their own bitmaps, which are merged segment by
  segment; only the "hit twice" bits are kept.
* Pass 2 probes it.  A digest with a cell that was hit once occurs once: such a row passes straight
  through.  The others possibly repeat, and only they are shuffled and grouped by their digest.

The filter has ``CELLS_PER_ROW`` cells a row, rounded up to a power of two, and at most ``2 ** max_bits``
cells (1 bit each: 64 MB by default, for some 33 million rows).  That bound is what is collected and
broadcast.  A corpus beyond it fills the filter: more digests (never texts) are shuffled, and the result stays exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from sluice.llm.staging import fresh_name, stage
from sluice.llm.textcols import slices

PROBES = 4
CELLS_PER_ROW = 16
LEAST_BITS, MAX_BITS = 16, 29
SEGMENT_BITS = 15  # cells of one merged piece of the filter: 4 KB of bits
#: A group with at least one row in HOT_SHARE of all counts as hot; there are at most HOT_SHARE such groups.
HOT_SHARE = 1000


def digest(text: bytes | None) -> bytes:
    """SHA-256 of the normalised text (``bytes.lower`` changes A-Z only); null is the empty text."""
    return hashlib.sha256((text or b"").lower()).digest()


def _digests(batch: pa.RecordBatch, text: int) -> list[bytes]:
    return [digest(t) for t in batch.column(text).cast(pa.binary()).to_pylist()]


def _cells(digests: list[bytes], bits: int) -> np.ndarray:
    """(rows, PROBES) cell numbers; an odd step keeps a row's cells apart."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((words[:, :1] + steps * (words[:, 1:2] | np.uint64(1))) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _bit(cells: np.ndarray) -> np.ndarray:
    return (1 << (cells & 7)).astype(np.uint8)


_SEGMENTS = "segment long, once binary, twice binary"


def _count_cells(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Pass 1 of a task: its bitmaps of cells hit at all and hit more than once, in segments."""
    once, twice = (np.zeros(1 << (bits - 3), dtype=np.uint8) for _ in range(2))
    for batch in batches:
        cells, hits = np.unique(_cells(batch.column(0).to_pylist(), bits), return_counts=True)
        again = cells[(hits > 1) | (once[cells >> 3] & _bit(cells) > 0)]
        np.bitwise_or.at(twice, again >> 3, _bit(again))
        np.bitwise_or.at(once, cells >> 3, _bit(cells))
    once, twice = (a.reshape(-1, 1 << (SEGMENT_BITS - 3)) for a in (once, twice))
    used = np.flatnonzero(once.any(axis=1))
    for part in np.array_split(used, len(used) // 64 + 1):
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), *(pa.array([a[s].tobytes() for s in part], pa.binary()) for a in (once, twice))],
            names=["segment", "once", "twice"])


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of all tasks, sorted by number -> one row per segment with its "hit twice" bits."""
    at, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([twice.tobytes()], pa.binary())],
                                          names=["segment", "twice"])
    for batch in batches:
        for segment, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
            if segment == at:
                twice |= b | (once & a)
                once |= a
                continue
            if at is not None:
                yield done()
            at, once, twice = segment, a.copy(), b.copy()
    if at is not None:
        yield done()


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Binary logarithm of the number of cells for so many rows."""
    return min(max_bits, max(LEAST_BITS, (rows * CELLS_PER_ROW - 1).bit_length()))


def repeat_filter(digests: DataFrame, bits: int) -> bytes:
    """The "hit twice" bits over all rows of ``digests`` (column ``digest``); ``2 ** (bits - 3)`` bytes."""
    counted = digests.select("digest").mapInArrow(lambda batches: _count_cells(batches, bits), _SEGMENTS)
    merged = counted.repartition("segment").sortWithinPartitions("segment") \
        .mapInArrow(_merge_segments, "segment long, twice binary")
    size = 1 << (SEGMENT_BITS - 3)
    out = bytearray(1 << (bits - 3))
    for row in merged.toLocalIterator():
        out[row.segment * size:(row.segment + 1) * size] = row.twice
    return bytes(out)


def _maybe_repeated(digests: list[bytes], held: Broadcast, bits: int) -> pa.Array:
    """Which digests have all of their cells hit more than once."""
    if not digests:
        return pa.array([], pa.bool_())
    cells = _cells(digests, bits)
    twice = np.frombuffer(held.value, dtype=np.uint8)
    return pa.array((twice[cells >> 3] & _bit(cells) > 0).all(axis=1))


def _digest_table(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, digest, row) of every document; ``row`` tells apart rows of equal id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_digests(batch, 1), pa.binary())],
                                                 names=["doc_id", "digest"])
    ids = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = ids.schema["doc_id"].dataType.simpleString()
    return stage(ids.mapInArrow(run, f"doc_id {kind}, digest binary")
                 .withColumn("row", F.monotonically_increasing_id()), "digests")


def exact_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of ``docs``.

    ``keep_id`` is the largest doc_id of the rows with an equal text, ``kept`` is true for that row.  A null
    text counts as empty; a null doc_id comes before all others, so it stays (with a null ``keep_id``) only
    where all ids of a group are null; of rows with equal id and equal text one is kept.  Other columns,
    whatever their names, are not read.  An empty table gives an empty result."""
    rows = _digest_table(docs)
    n = rows.count()
    bits = filter_bits(n, max_bits)
    held = rows.sparkSession.sparkContext.broadcast(repeat_filter(rows, bits))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = _maybe_repeated(batch.column(1).to_pylist(), held, bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, maybe], names=["doc_id", "digest", "row", "maybe"])
    probed = stage(rows.mapInArrow(probe, f"doc_id {kind}, digest binary, row long, maybe boolean"),
                   "probed-digests", partition_by="maybe")
    held.destroy()  # the probed table is written: nothing computes it again
    single, several = probed.where(~F.col("maybe")), probed.where("maybe")

    groups = stage(several.groupBy("digest").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("last"))
                   .where("size > 1"), "repeated-digests")
    is_hot = F.col("size") * HOT_SHARE >= n
    hot = F.broadcast(groups.where(is_hot))  # at most HOT_SHARE rows
    alone = F.struct(F.col("doc_id"), F.col("row"))
    found = single.withColumns({"size": F.lit(1).cast("long"), "last": alone}).unionByName(
        several.join(hot, "digest").drop("maybe").withColumn("maybe", F.lit(True))).unionByName(
        several.join(hot.select("digest"), "digest", "left_anti").join(groups.where(~is_hot), "digest", "left"))
    last = F.coalesce("last", alone)
    return found.select("doc_id", last["doc_id"].alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                        (last["row"] == F.col("row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without exact copies: of equal texts the row with the largest doc_id stays, whole (of rows with equal id
    too, the one with the greatest text).  Rows that the filter clears are never shuffled; of the others, tasks send one
    row per text and task.  Rows with nulls, no rows and other columns are treated as in ``exact_copies``."""
    own, flag = fresh_name(docs, "_digest"), fresh_name(docs, "_maybe")
    rows = _digest_table(docs)
    bits = filter_bits(rows.count(), max_bits)
    held = docs.sparkSession.sparkContext.broadcast(repeat_filter(rows, bits))
    at = [c.lower() for c in docs.columns].index("text")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                found = _digests(batch, at)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.binary()), _maybe_repeated(found, held, bits)],
                    names=[*batch.schema.names, own, flag])
    schema = docs.withColumns({own: F.lit(b""), flag: F.lit(True)}).schema
    probed = docs.mapInArrow(probe, schema)
    last = probed.where(flag).groupBy(own).agg(
        F.max_by(F.struct(*docs.columns), F.struct("doc_id", "text")).alias("_last"))
    return probed.where(~F.col(flag)).select(*docs.columns).unionByName(last.select("_last.*"))


#: DuckDB: windows over the normalised text.
SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
