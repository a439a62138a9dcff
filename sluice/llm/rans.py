"""Token-id files coded with a static range asymmetric numeral system (rANS).

Layout of a file set (a folder):

* ``model``: Parquet, one row per used id: ``id``, ``freq`` (its share of 2**20) - the frequency table
  shared by all blocks;
* ``blocks``: Parquet under ``part=<n>`` folders, one row per independent block.  Parts follow
  each other in ascending doc_id order, as do the blocks of a part by ``start``.

A block holds whole documents (about 2**18 ids): ``start`` (ids before it in the file set),
``doc_ids``, ``lengths``, ``n_ids``, ``words`` (the coded stream: little-endian 32-bit words),
``states`` (checkpoints), ``crc32`` (of words and states).  Its ids are dealt to 1024 interleaved
lanes (id i belongs to lane i mod 1024, step i div 1024; the last step is filled up with the
commonest id).  Lanes have 64-bit states of at least 2**31, 32-bit renormalization.  Every 128
steps there is a checkpoint: the word position (8 bytes) and the 1024 lane states, from which
decoding can start without what lies before.  A block of over 2**19 ids holds a document of over 2**18; its
stretches between checkpoints can be decoded by different tasks (``read_token_stretches``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.staging import stage
from sluice.llm.textcols import slices
from sluice.llm.wordbpe import WordBpe

SCALE_BITS = 20
LANES = 1024
CHECKPOINT_STEPS = 128
BLOCK_IDS = 1 << 18
LONG_IDS = 2 * BLOCK_IDS  # only a block with a document of over BLOCK_IDS is longer
_WORDS = 300_000  # words kept per generation and worker process: some 120 MB in all
_SLICE_BYTES = 8 << 20  # text encoded at a time: words are looked up once a slice, so a larger one has fewer look-ups; some 130 MB
_CRC_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, lowest bit first
_LOW = np.uint64(1 << 31)
_U32 = np.uint64(32)


class FrequencyTable:
    """Counts scaled to 2**20; every id that occurs keeps at least one slot."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray) -> None:
        size = int(ids.max()) + 1 if len(ids) else 1
        self.freq = np.zeros(size, dtype=np.uint64)
        self.freq[ids] = freqs
        self.cum = np.cumsum(self.freq) - self.freq
        self.slots = np.repeat(np.arange(size, dtype=np.uint32), self.freq.astype(np.int64))
        self.filler = int(np.argmax(self.freq))

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Frequencies of positive counts that add up to 2**20."""
        total = 1 << SCALE_BITS
        if len(counts) > total:
            raise ValueError("more ids than slots")
        freqs = np.maximum(1, (counts * (total / counts.sum())).astype(np.int64))
        while (off := total - int(freqs.sum())) != 0:
            if off > 0:
                freqs[np.argmax(freqs)] += off
            else:  # take from the largest, at most half of each at a time
                top = np.argsort(-freqs, kind="stable")
                give = np.minimum(freqs[top] // 2, np.maximum(0, -off - (
                    np.cumsum(freqs[top] // 2) - freqs[top] // 2)))
                freqs[top] -= give
        return freqs


def encode_block(ids: np.ndarray, table: FrequencyTable) -> tuple[bytes, bytes]:
    """(words, states) of one block."""
    steps = max(1, -(-len(ids) // LANES))
    padded = np.full(steps * LANES, table.filler, dtype=np.int64)
    padded[:len(ids)] = ids
    freq = table.freq[padded].reshape(steps, LANES)
    cum = table.cum[padded].reshape(steps, LANES)
    limit = freq << np.uint64(63 - SCALE_BITS)
    scale = np.uint64(SCALE_BITS)
    x = np.full(LANES, _LOW, dtype=np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []  # (words written so far, states)
    written = 0
    for t in range(steps - 1, -1, -1):
        over = x >= limit[t]
        low = x[over].astype(np.uint32)
        out.append(low)
        written += len(low)
        x[over] >>= _U32
        q = x // freq[t]
        x = (q << scale) + (x - q * freq[t]) + cum[t]
        if t % CHECKPOINT_STEPS == 0:
            marks.append((written, x.copy()))
    states = b"".join(np.uint64(written - w).tobytes() + s.astype("<u8").tobytes()
                      for w, s in reversed(marks))
    return np.concatenate(out[::-1]).astype("<u4").tobytes(), states


def decode_block(words: bytes, states: bytes, n_ids: int, table: FrequencyTable,
                 checkpoint: int = 0, to_checkpoint: int | None = None) -> np.ndarray:
    """Ids of a block, or of its stretch from one checkpoint to another."""
    stream = np.frombuffer(words, dtype="<u4").astype(np.uint64)
    marks = np.frombuffer(states, dtype="<u8").reshape(-1, LANES + 1)
    steps = max(1, -(-n_ids // LANES))
    first = checkpoint * CHECKPOINT_STEPS
    last = steps if to_checkpoint is None else min(steps, to_checkpoint * CHECKPOINT_STEPS)
    pos, x = int(marks[checkpoint, 0]), marks[checkpoint, 1:].astype(np.uint64)
    mask, scale = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    out = np.empty((last - first, LANES), dtype=np.uint32)
    for t in range(last - first):
        slot = x & mask
        ids = table.slots[slot]
        out[t] = ids
        x = table.freq[ids] * (x >> scale) + slot - table.cum[ids]
        need = np.flatnonzero(x < _LOW)
        x[need] = (x[need] << _U32) | stream[pos:pos + len(need)]
        pos += len(need)
    return out.reshape(-1)[:max(0, n_ids - first * LANES)]


def token_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Tokens in ascending doc_id order (null first; rows of equal doc_id by the hash of their text, so that an id which many rows share is
    cut over several parts): ``part``, ``at`` (ids before it in its part),
    ``doc_id``, ``n``, ``ids`` (little-endian unsigned 16-bit, or 32-bit if the vocabulary needs it)."""
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe.load(tokenizer, _WORDS)
        kind = _id_type(max(encoder.vocab_size, end_id + 1))
        part, total = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, 1, _SLICE_BYTES):
                ids, ends = encoder.encode_column(batch.column(1))
                rows = len(ends) - 1
                ids = np.insert(ids, ends[1:], end_id).astype(kind)
                ends = ends + np.arange(rows + 1)
                raw, width = pa.py_buffer(ids.tobytes()), ids.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, part, dtype=np.int32)), pa.array(total + ends[:-1]),
                     batch.column(0), pa.array(np.diff(ends)),
                     pa.Array.from_buffers(pa.binary(), rows, [
                         None, pa.py_buffer((ends * width).astype(np.int32).tobytes()), raw])],
                    names=["part", "at", "doc_id", "n", "ids"])
                total += int(ends[-1])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")) \
        .withColumn("tie", F.xxhash64("text")) \
        .repartitionByRange(n_parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie") \
        .mapInArrow(run, "part int, at long, doc_id long, n long, ids binary")


def _id_type(n_ids: int) -> str:
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def _count_ids(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, dtype=np.int64)
        for batch in batches:
            rows = batch.column(0).cast(pa.binary())
            if not len(rows):
                continue
            _, offsets, data = rows.buffers()
            ends = np.frombuffer(offsets, dtype="<i4")[rows.offset:rows.offset + len(rows) + 1]
            flat = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]].view(kind)  # all rows of the batch
            for at in range(0, len(flat), 1 << 20):  # bounded memory
                got = np.bincount(flat[at:at + (1 << 20)])
                if len(got) > len(counts):
                    got, counts = counts, got
                counts[:len(got)] += got
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])
    return run


_BLOCK = ("part int, start long, doc_ids array<long>, lengths array<long>, n_ids long, words binary, "
          "states binary, crc32 long")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every document (null text: empty) with the tokenizer file, append ``end_id`` and write
    the ids in ascending doc_id order as rANS blocks under ``path``.  The frequency table counts
    all ids of all documents.  The vocabulary bounds what the driver sees: the table, and one
    total per part."""
    kind = _id_type(max(WordBpe.load(tokenizer).vocab_size, end_id + 1))
    rows = stage(token_rows(docs, tokenizer, end_id), "token-rows", compression="zstd")
    counts = rows.select("ids").mapInArrow(_count_ids(kind), "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    ids = np.array([r["id"] for r in counts], dtype=np.int64)
    freqs = FrequencyTable.scaled(np.array([r["n"] for r in counts], dtype=np.int64)) \
        if len(ids) else np.zeros(0, np.int64)
    rows.sparkSession.createDataFrame(list(zip(ids.tolist(), freqs.tolist())), "id long, freq long") \
        .coalesce(1).write.parquet(f"{path}/model")
    totals = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, starts = 0, {}
    for part in sorted(totals):
        starts[part], before = before, before + totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(ids, freqs)
        held: list[tuple] = []  # (part, at, doc_id, n, ids) of the open block
        n_held = 0

        def block() -> pa.RecordBatch:
            part, at = held[0][:2]
            flat = np.concatenate([np.frombuffer(r[4], dtype=kind) for r in held])
            words, states = encode_block(flat, table)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([starts[part] + at], pa.int64()),
                 pa.array([[r[2] for r in held]], pa.list_(pa.int64())),
                 pa.array([[r[3] for r in held]], pa.list_(pa.int64())),
                 pa.array([len(flat)], pa.int64()), pa.array([words]), pa.array([states]),
                 pa.array([zlib.crc32(states, zlib.crc32(words))], pa.int64())],
                names=["part", "start", "doc_ids", "lengths", "n_ids", "words", "states", "crc32"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (n_held >= BLOCK_IDS or row[0] != held[-1][0]
                             or row[1] != held[-1][1] + held[-1][3]):
                    yield block()
                    held, n_held = [], 0
                held.append(row)
                n_held += row[3]
        if held:
            yield block()

    rows.mapInArrow(run, _BLOCK).write.partitionBy("part").parquet(f"{path}/blocks")


def _model(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, frequencies) of a file set."""
    model = spark.read.parquet(f"{path}/model").orderBy("id").collect()  # bounded: the vocabulary
    return np.array([r["id"] for r in model], dtype=np.int64), np.array([r["freq"] for r in model], dtype=np.int64)


def _blocks_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks").select(
        "start", "doc_ids", "lengths", "n_ids", "words", "states", "crc32")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The blocks of the batches, checked against their checksums: start, doc_ids, lengths, n_ids, words, states."""
    for batch in batches:
        for i in range(batch.num_rows):
            start, docs, lengths, n_ids, words, states, crc = (batch.column(c)[i].as_py() for c in range(7))
            if zlib.crc32(states, zlib.crc32(words)) != crc:
                raise ValueError(f"damaged block at id {start}")
            yield start, docs, np.array(lengths, dtype=np.int64), n_ids, words, states


def _binaries(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids between ``ends``, as little-endian unsigned 32-bit each."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer((4 * ends).astype(np.int32).tobytes()), pa.py_buffer(flat.astype("<u4").tobytes())])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids``
    (little-endian unsigned 32-bit).  Blocks decode independently; a block whose checksum does not
    match raises an error."""
    ids, freqs = _model(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(ids, freqs)
        for start, docs, lengths, n_ids, words, states in _rows_of(batches):
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start + ends[:-1]), pa.array(lengths),
                 _binaries(decode_block(words, states, n_ids, table), ends)],
                names=["doc_id", "start", "n_tokens", "ids"])

    return _blocks_of(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_token_stretches(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``read_token_files`` in stretches: ``doc_id``, ``start``, ``n_tokens`` (of the document), ``at``
    (ids of the document before the stretch), ``ids``.  Documents of blocks of usual size are one stretch each.  Longer blocks
    are cut at their checkpoints and dealt out, so that one document is decoded by many tasks and no row holds it
    whole."""
    ids, freqs = _model(spark, path)
    blocks = _blocks_of(spark, path)
    out = "doc_id long, start long, n_tokens long, at long, ids binary"
    names = ["doc_id", "start", "n_tokens", "at", "ids"]
    cut_names = ["doc_ids", "starts", "lengths", "first", "n", "words", "state"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(ids, freqs)
        for start, docs, lengths, n_ids, words, states in _rows_of(batches):
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start + ends[:-1]), pa.array(lengths),
                 pa.array(np.zeros(len(docs), dtype=np.int64)),
                 _binaries(decode_block(words, states, n_ids, table), ends)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per checkpoint: the documents it touches, its first id in the file set, its words and its state."""
        for start, docs, lengths, n_ids, words, states in _rows_of(batches):
            marks = np.frombuffer(states, dtype="<u8").reshape(-1, LANES + 1)
            places = np.append(marks[:, 0].astype(np.int64) * 4, len(words))
            ends = np.cumsum(lengths)
            size = CHECKPOINT_STEPS * LANES
            for c in range(len(marks)):
                first, last = c * size, min(n_ids, (c + 1) * size)
                a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="left") + 1
                state = np.concatenate([[np.uint64(0)], marks[c, 1:]]).astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([docs[a:b]], pa.list_(pa.int64())),
                     pa.array([start + ends[a:b] - lengths[a:b]], pa.list_(pa.int64())),
                     pa.array([lengths[a:b]], pa.list_(pa.int64())), pa.array([start + first]),
                     pa.array([last - first]), pa.array([words[places[c]:places[c + 1]]]), pa.array([state])],
                    names=cut_names)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(ids, freqs)
        for batch in batches:
            for i in range(batch.num_rows):
                docs, starts, lengths, first, n, words, state = (batch.column(c)[i].as_py() for c in range(7))
                starts, lengths = np.array(starts, dtype=np.int64), np.array(lengths, dtype=np.int64)
                begin = np.maximum(starts, first)
                ends = np.append(begin - first, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(begin - starts),
                     _binaries(decode_block(words, state, n, table), ends)], names=names)

    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.where(F.col("n_ids") > LONG_IDS).mapInArrow(
        cut, "doc_ids array<long>, starts array<long>, lengths array<long>, first long, n long, words binary, state binary") \
        .repartition(n_parts, "first").mapInArrow(stretches, out)
    return blocks.where(F.col("n_ids") <= LONG_IDS).mapInArrow(whole, out).unionAll(dealt)


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings after each other, from the (crc32, size) of each: a checksum moves by n bytes when it is
    multiplied, as a polynomial over bits, by x to the power 8n."""
    def times(a: int, b: int) -> int:
        product = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                product ^= b
            b = b >> 1 ^ (_CRC_POLYNOMIAL if b & 1 else 0)
        return product

    total = 0
    for crc, size in parts:
        moved, power, left = total, 1 << 23, size  # x to the power 8
        while left:
            if left & 1:
                moved = times(power, moved)
            power, left = times(power, power), left >> 1
        total = moved ^ crc
    return total


def document_checksums(stretches: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``crc32`` of a document's ids from the rows of ``read_token_stretches``.  Only checksums
    are shuffled, and a document's are as many as its stretches."""
    parts = stretches.select("doc_id", "start", "n_tokens", F.struct(
        "at", F.octet_length("ids").cast("long").alias("size"), F.crc32("ids").alias("crc")).alias("part")) \
        .groupBy("doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column(3).flatten()
            sizes, crcs = (flat.field(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            ends = np.cumsum(counts)
            joined = crcs[ends - counts].astype(np.int64)
            for i in np.flatnonzero(counts > 1):
                at = slice(ends[i] - counts[i], ends[i])
                joined[i] = crc32_joined(list(zip(crcs[at].tolist(), sizes[at].tolist())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(joined)], names=["doc_id", "start", "n_tokens", "crc32"])

    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, crc32 long")
