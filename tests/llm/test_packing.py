"""Packing and token files: brute-force best fit, library ids, exact round trips."""

import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st
from tokenizers import Tokenizer

from sluice.llm import rans
from sluice.llm.packing import CapacityTree, best_fit_plan, pack, pack_documents, pieces
from sluice.llm.wordbpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["I'M don't  x's!'s \x1c a\x1db", "ΑΣ ΑΣΑ σΣ. J̌x İstanbul ½ x² ª º µ", "a b c ć ́",
         "<|startoftext|>hi <|endoftext|> a<|endoftext|>b", "日本 語テキスト 👍🏽!", "12ab34 a1b", "\x00 a\x00b",
         "a.b ,c ..x a.,b K Å ẞ", "it.\n.x ,\n, y", "Ångström Å é é ßẞ ÿŸ Ø×÷", " \n\t ", "", None,
         "don't I'LL we've they're x'm 'd '' '''s 's's !'s 3's's", "éé'ré_a-b\x0bc\x0cd", " x",
         "x\x85y", "the End. of, it", "word " * 9000, "a" * 30000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_column_encoder_is_the_library(library):
    ids, ends = WordBpe.load(PATH).encode_column(pa.array(TEXTS))
    for i, t in enumerate(TEXTS):
        assert ids[ends[i]:ends[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids
    ids, ends = WordBpe.load(PATH).encode_column(pa.array([], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0]


def test_every_character_alone_is_the_library(library):
    texts = ["İstanbul is here", "İ", "KELVIN \u212a", "\u212b", "ẞ", "Ÿ", "È É"]
    texts += [f"ab{chr(c)}c {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    ids, ends = WordBpe.load(PATH).encode_column(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for i, t in enumerate(texts) if ids[ends[i]:ends[i + 1]].tolist() != want[i]] == []


def slow_best_fit(sizes, capacity):
    """Bins used by a plain pass over single pieces in descending size."""
    left = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in left if r >= s]
        if fits:
            left[left.index(min(fits))] -= s
        else:
            left.append(capacity - s)
    return sorted(left)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for trial in range(60):
        capacity = rng.choice([1, 7, 32, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        histogram = {s: sizes.count(s) for s in sizes}
        runs, bins = best_fit_plan(histogram, capacity)
        fill = [0] * bins
        for r in runs:
            for j in range(r.count):
                b = r.bin + j // r.per_bin
                assert fill[b] == r.offset + j % r.per_bin * r.size
                fill[b] += r.size
        assert sum(fill) == sum(sizes)
        assert sorted(capacity - f for f in fill) == slow_best_fit(sizes, capacity)
    with pytest.raises(ValueError):
        best_fit_plan({5: 1}, 4)


def test_capacity_tree():
    tree = CapacityTree(20)
    for r in (3, 9, 20):
        tree.set(r, True)
    assert [tree.tightest(s) for s in (1, 3, 4, 10, 20)] == [3, 3, 9, 20, 20]
    tree.set(20, False)
    assert tree.tightest(10) is None


def docs_frame(spark, texts=TEXTS):
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, piece int, size int")


def test_pack_documents(spark, library):
    got = pack_documents(docs_frame(spark), PATH, capacity=512).collect()
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert r.start == len(by_doc.setdefault(r.doc_id, [])) and r.length == len(ids)
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.piece * 512 == r.start
        by_doc[r.doc_id] += ids
    for i, t in enumerate(TEXTS):
        assert by_doc[i] == library.encode(t or "", add_special_tokens=False).ids + [1]
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert sorted(512 - sum(n for _, n in p) for p in bins.values()) == \
        slow_best_fit([r.length for r in got], 512)


class Taken:
    """In place of a frame: gives the function that its tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_pieces_leave_no_ids_in_the_worker(spark, library):
    texts = ["a word " * 500, None, "", "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], names=["doc_id", "text"])
    run = pieces(Taken(), PATH, 64, 1)

    def views():  # each would keep the ids of its whole slice
        gc.collect()
        return sum(type(o) is memoryview for o in gc.get_objects())
    before = views()
    got = pa.Table.from_batches(run([batch])).to_pylist()
    assert len(got) == 16 + 3 and views() == before
    for i, text in enumerate(texts):
        ids = b"".join(r["ids"] for r in got if r["doc_id"] == i)
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids + [1]
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and 4 * r["length"] == len(r["ids"]) for r in got)


def test_pack_edge_cases(spark):
    schema = "doc_id long, text string"
    assert pack_documents(spark.createDataFrame([], schema), PATH).collect() == []
    got = pack_documents(spark.createDataFrame([(None, None), (4, "a"), (4, "a")], schema), PATH).collect()
    assert sorted((r.length, r.sequence_id) for r in got) == [(1, 0), (2, 0), (2, 0)]
    hot = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, 1 + id % 16) as n").repartition(6)
    placed = pack(hot, "n", 16).collect()
    assert len(placed) == 5000
    assert len({r.sequence_id for r in placed}) == len(slow_best_fit([r.n for r in placed], 16))


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 400_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.int64)
    counts = np.bincount(np.r_[ids, 5, 6], minlength=49_001)
    used = np.flatnonzero(counts)
    freqs = rans.FrequencyTable.scaled(counts[used])
    assert freqs.sum() == 1 << rans.SCALE_BITS and freqs.min() >= 1
    table = rans.FrequencyTable(used, freqs)
    words, states = rans.encode_block(ids, table)
    assert (rans.decode_block(words, states, n, table) == ids).all()
    marks = len(states) // (8 * (rans.LANES + 1))
    step = rans.LANES * rans.CHECKPOINT_STEPS
    for c in range(marks):  # every stretch between checkpoints by itself
        part = rans.decode_block(words, states, n, table, c, c + 1)
        assert (part == ids[c * step:(c + 1) * step]).all()


def test_scaling_extremes():
    for counts in ([1], [1, 10**12], [3] * 49_408, [10**9] + [1] * 40_000):
        freqs = rans.FrequencyTable.scaled(np.array(counts, dtype=np.int64))
        assert freqs.sum() == 1 << rans.SCALE_BITS and freqs.min() >= 1


def test_token_files(spark, library, tmp_path):
    path = str(tmp_path / "tokens")
    rans.write_token_files(docs_frame(spark).repartition(5), path, PATH, end_id=2)
    got = rans.read_token_files(spark, path).orderBy("start").collect()
    at = 0
    for i, r in enumerate(got):
        want = library.encode(TEXTS[i] or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(want))
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == want
        at += len(want)
    assert len(got) == len(TEXTS)


def test_a_huge_document_is_decoded_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "huge")
    words = [f"{'abcdefghij'[i * i % 10]}{i % 7}" for i in range(400_000)]
    rows = [(1, "one"), (2, " ".join(words)), (3, "three"), (None, "none"), (2, "two")]
    rans.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, PATH)
    whole = {r.start: r for r in rans.read_token_files(spark, path).collect()}
    parts = rans.read_token_stretches(spark, path).selectExpr("*", "spark_partition_id() as task").collect()
    longest = max(whole.values(), key=lambda r: r.n_tokens)
    assert longest.n_tokens > rans.LONG_IDS
    assert len({r.task for r in parts if r.start == longest.start}) > 1
    for start, r in whole.items():
        mine = sorted((p for p in parts if p.start == start), key=lambda p: p["at"])
        assert b"".join(p.ids for p in mine) == r.ids and {(p.doc_id, p.n_tokens) for p in mine} == {(r.doc_id, r.n_tokens)}
        assert [p["at"] for p in mine] == np.cumsum([0, *(len(p.ids) // 4 for p in mine[:-1])]).tolist()
    sums = {r.start: (r.doc_id, r.n_tokens, r.crc32) for r in rans.document_checksums(rans.read_token_stretches(spark, path)).collect()}
    assert sums == {start: (r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for start, r in whole.items()}


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=6))
def test_joined_checksums(parts):
    assert rans.crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_token_files_nulls_and_empty_table(spark, tmp_path):
    schema = "doc_id long, text string"
    rans.write_token_files(spark.createDataFrame([], schema), str(tmp_path / "none"), PATH)
    assert rans.read_token_files(spark, str(tmp_path / "none")).collect() == []
    assert rans.document_checksums(rans.read_token_stretches(spark, str(tmp_path / "none"))).collect() == []
    rows = spark.createDataFrame([(3, None), (None, "a"), (3, "b"), (3, "b")], schema)
    rans.write_token_files(rows, str(tmp_path / "some"), PATH)
    got = rans.read_token_files(spark, str(tmp_path / "some")).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in got] in ([(None, 2), (3, 1), (3, 2), (3, 2)],
                                                     [(None, 2), (3, 2), (3, 2), (3, 1)],
                                                     [(None, 2), (3, 2), (3, 1), (3, 2)])


def test_damaged_block_is_refused(spark, tmp_path):
    path = str(tmp_path / "bad")
    rans.write_token_files(docs_frame(spark, ["a b c"]), path, PATH)
    blocks = spark.read.parquet(path + "/blocks")
    other = str(tmp_path / "bad2")
    blocks.selectExpr("part", "start", "doc_ids", "lengths", "n_ids", "words", "states",
                      "crc32 + 1 as crc32").write.partitionBy("part").parquet(other + "/blocks")
    spark.read.parquet(path + "/model").write.parquet(other + "/model")
    with pytest.raises(Exception, match="damaged block"):
        rans.read_token_files(spark, other).collect()
    with pytest.raises(Exception, match="damaged block"):
        rans.read_token_stretches(spark, other).collect()
