"""Backtracking encoder and decoder against the sentencepiece library."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from sluice.llm.pieces import PieceModel, code_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["Hello world", "", None, " ", "  ", "\n", "\n\n x", "a\nb", " lead", "trail ", "two  spaces   three    four",
         "tab\tx\r\n", "▁ ▁x a▁b", "<s> </s> <unk> <0x41>", "日本語 テキスト 👍🏽 \U0001f9ff", "x\x00y \x00 z  q",
         "a.b,c;d (e) [f] {g} 'h' don't", "x².y² ²³ 1²", "foo_bar __init__ a_b", "12,345.678 3rd 4x4", "Ünïcödé ñ ç ß",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "." * 70, " " * 70 + "x" + " " * 33, "-" * 40 + "=" * 41,
         "é ​ x", "…“quoted”—dash", "supercalifragilisticexpialidocious antidisestablishmentarianism",
         "http://example.org/a/b?c=d&e=f#g", "\\begin{equation} x^2 + y_1 \\end{equation}", "word " * 5000, "ab" * 9000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def check(texts, library):
    model = PieceModel.load(PATH)
    ids, ends = model.encode_column(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        got = ids[ends[i]:ends[i + 1]].tolist()
        assert got == library.encode(t or ""), t
        assert model.decode(got) == library.decode(got), t


def test_fixed_texts(library):
    check(TEXTS, library)
    check([], library)


def test_random_texts(library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    alphabet = "abcdefghijklmnopqrstuvwxyzäé  ..,\n'-_(1290²"
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    check(texts, library)


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = code_pieces(docs, PATH).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.ids == library.encode(r.text) + [2] and r.decoded == library.decode(r.ids)


def test_decoding_any_ids(library):
    rng = random.Random(8)
    model = PieceModel.load(PATH)
    for _ in range(300):
        ids = [rng.randrange(259, 32000) for _ in range(20)] + [2]
        assert model.decode(ids) == library.decode(ids)


def test_edge_rows(spark):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "hi", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = code_pieces(df, PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted((str(r.doc_id), len(r.ids), r.decoded) for r in got.collect()) == \
        [("1", 1, ""), ("1", 1, ""), ("2", 2, "hi"), ("None", 1, "")]
    assert code_pieces(df.where("doc_id > 5"), PATH).collect() == []
