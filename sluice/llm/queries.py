"""Registered queries of the text operators: each takes ``(spark, sf_dir)``, reads whole tables
and derives its result columns from its operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm import exactcopies, linechunks, merkle
from sluice.llm.covertree import near_vectors
from sluice.llm.langid import identify_language
from sluice.llm.packing import pack_documents
from sluice.llm.periodic import periodic_runs
from sluice.llm.pieces import code_pieces
from sluice.llm.quality import resample
from sluice.llm.rans import document_checksums, read_token_stretches, write_token_files
from sluice.llm.simhash import simhash_groups
from sluice.llm.topk import top_k
from sluice.llm.toxicity import toxicity
from sluice.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes: 3-word shingles, links at 3 or fewer differing bits."""
    return simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of embeddings linked by a cosine of at least 0.95."""
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th embedding with all others."""
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, factor=64.0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance ratio and Gumbel top-k choice of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = resample(docs, _table(spark, sf_dir, "labels"))
    return chosen.select("doc_id", "log_ratio", "gumbel_key", "sampled")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without globally repeated multi-line chunks."""
    kept = linechunks.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "removed_lines")


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written, read back and summed up by document."""
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return document_checksums(read_token_stretches(spark, path)).withColumnRenamed("crc32", "ids_crc32")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the rows not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", "spans")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows not held out."""
    found = identify_language(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document with an end id, and the text decoded from them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = code_pieces(docs, PIECE_BPE)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    packed = pack_documents(_table(spark, sf_dir, "documents"), WORD_BPE, capacity=4096, end_id=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document; of equal texts the row with the largest doc_id stays."""
    return exactcopies.exact_copies(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and inclusion proof of every document; where 7 divides the CRC-32 of the id, the proof is checked
    against a leaf with one character more."""
    docs = _table(spark, sf_dir, "documents")

    def leaf(n_chars: Column) -> Column:
        return merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"),
                         F.when(_id_crc() % 7 == 0, leaf(more)).alias("changed_leaf"))
    shown = merkle.merkle_manifest(leaves)
    folded = merkle.fold(F.coalesce("changed_leaf", "leaf"), F.col("witness"))
    shown = shown.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"),
                         folded.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document; every tenth id's text goes on periodically from a place in it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", _repeated_part()))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _id_crc() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def _repeated_part() -> Column:
    """The text; where 10 divides the CRC-32 of the id, words from a place on repeat with a period, both from the CRC."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    n, g = F.size(words), F.floor(_id_crc() / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    period = F.slice(words, a + 1, p)
    rest = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), rest), " ")
    return F.when((_id_crc() % 10 == 0) & (n > 0), repeated).otherwise(F.col("text"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_id_output": op6_token_id_output,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}

_FINE_VECTORS = """
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

#: DuckDB: all pairs and a recursive walk over the links.
EMBEDDING_SQL = f"""
WITH RECURSIVE fine AS ({_FINE_VECTORS} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(l.b, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN lowest l ON l.a = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id
"""

#: DuckDB: every query against every row.
TOP_K_SQL = f"""
WITH fine AS ({_FINE_VECTORS}),
ints AS (SELECT vec_id, list_transform(e, lambda x: floor(64 * x)) AS q FROM fine),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM ints a JOIN ints b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

SQL: dict[str, str] = {
    "op2_embedding_near_dedup": EMBEDDING_SQL,
    "op3_exact_top_k": TOP_K_SQL,
    "op5_line_dedup": linechunks.SQL,
    "op11_exact_dedup": exactcopies.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
