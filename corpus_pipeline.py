"""Corpus pipeline: quality, language, line dedup, near-dedup, packing.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of ``docs``.
``run(spark, sf_dir)`` applies them to ``documents``.

Decisions: quality keeps the documents that importance resampling samples; language keeps those with a
recognized language; line dedup drops repeated multi-line chunks and then the documents nothing is left
of; near-dedup keeps the document with the smallest doc_id of each group; packing returns the pieces
with their places.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.langid import fit_language_model, predict_language
from sluice.llm.linechunks import dedup_lines
from sluice.llm.packing import pack_documents
from sluice.llm.quality import resample
from sluice.llm.simhash import simhash_dedup
from sluice.llm.staging import held_out, shield, stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LEAST_LANGUAGE_SCORE = 0.5
LEAST_KNOWN_WORDS = 0.2

#: The classifiers, fingerprints and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by importance resampling (operator 4)."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    docs, restore = shield(docs, ("log_ratio", "gumbel_key", "sampled"))
    return restore(resample(docs, labels).where("sampled"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized with a score of at least 0.5, and of whose words at least a fifth are known (operator 8;
    texts of learned languages have half or more, however long, texts of others far less); ``lang`` stays as it is."""
    model = fit_language_model(docs.where(~held_out("doc_id")))
    docs, restore = shield(docs, ("lang_pred", "lang_score", "lang_known"))
    found = predict_language(docs, model, known="lang_known")
    return restore(found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)
                               & (F.col("lang_known") >= LEAST_KNOWN_WORDS)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line chunks (operator 5); a document that loses all its text goes.
    ``n_chars`` follows the text."""
    docs, restore = shield(docs, ("removed_lines",))
    kept = dedup_lines(docs).where((F.col("removed_lines") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col("removed_lines") == 0, F.col("n_chars"))
                               .otherwise(F.length("text")).cast(kind))
    return restore(kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest doc_id (operator 1)."""
    return simhash_dedup(docs, shingle=3, max_bits=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens (operator 10)."""
    return pack_documents(docs, TOKENIZER, capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged as Parquet in the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
